"""Small tables with the awkward rows that every operator must take."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "ba ke li mo nu ra se ti vo wy dra flo gri plu sta tre".split()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    return WORD.findall(lower(text or ""))


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def near(text, seed, edits=1):
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng.random(), 1) + "x"
    return " ".join(words)


def rows():
    base, other = prose(1, 300), prose(2, 120)
    out = [(0, base), (1, base), (2, base.upper()), (3, near(base, 3)), (4, near(near(base, 3), 4, 2)), (5, other)]
    out += [(6, None), (7, ""), (8, "   \n\t "), (9, "one"), (10, "ONE"), (11, "one two"), (12, "one two three")]
    out += [(13, "Ünï códe — ☃ 한국어  x▁y  double"), (14, prose(14, 9000)), (15, near(other, 5, 30)), (16, "." * 50)]
    out += [(20 + i, prose(100 + i, 40 + i)) for i in range(20)]
    out += [(50 + i, near(base, 500 + i, i % 7)) for i in range(14)]
    out += [(90, "tie tie tie tie tie tie"), (91, "tie tie tie tie tie tie")]
    return out


def documents(spark, data=None, partitions=3):
    """Documents with columns whose names clash with those that operators use inside."""
    frame = spark.createDataFrame(rows() if data is None else data, "doc_id long, text string")
    for name in ("x", "n", "s", "row", "cell", "h", "unit", "value", "label", "key", "score", "size", "a", "root"):
        frame = frame.withColumn(name, F.lit("clash"))
    frame = frame.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    return frame.withColumn("n_chars", F.length("text").cast("long")).repartition(partitions)


def empty(spark):
    return documents(spark, [])
