"""The audit of filters against walking every order over every document."""

import itertools
import re
from fractions import Fraction

from pyspark.sql import functions as F

from dupelens.llm import filter_audit
from tests.llm.cases import empty, prose


def sample():
    long, capital = prose(1, 400), prose(2, 250) + " " + "X" * 400
    out = [(0, long, "a"), (1, long, "b"), (2, long, "a"), (2, long, "a"), (3, None, "a"), (4, "", None), (5, " \n", "")]
    out += [(6, capital, "a"), (7, capital, "a"), (8, "tie " * 300, "b"), (9, "tie|" + " tie" * 300, "b"), (None, long, "a"), (None, "", "c")]
    out += [(10, "A" * 30, "c"), (10, "A" * 30, "a"), (11, prose(3, 260) + " 100%", "b"), (12, prose(4, 199), "b"), (13, prose(5, 200), "a")]
    out += [(14, "é\x0bÈ\x85x \x1c" * 120, "d"), (15, "WORD word " * 150, "d")]
    return out


def marks():
    return [(0, 1, 0), (1, 1, 1), (2, 0, 1), (6, 1, None), (6, 0, 1), (10, 1, 0), (15, None, 1), (None, 1, 1), (99, 1, 1)]


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    cases = []
    for key, text, source in rows:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": key is not None and any(k is not None and k < key and (x or "") == t for k, x, _ in rows),
        }
        cases.append((source or "", fails, key in good, key in toxic))
    out, total = {}, {}
    for part in {c[0] for c in cases}:
        own = [c for c in cases if c[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [c for c in left if c[1][f]]
                left = [c for c in left if not c[1][f]]
                redundant = sum(c[1][f] for c in own) - len(gone)
                alone = sum(c[1][f] and sum(c[1].values()) == 1 for c in own)
                out[part, "".join(order), step] = [
                    len(left), len(gone), redundant, alone, sum(c[2] for c in gone), sum(c[3] for c in gone)
                ]
                total[part, f] = total.get((part, f), 0) + len(gone)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def frames(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("mask", "digest", "part", "words", "n", "good", "quality", "toxic"):
        docs = docs.withColumn(name, F.lit("clash"))
    labels = spark.createDataFrame(marks(), "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    return docs.repartition(4), labels


def test_audit_equals_walking_all_orders(spark):
    docs, labels = frames(spark)
    found = filter_audit.audit(docs, labels)
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema) == filter_audit.RESULT.replace("long", "bigint")
    rows = found.collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows} == brute(sample(), marks())
    assert len(rows) == 600 * len({s or "" for _, _, s in sample()})


def test_shares_add_up_and_follow_the_definition():
    counts = [(0, 5), (1, 3), (3, 4), (6, 2), (7, 1)]
    removed = filter_audit.removals(counts, 3)
    shares = filter_audit.shares(removed, 3)
    # A document's removal is shared evenly by the filters that it fails.
    expected = [sum(Fraction(n, bin(m).count("1")) for m, n in counts if m >> i & 1) for i in range(3)]
    assert shares == expected and sum(shares) == removed[-1] == 10
    assert filter_audit.shares(filter_audit.removals([(1, 4)], 1), 1) == [4]


def test_empty_tables(spark):
    _, labels = frames(spark)
    assert filter_audit.audit(empty(spark), labels).count() == 0
    docs, labels = frames(spark)
    found = filter_audit.audit(docs, labels.limit(0)).agg(F.max("good_lost"), F.max("toxic_lost")).first()
    assert tuple(found) == (0, 0)


def test_duplicates_are_never_gathered(spark):
    docs, labels = frames(spark)
    plan = filter_audit.profiles(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_" not in plan
