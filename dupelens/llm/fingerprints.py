"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash below ``1 / FRACTION`` of the hash range, however long the document is, so
sketches of unequal documents compare (shares of common hashes below the threshold) and merge (union). Sets of at most
``WHOLE`` shingles are kept entirely; a comparison uses only hashes below the smaller of the two thresholds. The
fingerprint is the number of distinct shingles, ``w`` (whole) or ``s`` (scaled), and the sorted hashes in base64.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dupelens.llm.tables import texts
from dupelens.llm.words import row_shingles

WORDS = 5
FRACTION = 8
WHOLE = 128
THRESHOLD = np.uint64((1 << 64) // FRACTION)
CELL_ROWS = 1_000
MOST_CELLS = 2_000


class Sketch:
    """Number of distinct shingles, whether all are kept, and the sorted kept hashes."""

    def __init__(self, size: int, whole: bool, kept: np.ndarray):
        self.size, self.whole, self.kept = size, whole, kept

    @classmethod
    def of(cls, shingles: np.ndarray) -> Sketch:
        unique = np.unique(shingles)
        whole = len(unique) <= WHOLE
        return cls(len(unique), whole, unique if whole else unique[unique < THRESHOLD])

    @classmethod
    def read(cls, text: str) -> Sketch:
        size, kept = text.split(":", 1)
        return cls(int(size[:-1]), size[-1] == "w", np.frombuffer(base64.b64decode(kept), np.uint64))

    def write(self) -> str:
        return f"{self.size}{'w' if self.whole else 's'}:" + base64.b64encode(self.kept.tobytes()).decode()

    def common(self, other: Sketch) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of both under one threshold."""
        if self.whole and other.whole:
            return self.kept, other.kept
        return self.kept[self.kept < THRESHOLD], other.kept[other.kept < THRESHOLD]

    def likeness(self, other: Sketch) -> float:
        """Estimated Jaccard similarity; 1 for two sets without shingles."""
        if not self.size and not other.size:
            return 1.0
        a, b = self.common(other)
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both / max(1, len(a) + len(b) - both)

    def containment(self, other: Sketch) -> float:
        """Estimated share of this set that the other one holds."""
        a, b = self.common(other)
        return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else float(not self.size)

    def merge(self, other: Sketch) -> Sketch:
        """The sketch of the union; its size is exact for whole sketches and estimated otherwise."""
        kept = np.union1d(*self.common(other))
        whole = self.whole and other.whole and len(kept) <= WHOLE
        if self.whole and other.whole:
            return Sketch(len(kept), whole, kept if whole else kept[kept < THRESHOLD])
        return Sketch(len(kept) * FRACTION, False, kept)


def sketches(column: pa.Array) -> list[Sketch]:
    return [Sketch.of(s) for s in row_shingles(column, WORDS)]


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row (null text: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [s.write() for s in sketches(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def _order() -> list[Column]:
    return [F.col("doc_id").asc_nulls_first(), F.col("h")]


def with_followers(docs: DataFrame) -> DataFrame:
    """The rows dealt into cells of neighbouring ids, each cell sorted and closed by the first row of the next one.

    The last cell is closed by the first row of all. Columns: ``cell, guest (0, or 1 for the closing row), doc_id, h,
    text``; ties of ``doc_id`` are in the order of the text's hash ``h``.
    """
    rows = texts(docs).withColumn("h", F.xxhash64("text"))
    size = docs.count()
    cells = min(MOST_CELLS, size // CELL_ROWS + 1)
    bounds = docs.select(F.col("doc_id").cast("double").alias("doc_id")).approxQuantile(
        "doc_id", [i / cells for i in range(1, cells)], 0.25 / cells
    ) if cells > 1 else []
    edges = F.array(*(F.lit(int(b)) for b in sorted(set(bounds))))
    cell = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(edges, lambda b: b <= F.col("doc_id")))) if bounds else F.lit(0)
    placed = rows.withColumn("cell", cell)
    first = placed.groupBy("cell").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("i"), "h")).alias("f"))
    # At most MOST_CELLS rows of three numbers each.
    every = Window.orderBy("cell")
    heads = first.withColumn("before", F.lag("cell").over(every)).withColumn("last", F.max("cell").over(Window.partitionBy()))
    heads = heads.select(F.coalesce("before", "last").alias("cell"), F.col("f.i").alias("i"), F.col("f.h").alias("g"))
    found = rows.join(
        F.broadcast(heads), (F.coalesce("doc_id", F.lit(-(2**63))) == F.col("i")) & (F.col("h") == F.col("g"))
    ).dropDuplicates(["cell", "i", "g"])
    guests = found.select("cell", F.lit(1).alias("guest"), "doc_id", "h", "text")
    everything = placed.select("cell", F.lit(0).alias("guest"), "doc_id", "h", "text").union(guests)
    return everything.repartition("cell").sortWithinPartitions("cell", "guest", *_order())


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, follower: str) -> str:
    """The text with its last quarter replaced by as many first characters (or all) of the follower."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + follower[:quarter]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pending: tuple[int | None, int, str, Sketch] | None = None
    for whole in batches:
        for at in range(0, len(whole), 500):
            batch = whole.slice(at, 500)
            values = batch.column("text").to_pylist()
            rows = list(
                zip(batch.column("doc_id").to_pylist(), batch.column("guest").to_pylist(), values, sketches(batch.column("text")), strict=True)
            )
            line = [pending, *rows] if pending else rows
            pairs = [(a, b) for a, b in zip(line[:-1], line[1:], strict=True) if not a[1]]
            pending = line[-1]
            changed = [edited(a[2], b[2]) for a, b in pairs]
            others = sketches(pa.array(changed, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[0] for a, _ in pairs], pa.int64()),
                    pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
                    pa.array([a[3].write() for a, _ in pairs], pa.string()),
                    pa.array([o.write() for o in others], pa.string()),
                    pa.array([a[3].likeness(o) for (a, _), o in zip(pairs, others, strict=True)], pa.float64()),
                    pa.array([a[3].likeness(b[3]) for a, b in pairs], pa.float64()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see ``SCHEMA``.

    Null texts are empty. The follower of a row is the next one by ``doc_id`` (null ids first, equal ids by a hash of
    the text), of the last row the first; a single row follows itself. Repeated rows give a row each, an empty table an
    empty result. Two texts without words are alike (1).
    """
    return with_followers(docs).mapInArrow(_compared, SCHEMA)
