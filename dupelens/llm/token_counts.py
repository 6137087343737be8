"""Token counts without token ids: pieces are counted once per distinct pre-token.

No piece of the vocabulary holds certain neighbouring characters, so no merge of the encoder crosses such a place and a
text may be cut there: before a space symbol that follows another character, and around line breaks (checked when the
model is loaded). What lies between two cuts is a pre-token.

Per document the frequencies of its pre-tokens are joined with the piece counts of the distinct pre-tokens. The most
frequent pre-tokens of a bounded sample, at most ``HEAD``, are counted beforehand and joined where the documents are
read, which keeps hot keys out of the shuffle. All others travel in blocks: a block is a run of documents of one task with
about ``BLOCK`` frequencies; it names each distinct pre-token once, with the places in the block of the documents that
hold it. Pre-tokens are dealt into buckets, each distinct one is counted once in the task of its bucket, and the sums of
a block go back as one list per task. So the shuffles carry a string per block and small numbers, and no task holds
more than a bucket of a few blocks.

A block is known by its task and its number there, so the documents should come from files or a written table, which a
retried task reads in the same order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dupelens.llm.sentencepiece_lattice import PART, SPACE, model_path
from dupelens.llm.tables import keep, most_frequent, texts, tidy

HEAD = 1 << 16
HEAD_CHARS = 64
SAMPLE = 10_000
LIMIT = 4096
LONGEST_CACHE = 500_000
BLOCK = 1_000_000
BUCKETS_PER_PARTITION = 4


class PieceCounter:
    """Counts the pieces of pre-tokens."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in pieces):
            raise ValueError("pieces of this model cross a space or a line break")
        # A line break in front stands apart from what follows, so the leading space symbol joins it, not the pre-token.
        self.front = len(self.model.encode("\n"))

    def counts(self, parts: list[str]) -> np.ndarray:
        found = self.model.encode([f"\n{p}" for p in parts], num_threads=1)
        return np.array([len(f) for f in found], np.int64) - self.front


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def pretokens(text: str) -> list[str]:
    return PART.findall(SPACE + text.replace(" ", SPACE)) if text else []


def head_counts(source: DataFrame, path: str, head: int = HEAD) -> dict[str, int]:
    """Piece counts of the most frequent pre-tokens of a bounded sample; it decides the plan, not the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(p for p in pretokens(text.as_py()) if len(p) <= HEAD_CHARS)
        common = seen.most_common(head)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([p for p, _ in common], pa.string()), "n": pa.array([n for _, n in common], pa.int64())}
        )

    rows = max(1, source.count())
    sample = source.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, rows // SAMPLE))) == 0)
    counts = keep(sample.mapInArrow(run, "part string, n long").groupBy("part").agg(F.sum("n").alias("n")), "pretokens")
    parts = [r["part"] for r in most_frequent(counts, "n", head).select("part").collect()]
    return dict(zip(parts, counter(path).counts(parts).tolist(), strict=True)) if parts else {}


SCHEMA = (
    "bucket long, block long, parts array<string>, uses array<int>, at array<int>, n array<long>, "
    "ids array<long>, sizes array<long>"
)
KINDS = [pa.int64(), pa.int64(), pa.list_(pa.string())] + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())] * 3
SUMS = "block long, at array<int>, n array<long>, ids array<long>, sizes array<long>"


def _batch(rows: list[tuple], schema: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in schema.split(", ")]
    )


class Block:
    """A run of documents: of each its id, size and tokens of head pre-tokens, and the frequencies of all others."""

    def __init__(self):
        self.ids, self.sizes, self.known = [], [], []
        self.codes: dict[str, int] = {}
        self.part, self.at, self.n = [], [], []

    def add(self, doc_id: int | None, text: str, head: dict[str, int]) -> None:
        known, other = 0, []
        for part in pretokens(text):
            n = head.get(part)
            if n is None:
                other.append(part)
            else:
                known += n
        for part, n in Counter(other).items():
            self.part.append(self.codes.setdefault(part, len(self.codes)))
            self.at.append(len(self.ids))
            self.n.append(n)
        self.ids.append(doc_id)
        self.sizes.append(len(text.encode()))
        self.known.append(known)

    def rows(self, block: int, buckets: int) -> Iterator[tuple]:
        """A row with the documents, and one for each bucket with its pre-tokens."""
        yield zlib.crc32(b"%d" % block) % buckets, block, None, None, None, self.known, self.ids, self.sizes
        names = list(self.codes)
        bucket = np.array([zlib.crc32(p.encode()) % buckets for p in names], np.int64)
        part, at, n = np.array(self.part, np.int64), np.array(self.at, np.int32), np.array(self.n, np.int64)
        order = np.lexsort((part, bucket[part])) if len(part) else part
        part, at, n = part[order], at[order], n[order]
        edges = np.flatnonzero(np.diff(bucket[part])) + 1 if len(part) else part
        for of, places, counts in zip(np.split(part, edges), np.split(at, edges), np.split(n, edges), strict=True):
            if len(of):
                own, uses = np.unique(of, return_counts=True)
                yield int(bucket[of[0]]), block, [names[i] for i in own], uses.astype(np.int32), places, counts, None, None


def _frequencies(batches: Iterator[pa.RecordBatch], head: dict[str, int], buckets: int) -> Iterator[pa.RecordBatch]:
    task, made, now = TaskContext.get().partitionId(), 0, Block()

    def out() -> Iterator[pa.RecordBatch]:
        rows = list(now.rows((task << 32) + made, buckets))
        for low in range(0, len(rows), 500):
            yield _batch(rows[low : low + 500], SCHEMA, KINDS)

    for batch in batches:
        for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            now.add(key, value.as_py(), head)
            if len(now.part) + len(now.ids) >= BLOCK:
                yield from out()
                made, now = made + 1, Block()
    if now.ids:
        yield from out()
    tidy()


def _weighted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Frequencies times pieces, summed up by document; each distinct pre-token of the task is counted once."""
    known: dict[str, int] = {}
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def sums() -> pa.RecordBatch:
        rows = []
        for block, pairs in held.items():
            at, inverse = np.unique(np.concatenate([p[0] for p in pairs]), return_inverse=True)
            total = np.zeros(len(at), np.int64)
            np.add.at(total, inverse, np.concatenate([p[1] for p in pairs]))
            rows.append((block, at, total, None, None))
        held.clear()
        return _batch(rows, SUMS, [pa.int64(), *KINDS[4:]])

    for batch in batches:
        base = batch.filter(batch.column("parts").is_null())
        if len(base):
            yield base.select(["block", "at", "n", "ids", "sizes"])
        for row in range(len(batch)):
            parts = batch.column("parts")[row].as_py()
            if parts is None:
                continue
            if len(known) > LONGEST_CACHE:
                known.clear()
            fresh = [p for p in parts if p not in known]
            if fresh:
                known.update(zip(fresh, counter(path).counts(fresh).tolist(), strict=True))
            pieces = np.repeat([known[p] for p in parts], batch.column("uses")[row].values.to_numpy())
            at = batch.column("at")[row].values.to_numpy().copy()
            held.setdefault(batch.column("block")[row].as_py(), []).append((at, pieces * batch.column("n")[row].values.to_numpy()))
            size += len(at)
            if size >= BLOCK:
                yield sums()
                size = 0
    if held:
        yield sums()
    tidy(known)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a block, whose rows follow each other, the one with its documents first."""
    block, ids, sizes, total = None, None, None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, sizes, pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:
        for row in range(len(batch)):
            n = batch.column("n")[row].values.to_numpy()
            if batch.column("ids")[row].is_valid:
                if block is not None:
                    yield out()
                block, ids, sizes = batch.column("block")[row].as_py(), batch.column("ids")[row].values, batch.column("sizes")[row].values
                total = n.copy()
            else:
                total[batch.column("at")[row].values.to_numpy()] += n
    if block is not None:
        yield out()
    tidy()


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of the whole text of every row.

    Null and empty texts have 0 bytes and 0 tokens. Each row gives a row, also where id and text repeat; an empty
    table gives an empty result; other columns are left out.
    """
    path = path or model_path()
    source = texts(docs)
    head = head_counts(source, path)
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = source.mapInArrow(lambda b: _frequencies(b, head, buckets), SCHEMA)
    dealt = found.repartition("bucket").mapInArrow(lambda b: _weighted(b, path), SUMS)
    joined = dealt.repartition("block").sortWithinPartitions("block", F.col("ids").isNull())
    totals = joined.mapInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")
    return totals.withColumn("over_limit", F.col("n_tokens") > limit)
