"""Language-model scores by context-tree weighting over bytes.

A text becomes its words (A-Z as a-z) with one space between and a line break at the end. Each byte is eight binary
decisions, each with a tree of the ``DEPTH`` bytes before it (nearest first). A node holds how often either bit came in training and its
Krichevsky-Trofimov estimate; weighting mixes the estimates of all depths by how well each coded the training bits. A
context that training never saw takes the estimate of the longest part of it that was seen. The score is the log10
probability of the bytes, so its negative, in bits, is the code length.

Training gathers counts of all runs of ``DEPTH + 1`` bytes: combined per task, added up by a shuffle, and weighted in
groups of equal nearest two bytes. Only the two upper levels of the trees (at most 65,536 nodes each) pass through the driver.
Every distinct run of the corpus is scored once. Documents look the most frequent runs up in a table of bounded size and
join the rest by a shuffle. Words of the base score go the same way: those frequent in a bounded sample are counted in
place, all others by a shuffle; the sample decides where a word is counted, never how often.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dupelens.llm.tables import keep, most_frequent, texts, tidy
from dupelens.llm.words import IS_WORD, LOWER, chunks, mixed, powers, utf8, word_spans

DEPTH = 5
GROUPED = 2
HEAD_WORDS = 1 << 17
HEAD_RUNS = 1 << 19
TABLE_BITS = 21
SECOND = np.uint64(0x94D049BB133111EB)
SAMPLE = 10_000
#: Byte runs that a task holds before it adds them up, and distinct ones before it hands them to the shuffle.
MERGE = 1_000_000
FLUSH = 500_000
SPACE, END = 32, 10
RUN, HEAD, TAIL, TOTAL = range(4)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is left out of training: CRC-32 of its id as text, modulo 5, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 1, F.lit(False))


def canonical(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that are modelled, and where those of each row begin. A row without words is its end alone."""
    n = len(rows) - 1
    empty = np.flatnonzero(rows[:-1] == rows[1:])
    at = np.searchsorted(rows[1:], np.arange(len(starts)), "right")
    order = np.argsort(np.concatenate([at, empty]), kind="stable")
    begin = np.concatenate([starts, np.zeros(len(empty), np.int64)])[order]
    size = np.concatenate([ends - starts, np.zeros(len(empty), np.int64)])[order] + 1
    owner = np.concatenate([at, empty])[order]
    until = np.cumsum(size)
    total = int(until[-1]) if len(until) else 0
    source = np.arange(total) + np.repeat(begin - (until - size), size)
    out = data[np.minimum(source, max(len(data) - 1, 0))] if len(data) else np.zeros(total, np.uint8)
    out[until - 1] = SPACE
    last = np.searchsorted(owner, np.arange(n), "right") - 1
    out[until[last] - 1] = END
    return out, np.concatenate([[0], until[last]]).astype(np.int64)


def byte_runs(out: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each byte the ``DEPTH`` bytes before it, nearest first, and the byte itself, as one number."""
    place = np.arange(len(out)) - np.repeat(at[:-1], np.diff(at))
    code = out.astype(np.uint64)
    for k in range(1, DEPTH + 1):
        before = np.full(len(out), END, np.uint64)
        before[k:] = out[:-k]
        before[place < k] = END
        code |= before << np.uint64(8 * (DEPTH + 1 - k))
    return code


def prepared(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By chunk of rows: first and last row, word hashes with the first word of each row, byte runs with their begins."""
    raw, at = utf8(column)
    for first, last in chunks(at):
        part = at[first : last + 1]
        data = LOWER[raw[part[0] : part[-1]]]
        starts, ends, rows = word_spans(data, part - part[0], IS_WORD)
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        hashes = mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        out, begins = canonical(data, starts, ends, rows)
        yield first, last, hashes, rows, byte_runs(out, begins), begins


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def place_in(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key among sorted ones, -1 where it is missing."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


GATHERED = "kind int, key long, row long, n long, trained long"


def _gather(batches: Iterator[pa.RecordBatch], head: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each task the counts of byte runs and head words in training, and each other word of each row."""
    runs: tuple[list, list] = ([], [])
    words = np.zeros(len(head) + 1, np.int64)
    tokens = 0

    def rows_of(kind: int, key: np.ndarray, row: np.ndarray, n: np.ndarray, trained: np.ndarray) -> pa.RecordBatch:
        key = key.view(np.int64) if key.dtype == np.uint64 else key.astype(np.int64)
        return _batch(kind=np.full(len(key), kind, np.int32), key=key, row=row, n=n, trained=trained)

    def counted(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(key), 100_000):
            part = slice(a, a + 100_000)
            yield rows_of(RUN, key[part], np.zeros(len(key[part]), np.int64), n[part], n[part])

    for batch in batches:
        train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        row_ids = batch.column("row").to_numpy()
        for first, last, hashes, rows, codes, begins in prepared(batch.column("text")):
            learn = train[first:last]
            key, inverse = np.unique(codes, return_inverse=True)
            weight = np.repeat(learn, np.diff(begins)).astype(float)
            runs[0].append(key)
            runs[1].append(np.bincount(inverse, weight, len(key)))
            if sum(map(len, runs[0])) > MERGE:
                key, n = _summed(*runs)
                runs = ([key], [n])
                if len(key) > FLUSH:
                    yield from counted(key, n)
                    runs = ([], [])
            at = place_in(head, hashes)
            owner = np.repeat(np.arange(last - first), np.diff(rows))
            known = at >= 0
            words[:-1] += np.bincount(at[known & learn[owner]], minlength=len(head))
            words[-1] += int(learn.sum())
            tokens += int(np.diff(rows)[learn].sum() + learn.sum())
            other, other_owner = hashes[~known], owner[~known]
            pieces = [np.unique(other[a:b], return_counts=True) for a, b in _bounds(other_owner, last - first)]
            key = np.concatenate([*(p[0] for p in pieces), np.zeros(0, np.uint64)])
            n = np.concatenate([*(p[1] for p in pieces), np.zeros(0, np.int64)]).astype(np.int64)
            mine = np.repeat(np.arange(last - first), [len(p[0]) for p in pieces])
            yield rows_of(TAIL, key, row_ids[first:last][mine], n, np.where(learn[mine], n, 0))
    if runs[0]:
        yield from counted(*_summed(*runs))
    some = np.flatnonzero(words)
    yield rows_of(HEAD, some, np.zeros(len(some), np.int64), words[some], words[some])
    one = np.array([tokens], np.int64)
    yield rows_of(TOTAL, np.zeros(1, np.int64), np.zeros(1, np.int64), one, one)
    tidy()


def _bounds(owner: np.ndarray, n: int) -> list[tuple[int, int]]:
    at = np.searchsorted(owner, np.arange(n + 1))
    return list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


_HALF = np.array([math.lgamma(k + 0.5) for k in range(2048)])
_WHOLE = np.array([math.lgamma(k + 1.0) for k in range(2048)])


def _log_gamma(n: np.ndarray, shift: float, table: np.ndarray) -> np.ndarray:
    x = np.maximum(n + shift, 1e-9)
    out = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x)
    small = n < len(table)
    out[small] = table[n[small].astype(np.int64)]
    return out


def kt_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability that the estimator gives to a zeros and b ones."""
    return _log_gamma(a, 0.5, _HALF) + _log_gamma(b, 0.5, _HALF) - math.log(math.pi) - _log_gamma(a + b, 1.0, _WHOLE)


class Level:
    """Nodes of one depth: sorted keys (context, bits so far), counts of either bit, log weighted probability, and the
    share of the node's own estimate in the mix."""

    def __init__(self, key: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None):
        own = kt_block(a, b)
        self.key, self.a, self.b = key, a, b
        self.log = own if below is None else math.log(0.5) + np.logaddexp(own, below)
        self.share = np.ones(len(key)) if below is None else np.exp(math.log(0.5) + own - self.log)

    def up(self) -> Level:
        """The level above, of contexts one byte shorter."""
        key, at = np.unique(((self.key >> np.uint64(16)) << np.uint64(8)) | (self.key & np.uint64(255)), return_inverse=True)
        return Level(key, *(np.bincount(at, v, len(key)) for v in (self.a, self.b, self.log)))


def _decisions(byte: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the eight bits of a byte: the bits before it (with a leading one), and the bit."""
    whole = byte.astype(np.int64) | 256
    for k in range(8):
        yield (whole >> (8 - k)).astype(np.uint64), (whole >> (7 - k)) & 1


def tree(codes: np.ndarray, n: np.ndarray, top: int) -> list[Level]:
    """Levels ``DEPTH`` to ``top`` over trained byte runs."""
    context, byte = codes >> np.uint64(8), codes & np.uint64(255)
    keys, bits = zip(*(((context << np.uint64(8)) | u, bit) for u, bit in _decisions(byte)), strict=True)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    bit, weight = np.concatenate(bits), np.tile(n.astype(float), 8)
    levels = [Level(key, np.bincount(at, weight * (bit == 0), len(key)), np.bincount(at, weight * bit, len(key)), None)]
    for _ in range(DEPTH - top):
        levels.append(levels[-1].up())
    return levels


def log_probability(codes: np.ndarray, levels: list[Level]) -> np.ndarray:
    """Log10 probability of the last byte of each run given the bytes before it, under levels from deepest to root."""
    context, byte = codes >> np.uint64(8), codes & np.uint64(255)
    out = np.zeros(len(codes))
    for u, bit in _decisions(byte):
        mix = np.full(len(codes), np.nan)
        for above, level in enumerate(levels):
            at = place_in(level.key, ((context >> np.uint64(8 * above)) << np.uint64(8)) | u)
            seen = at >= 0
            if not seen.any():
                continue
            a, b, share = level.a[at], level.b[at], level.share[at]
            own = np.where(bit == 1, b + 0.5, a + 0.5) / (a + b + 1)
            mix = np.where(seen, np.where(np.isnan(mix), own, share * own + (1 - share) * mix), np.nan)
        out += np.log10(np.where(np.isnan(mix), 0.5, mix))
    return out


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()


def _group_roots(table: pa.Table) -> pa.Table:
    """The uppermost level that a group of runs with equal nearest bytes holds."""
    codes, n = _arrays(table)
    level = tree(codes[n > 0], n[n > 0], GROUPED)[-1] if (n > 0).any() else None
    if level is None:
        return pa.table({"key": pa.array([], pa.int64()), **{c: pa.array([], pa.float64()) for c in ("a", "b", "log")}})
    return pa.table({"key": level.key.view(np.int64), "a": level.a, "b": level.b, "log": level.log})


def upper_levels(runs: DataFrame) -> list[Level]:
    """The levels above the groups: at most 65,536 nodes with one byte of context, and 256 with none."""
    roots = runs.groupBy("nearest").applyInArrow(_group_roots, "key long, a double, b double, log double")
    short = F.shiftleft(F.shiftright("key", 16), 8).bitwiseOR(F.col("key").bitwiseAND(F.lit(255)))
    sums = roots.groupBy(short.alias("key")).agg(*(F.sum(c).alias(c) for c in ("a", "b", "log"))).orderBy("key").toArrow()
    key, a, b, log = (sums.column(c).to_numpy() for c in ("key", "a", "b", "log"))
    first = Level(key.astype(np.uint64), a, b, log)
    return [first, first.up()]


def scored_runs(runs: DataFrame) -> DataFrame:
    """``(key, n, p)``: each distinct run with its count in training and its log10 probability."""
    upper = upper_levels(runs)

    def score(table: pa.Table) -> pa.Table:
        codes, n = _arrays(table)
        levels = tree(codes[n > 0], n[n > 0], GROUPED) if (n > 0).any() else []
        if not levels:
            levels = [Level(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), None)] * (DEPTH - GROUPED + 1)
        return pa.table({"key": codes.view(np.int64), "n": n, "p": log_probability(codes, [*levels, *upper])})

    return runs.groupBy("nearest").applyInArrow(score, "key long, n long, p double")


class RunTable:
    """A table of bounded size from byte runs to log probabilities. Runs come by falling frequency; each has two slots, and
    only a rare one that finds both taken is not in the table."""

    def __init__(self, keys: np.ndarray, p: np.ndarray):
        self.keys = np.full(1 << TABLE_BITS, np.iinfo(np.uint64).max, np.uint64)
        self.p = np.zeros(1 << TABLE_BITS)
        for turn in (0, 1):
            slot = self.slot(keys, turn)
            free, first = np.unique(slot, return_index=True)
            first = first[self.keys[free] == np.iinfo(np.uint64).max]
            self.keys[slot[first]], self.p[slot[first]] = keys[first], p[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, p = keys[left], p[left]

    @staticmethod
    def slot(keys: np.ndarray, turn: int) -> np.ndarray:
        return (mixed(keys ^ SECOND if turn else keys) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is not in the table."""
        slot = self.slot(keys, 0)
        missed = np.flatnonzero(self.keys[slot] != keys)
        slot[missed] = self.slot(keys[missed], 1)
        missed = missed[self.keys[slot[missed]] != keys[missed]]
        slot[missed] = -1
        return slot


SCORED = "row long, doc_id long, held_out boolean, tokens long, known long, base double, score double, key long, n long"


def _score(batches: Iterator[pa.RecordBatch], head: np.ndarray, counts: np.ndarray, table: RunTable) -> Iterator[pa.RecordBatch]:
    """Of each row what the two head tables tell, and a row for each other byte run."""
    logs = np.log10(counts + 0.5)
    for batch in batches:
        row_ids = batch.column("row").to_numpy()
        for first, last, hashes, rows, codes, begins in prepared(batch.column("text")):
            size = last - first
            at = place_in(head, hashes)
            owner = np.repeat(np.arange(size), np.diff(rows))
            found = at >= 0
            base = np.bincount(owner[found], logs[at[found]], size) + logs[-1]
            known = np.bincount(owner[found], counts[at[found]] > 0, size) + (counts[-1] > 0)
            slot = table.places(codes)
            hit = slot >= 0
            byte_owner = np.repeat(np.arange(size), np.diff(begins))
            score = np.bincount(byte_owner[hit], table.p[slot[hit]], size)
            ids = pa.array(row_ids[first:last])
            none = pa.nulls(size, pa.int64())
            names = [c.split()[0] for c in SCORED.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    batch.column("doc_id").slice(first, size),
                    batch.column("held_out").slice(first, size),
                    pa.array((np.diff(rows) + 1).astype(np.int64)),
                    pa.array(known.astype(np.int64)),
                    pa.array(base),
                    pa.array(score),
                    none,
                    none,
                ],
                names=names,
            )
            rest, rest_owner = codes[~hit], byte_owner[~hit]
            if len(rest):
                order = np.lexsort((rest, rest_owner))
                rest, rest_owner = rest[order], rest_owner[order]
                new = np.flatnonzero(np.r_[True, (rest[1:] != rest[:-1]) | (rest_owner[1:] != rest_owner[:-1])])
                n = np.diff(np.r_[new, len(rest)])
                m = len(new)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row_ids[first:last][rest_owner[new]]),
                        pa.nulls(m, pa.int64()),
                        pa.nulls(m, pa.bool_()),
                        pa.nulls(m, pa.int64()),
                        pa.nulls(m, pa.int64()),
                        pa.nulls(m, pa.float64()),
                        pa.nulls(m, pa.float64()),
                        pa.array(rest[new].view(np.int64)),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=names,
                )
    tidy()


def head_words(source: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent words of a bounded sample of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for batch in batches:
            for _, _, hashes, _, _, _ in prepared(batch.column("text")):
                key, n = np.unique(hashes, return_counts=True)
                keys.append(key)
                counts.append(n)
        if keys:
            key, n = _summed(keys, counts)
            yield _batch(key=key.view(np.int64), n=n)

    rows = max(1, source.count())
    sample = source.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, rows // SAMPLE))) == 0)
    counts = sample.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    common = most_frequent(keep(counts, "sampled-words"), "n", HEAD_WORDS)
    keys = common.select("key").toArrow().column("key").to_numpy()
    return np.sort(keys.view(np.uint64))


def scores(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Null and empty texts, and texts without words, are one end token. Without training rows nothing is known: each bit
    has probability one half. Repeated rows count in training each and give a row each; an empty table gives an empty result.
    """
    source = texts(docs).select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text", held_out().alias("held_out"))
    head = head_words(source)
    gathered = keep(source.mapInArrow(lambda b: _gather(b, head), GATHERED), "gathered")

    nearest = F.shiftright("key", 8 * (DEPTH + 1 - GROUPED)).cast("int")
    runs = gathered.where(F.col("kind") == RUN).groupBy("key").agg(F.sum("trained").alias("n"))
    scored = keep(scored_runs(keep(runs.withColumn("nearest", nearest), "runs")), "scored-runs")
    top = most_frequent(scored, "n", HEAD_RUNS).select("key", "n", "p").toArrow()
    order = np.argsort(-top.column("n").to_numpy(), kind="stable")
    table = RunTable(top.column("key").to_numpy().view(np.uint64)[order], top.column("p").to_numpy()[order])

    counts = np.zeros(len(head) + 1)
    for row in gathered.where(F.col("kind") == HEAD).groupBy("key").agg(F.sum("trained").alias("n")).toArrow().to_batches():
        counts[row.column("key").to_numpy()] = row.column("n").to_numpy()
    total = gathered.where(F.col("kind") == TOTAL).agg(F.sum("trained")).first()[0] or 0
    tail = gathered.where(F.col("kind") == TAIL).select("key", "row", "n", "trained")
    learned = keep(tail.groupBy("key").agg(F.sum("trained").alias("c")), "tail-words")
    distinct = int((counts > 0).sum()) + learned.where("c > 0").count()

    found = keep(source.mapInArrow(lambda b: _score(b, head, counts, table), SCORED), "scores")
    zero = [F.lit(0).cast("long").alias(c) for c in ("tokens", "known")]
    nobody = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out")]
    tail_words = tail.join(learned, "key").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("base"),
    )
    tail_runs = (
        found.where("key is not null").select("row", "key", "n").join(scored.select("key", "p"), "key")
        .groupBy("row").agg(F.sum(F.col("n") * F.col("p")).alias("score"))
    )
    each = found.where("key is null").select("row", "doc_id", "held_out", "tokens", "known", "base", "score", F.lit(1).alias("rows"))
    each = each.union(tail_words.select("row", *nobody, zero[0], "known", "base", F.lit(0.0), F.lit(0)))
    each = each.union(tail_runs.select("row", *nobody, *zero, F.lit(0.0), "score", F.lit(0)))
    sums = each.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        *(F.sum(c).alias(c) for c in ("tokens", "known", "base", "score", "rows")),
    )
    norm = math.log10(total + 0.5 * (distinct + 1))
    one = sums.select(
        "doc_id",
        "held_out",
        F.expr("tokens div rows").alias("n_tokens"),
        F.expr("known div rows").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        ((F.col("base") - F.col("tokens") * norm) / F.col("rows")).alias("base_score"),
        (F.col("score") / F.col("rows")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"),
    )
    return one.drop("copy")
