"""Similar content within duration clusters, without scoring all pairs.

A score of t means that at one offset at least a = ceil(t n) of the n places of the shorter sequence match. Of any n - a + m of
its places m are among those, whatever they are: the ones whose values are rarest among the sequences it is compared with are looked
up in the others, and only offsets at which m of them match are counted in full. No qualifying pair is missed, and none that does
not qualify is found.

**Blocks.** The sequences of a cluster travel once: a cluster of up to ``BLOCK_WORDS`` values is one group, a larger one is dealt
into blocks, of which each two meet in a group of their own. Matches are joined and counted inside a group, in pieces of
``PIECE`` matches, so what is shuffled is the content and what comes out are the pairs; matches themselves are never moved. A value
meets others within the offset window around its own place only, not all of a sequence that it fills.

**Bit errors.** With ``max_bits`` = e two 32-bit values match if at most e of their bits differ. Cut into e + 2 blocks they agree
in two blocks at least; values that agree in two blocks are compared, each distinct value once, and a place is looked up by all values
that match its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dupelens.functions.sequences import MAX_OFFSET, WORD_BITS, best_alignment
from dupelens.runtime import materialize

MAX_COMMON = 5
#: Where an order of values is asked for: contents whose values are counted, and the values that are kept of them.
SAMPLED = 20_000
FREQUENT = 262_144
#: Values of a block of sequences, and matches that are held at once.
BLOCK_WORDS = 1 << 20
PIECE = 1 << 20
#: Bits of the bitmap for each class that is asked for, the most that it may have (8 MB), and those of one of its rows.
BITS_EACH, MOST_BITS, ROW_BITS = 16, 1 << 26, 32_768


def content_classes(records: DataFrame, words: Column | None = None) -> DataFrame:
    """Distinct content per cluster: class_id, cluster_start, fingerprint, words, length.

    Copies share a class, so scoring costs nothing more for content that occurs very often. With ``words``, an expression over the
    column ``content``, sequences are made of one copy only, once copies are gone.
    """
    # Copies have equal content, but that of a copy may be missing.
    held = "words" if words is None else "content"
    distinct = records.groupBy("cluster_start", "fingerprint").agg(F.first(held, ignorenulls=True).alias(held))
    made = distinct if words is None else distinct.select("cluster_start", "fingerprint", words.alias("words"))
    return materialize(
        made.withColumn("length", F.coalesce(F.size("words"), F.lit(0))).withColumn("class_id", F.monotonically_increasing_id()),
        "content-classes",
    )


def bit_blocks(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of ``max_bits + 1`` blocks that make up a value: with fewer differing bits one of them is equal."""
    edges = [WORD_BITS * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _needed(length: np.ndarray, threshold: float) -> np.ndarray:
    """Places that match at the best offset of a qualifying pair whose shorter sequence has that length."""
    return np.maximum(np.ceil(length * threshold - 1e-9), 1).astype(np.int64)


def _asked(length: np.ndarray, threshold: float) -> np.ndarray:
    """Matches that must be found at one offset among the places that are looked up."""
    return np.clip(_needed(length, threshold) // 5, 1, MAX_COMMON)


def _each(low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers low, low + 1, ... of all ranges, and which range each comes from."""
    of = np.repeat(np.arange(len(count)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + low[of], of


def _pieces(count: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of entries whose counts add up to about ``most``."""
    ends, at = np.cumsum(count), 0
    while at < len(count):
        end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
        yield at, (at := max(end, at + 1))


def _alike(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the matching values of each of the distinct ``values``, as numbers in one list, and that list."""
    if not max_bits:
        return np.arange(len(values) + 1), np.arange(len(values))
    blocks = bit_blocks(min(max_bits + 1, WORD_BITS - 1))
    codes = [np.arange(len(values)) * (len(values) + 1)]
    for equal in combinations(blocks, len(blocks) - max_bits):
        mask = sum(((1 << width) - 1) << shift for shift, width in equal)
        turn = np.argsort(values & mask, kind="stable")
        key = values[turn] & mask
        # Each value with those that follow it in its run.
        rest = np.searchsorted(key, key, "right") - np.arange(len(key)) - 1
        for a, b in _pieces(rest, PIECE):
            other, of = _each(np.arange(a, b) + 1, rest[a:b])
            one, other = turn[of + a], turn[other]
            near = np.bitwise_count(values[one] ^ values[other]) <= max_bits
            codes += [one[near] * len(values) + other[near], other[near] * len(values) + one[near]]
    codes = np.unique(np.concatenate(codes))
    return np.searchsorted(codes, np.arange(len(values) + 1) * len(values)), codes % len(values)


class _Group:
    """The sequences of a block of a cluster, or of two, as arrays, in the order of (length, class_id)."""

    def __init__(self, rows: pa.Table, threshold: float, max_offset: int, max_bits: int, keys: np.ndarray, costs: np.ndarray):
        ids, words = rows.column("class_id").to_numpy(), rows.column("words").combine_chunks()
        turn = np.lexsort((ids, words.value_lengths().to_numpy(zero_copy_only=False)))
        self.ids, self.block = ids[turn], rows.column("own").to_numpy()[turn]
        self.between = rows.column("low")[0] != rows.column("high")[0]
        words = words.take(pa.array(turn))
        self.size = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.values = words.flatten().to_numpy(zero_copy_only=False)
        self.first = np.cumsum(self.size) - self.size
        self.row = np.repeat(np.arange(len(self.size)), self.size)
        self.place = np.arange(len(self.values)) - self.first[self.row]
        self.threshold, self.reach, self.bits = threshold, max_offset, max_bits
        distinct, self.value, count = np.unique(self.values, return_inverse=True, return_counts=True)
        self.lists, self.alike = _alike(distinct, max_bits)
        near = np.concatenate([[0], np.cumsum(count[self.alike])])
        #: Places that hold a match of the value: rare values are looked up first.
        self.met = (near[self.lists[1:]] - near[self.lists[:-1]])[self.value]
        cost = self.met
        if len(keys):
            at = np.minimum(np.searchsorted(keys, self.values), len(keys) - 1)
            cost = np.where(keys[at] == self.values, costs[at], -np.inf)
        rank = np.empty(len(self.values), np.int64)
        order = np.lexsort((self.values, cost, self.row))
        rank[order] = self.place
        spared = _needed(self.size, threshold) - _asked(self.size, threshold)
        self.searched = np.flatnonzero(rank < (self.size - spared)[self.row])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The qualifying pairs, shorter first, as numbers of rows: of both blocks where there are two."""
        # Places by value and place, so that those of a value within the window are one range; ``far`` keeps windows of values apart.
        far = int(self.size.max()) + self.reach + 1
        sort = np.argsort(self.value * (2 * far) + self.place, kind="stable")
        sorted_at = (self.value * (2 * far) + self.place)[sort]
        search = self.searched[self.met[self.searched] > 1]
        wide = 2 * self.reach + 1
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = []
        tries = self.lists[self.value[search] + 1] - self.lists[self.value[search]]
        for a, b in _pieces(tries, PIECE):
            entry, of = _each(self.lists[self.value[search[a:b]]], tries[a:b])
            asking = search[a:b][of]
            around = self.alike[entry] * (2 * far) + self.place[asking]
            low = np.searchsorted(sorted_at, around - self.reach)
            high = np.searchsorted(sorted_at, around + self.reach, "right")
            for c, d in _pieces(high - low, PIECE):
                at, of = _each(low[c:d], (high - low)[c:d])
                one, other = asking[c:d][of], sort[at]
                short, long = self.row[one], self.row[other]
                # Rows stand in the order of lengths, so the later of two rows is the longer one.
                kept = (short < long) & (self.block[short] != self.block[long]) if self.between else short < long
                one, other, short, long = one[kept], other[kept], short[kept], long[kept]
                codes = (short * len(self.ids) + long) * wide + self.place[other] - self.place[one] + self.reach
                held = np.concatenate([held, codes])
                counts = np.concatenate([counts, np.ones(len(codes), np.int64)])
                if len(held) > 2 * PIECE:
                    held, counts = self._added(held, counts)
                    # All rows before that of this place are done.
                    done = np.searchsorted(held, self.row[asking[d - 1]] * len(self.ids) * wide)
                    found.append(self._confirmed(held[:done], counts[:done], wide))
                    held, counts = held[done:], counts[done:]
        held, counts = self._added(held, counts)
        found.append(self._confirmed(held, counts, wide))
        both = np.unique(np.concatenate(found))
        return both // len(self.ids), both % len(self.ids)

    @staticmethod
    def _added(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turn = np.argsort(codes, kind="stable")
        codes = codes[turn]
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
        return codes[starts], np.add.reduceat(counts[turn], starts) if len(codes) else counts

    def _confirmed(self, codes: np.ndarray, counts: np.ndarray, wide: int) -> np.ndarray:
        """The pairs that match in enough places at one of the offsets that have enough matches among the places looked up."""
        pair, offset = codes // wide, codes % wide - self.reach
        short, long = pair // len(self.ids), pair % len(self.ids)
        likely = np.flatnonzero(counts >= _asked(self.size[short], self.threshold))
        good = [np.zeros(0, np.int64)]
        short, long, offset, pair = short[likely], long[likely], offset[likely], pair[likely]
        # Places of the shorter one that have one opposite.
        begin = np.maximum(0, -offset)
        length = np.minimum(self.size[short], self.size[long] - offset) - begin
        for a, b in _pieces(length, PIECE):
            at, of = _each(begin[a:b], length[a:b])
            of += a
            one, other = self.values[self.first[short[of]] + at], self.values[self.first[long[of]] + at + offset[of]]
            equal = np.bitwise_count(one ^ other) <= self.bits if self.bits else one == other
            matches = np.bincount(of[equal] - a, minlength=b - a)
            good.append(pair[a:b][matches >= _needed(self.size[short[a:b]], self.threshold)])
        return np.unique(np.concatenate(good))


def _costs(classes: DataFrame, cost: Column | None) -> tuple[np.ndarray, np.ndarray]:
    """The frequent values of a sample, ascending, and their costs: at most ``FREQUENT`` numbers. All others cost less. Without a
    ``cost`` there are none: values are counted where sequences meet."""
    if cost is None:
        return np.zeros(0, np.int64), np.zeros(0)
    total = classes.where("length > 0").count()
    some = classes.where("length > 0").where(F.pmod(F.xxhash64("class_id"), F.lit(max(1, total // SAMPLED))) == 0)
    counts = some.select(F.explode("words").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    most = counts.orderBy(F.desc("n"), "key").limit(FREQUENT)
    rows = most.select("key", cost.cast("double").alias("cost")).toArrow()
    keys, costs = (rows.column(c).to_numpy() for c in ("key", "cost"))
    turn = np.argsort(keys)
    return keys[turn].astype(np.int64), costs[turn].astype(np.float64)


def meeting_blocks(rows: DataFrame, key: Column) -> DataFrame:
    """Each row of a cluster, dealt by ``key`` to one of its ``blocks``, for each two blocks that meet there: adds own, low and high.
    A block meets every other one and itself."""
    dealt = rows.withColumn("own", F.pmod(key, F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})


def _blocks(classes: DataFrame):
    """The sequences of clusters that hold several, grouped by cluster and two of its blocks (one twice where there is only one)."""
    sequences = classes.where("length > 0").select("cluster_start", "class_id", "length", "words")
    # One row per cluster: as many as tolerances fit into the range of durations.
    clusters = sequences.groupBy("cluster_start").agg(
        F.ceil(F.sum("length") / BLOCK_WORDS).cast("int").alias("blocks"), F.count(F.lit(1)).alias("held")
    )
    among = sequences.join(F.broadcast(clusters.where("held > 1").drop("held")), "cluster_start")
    dealt = meeting_blocks(among, F.xxhash64("class_id"))
    return dealt.select("cluster_start", "low", "high", "class_id", "own", "words").groupBy("cluster_start", "low", "high")


def _places(classes: DataFrame, threshold: float, cost: Column | None) -> DataFrame:
    """cluster_start, class_id, value, position of the places by which sequences are looked up in each group."""
    keys, costs = _costs(classes, cost)

    def places(rows: pa.Table) -> pa.Table:
        group = _Group(rows, threshold, MAX_OFFSET, 0, keys, costs)
        at = group.searched
        return pa.table(
            {
                "cluster_start": pa.array(np.repeat(rows.column("cluster_start").to_numpy()[:1], len(at))),
                "class_id": group.ids[group.row[at]], "value": group.values[at], "position": group.place[at],
            }
        )

    return _blocks(classes).applyInArrow(places, "cluster_start double, class_id bigint, value bigint, position bigint")


def candidate_pairs(
    classes: DataFrame, threshold: float, max_offset: int = MAX_OFFSET, max_bits: int = 0, cost: Column | None = None
) -> DataFrame:
    """Pairs of classes (class_1, class_2) of one cluster that reach ``threshold`` (> 0).

    ``cost``, an expression over ``key`` and ``n``, puts the values in order, by default how often they occur in a group.
    """
    if threshold <= 0:
        raise ValueError("a threshold above 0 is needed: at 0 every pair of a cluster qualifies")
    if not 0 <= max_bits < WORD_BITS:
        raise ValueError(f"max_bits must be from 0 to {WORD_BITS - 1}")
    keys, costs = _costs(classes, cost)

    def found(rows: pa.Table) -> pa.Table:
        group = _Group(rows, threshold, max_offset, max_bits, keys, costs)
        short, long = group.pairs()
        return pa.table({"class_1": group.ids[short], "class_2": group.ids[long]})

    return _blocks(classes).applyInArrow(found, "class_1 bigint, class_2 bigint")


def _among(classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The classes whose class_id is among ``wanted``, and few others: a bitmap of hashed ids reaches the scan, so that the content
    of all others is never moved."""
    asked = max(ROW_BITS, BITS_EACH * wanted.count())
    size = min(MOST_BITS, 1 << (asked - 1).bit_length())
    at = F.pmod(F.xxhash64("class_id"), F.lit(size))
    row, place = F.floor(at / ROW_BITS).alias("row"), F.pmod(at, F.lit(ROW_BITS))
    rows = wanted.select(row, place.alias("place")).groupBy("row").agg(F.expr("bitmap_construct_agg(place)").alias("bits"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return classes.withColumn("row", row).join(F.broadcast(rows), "row").where(is_set).select(*classes.columns)


def score_pairs(pairs: DataFrame, classes: DataFrame, max_offset: int = MAX_OFFSET, max_bits: int = 0) -> DataFrame:
    """Adds both fingerprints, the cluster and the best-alignment similarity, in fingerprint order.

    The similarity is null where a content is missing. A pair without a second class is scored as one with missing content.
    """
    ends = pairs.select(F.explode(F.array("class_1", "class_2")).alias("class_id")).where("class_id is not null")
    classes = _among(classes, ends)
    left = classes.select(
        "cluster_start", F.col("class_id").alias("class_1"), F.col("fingerprint").alias("fp_1"), F.col("words").alias("words_1")
    )
    right = classes.select(
        F.col("class_id").alias("class_2"), F.col("fingerprint").alias("fp_2"), F.col("words").alias("words_2")
    )
    swap = F.col("fp_1") > F.col("fp_2")
    return (
        pairs.join(left, "class_1")
        .join(right, "class_2", "left")
        .withColumn("similarity", best_alignment(max_offset, max_bits)("words_1", "words_2"))
        .select(
            "cluster_start",
            F.when(swap, F.col("class_2")).otherwise(F.col("class_1")).alias("class_1"),
            F.when(swap, F.col("class_1")).otherwise(F.col("class_2")).alias("class_2"),
            F.when(swap, F.col("fp_2")).otherwise(F.col("fp_1")).alias("fingerprint_1"),
            F.when(swap, F.col("fp_1")).otherwise(F.col("fp_2")).alias("fingerprint_2"),
            "similarity",
        )
    )


def similar_classes(
    classes: DataFrame,
    threshold: float,
    max_offset: int = MAX_OFFSET,
    wanted: Callable[[DataFrame], DataFrame] | None = None,
    max_bits: int = 0,
) -> DataFrame:
    """All pairs of different content in one cluster with a similarity of at least ``threshold``.

    ``wanted`` narrows the candidates (class_1, class_2) before any content is moved or scored.
    """
    pairs = candidate_pairs(classes, threshold, max_offset, max_bits)
    pairs = materialize(wanted(pairs) if wanted else pairs, "candidates")
    scored = score_pairs(pairs, classes, max_offset, max_bits)
    return scored.where(F.col("similarity") >= threshold)
