"""Every pair of units of a duration cluster with its similarity, however low it is.

A unit stands for the files of a cluster with equal fingerprint, source and format. Nothing is left out: pairs without a value in common
score 0, and files of one asset (its formats) are compared like all others.

The result has a row per pair, so it grows with the square of a cluster. Contents and units are dealt into blocks of a cluster, of
which each two meet in a group of their own, where the rows are made: what is moved is each content, once per block of its cluster. With
about ``BLOCK_UNITS`` units to a block a group makes about the square of that in rows, however large the cluster is. Inside a group the places of equal values
within the offset window are counted by pair and offset, so work follows the values that two contents have in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dupelens.functions.sequences import MAX_OFFSET
from dupelens.operators import candidates
from dupelens.runtime import materialize

#: Units of a block, parts in which a block meets itself, counts by pair and offset that are held at once, and rows of a batch.
BLOCK_UNITS = 1024
BANDS = 8
CELLS = 1 << 18
ROWS = 1 << 16

SCHEMA = (
    "cluster_start double, fingerprint_1 string, source_1 string, format_1 string, "
    "fingerprint_2 string, source_2 string, format_2 string, similarity double"
)


class _Sequences:
    """The sequences of a group, by row, and their places in the order of values."""

    def __init__(self, words: pa.ListArray, max_offset: int):
        self.reach, self.wide = max_offset, 2 * max_offset + 1
        self.size = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.row = np.repeat(np.arange(len(self.size)), self.size)
        self.place = np.arange(len(self.row)) - self.first[self.row]
        _, value = np.unique(words.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        # Places by value and place: those of a value within the window are one range, and windows of two values never meet.
        self.key = value * (2 * (int(self.size.max()) + max_offset + 1)) + self.place
        self.order = np.argsort(self.key, kind="stable")

    def best(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some of the rows ``left`` at a time, and their matches at the best offset with each of the rows ``right``: a line for
        each row of the left, a column for each of the right."""
        column = np.full(len(self.size), -1)
        column[right] = np.arange(len(right))
        held = self.order[column[self.row[self.order]] >= 0]
        key, code = self.key[held], column[self.row[held]] * self.wide + self.place[held]
        some = max(1, CELLS // (self.wide * len(right)))
        for start in range(0, len(left), some):
            rows = left[start : start + some]
            at, line = candidates._each(self.first[rows], self.size[rows])
            low = np.searchsorted(key, self.key[at] - self.reach)
            met = np.searchsorted(key, self.key[at] + self.reach, "right") - low
            begin = line * (len(right) * self.wide) + self.reach - self.place[at]
            counts = np.zeros(len(rows) * len(right) * self.wide, np.int64)
            for a, b in candidates._pieces(met, candidates.PIECE):
                entry, of = candidates._each(low[a:b], met[a:b])
                counts += np.bincount(code[entry] + begin[a:b][of], minlength=len(counts))
            yield rows, counts.reshape(len(rows), len(right), self.wide).max(axis=2)


def _content_pairs(
    words: pa.ListArray, sides: tuple[np.ndarray, np.ndarray] | None, max_offset: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, later row, similarity) of all pairs of rows, or of those between two ``sides`` only."""
    sequences, rows = _Sequences(words, max_offset), np.arange(len(words))
    band = -(-len(rows) // BANDS)
    parts = [sides] if sides else [(rows[a : a + band], rows[a:]) for a in range(0, len(rows), band)]
    found = [(rows[:0], rows[:0], np.zeros(0))]
    for left, right in parts:
        for some, best in sequences.best(left, right):
            one, other = np.repeat(some, len(right)), np.tile(right, len(some))
            similarity = best.ravel() / np.minimum(sequences.size[one], sequences.size[other])
            # A part that meets itself has each of its pairs twice.
            kept = one != other if sides else one < other
            found.append((np.minimum(one, other)[kept], np.maximum(one, other)[kept], similarity[kept]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _group_pairs(rows: pa.Table, max_offset: int) -> pa.Table:
    """All pairs of units of a block, or of two blocks. Rows with ``words`` are contents, those without are units."""
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    is_content = pc.is_valid(rows.column("words"))
    contents = rows.filter(is_content).sort_by("fingerprint").combine_chunks()
    units = rows.filter(pc.invert(is_content)).sort_by([(c, "ascending") for c in ("fingerprint", "source", "format")])
    # Units of a missing content have nothing to compare.
    of_content = pc.index_in(units.column("fingerprint"), value_set=contents.column("fingerprint"))
    units, of_content = units.filter(pc.is_valid(of_content)).combine_chunks(), pc.drop_null(of_content).to_numpy()
    count = np.bincount(of_content, minlength=len(contents))
    first = np.cumsum(count) - count
    start, named = rows.column("cluster_start").to_numpy()[:1], units.select(["fingerprint", "source", "format"])

    def made(one: np.ndarray, other: np.ndarray, similarity: np.ndarray) -> pa.Table:
        ends = [named.take(pa.array(of)) for of in (one, other)]
        return pa.table(
            {"cluster_start": pa.array(np.repeat(start, len(one)))}
            | {f"{name}_{n}": end.column(name) for n, end in enumerate(ends, 1) for name in end.column_names}
            | {"similarity": pa.array(similarity)}
        )

    # Units that meet themselves: those of several files.
    itself = np.flatnonzero(units.column("several").to_numpy()) if low == high else np.zeros(0, np.int64)
    found = [made(itself, itself, np.ones(len(itself)))]
    own = contents.column("own").to_numpy()
    sides = (np.flatnonzero(own == low), np.flatnonzero(own == high)) if low != high else None
    if len(contents) and (sides is None or min(map(len, sides))):
        a, b, score = _content_pairs(contents.column("words").chunk(0), sides, max_offset)
        each = count[a] * count[b]
        for c, d in candidates._pieces(each, ROWS):
            nth, of = candidates._each(np.zeros(d - c, np.int64), each[c:d])
            one, other = a[c:d][of], b[c:d][of]
            found.append(made(first[one] + nth // count[other], first[other] + nth % count[other], score[c:d][of]))
    if sides is None:
        # Equal content: each unit with those that follow.
        at = np.arange(len(units))
        later = (first + count)[of_content] - at - 1
        for c, d in candidates._pieces(later, ROWS):
            other, of = candidates._each(at[c:d] + 1, later[c:d])
            found.append(made(at[c:d][of], other, np.ones(len(of))))
    return pa.concat_tables(found)


def unit_pairs(records: DataFrame, classes: DataFrame, max_offset: int = MAX_OFFSET) -> DataFrame:
    """All pairs of units of each cluster, in the order of (fingerprint, source, format), with the best-alignment similarity. A unit
    meets itself if it has several files. Contents that are missing are compared with nothing."""
    file = F.struct("asset_id", "file_key")
    units = records.groupBy("cluster_start", "fingerprint", "source", "format").agg(
        (~F.min(file).eqNullSafe(F.max(file))).alias("several")
    )
    contents = classes.where("length > 0").select("cluster_start", "fingerprint", "length", "words")
    rows = contents.unionByName(materialize(units, "units"), allowMissingColumns=True)
    # One row per cluster: as many as tolerances fit into the range of durations.
    blocks = rows.groupBy("cluster_start").agg(
        F.greatest(F.ceil(F.sum("length") / candidates.BLOCK_WORDS), F.ceil(F.count("several") / BLOCK_UNITS)).cast("int").alias("blocks")
    )
    dealt = candidates.meeting_blocks(rows.join(F.broadcast(blocks), "cluster_start"), F.xxhash64("fingerprint"))
    group = dealt.select("cluster_start", "low", "high", "own", "fingerprint", "words", "source", "format", "several")
    return group.groupBy("cluster_start", "low", "high").applyInArrow(lambda table: _group_pairs(table, max_offset), SCHEMA)
