"""Benchmark decontamination by greedy string tiling.

Words are runs of characters other than ASCII punctuation and white space, A-Z as a-z. Every run of ``seed`` words of
an item is a seed; an item of fewer words is one seed of its whole length. Seeds are Karp-Rabin hashes; those that follow
each other in both texts make up maximal matches. The longest match of words that are not marked is marked, again and
again, until none of ``seed`` words is left, so reordered passages are found piece by piece. A document is contaminated by
an item when the marks cover at least ``coverage`` of the words of the item.

1. The running hashes of each document are held against a Bloom filter of the seeds, of at most 2^26 bits whatever the size
   of the benchmark; what is left is written once, for each text its hashes and places. A fuller filter lets more hashes
   through and loses none.
2. Marks that cover c words hold at least ``c / seed`` seeds of the item. So many less one may be left out, the most
   frequent ones: the rest is joined to the hashes of the texts and gives the pairs of texts and items, with equal texts
   taken once. No item goes through the driver, and no seed that most documents share makes pairs if the item has rarer ones.
3. Each pair is tiled. Places of a repeated seed are followed from word to word of the item, never listed as a product.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dupelens.llm.tables import keep, texts, tidy
from dupelens.llm.words import IS_WORD, STEP, chunks, mixed, utf8, word_hashes

PLAIN = IS_WORD.copy()
PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = False
LEAST_BITS, MOST_BITS = 16, 26
#: The slots of a hash begin at these bits.
PROBES = (0, 19, 38)
SEEN = 200_000


@dataclass(frozen=True)
class Rule:
    """Words of a seed (and least tile of items that are not shorter), and least covered share of an item."""

    seed: int = 5
    coverage: float = 0.6

    def least_seeds(self, words: Column) -> Column:
        """The least number of seeds of an item of so many words that lie in marks which cover enough of it."""
        covered = F.ceil(words * self.coverage - 1e-9)
        return F.greatest(F.ceil(covered / self.seed), F.lit(1)).cast("long")


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for i in range(1, size):
        out = out * STEP + words[i : n + i]
    return mixed(out)


def matches(places: list[np.ndarray], seed: int) -> list[tuple[int, int, int]]:
    """Maximal matches ``(length, in document, in item)``; ``places`` has for each seed of the item, in order, its sorted
    places in the document."""
    found: list[tuple[int, int, int]] = []
    before, lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for j, now in enumerate([*places, np.zeros(0, np.int64)]):
        new = np.full(len(now), seed, np.int64)
        ended = np.ones(len(before), bool)
        if len(before) and len(now):
            at = np.minimum(np.searchsorted(before, now - 1), len(before) - 1)
            goes_on = before[at] == now - 1
            new[goes_on] = lengths[at[goes_on]] + 1
            ended[at[goes_on]] = False
        back = lengths[ended] - seed
        found += zip(lengths[ended].tolist(), (before[ended] - back).tolist(), (j - 1 - back).tolist(), strict=True)
        before, lengths = now, new
    return found


def tiles(places: list[np.ndarray], seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(in document, in item, length)``: always the longest unmarked match, the earliest among equals."""
    heap = [(-length, j, i) for length, i, j in matches(places, seed)]
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item = np.zeros(len(places) + seed - 1, bool)
    out = []
    while heap and np.count_nonzero(~in_item) >= seed:
        length, j, i = heapq.heappop(heap)
        length = -length
        free = [not marked and i + t not in in_doc for t, marked in enumerate(in_item[j : j + length].tolist())]
        if all(free):
            in_doc.update(range(i, i + length))
            in_item[j : j + length] = True
            out.append((i, j, length))
            continue
        start = None
        for t in range(length + 1):
            if t < length and free[t]:
                start = t if start is None else start
            elif start is not None:
                if t - start >= seed:
                    heapq.heappush(heap, (start - t, j + start, i + start))
                start = None
    return out


def _lists(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int64)))


def seeded(benchmark: DataFrame, rule: Rule) -> DataFrame:
    """``(item_id, n, size, seeds)`` of every item with words: their number, the words of a seed, the seeds in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8(batch.column("text"))
            words, rows = word_hashes(raw, at, PLAIN)
            n = np.diff(rows)
            size = np.minimum(n, rule.seed)
            made = [rolling(words[a:b], int(s)) if s else words[:0] for a, b, s in zip(rows[:-1], rows[1:], size, strict=True)]
            flat = np.concatenate([*made, np.zeros(0, np.uint64)])
            ends = np.concatenate([[0], np.cumsum([len(m) for m in made])])
            columns = [batch.column("item_id"), pa.array(n, pa.int64()), pa.array(size, pa.int64()), _lists(flat, ends)]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "n", "size", "seeds"])

    made = texts(benchmark, "item_id").mapInArrow(run, "item_id long, n long, size long, seeds array<long>")
    # The number of a row is written with it, so that it names the row in all that follows.
    return keep(made.where("n > 0").withColumn("item", F.monotonically_increasing_id()), "items")


def bit_table(seeds: DataFrame) -> np.ndarray:
    """A Bloom filter of the seeds, 64 slots in a number; put together by tasks, at most 2^20 rows of two numbers reach the driver."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(64 * (seeds.count() + 1)))))
    probes = F.array(*(F.shiftrightunsigned("seed", s).bitwiseAND(F.lit((1 << bits) - 1)) for s in PROBES))
    slots = seeds.select(F.explode(probes).alias("slot"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))
    found = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def _places_in(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where all slots of each hash are set."""
    left = np.arange(len(hashes))
    for shift in PROBES:
        slot = (hashes[left] >> np.uint64(shift)) & np.uint64(64 * len(table) - 1)
        left = left[(table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1]
    return left


def hits_of(column: pa.Array, table: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of a batch of texts that are in the table, sorted in each text, their places, and where each text begins."""
    raw, at = utf8(column)
    hashes, places, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(column), np.int64)
    for first, last in chunks(at):
        part = at[first : last + 1]
        words, rows = word_hashes(raw[part[0] : part[-1]], part - part[0], PLAIN)
        own = []
        for size in sizes:
            found = rolling(words, size)
            at_word = _places_in(table, found)
            row = np.searchsorted(rows, at_word, "right") - 1
            inside = at_word + size <= rows[row + 1]
            own.append((row[inside], found[at_word[inside]].view(np.int64), (at_word - rows[row])[inside]))
        if not own:
            continue
        row, found, place = (np.concatenate(c) for c in zip(*own, strict=True))
        order = np.lexsort((place, found, row))
        hashes.append(found[order])
        places.append(place[order])
        counts[first:last] += np.bincount(row, minlength=last - first)
    return np.concatenate(hashes), np.concatenate(places), np.concatenate([[0], np.cumsum(counts)])


HASHES = [F.xxhash64, lambda text: F.xxhash64(F.lit(1), text)]


def _text_keys(text: Column) -> list[Column]:
    """Two numbers that name a text: 128 bits of hashes."""
    return [h(F.coalesce(text, F.lit(""))) for h in HASHES]


def hits(docs: DataFrame, table: np.ndarray, sizes: list[int]) -> DataFrame:
    """``(doc_id, h, g, seeds, places)`` of every row with hashes in the table; null lists where the task had the text before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            hashes, places, at = hits_of(batch.column("text"), table, sizes)
            keys = list(zip(batch.column("h").to_pylist(), batch.column("g").to_pylist(), strict=True))
            again = np.zeros(len(batch), bool)
            for i in np.flatnonzero(np.diff(at)).tolist():
                again[i] = keys[i] in seen
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(keys[i])
            left = np.repeat(~again, np.diff(at))
            ends = np.concatenate([[0], np.cumsum(np.where(again, 0, np.diff(at)))])
            made = [*(batch.column(c) for c in ("doc_id", "h", "g")), _lists(hashes[left], ends), _lists(places[left], ends)]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "h", "g", "seeds", "places"]).filter(pa.array(np.diff(at) > 0))
        tidy()

    source = texts(docs)
    source = source.select("doc_id", "text", *(k.alias(n) for k, n in zip(_text_keys(F.col("text")), "hg", strict=True)))
    return source.mapInArrow(run, "doc_id long, h long, g long, seeds array<long>, places array<long>")


def candidates(found: DataFrame, seeds: DataFrame, rule: Rule) -> DataFrame:
    """``(h, g, item)``: the texts and items that share one of the seeds of an item without its most frequent ones."""
    shared = found.select("h", "g", F.explode(F.array_distinct("seeds")).alias("seed"))
    shared = keep(shared.join(seeds.select("seed").distinct(), "seed", "left_semi"), "shared-seeds")
    often = shared.groupBy("seed").agg(F.count(F.lit(1)).alias("often"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("often"), "seed", "place"))
    ranked = seeds.join(often, "seed", "left").withColumn("often", F.coalesce("often", F.lit(0))).withColumn("rank", rank)
    rare = ranked.where((F.col("rank") >= rule.least_seeds(F.col("n"))) & (F.col("often") > 0))
    # Written, so that the join has two plain sides and a hot seed can be split.
    return shared.join(keep(rare.select("seed", "item").distinct(), "rare-seeds"), "seed").select("h", "g", "item").distinct()


def _tiled(rule: Rule, rows: Iterable[tuple]) -> Iterator[tuple]:
    """Of rows of item, number of words, words of a seed, seeds, hashes and places those that are covered enough."""
    for i, (n, size, seeds, hashes, at) in enumerate(rows):
        low, high = np.searchsorted(hashes, seeds, "left"), np.searchsorted(hashes, seeds, "right")
        laid = tiles([at[a:b] for a, b in zip(low, high, strict=True)], size)
        covered = sum(t[2] for t in laid)
        if laid and covered >= rule.coverage * n:
            yield i, covered, covered / n, [list(t) for t in laid]


FOUND = "h long, g long, item_id long, item_words long, covered long, coverage double, tiles array<array<long>>"


def tiled(pairs: DataFrame, rule: Rule) -> DataFrame:
    """``FOUND`` of the pairs that marks cover enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = zip(batch.column("n").to_pylist(), batch.column("size").to_pylist(), strict=True)
            lists = [batch.column(c) for c in ("item_seeds", "seeds", "places")]
            rows = ((*number, *(c[i].values.to_numpy() for c in lists)) for i, number in enumerate(numbers))
            good = list(_tiled(rule, rows))
            kept = batch.select(["h", "g", "item_id", "n"]).take(pa.array([g[0] for g in good], pa.int64()))
            columns = zip(*(g[1:] for g in good), strict=True) if good else [()] * 3
            kinds = [pa.int64(), pa.float64(), pa.list_(pa.list_(pa.int64()))]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], names=[c.split()[0] for c in FOUND.split(", ")])

    return pairs.mapInArrow(run, FOUND)


def _found(docs: DataFrame, benchmark: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, h, g)`` of the rows that hold a seed perhaps, and ``FOUND``, once for each text and item."""
    items = seeded(benchmark, rule)
    seeds = items.select("item", "n", F.posexplode("seeds").alias("place", "seed"))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most ``seed`` numbers
    rows = keep(hits(docs, bit_table(seeds), sizes), "hits")
    found = keep(rows.where("seeds is not null and size(seeds) > 0").dropDuplicates(["h", "g"]).drop("doc_id"), "hit-texts")
    pairs = keep(candidates(found, seeds, rule), "pairs")
    of_item = items.select("item", "item_id", "n", "size", F.col("seeds").alias("item_seeds"))
    return rows.select("doc_id", "h", "g"), keep(tiled(pairs.join(found, ["h", "g"]).join(of_item, "item"), rule), "tiled")


def contaminated(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row for each document and each item that covers it enough.

    ``covered`` counts marked words of the item; ``tiles`` lists (first word in the document, first word in the item,
    number of words), longest first. Null and empty texts and items without words match nothing. An item of fewer words
    than a seed is found wherever all its words follow each other. Repeated rows, of documents or items, give a result
    each; empty tables give an empty result.
    """
    rows, found = _found(docs, benchmark, rule)
    return rows.join(found, ["h", "g"]).select("doc_id", "item_id", "item_words", "covered", "coverage", "tiles")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    bad = _found(docs, benchmark, rule)[1].select("h", "g").distinct()
    own = _text_keys(docs["text"])
    return docs.join(bad, (own[0] == bad["h"]) & (own[1] == bad["g"]), "left_anti")
