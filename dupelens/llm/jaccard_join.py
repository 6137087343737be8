"""Set similarity join of documents on word shingles: T-occurrence search with skipped long lists.

Two sets link when ``100 * |intersection| >= percent * |union|``. Equal sets are one class first, so copies are never
paired. A class of size n shares at least ``T(n) = ceil(percent n / 100)`` shingles with any partner.

1. Of the first ``n - T(n) + k`` shingles in the order of their hashes at least k are among the first of a partner as
   well, so one is left when each class leaves out its ``k - 1`` most frequent ones. Classes that meet no other one in
   what is left have no partner; only for the rest the whole sets are gathered.
2. DivideSkip over these: lists are counted, and each class sets its ``T(n) - 1`` longest lists aside. A partner is
   then in one of the ``n - T(n) + 1`` short ones. Short lists are merged by a join on the shingle; the long ones are
   probed by binary search in the sorted set of a candidate, which counts the exact overlap.
3. Merging goes in rounds: each list offers one class as its centre, each class is checked against the centre that most
   of its lists name, and lists whose classes are already connected are left out. Classes that meet, directly or through
   others, in the lists left after ``ROUNDS`` rounds are one group. A group is dealt into blocks of bounded size, each pair of
   blocks is counted as one sparse product, and what leaves it is one row per class: the least class that links of the
   block reach. Where the lists of a group hold fewer pairs than the blocks need rows, its pairs are checked one by one.
   Either way every pair that meets is checked exactly, and no link between components is lost.
4. The number of links needs every pair. All links lie inside components, so the classes of a component are dealt into
   blocks of bounded size and each pair of blocks is counted as one sparse product. Only sums per class leave it: the
   result is linear, and no pair of classes becomes a row.

A shingle hash has 64 bits, of which step 1 uses 40; classes are known by 64 bits of a digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dupelens.llm.components import components
from dupelens.llm.tables import keep, texts, tidy
from dupelens.llm.words import row_shingles

SLOTS = 1 << 20
ROUNDS = 2
PARITY = [f"p{i}" for i in range(8)]
BLOCK_CLASSES = 256
GROUP_CLASSES = 1024
BLOCK_SHINGLES = 1 << 20
CHUNK = 4096


@dataclass(frozen=True)
class Rule:
    """Shingle length, least similarity in percent, and the share of a set (in percent) that is set aside as long lists."""

    words: int = 3
    percent: int = 90
    skip: int = 10

    def needed(self, n):
        """Least overlap of a set of size ``n`` with any partner; works on numbers, arrays and columns."""
        return _div(n * self.percent + 99, 100)

    def skipped(self, n):
        return _div(n * self.skip, 100)

    def prefix(self, n: int) -> int:
        largest = n * 100 // self.percent
        return min(n, n - self.needed(n) + self.skipped(largest) + 1)

    def fits(self, own: str, other: str) -> Column:
        """Whether two entries (structs of n, rank and parity) of a list can belong to sets that link.

        If the list is the first one that they share, no more can be common than what follows it in either; and sets
        whose parities differ in d bits differ in d shingles at least.
        """
        a, b = (lambda name: F.col(f"{own}.{name}")), (lambda name: F.col(f"{other}.{name}"))
        most = F.least(a("n") - a("rank"), b("n") - b("rank")) + 1
        both = a("n") + b("n")
        differ = sum(F.bit_count(a(p).bitwiseXOR(b(p))) for p in PARITY)
        whole = 100 + self.percent
        return (whole * most >= self.percent * both) & (whole * differ <= (100 - self.percent) * both)

    def links(self, sizes_a: np.ndarray, sizes_b: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Whether each pair of two series of sets links, from their sizes and the table of their common counts."""
        union = sizes_a[:, None] + sizes_b[None, :] - common
        return (common > 0) & (100 * common >= self.percent * union)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sorted sets link: the smaller one's elements are looked up in the larger by binary search."""
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)) if len(b) else 0
        return common > 0 and 100 * common >= self.percent * (len(a) + len(b) - common)


def _div(value, by: int):
    return F.floor(value / F.lit(by)).cast("long") if isinstance(value, Column) else value // by


def class_key(unique: np.ndarray) -> int:
    """64 bits of a digest of a sorted set."""
    return int.from_bytes(hashlib.blake2b(unique.tobytes(), digest_size=8).digest(), "little", signed=True)


def _long_lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def parity(unique: np.ndarray) -> np.ndarray:
    """For each of 512 slots whether an odd number of shingles falls into it, as 8 numbers."""
    odd = np.bincount((unique >> np.uint64(8)).astype(np.int64) & 511, minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketched(docs: DataFrame, rule: Rule, with_hash: bool = False) -> DataFrame:
    """``(doc_id, n, x, prefix)``: set size, class (null: empty set), and for the first row of a class in a task
    the keys of the shingles that are merged; ``with_hash`` adds ``h``, a hash of the text."""
    more = ["h"] if with_hash else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, keys, prefixes = [], [], []
            for found in row_shingles(batch.column("text"), rule.words):
                unique = np.unique(found)
                key = class_key(unique) if len(unique) else None
                fresh = key is not None and key not in seen
                if fresh:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(key)
                sizes.append(len(unique))
                keys.append(key)
                prefixes.append((unique[: rule.prefix(len(unique))] >> np.uint64(24)) if fresh else unique[:0])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.int64()),
                    _long_lists(prefixes),
                    *(batch.column(c) for c in more),
                ],
                names=["doc_id", "n", "x", "prefix", *more],
            )
        tidy()

    source = texts(docs).select("*", *(F.xxhash64("text").alias(c) for c in more))
    return source.mapInArrow(run, ", ".join(["doc_id long, n long, x long, prefix array<long>", *(f"{c} long" for c in more)]))


def whole_sets(docs: DataFrame, rule: Rule, wanted: DataFrame) -> DataFrame:
    """``(x, shingles, p0 .. p7)`` of the classes in ``wanted (x)``: whole sorted sets and their parities.

    A bit table of fixed size, whatever the input, tells most other documents apart before their sets are made.
    """
    slots = wanted.select(F.col("x").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")).distinct().toArrow()
    wanted_slots = np.zeros(SLOTS, bool)
    wanted_slots[slots.column("slot").to_numpy()] = True
    packed = np.packbits(wanted_slots).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        seen: set[int] = set()
        for batch in batches:
            keys, sets, odd = [], [], []
            for found in row_shingles(batch.column("text"), rule.words):
                unique = np.unique(found)
                key = class_key(unique) if len(unique) else 0
                if len(unique) and hit[key & (SLOTS - 1)] and key not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    sets.append(unique)
                    odd.append(parity(unique))
            bits = np.array(odd, np.int64).reshape(-1, len(PARITY))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), _long_lists(sets), *(pa.array(np.ascontiguousarray(c)) for c in bits.T)],
                names=["x", "shingles", *PARITY],
            )
        tidy()

    made = texts(docs).mapInArrow(run, "x long, shingles array<long>, " + ", ".join(f"{p} long" for p in PARITY))
    return made.join(wanted, "x", "left_semi").dropDuplicates(["x"])


def checked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            good = [
                rule.linked(left[i].values.to_numpy().view(np.uint64), right[i].values.to_numpy().view(np.uint64))
                for i in range(len(batch))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    first = sets.select(F.col("x").alias("a"), F.col("shingles").alias("left"))
    second = sets.select(F.col("x").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(first, "a").join(second, "b").mapInArrow(run, "a long, b long")


def meeting_classes(sketch: DataFrame, rule: Rule) -> DataFrame:
    """``(x)``: the classes that share one of their first shingles, the commonest ones left out, with another class."""
    entries = sketch.where("x is not null").select("x", "n", F.explode("prefix").alias("s"))
    # Written, so that the join has two plain shuffles and a long list can be split.
    lengths = keep(entries.groupBy("s").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "lengths")
    shared = keep(entries.join(lengths, "s").select("s", "x", "n"), "lists").distinct()
    lengths = shared.groupBy("s").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    longest = Window.partitionBy("x").orderBy(F.desc("length"), "s")
    ranked = shared.join(lengths, "s").withColumn("rank", F.row_number().over(longest))
    left = keep(ranked.where(F.col("rank") > rule.skipped(F.col("n"))).select("s", "x"), "meeting")
    again = left.groupBy("s").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    return left.join(again, "s").select("x").distinct()


def short_lists(sets: DataFrame, rule: Rule) -> DataFrame:
    """``(s, x, entry)``: of each class its ``n - T + 1`` shortest lists, the ``T - 1`` longest ones set aside.

    Lists of one class only are the shortest and meet nothing, so they are counted but not kept.
    """
    entries = sets.select("x", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"))
    lengths = keep(entries.groupBy("s").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "lengths")
    shared = keep(entries.join(lengths, "s").select("s", "x", "n", "length"), "lists")
    own = Window.partitionBy("x")
    rank = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("length", "s"))
    ranked = shared.withColumn("rank", rank)
    short = ranked.where(F.col("rank") <= F.col("n") - rule.needed(F.col("n")) + 1).select("s", "x", "n", "rank")
    entry = F.struct("n", "rank", *PARITY).alias("entry")
    return short.join(sets.select("x", *PARITY), "x").select("s", "x", entry)


def _pair(left: str, right: str) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _connected(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The lists that hold classes of more than one component, with the component of each."""
    known = lists.join(roots.withColumnRenamed("a", "x"), "x", "left").withColumn("root", F.coalesce("root", "x"))
    mixed = known.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return known.join(mixed.select("s"), "s")


def _centre_pairs(lists: DataFrame, rule: Rule, turn: int) -> DataFrame:
    """For each class the centre that most of its lists name, where entries and components allow a new link."""
    order = F.xxhash64("root", F.lit(turn))
    centres = lists.groupBy("s").agg(F.min(F.struct(order.alias("o"), "x", "root", "entry")).alias("c"))
    offered = (
        lists.join(centres, "s")
        .where((F.col("root") != F.col("c.root")) & rule.fits("entry", "c.entry"))
        .groupBy("x", F.col("c.x").alias("centre"))
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    best = offered.groupBy("x").agg(F.max_by("centre", F.struct("hits", "centre")).alias("centre"))
    return best.select(*_pair("x", "centre")).distinct()


def _all_pairs(lists: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of classes of different components that meet in a list and can link."""
    other = lists.select("s", F.col("x").alias("y"), F.col("root").alias("far"), F.col("entry").alias("partner"))
    return (
        lists.join(other, "s")
        .where((F.col("x") < F.col("y")) & (F.col("root") != F.col("far")) & rule.fits("entry", "partner"))
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
        .distinct()
    )


def _blocks(weight: str = "weight") -> Column:
    return F.ceil(F.greatest(F.count(F.lit(1)) / GROUP_CLASSES, F.sum(weight) / BLOCK_SHINGLES)).cast("long")


def groups(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(x, root, g)``: the group of each class that meets others in ``lists``; ``(g, blocks, direct)``: the blocks of a
    group, and whether checking the pairs of its lists one by one takes fewer rows."""
    met = keep(lists.groupBy("s").agg(F.min("x").alias("least"), F.count(F.lit(1)).alias("m")), "met")
    links = lists.join(met, "s").select(F.col("x").alias("a"), F.col("least").alias("b")).distinct()
    found = components(links)
    of = found.withColumnRenamed("a", "x").union(found.select(F.col("root").alias("x"), "root").distinct())
    of = of.withColumnRenamed("root", "g")
    classes = lists.groupBy("x").agg(F.first("root").alias("root"), F.first("entry.n").alias("weight"))
    members = keep(classes.join(of, "x"), "groups")
    pairs = met.join(of, met["least"] == of["x"]).groupBy("g").agg(F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("pairs"))
    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("classes"), _blocks().alias("blocks")).join(pairs, "g")
    sizes = sizes.select("g", "blocks", (F.col("pairs") < F.col("classes") * F.col("blocks")).alias("direct"))
    return members.select("x", "root", "g"), keep(sizes, "group-sizes")


def least_linked(linked: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the classes of two blocks the least class that a chain of links between the blocks reaches."""
    first, second = first.copy(), second.copy()
    far = np.iinfo(np.int64).max
    while True:
        new_first = np.minimum(first, np.where(linked, second[None, :], far).min(1))
        new_second = np.minimum(second, np.where(linked, new_first[:, None], far).min(0))
        if (new_first == first).all() and (new_second == second).all():
            return first, second
        first, second = new_first, new_second


def _block_components(rule: Rule, one: bool, rows: list[tuple]) -> Iterator[tuple[int, int]]:
    """``(a, b)``: classes of a pair of blocks, each with the least class that it is connected with, from rows of side, x,
    root and shingles. Blocks of one component only have nothing to add."""
    left = [r for r in rows if r[0] == 0]
    right = left if one else [r for r in rows if r[0] == 1]
    if not left or not right or len({r[2] for r in rows}) == 1:
        return
    linked = rule.links(
        *(np.array([len(r[3]) for r in side]) for side in (left, right)),
        common_counts([r[3] for r in left], [r[3] for r in right]),
    )
    ids = [np.array([r[1] for r in side], np.int64) for side in (left, right)]
    for own, least in zip(ids, least_linked(linked, *ids), strict=True):
        moved = own != least
        yield from zip(own[moved].tolist(), least[moved].tolist(), strict=True)


def _linked_in_groups(lists: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """``(a, b)``: links that connect, with those known, all classes of ``lists`` that links between lists connect."""
    members, sizes = groups(lists)
    blocked = members.join(sizes.where("not direct"), "g").join(sets.select("x", "shingles"), "x")
    found = blockwise(
        blocked.select(F.col("g").alias("of"), "blocks", "x", F.col("root").alias("with"), "shingles"),
        lambda one, rows: _block_components(rule, one, rows),
    ).toDF("a", "b")
    if sizes.where("direct").isEmpty():
        return found
    alone = members.join(sizes.where("direct"), "g").select("x")
    pairs = keep(_all_pairs(lists.join(alone, "x", "left_semi"), rule), "pairs")
    return found.union(checked(pairs, sets, rule))


def linked_classes(docs: DataFrame, sketch: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """``(a, root)``: the component of each class that links with another one; and the sets of all that could."""
    sets = keep(whole_sets(docs, rule, keep(meeting_classes(sketch, rule), "classes")), "sets")
    lists = keep(short_lists(sets, rule), "short-lists")
    links = tried = None
    roots = lists.select(F.col("x").alias("a"), F.col("x").alias("root")).limit(0)
    for turn in range(ROUNDS):
        pairs = _centre_pairs(_connected(lists, roots), rule, turn)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = keep(pairs, "pairs")
        found = keep(checked(pairs, sets, rule), "links")
        tried = pairs if tried is None else tried.union(pairs)
        links = found if links is None else links.union(found)
        roots = components(links)
    rest = keep(_linked_in_groups(keep(_connected(lists, roots), "open-lists"), sets, rule), "links")
    return components(rest if links is None else links.union(rest)), sets


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of each set of ``left`` with each of ``right``."""
    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (a, of_a), (b, of_b) = flat(left), flat(right)
    both = np.intersect1d(a, b)
    total = np.zeros((len(left), len(right)), np.int64)
    if not len(both):
        return total

    def held(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        good = both[at] == values
        at, owner = at[good], owner[good]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    (at_a, of_a), (at_b, of_b) = held(a, of_a), held(b, of_b)
    for low in range(0, len(both), CHUNK):
        tables = []
        for at, owner, n in ((at_a, of_a, len(left)), (at_b, of_b, len(right))):
            i, j = np.searchsorted(at, (low, low + CHUNK))
            part = np.zeros((n, min(CHUNK, len(both) - low)), np.float32)
            part[owner[i:j], at[i:j] - low] = 1
            tables.append(part)
        total += (tables[0] @ tables[1].T).astype(np.int64)
    return total


def _block_links(rule: Rule, one: bool, rows: list[tuple]) -> Iterator[tuple[int, int]]:
    """``(x, links)`` of a pair of blocks (``one``: of a block with itself) from rows of side, x, copies and shingles."""
    first = [r for r in rows if r[0] == 0]
    second = first if one else [r for r in rows if r[0] == 1]
    if not first or not second:
        return
    sizes = [np.array([len(r[3]) for r in side]) for side in (first, second)]
    copies = [np.array([r[2] for r in side]) for side in (first, second)]
    linked = rule.links(*sizes, common_counts([r[3] for r in first], [r[3] for r in second]))
    if one:
        np.fill_diagonal(linked, False)
    yield from zip((r[1] for r in first), (linked @ copies[1]).tolist(), strict=True)
    if not one:
        yield from zip((r[1] for r in second), (copies[0] @ linked).tolist(), strict=True)


def blockwise(members: DataFrame, work: Callable[[bool, list[tuple]], Iterable[tuple[int, int]]]) -> DataFrame:
    """What ``work`` yields, two numbers a row, for every pair of blocks of every group.

    ``members (of, blocks, x, with, shingles)``: the classes of a group are dealt into its blocks, and a group of m blocks
    sends each class to m tasks. ``work`` takes whether the blocks are the same one, and rows of side, x, with, shingles.
    """
    dealt = members.withColumn("own", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    sent = dealt.select("of", "own", "x", "with", "shingles", other).select(
        "of", low.alias("low"), high.alias("high"), (F.col("own") > low).cast("int").alias("side"), "x", "with", "shingles"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, made = None, [], []

        def flush(force: bool) -> Iterator[pa.RecordBatch]:
            if made and (force or len(made) > 10_000):
                x, n = zip(*made, strict=True)
                made.clear()
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(n, pa.int64())], names=["x", "found"])

        for batch in batches:
            names = ("of", "low", "high", "side", "x", "with")
            plain = zip(*(batch.column(n).to_pylist() for n in names), strict=True)
            shingles = batch.column("shingles")
            for i, (of, low, high, *row) in enumerate(plain):
                if (of, low, high) != now:
                    if rows:
                        made.extend(work(now[1] == now[2], rows))
                    yield from flush(False)
                    now, rows = (of, low, high), []
                rows.append((*row, shingles[i].values.to_numpy().view(np.uint64).copy()))
        if rows:
            made.extend(work(now[1] == now[2], rows))
        yield from flush(True)
        tidy()

    keys = ["of", "low", "high"]
    return sent.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "x long, found long")


def link_counts(roots: DataFrame, sets: DataFrame, sizes: DataFrame, rule: Rule) -> DataFrame:
    """``(x, links)``: with how many rows of other classes the rows of each class link; classes without links left out.

    ``sizes (x, copies)`` has the number of rows of each class.
    """
    of = roots.select(F.col("a").alias("x"), "root").union(roots.select(F.col("root").alias("x"), "root").distinct())
    members = keep(of.join(sizes, "x").join(sets.select("x", "shingles"), "x"), "members")
    weight = F.sum(F.size("shingles").cast("long"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_CLASSES, weight / BLOCK_SHINGLES)).cast("int").alias("blocks")
    dealt = members.join(members.groupBy("root").agg(blocks), "root")
    counted = blockwise(
        dealt.select(F.col("root").alias("of"), "blocks", "x", F.col("copies").alias("with"), "shingles"),
        lambda one, rows: _block_links(rule, one, rows),
    )
    return counted.groupBy("x").agg(F.sum("found").alias("links"))


def _of_classes(sketch: DataFrame, roots: DataFrame) -> DataFrame:
    """``(x, copies, component_id)`` of every class."""
    firsts = sketch.where("x is not null").groupBy("x").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    rooted = firsts.join(roots.withColumnRenamed("a", "x"), "x", "left").withColumn("root", F.coalesce("root", "x"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return keep(rooted.join(least, "root").select("x", "copies", "component_id"), "components")


def jaccard_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs (doc_id, text)``.

    ``component_id`` is the least ``doc_id`` that links reach, the row itself included. Texts that are null, empty or
    without words have an empty set and link with nothing, not even with each other. Rows that repeat a ``doc_id`` stay
    separate rows. An empty table gives an empty result; other columns are ignored.
    """
    sketch = keep(sketched(docs, rule), "sketch")
    of_class = _of_classes(sketch, linked_classes(docs, sketch, rule)[0]).drop("copies")
    # Copies of one text are all of one class: nothing follows this join, so that a hot class can be split.
    return sketch.select("doc_id", "n", "x").join(of_class, "x", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def jaccard_links(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``jaccard_components`` with ``n_links``: with how many other rows each row links, rows of the same set included.

    Every pair inside a component is counted exactly.
    """
    sketch = keep(sketched(docs, rule), "sketch")
    roots, sets = linked_classes(docs, sketch, rule)
    of_class = _of_classes(sketch, roots)
    links = link_counts(roots, sets, of_class.select("x", "copies"), rule)
    n_links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    counted = keep(of_class.join(links, "x", "left").select("x", "component_id", n_links), "link-counts")
    return sketch.select("doc_id", "n", "x").join(counted, "x", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each(docs: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one row stays, that with the least ``doc_id``.

    Rows without an id come last, rows with equal ids in the order of a hash of their text, and of rows that repeat both
    one stays. Rows with an empty set (no words) have no copies: all of them stay.
    """
    sketch = keep(sketched(docs, rule, with_hash=True), "sketch")
    roots = linked_classes(docs, sketch, rule)[0].withColumnRenamed("a", "x")
    rooted = sketch.select("doc_id", "x", "h").join(roots, "x", "left").withColumn("root", F.coalesce("root", "x"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = rooted.where("x is not null").groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", "k.h")
    rows = sketch.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("rows"), F.max("x").isNotNull().alias("words"))
    same = rows["doc_id"].eqNullSafe(first["doc_id"]) & (rows["h"] == first["h"])
    stay = rows.where("words").join(first, same, "left_semi").union(rows.where("not words"))
    stay = keep(stay.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), (F.col("words") & (F.col("rows") > 1)).alias("_again")), "stay")

    def of(wanted: DataFrame) -> DataFrame:
        here = docs["doc_id"].cast("long").eqNullSafe(wanted["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == wanted["_h"])
        return docs.join(wanted, here, "left_semi")

    kept, again = of(stay.where("not _again")), stay.where("_again")
    if again.isEmpty():
        return kept
    name = "_h_" + "_".join(docs.columns)
    hashed = of(again).withColumn(name, F.xxhash64("text"))
    return kept.union(hashed.dropDuplicates(["doc_id", name]).drop(name))
