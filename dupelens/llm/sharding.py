"""Sharding by balanced label propagation, with row counts at most one apart.

Equal texts are one unit. Units that share a MinHash value of their word shingles are linked through it, so a link
table has at most ``HASHES`` rows per unit, however many units share a value. Each round joins the labels to the values, lets
each value vote for the shard where most of its rows are, and each unit wish for the shard with most votes. Wishes are
granted by quota: between two shards as many rows as wish to go the other way, plus what the target has room for up to ``SLACK`` percent
above the mean; which units go is decided by a hash. Quotas are worked out from sums over pairs of shards, never from units.

Last, rows are put in the order of shard, link and unit, numbered by running sums over small cells, and cut into
equal parts: this settles what the quotas left uneven, and units without links stand at the borders to take the shift.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dupelens.llm.tables import keep, texts
from dupelens.llm.words import mixed, row_shingles

SHARDS = 24
HASHES = 4
WORDS = 5
ROUNDS = 4
BUCKETS = 64
HOT_ROWS = 1_000
SLACK = 10
SEEDS = [np.uint64(0x243F6A8885A308D3 + 0x9E3779B97F4A7C15 * i & (1 << 64) - 1) for i in range(HASHES)]


def described(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32, unit, values)``: bytes plus 8, checksum, digest of the text, MinHash values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums, units, values = [], [], [], []
            for value, found in zip(batch.column("text"), row_shingles(batch.column("text"), WORDS), strict=True):
                raw = value.as_py().encode()
                sizes.append(len(raw) + 8)
                sums.append(zlib.crc32(raw))
                units.append(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True))
                values.append([int(mixed(found ^ s).min().view(np.int64)) for s in SEEDS] if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(units, pa.int64()),
                    pa.array(values, pa.list_(pa.int64())),
                ],
                names=["doc_id", "size", "text_crc32", "unit", "values"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, size long, text_crc32 long, unit long, values array<long>")


def links(units: DataFrame) -> DataFrame:
    """``(unit, n, value)``: MinHash values that at least two units share."""
    every = units.select("unit", "n", F.explode(F.array_distinct("values")).alias("value"))
    # Written, so that the join is of two plain shuffles and a value of very many units can be split.
    shared = keep(every.groupBy("value").agg(F.count(F.lit(1)).alias("units")).where("units > 1"), "shared")
    return every.join(shared.select("value"), "value").select("unit", "n", "value")


def _hashed(*seed) -> Column:
    """A number in [0, 1) that depends on the unit and the seed."""
    return F.pmod(F.xxhash64("unit", *(F.lit(s) for s in seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def wishes(linked: DataFrame, labels: DataFrame) -> DataFrame:
    """``(unit, n, label, wish)`` of the units that most of their linked rows would have elsewhere.

    Ties are settled by a hash of value and label, so that they draw different values to different shards.
    """
    labelled = linked.join(labels.select("unit", "label"), "unit")
    votes = labelled.groupBy("value", "label").agg(F.sum("n").alias("rows"))
    most = F.max(F.struct("rows", F.xxhash64("value", "label").alias("tie"), F.col("label").alias("choice"))).alias("most")
    best = keep(votes.groupBy("value").agg(most).select("value", "most.*"), "best")
    counted = labelled.join(best, "value").groupBy("unit", "n", "label", "choice").agg(
        F.count(F.lit(1)).alias("votes"), F.sum("rows").alias("rows"), F.max("tie").alias("tie")
    )
    chosen = counted.groupBy("unit", "n", "label").agg(F.max_by("choice", F.struct("votes", "rows", "tie")).alias("wish"))
    return chosen.where("wish <> label")


def quotas(flows: list[tuple[int, int, int]], loads: dict[int, int], shards: int, slack: int = 0) -> list[tuple[int, int, float]]:
    """For each pair of shards the share of wishes that is granted: exchanges, and the room that the target has
    below the mean load and ``slack`` percent of it more."""
    wish = {(a, b): n for a, b, n in flows}
    most = -(-sum(loads.values()) * (100 + slack) // (100 * shards))
    room = {s: max(0, most - loads.get(s, 0)) for s in range(shards)}
    granted = {}
    for (a, b), n in sorted(wish.items()):
        swap = min(n, wish.get((b, a), 0))
        extra = min(n - swap, room[b])
        room[b] -= extra
        granted[a, b] = (swap + extra) / n
    return [(a, b, share) for (a, b), share in granted.items()]


def propagated(units: DataFrame, shards: int, rounds: int) -> DataFrame:
    """``(unit, label, place)``: the shard of each unit, and where its rows stand in it (1: linked, 0 and 2: borders)."""
    spark = units.sparkSession
    linked = keep(links(units), "links")
    first = F.floor(_hashed(0) * shards).cast("int")
    alone = units.join(linked.select("unit").distinct(), "unit", "left_anti")
    labels = keep(
        linked.groupBy("unit").agg(F.first("n").alias("n"), F.min("value").alias("value")).withColumn("label", first), "labels"
    )
    rest = {r["label"]: r["n"] for r in alone.groupBy(first.alias("label")).agg(F.sum("n").alias("n")).collect()}
    for turn in range(1, rounds + 1):
        asked = keep(wishes(linked, labels), "wishes")
        flows = [tuple(r) for r in asked.groupBy("label", "wish").agg(F.sum("n")).collect()]
        if not flows:
            break
        loads = dict(rest)
        for r in labels.groupBy("label").agg(F.sum("n").alias("n")).collect():
            loads[r["label"]] = loads.get(r["label"], 0) + r["n"]
        shares = spark.createDataFrame(quotas(flows, loads, shards, SLACK), "label int, wish int, share double")
        moved = asked.join(F.broadcast(shares), ["label", "wish"]).where(_hashed(turn) < F.col("share")).select("unit", "wish")
        labels = keep(
            labels.join(moved, "unit", "left").withColumn("label", F.coalesce("wish", "label")).select("unit", "n", "value", "label"),
            "labels",
        )
    borders = alone.select("unit", first.alias("label"), F.when(_hashed(-1) < 0.5, 0).otherwise(2).alias("place"), F.col("unit").alias("value"))
    return labels.select("unit", "label", F.lit(1).alias("place"), "value").union(borders)


def numbered(rows: DataFrame, order: list[str], inside: list[Column]) -> DataFrame:
    """Adds ``rank``, from 0, in the order of ``order`` and then ``inside``, without sorting all rows in one task.

    Rows are numbered in the cells that ``order`` names; only the sizes of cells are summed up in one place.
    """
    sizes = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("rows"))
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("start", F.coalesce(F.sum("rows").over(running), F.lit(0))).drop("rows")
    within = rows.withColumn("at", F.row_number().over(Window.partitionBy(*order).orderBy(*inside)))
    return within.join(starts, order).withColumn("rank", F.col("start") + F.col("at") - 1).drop("start", "at")


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row, by the law ``rows``.

    Null texts are empty texts of size 8. Rows with equal texts stand next to each other, a group larger than a shard
    fills several. Repeated rows get slots of their own; an empty table gives an empty result. ``grown_shard`` is null.
    """
    base = keep(described(docs), "described")
    units = base.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.first("values").alias("values"))
    placed = propagated(keep(units, "units"), shards, rounds)
    sizes = units.select("unit", "n")
    labelled = base.drop("values").join(placed.join(sizes, "unit"), "unit")
    parts = F.ceil(F.col("n") / HOT_ROWS).cast("int")
    hot = F.col("n") > HOT_ROWS
    cells = labelled.select(
        "doc_id", "size", "text_crc32", "label", "place", "value", "unit",
        F.pmod(F.xxhash64("value"), F.lit(BUCKETS)).cast("int").alias("bucket"),
        F.when(hot, F.col("unit")).otherwise(F.lit(-(2**63))).alias("group"),
        F.when(hot, F.pmod(F.xxhash64("doc_id"), parts)).otherwise(0).cast("int").alias("part"),
    )
    total = base.count()
    low, more = divmod(total, shards)
    ranked = numbered(cells, ["label", "place", "bucket", "group", "part"], [F.col(c) for c in ("value", "unit", "doc_id")])
    rank, early = F.col("rank"), more * (low + 1)
    shard = F.when(rank < early, F.floor(rank / (low + 1))).otherwise(more + F.floor((rank - early) / max(low, 1))).cast("int")
    start = F.when(F.col("shard") < more, F.col("shard") * (low + 1)).otherwise(early + (F.col("shard") - more) * low)
    return ranked.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("rank") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "unit",
    )
