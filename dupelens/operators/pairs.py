"""Pair table: records, filters, enrichment, statistics, histograms and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dupelens.functions.labels import duplicate_type_of_pair, experiment_type, similarity_range
from dupelens.runtime import materialize, side_by_side

# Default histogram thresholds.
BUCKETS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
ENDPOINT = ("asset_id", "file_key", "format", "source", "duration")
PAIR_KEY = ("asset_id_1", "file_key_1", "asset_id_2", "file_key_2")


def assemble(links: DataFrame, records: DataFrame) -> DataFrame:
    """Full pair records from (file_key_1, file_key_2, similarity) links and the fingerprint table."""

    def side(n: int) -> DataFrame:
        return records.select(*(F.col(c).alias(f"{c}_{n}") for c in ENDPOINT))

    joined = links.join(side(1), "file_key_1").join(side(2), "file_key_2")
    return with_labels(joined)


def with_labels(pairs: DataFrame) -> DataFrame:
    """Pair columns completed by same-asset flag, label and duration difference."""
    return pairs.select(
        "asset_id_1",
        "asset_id_2",
        (F.col("asset_id_1") == F.col("asset_id_2")).alias("is_same_asset"),
        "similarity",
        duplicate_type_of_pair().alias("duplicate_type"),
        "file_key_1",
        "format_1",
        "source_1",
        "duration_1",
        "file_key_2",
        "format_2",
        "source_2",
        "duration_2",
        F.abs(F.col("duration_1") - F.col("duration_2")).alias("duration_diff"),
    )


def star_links(records: DataFrame) -> DataFrame:
    """Every file of a fingerprint linked to the first file with it: the group's pairs in linear size."""
    first = materialize(records.groupBy("fingerprint").agg(F.min("file_key").alias("file_key_1")), "first-files")
    return (
        records.select("fingerprint", F.col("file_key").alias("file_key_2"))
        .join(first, "fingerprint")
        .where("file_key_1 <> file_key_2")
        .select("file_key_1", "file_key_2", F.lit(1.0).alias("similarity"))
    )


def unordered_key() -> list[Column]:
    """The pair of (asset, file) endpoints in a fixed order, so both orientations agree."""
    ends = F.sort_array(
        F.array(*(F.struct(F.col(f"asset_id_{n}").alias("asset"), F.col(f"file_key_{n}").alias("file")) for n in (1, 2)))
    )
    return [
        ends[0]["asset"].alias("low_asset"),
        ends[0]["file"].alias("low_file"),
        ends[1]["asset"].alias("high_asset"),
        ends[1]["file"].alias("high_file"),
    ]


KEY_NAMES = ["low_asset", "low_file", "high_asset", "high_file"]


def not_stored(pairs: DataFrame, stored: DataFrame) -> DataFrame:
    """Pairs that ``stored`` does not hold in either orientation."""
    keyed = pairs.select("*", *unordered_key())
    known = stored.select(*unordered_key())
    return keyed.join(known, KEY_NAMES, "left_anti").drop(*KEY_NAMES)


def above(pairs: DataFrame, threshold: float = 0.0) -> DataFrame:
    return pairs.where(F.col("similarity") >= threshold)


def attribute_filter(same_format: bool = False, cross_source: bool = False, same_source: bool = False) -> Column:
    """Conjunction of the asked attribute tests; cross and same source exclude each other."""
    if cross_source and same_source:
        raise ValueError("cross_source and same_source exclude each other")
    test = F.lit(True)
    if same_format:
        test = test & (F.col("format_1") == F.col("format_2"))
    if cross_source:
        test = test & (F.col("source_1") != F.col("source_2"))
    if same_source:
        test = test & (F.col("source_1") == F.col("source_2"))
    return test


def filter_counts(pairs: DataFrame, test: Column) -> DataFrame:
    """Pairs kept and filtered out."""
    return pairs.agg(
        F.count(F.lit(1)).alias("loaded"), F.count_if(test).alias("kept"), F.count_if(~test).alias("filtered_out")
    )


def comparable_sizes(size_1: Column, size_2: Column, max_ratio: float = 10.0) -> Column:
    """False where both sizes are known and one is more than ``max_ratio`` times the other."""
    known = (size_1 > 0) & (size_2 > 0)
    ratio = F.try_divide(F.greatest(size_1, size_2), F.least(size_1, size_2))
    return ~(known & F.coalesce(ratio > max_ratio, F.lit(False)))


def on_air(pairs: DataFrame, on_air_assets: DataFrame) -> DataFrame:
    """Pairs whose two (asset, source) endpoints are both on air."""
    keys = on_air_assets.select("asset_id", "source").distinct()
    for n in (1, 2):
        side = keys.select(F.col("asset_id").alias(f"asset_id_{n}"), F.col("source").alias(f"source_{n}"))
        pairs = pairs.join(side, [f"asset_id_{n}", f"source_{n}"], "left_semi")
    return pairs


def with_fingerprints(pairs: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Fingerprints of both endpoints by (asset, source, format); null where there is none."""
    for n in (1, 2):
        side = fingerprints.select(
            *(F.col(c).alias(f"{c}_{n}") for c in ("asset_id", "source", "format", "fingerprint"))
        )
        pairs = pairs.join(side, [f"asset_id_{n}", f"source_{n}", f"format_{n}"], "left")
    return pairs


def distinct_assets(pairs: DataFrame) -> DataFrame:
    """(asset, source) of both endpoints, each once."""
    ends = F.explode(
        F.array(
            *(F.struct(F.col(f"asset_id_{n}").alias("asset_id"), F.col(f"source_{n}").alias("source")) for n in (1, 2))
        )
    )
    return pairs.select(ends.alias("e")).select("e.asset_id", "e.source").distinct()


def counts_by_type(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("duplicate_type").agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("pairs"), "duplicate_type")


def counts_by_range(pairs: DataFrame) -> DataFrame:
    return (
        pairs.groupBy(similarity_range(F.col("similarity")).alias("similarity_range"))
        .agg(F.count(F.lit(1)).alias("pairs"), F.min("similarity").alias("lowest"))
        .orderBy(F.desc("lowest"))
    )


def totals(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count(F.lit(1)).alias("total_duplicates"),
        F.count_if(F.col("source_1") != F.col("source_2")).alias("cross_source"),
        F.count_if("is_same_asset").alias("same_asset"),
        F.count_if(~F.col("is_same_asset")).alias("different_asset"),
    )


def breakdown(pairs: DataFrame) -> DataFrame:
    """Pairs per format and per source pair."""
    return (
        pairs.groupBy("format_1", F.concat_ws("↔", "source_1", "source_2").alias("source_pair"))
        .agg(F.count(F.lit(1)).alias("pairs"))
    )


def bucket_number(similarity: Column, thresholds=BUCKETS) -> Column:
    """0-based bucket [t_i, t_i+1); the last one also takes its upper bound; null outside all buckets."""
    last = len(thresholds) - 2
    result = None
    for i in range(last + 1):
        inside = (similarity >= thresholds[i]) & (
            (similarity <= thresholds[i + 1]) if i == last else (similarity < thresholds[i + 1])
        )
        result = (F.when if result is None else result.when)(inside, i)
    return result


def bucket_label(low: float, high: float) -> str:
    return f"[{low:.1f}-{high:.1f})"


def histogram(pairs: DataFrame, thresholds=BUCKETS) -> DataFrame:
    """Count, share of all pairs and text bar per bucket; empty buckets show 0.

    The pairs are reduced to one row per bucket before anything else happens.
    """
    thresholds = sorted(thresholds)
    spark = pairs.sparkSession
    counted = pairs.groupBy(bucket_number(F.col("similarity"), thresholds).alias("bucket")).agg(
        F.count(F.lit(1)).alias("pairs")
    )
    buckets = spark.createDataFrame(
        [(i, bucket_label(*b), float(b[0]), float(b[1])) for i, b in enumerate(zip(thresholds, thresholds[1:]))],
        "bucket int, bucket_label string, bucket_min double, bucket_max double",
    )
    # Out-of-range pairs keep their (null) row, so they stay in the total; a handful of rows from here on.
    merged = counted.join(buckets, "bucket", "full_outer")
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("pairs").over(everything)
    share = F.coalesce(F.try_divide(F.coalesce("pairs", F.lit(0)) * 100.0, total), F.lit(0.0))
    return (
        merged.withColumn("percentage", share)
        .where(F.col("bucket").isNotNull())
        .select(
            "bucket_label",
            "bucket_min",
            "bucket_max",
            F.coalesce("pairs", F.lit(0)).alias("pairs"),
            "percentage",
            F.repeat(F.lit("█"), F.floor(F.col("percentage") / 2.5).cast("int")).alias("bar"),
        )
    )


def cumulative(hist: DataFrame) -> DataFrame:
    """Running share over the buckets in order (one row per bucket)."""
    upward = Window.orderBy("bucket_min").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("pairs").over(Window.partitionBy(F.lit(0)))
    return hist.select(
        "bucket_label",
        "pairs",
        F.coalesce(F.try_divide(F.sum("pairs").over(upward) * 100.0, total), F.lit(0.0)).alias("cumulative_pct"),
    )


def insights(pairs: DataFrame, thresholds=BUCKETS) -> DataFrame:
    """Most common bucket and the exact, high and low shares, from one pass over the pairs."""
    hist = histogram(pairs, thresholds)
    modal = hist.agg(F.max_by("bucket_label", F.struct("pairs", -F.col("bucket_min"))).alias("modal_bucket"), F.max("pairs").alias("modal_pairs"))
    s = F.col("similarity")
    shares = pairs.agg(
        F.count(F.lit(1)).alias("total_pairs"),
        F.count_if(s >= 1.0).alias("exact_pairs"),
        F.count_if(s >= 0.8).alias("high_pairs"),
        F.count_if(s < 0.5).alias("low_pairs"),
    )
    joined = side_by_side(shares, modal)
    for name in ("exact", "high", "low"):
        joined = joined.withColumn(
            f"{name}_pct", F.coalesce(F.try_divide(F.col(f"{name}_pairs") * 100.0, F.col("total_pairs")), F.lit(0.0))
        )
    return joined


def median(pairs: DataFrame, cells: int = 10_000) -> DataFrame:
    """Exact median similarity as one row, without bringing all values together.

    Counts per cell of the unit interval (a fixed number of rows) locate the one or two cells that hold the
    middle ranks; only their distinct values are ordered.
    """
    counted = pairs.where(F.col("similarity").isNotNull()).groupBy("similarity").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("cell", F.floor(F.col("similarity") * cells))
    upward = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    totals = counted.groupBy("cell").agg(F.sum("n").alias("cell_n"))
    totals = totals.select(
        "cell",
        (F.sum("cell_n").over(upward) - F.col("cell_n")).alias("before"),
        F.sum("cell_n").over(upward).alias("upto"),
        F.sum("cell_n").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    lower, upper = F.expr("(total + 1) div 2"), F.expr("(total + 2) div 2")
    middle = totals.where((F.col("upto") >= lower) & (F.col("before") < upper))
    inside = Window.partitionBy("cell").orderBy("similarity").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.join(F.broadcast(middle), "cell").withColumn("last", F.col("before") + F.sum("n").over(inside))
    first = F.col("last") - F.col("n")
    low = F.max(F.when((first < lower) & (F.col("last") >= lower), F.col("similarity")))
    high = F.max(F.when((first < upper) & (F.col("last") >= upper), F.col("similarity")))
    return ranked.agg(F.round((low + high) / 2, 6).alias("median"))


def summary(pairs: DataFrame) -> DataFrame:
    """Count, mean, extremes, median and tier counts of both tier tables."""
    s = F.col("similarity")
    stats = pairs.agg(
        F.count("similarity").alias("comparisons"),
        F.round(F.avg(s), 6).alias("average"),
        F.max(s).alias("highest"),
        F.min(s).alias("lowest"),
        F.count_if(s >= 0.99).alias("identical"),
        F.count_if((s >= 0.90) & (s < 0.99)).alias("very_high"),
        F.count_if((s >= 0.80) & (s < 0.90)).alias("high"),
        F.count_if((s >= 0.50) & (s < 0.80)).alias("medium"),
        F.count_if(s < 0.50).alias("low"),
        F.count_if(s >= 0.95).alias("version_very_high"),
        F.count_if((s >= 0.80) & (s < 0.95)).alias("version_high"),
    )
    return side_by_side(stats, median(pairs))


def experiment_counts(pairs: DataFrame, threshold: float = 0.75, sizes: tuple[str, str] | None = None) -> DataFrame:
    """Pairs per experiment label among pairs above the threshold; with ``sizes``, the columns of both file sizes, pairs of
    very different sizes are left out before anything else."""
    if sizes:
        pairs = pairs.where(comparable_sizes(*(F.col(c) for c in sizes)))
    label = experiment_type(F.col("similarity"), F.col("format_1") == F.col("format_2"))
    return above(pairs, threshold).groupBy(label.alias("duplicate_type")).agg(F.count(F.lit(1)).alias("pairs"))


def _shuffled(seed: int, *keys: str) -> Column:
    """A reproducible random order: the digest of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *keys))


def stratified_sample(pairs: DataFrame, per_bucket: int = 5, seed: int = 42, thresholds=BUCKETS) -> DataFrame:
    """At most ``per_bucket`` random pairs of each bucket.

    Every map task keeps ``per_bucket`` rows per bucket before the shuffle, so large buckets cost nothing.
    """
    bucketed = pairs.withColumn("bucket", bucket_number(F.col("similarity"), sorted(thresholds))).where(
        F.col("bucket").isNotNull()
    )
    order = Window.partitionBy("bucket").orderBy(_shuffled(seed, *PAIR_KEY), *PAIR_KEY)
    return bucketed.withColumn("pair_number", F.row_number().over(order)).where(F.col("pair_number") <= per_bucket)


def random_sample(rows: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    return rows.orderBy(_shuffled(seed, *keys), *keys).limit(n)


def sample_bundle(pairs: DataFrame, fingerprints: DataFrame, per_bucket: int = 5, thresholds=BUCKETS) -> DataFrame:
    """Per bucket its size, the number sampled and the sampled pairs with fingerprints and file names."""
    sizes = pairs.groupBy(bucket_number(F.col("similarity"), sorted(thresholds)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("total_pairs")
    )
    sampled = with_fingerprints(stratified_sample(pairs, per_bucket, thresholds=thresholds), fingerprints)
    info = F.struct("pair_number", "asset_id_1", "asset_id_2", "similarity", "fingerprint_1", "fingerprint_2")
    bundles = sampled.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sampled"), F.sort_array(F.collect_list(info)).alias("pairs")
    )
    return bundles.join(sizes, "bucket").select("bucket", "total_pairs", "sampled", "pairs")
