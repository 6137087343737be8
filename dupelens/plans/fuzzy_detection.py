"""End-to-end fuzzy detection: scan, block by duration, leave out what is known, score, label, count.

Files of one cluster with equal fingerprint, source and format form a *unit*. Similarity, label, mode and
format tests are the same for all file pairs of two units, so results are kept per pair of units with the
exact number of file pairs they stand for. The result stays linear in the number of copies of a file,
where a list of file pairs would grow with its square; ``unit_members`` names the files of each unit.

Content is stored once per cluster and fingerprint, beside lean records. File pairs are counted for the candidates before any
content is moved: pairs of one asset, of another mode, or known from earlier runs are taken off, and what has none left is never
scored. One scoring pass writes tagged rows, results and errors, and counts them as it goes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dupelens.functions.labels import duplicate_type_of_pair
from dupelens.functions.sequences import MAX_OFFSET
from dupelens.operators import candidates, clustering, pair_space
from dupelens.runtime import fresh_path, materialize, side_by_side

UNIT = ["cluster_start", "fingerprint", "source", "format"]
UNIT_PAIR = ["cluster_start", "fingerprint_1", "source_1", "format_1", "fingerprint_2", "source_2", "format_2"]
KNOWN = ["asset_id_1", "file_key_1", "asset_id_2", "file_key_2"]
MODES = ("all", "cross-source", "same-source")
DEFAULT_THRESHOLD = 0.60


@dataclass
class Blocked:
    """Records of duration clusters without their content, the content once per cluster and fingerprint (where the records
    have any), both written once, and the durations they came from."""

    records: DataFrame
    durations: clustering.Durations
    classes: DataFrame | None = None


@dataclass
class Detection:
    """Labelled pairs of units, the files that could not be compared, and what the scoring pass counted: pairs of
    contents ``scored``, of them ``results``, and contents that gave ``errors``."""

    pairs: DataFrame
    errors: DataFrame
    counts: dict[str, int]


def block(records: DataFrame, tolerance: float = 5.0, words: Column | None = None) -> Blocked:
    """Attaches anchored duration clusters to usable records. Their sequences are the column ``words``, or are made by the expression
    ``words`` from the column ``content``, of one copy of a content."""
    held = "words" if words is None else "content"
    # Records are read twice, once without and once with their content.
    plain = materialize(records.drop(held), "records")
    durations = clustering.Durations(plain)
    clusters = materialize(clustering.anchored_clusters(durations, tolerance), "clusters")
    lean = materialize(clustering.attach(plain, clusters, durations), "blocked")
    if held not in records.columns:
        return Blocked(lean, durations)
    content = clustering.attach(records.select("duration", "fingerprint", held), clusters, durations)
    return Blocked(lean, durations, candidates.content_classes(content, words))


def unit_members(blocked: DataFrame) -> DataFrame:
    return blocked.select(*UNIT, "asset_id", "file_key")


def _units(blocked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files per (unit, asset), and per unit the files and the pairs of files of different assets."""
    per_asset = blocked.groupBy(*UNIT, "asset_id").agg(F.count(F.lit(1)).alias("n"))
    units = per_asset.groupBy(*UNIT).agg(F.sum("n").alias("files"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    return per_asset, units


def _side(frame: DataFrame, side: int, *extra: str) -> DataFrame:
    keep = [F.col("cluster_start")]
    keep += [F.col(c).alias(f"{c}_{side}") for c in ("fingerprint", "source", "format", *extra)]
    return frame.select(*keep)


def _shared_asset_pairs(unit_pairs: DataFrame, per_asset: DataFrame) -> DataFrame:
    """File pairs of two different units that belong to one asset. Only assets with files in more than
    one unit of a cluster can have any, so all others are left out first."""
    in_several = (
        per_asset.groupBy("cluster_start", "asset_id").agg(F.count(F.lit(1)).alias("units")).where("units > 1")
    )
    shared = per_asset.join(in_several.drop("units"), ["cluster_start", "asset_id"], "left_semi")
    left = _side(shared, 1, "asset_id", "n")
    right = _side(shared, 2, "asset_id", "n").withColumnRenamed("asset_id_2", "asset_id_1")
    return (
        unit_pairs.select(*UNIT_PAIR)
        .join(left, UNIT_PAIR[:4])
        .join(right, ["cluster_start", *UNIT_PAIR[4:], "asset_id_1"])
        .groupBy(*UNIT_PAIR)
        .agg(F.sum(F.col("n_1") * F.col("n_2")).alias("same_asset"))
    )


def _known_pairs(records: DataFrame, known: DataFrame) -> DataFrame:
    """Known file pairs per pair of units: (``UNIT_PAIR``, known). Endpoints count in either order, repeated ones once."""
    one, other = (F.struct(F.col(f"asset_id_{n}").alias("asset_id"), F.col(f"file_key_{n}").alias("file_key")) for n in (1, 2))
    ends = known.where("asset_id_1 <> asset_id_2").select(F.least(one, other).alias("one"), F.greatest(one, other).alias("other"))
    asked = ends.distinct().select(
        F.col("one.asset_id").alias("asset_id_1"), F.col("one.file_key").alias("file_key_1"),
        F.col("other.asset_id").alias("asset_id_2"), F.col("other.file_key").alias("file_key_2"),
    )
    unit = F.struct("fingerprint", "source", "format")
    places = records.select("cluster_start", "asset_id", "file_key", unit.alias("unit"))
    for n in (1, 2):
        side = places.select("cluster_start", *(F.col(c).alias(f"{c}_{n}") for c in ("asset_id", "file_key", "unit")))
        asked = asked.join(side, [f"asset_id_{n}", f"file_key_{n}", *(["cluster_start"] if n == 2 else [])])
    ordered = asked.select("cluster_start", F.least("unit_1", "unit_2").alias("u1"), F.greatest("unit_1", "unit_2").alias("u2"))
    names = ("fingerprint", "source", "format")
    return (
        ordered.select("cluster_start", *(F.col(f"u{n}.{c}").alias(f"{c}_{n}") for n in (1, 2) for c in names))
        .groupBy(*UNIT_PAIR)
        .agg(F.count(F.lit(1)).alias("known"))
    )


def open_pairs(blocked: Blocked, class_pairs: DataFrame, mode: str = "all", known: DataFrame | None = None) -> DataFrame:
    """Pairs of units of the mode that have file pairs of different assets which are not known, with their number.

    ``class_pairs`` (class_1, class_2) are pairs of different content; pairs of equal content are added, with null classes.
    """
    per_asset, units = _units(blocked.records)
    left, right = _side(units, 1, "files", "squares"), _side(units, 2, "files")
    names = blocked.classes.select("class_id", "cluster_start", "fingerprint")
    sides = class_pairs
    for n in (1, 2):
        own = names.select(F.col("class_id").alias(f"class_{n}"), *(["cluster_start"] if n == 1 else []), F.col("fingerprint").alias(f"f_{n}"))
        sides = sides.join(own, f"class_{n}")
    swap = F.col("f_1") > F.col("f_2")
    between = sides.select(
        "cluster_start",
        F.when(swap, F.col("class_2")).otherwise(F.col("class_1")).alias("class_1"),
        F.when(swap, F.col("class_1")).otherwise(F.col("class_2")).alias("class_2"),
        F.least("f_1", "f_2").alias("fingerprint_1"),
        F.greatest("f_1", "f_2").alias("fingerprint_2"),
    )
    different = between.join(left, ["cluster_start", "fingerprint_1"]).join(right, ["cluster_start", "fingerprint_2"])
    # Equal content: one row per source and format combination, not per file. Missing content equals nothing.
    readable = blocked.classes.where("length > 0").select("cluster_start", F.col("fingerprint").alias("fingerprint_1"))
    one = left.join(readable, ["cluster_start", "fingerprint_1"], "left_semi")
    same = one.join(
        right, (one.cluster_start == right.cluster_start) & (F.col("fingerprint_1") == F.col("fingerprint_2"))
    ).drop(right.cluster_start)
    same = same.where(
        (F.col("source_1") < F.col("source_2"))
        | ((F.col("source_1") == F.col("source_2")) & (F.col("format_1") <= F.col("format_2")))
    )
    unit_pairs = materialize(in_mode(different.unionByName(same, allowMissingColumns=True), mode), "unit-pairs")
    is_same_unit = (
        (F.col("fingerprint_1") == F.col("fingerprint_2"))
        & (F.col("source_1") == F.col("source_2"))
        & (F.col("format_1") == F.col("format_2"))
    )
    counted = unit_pairs.join(_shared_asset_pairs(unit_pairs.where(~is_same_unit), per_asset), UNIT_PAIR, "left")
    within = F.expr("(files_1 * files_1 - squares_1) div 2")
    across = F.col("files_1") * F.col("files_2") - F.coalesce("same_asset", F.lit(0))
    counted = counted.withColumn("file_pairs", F.when(is_same_unit, within).otherwise(across))
    if known is not None:
        counted = counted.join(_known_pairs(blocked.records, known), UNIT_PAIR, "left")
        counted = counted.withColumn("file_pairs", F.col("file_pairs") - F.coalesce("known", F.lit(0)))
    kept = counted.where("file_pairs > 0").select(*UNIT_PAIR, "class_1", "class_2", "files_1", "files_2", "file_pairs")
    return materialize(kept, "open-pairs")


def in_mode(unit_pairs: DataFrame, mode: str) -> DataFrame:
    """Pairs of the asked mode: all, cross-source or same-source."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}: expected one of {MODES}")
    if mode == "all":
        return unit_pairs
    same_source = F.col("source_1") == F.col("source_2")
    return unit_pairs.where(same_source if mode == "same-source" else ~same_source)


def _scoring_pass(to_score: DataFrame, classes: DataFrame, threshold: float, max_offset: int, max_bits: int) -> tuple[DataFrame, dict]:
    """Scores all pairs, and every missing content once, and writes rows tagged ``result``, ``below`` or ``error``."""
    missing = classes.where("length <= 0").select(F.col("class_id").alias("class_1"), F.lit(None).cast("bigint").alias("class_2"))
    scored = candidates.score_pairs(to_score.unionByName(missing), classes, max_offset, max_bits)
    similarity = F.col("similarity")
    outcome = F.when(similarity.isNull(), "error").when(similarity >= threshold, "result").otherwise("below")
    seen = Observation()
    tagged = scored.withColumn("outcome", outcome).observe(
        seen,
        F.count_if(F.col("outcome") != "error").alias("scored"),
        F.count_if(F.col("outcome") == "result").alias("results"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
    )
    return materialize(tagged, "scored"), dict(seen.get)


def _failed_files(records: DataFrame, failed: DataFrame) -> DataFrame:
    """One row per file that could not be compared, with ``comparisons``, the files of other assets that it would have met."""
    of_asset = records.groupBy("cluster_start", "asset_id").agg(F.count(F.lit(1)).alias("own"))
    of_cluster = of_asset.groupBy("cluster_start").agg(F.sum("own").alias("all"))
    kept = [c for c in ("format", "source", "duration") if c in records.columns]
    return (
        records.join(failed, ["cluster_start", "fingerprint"], "left_semi")
        .join(of_asset, ["cluster_start", "asset_id"])
        .join(of_cluster, "cluster_start")
        .withColumn("comparisons", F.col("all") - F.col("own"))
        .where("comparisons > 0")
        .select(
            F.lit("comparison_returned_none").alias("error_type"),
            F.lit("no content to compare").alias("error_message"),
            F.current_timestamp().alias("timestamp"),
            "cluster_start", "asset_id", "file_key", "fingerprint", *kept, "comparisons",
        )
    )


def compare(
    blocked: Blocked,
    mode: str = "all",
    threshold: float = DEFAULT_THRESHOLD,
    known: DataFrame | None = None,
    max_offset: int = MAX_OFFSET,
    max_bits: int = 0,
) -> Detection:
    """Compares all content of each cluster. ``known`` (``KNOWN``) names file pairs that need no comparison any more."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}: expected one of {MODES}")
    found = candidates.candidate_pairs(blocked.classes, threshold, max_offset, max_bits)
    pairs = open_pairs(blocked, found, mode, known)
    to_score = pairs.where("class_1 is not null").select("class_1", "class_2").distinct()
    scored, counts = _scoring_pass(to_score, blocked.classes, threshold, max_offset, max_bits)
    results = scored.where("outcome = 'result'").select("class_1", "class_2", "similarity")
    similar = pairs.join(results, ["class_1", "class_2"]).unionByName(
        pairs.where("class_1 is null").withColumn("similarity", F.lit(1.0))
    )
    labelled = similar.withColumn("duplicate_type", duplicate_type_of_pair()).select(
        *UNIT_PAIR, "similarity", "duplicate_type", "files_1", "files_2", "file_pairs"
    )
    failed = scored.where("outcome = 'error'").select("cluster_start", F.coalesce("fingerprint_1", "fingerprint_2").alias("fingerprint"))
    return Detection(labelled, _failed_files(blocked.records, failed), counts)


def detect(blocked: Blocked, mode: str = "all", threshold: float = DEFAULT_THRESHOLD, known: DataFrame | None = None) -> DataFrame:
    """Labelled pairs of units with a similarity of at least ``threshold``."""
    return compare(blocked, mode, threshold, known).pairs


def not_known(unit_pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose content is not among ``known`` (fingerprint_1, fingerprint_2), in either order."""
    key = [F.least("fingerprint_1", "fingerprint_2").alias("low"), F.greatest("fingerprint_1", "fingerprint_2").alias("high")]
    seen = known.select(*key).distinct()
    return unit_pairs.select("*", *key).join(seen, ["low", "high"], "left_anti").drop("low", "high")


def run_summary(blocked: Blocked, found: Detection) -> DataFrame:
    """One row: songs, clusters, comparisons, skipped pairs, comparisons that failed, duplicates, share of the brute-force
    work saved. A comparison fails if the content of either file is missing."""
    songs = blocked.durations.records
    brute = songs * (songs - 1) // 2
    counts = pair_space.cluster_pairs(blocked.records).agg(
        F.count(F.lit(1)).alias("clusters"),
        F.sum("compared").alias("comparisons"),
        F.sum(F.col("skipped_same_file") + F.col("skipped_same_asset")).alias("skipped"),
    )
    failed = found.errors.select("cluster_start", "fingerprint").distinct()
    sound = blocked.records.join(failed, ["cluster_start", "fingerprint"], "left_anti")
    compared = pair_space.cluster_pairs(sound).agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("scored"))
    duplicates = found.pairs.agg(F.coalesce(F.sum("file_pairs"), F.lit(0)).alias("duplicates"))
    joined = side_by_side(counts, compared, duplicates)
    saved = (1 - F.col("comparisons") / F.lit(brute)) * 100 if brute else F.lit(0.0)
    return joined.select(
        F.lit(songs).cast("bigint").alias("songs"),
        "clusters",
        "comparisons",
        "skipped",
        (F.col("comparisons") - F.col("scored")).alias("errors"),
        "duplicates",
        F.round(saved, 6).alias("efficiency_pct"),
    )
