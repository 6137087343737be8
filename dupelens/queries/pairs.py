"""Pair analytics: filters, joins, labels, histograms, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from dupelens.functions import labels
from dupelens.functions.mapping import source_of_indicator
from dupelens.operators import pairs as ops
from dupelens.queries.exact import PER_SONG
from dupelens.queries.exact import SPARK as EXACT
from dupelens.queries.views import with_views
from dupelens.sources import fixtures
from dupelens.sources.fingerprints import usable

KEYS = ("file_key_1", "file_key_2")
CUSTOM = (0.2, 0.35, 0.5, 0.65, 0.8, 0.95)


def _pairs(spark, sf):
    return fixtures.pairs(spark, sf)


def _labelled(spark, sf):
    return ops.with_labels(_pairs(spark, sf))


def _on_air_assets(spark, sf):
    asset = fixtures.asset(spark, sf)
    return asset.where(
        (F.col("last_status_group") == "ON_AIR")
        & F.col("product_indicator").isin(1, 3)
        & (F.col("asset_type") == "Music")
    ).select("asset_id", source_of_indicator("product_indicator").alias("source"))


def _fingerprints(spark, sf):
    return usable(fixtures.fingerprint(spark, sf)).select("asset_id", "source", "format", "fingerprint")


def _records(spark, sf):
    records = usable(fixtures.fingerprint(spark, sf))
    return ops.assemble(ops.star_links(records), records)


def _arithmetic(spark, sf):
    one, two = F.col("duration_1"), F.col("duration_2")
    return _pairs(spark, sf).select(
        *KEYS,
        F.abs(one - two).alias("duration_diff"),
        F.try_divide(one, two).alias("size_ratio"),
        (F.try_divide(F.abs(one - two), two) * 100).alias("size_diff_pct"),
        F.abs(F.length("file_key_1") - F.length("file_key_2")).alias("length_diff"),
    )


def _warnings(spark, sf):
    one, two = F.col("duration_1"), F.col("duration_2")
    warned = labels.pair_warnings(F.abs(one - two), F.try_divide(one, two + 100), F.col("similarity"), F.col("similarity"))
    return _pairs(spark, sf).select(*KEYS, F.array_join(warned, ",").alias("warnings"))


def _statuses(spark, sf):
    return _pairs(spark, sf).select(
        *KEYS, *(labels.status(F.col("similarity"), name).alias(f"{name}_status") for name in labels.STATUS_TABLES)
    )


def _stored(spark, sf):
    """Pairs known before: the most similar ones, some of them stored the other way round."""
    known = _pairs(spark, sf).where("similarity >= 0.9")
    swap = F.col("format_1") == "wav"
    names = [f"{c}_{n}" for c in ("asset_id", "file_key") for n in (1, 2)]
    other = {name: name[:-1] + ("2" if name.endswith("1") else "1") for name in names}
    return known.select(*(F.when(swap, F.col(other[n])).otherwise(F.col(n)).alias(n) for n in names))


def _size_filter(spark, sf):
    keep = ops.comparable_sizes(F.col("duration_1"), F.col("asset_id_2").cast("double"))
    return _pairs(spark, sf).where(keep).select(*KEYS, "duration_1", "asset_id_2")


def _sample(spark, sf):
    return ops.stratified_sample(_pairs(spark, sf)).select("bucket", "pair_number", *KEYS, "similarity")


def _bundle(spark, sf):
    bundles = ops.sample_bundle(_pairs(spark, sf), _fingerprints(spark, sf))
    return bundles.withColumn("pairs", F.to_json("pairs", {"ignoreNullFields": "false"}))


SPARK = {
    "pair_records": _records,
    "classify_pairs": lambda s, d: _labelled(s, d).select(*KEYS, "similarity", "duplicate_type"),
    "similarity_status": _statuses,
    "experiment_types": lambda s, d: ops.experiment_counts(_pairs(s, d)),
    "pair_arithmetic": _arithmetic,
    "pair_warnings": _warnings,
    "pairs_above_threshold": lambda s, d: ops.above(_pairs(s, d), 0.75).select(*KEYS, "similarity"),
    "pairs_attribute_filters": lambda s, d: _pairs(s, d)
    .where(ops.attribute_filter(same_format=True, cross_source=True))
    .select(*KEYS, "format_1", "source_1", "source_2"),
    "pairs_filter_counts": lambda s, d: ops.filter_counts(
        _pairs(s, d), ops.attribute_filter(same_format=True, same_source=True)
    ),
    "size_ratio_prefilter": _size_filter,
    "pairs_on_air": lambda s, d: ops.on_air(_pairs(s, d), _on_air_assets(s, d)).select(*KEYS, "similarity"),
    "pairs_with_fingerprints": lambda s, d: ops.with_fingerprints(_pairs(s, d), _fingerprints(s, d)).select(
        *KEYS, "fingerprint_1", "fingerprint_2"
    ),
    "new_pairs_only": lambda s, d: ops.not_stored(_pairs(s, d), _stored(s, d)).select(*KEYS, "similarity"),
    "distinct_pair_assets": lambda s, d: ops.distinct_assets(_pairs(s, d)),
    "pairs_by_type": lambda s, d: ops.counts_by_type(_labelled(s, d)),
    "pairs_by_similarity_range": lambda s, d: ops.counts_by_range(_pairs(s, d)),
    "pair_totals": lambda s, d: ops.totals(_labelled(s, d)),
    "pair_breakdown": lambda s, d: ops.breakdown(_pairs(s, d)),
    "similarity_histogram": lambda s, d: ops.histogram(_pairs(s, d)),
    "similarity_histogram_custom": lambda s, d: ops.histogram(_pairs(s, d), CUSTOM),
    "similarity_cdf": lambda s, d: ops.cumulative(ops.histogram(_pairs(s, d))),
    "similarity_insights": lambda s, d: ops.insights(_pairs(s, d)),
    "similarity_summary": lambda s, d: ops.summary(_pairs(s, d)),
    "pairs_ranked": lambda s, d: _pairs(s, d).orderBy(F.desc("similarity"), *KEYS).select(*KEYS, "similarity"),
    "stratified_sample": _sample,
    "sample_bundle": _bundle,
    "random_sample": lambda s, d: ops.random_sample(EXACT["duplicated_assets"](s, d), 5, ["song_id", "product_indicator"]),
}

DUPLICATE_TYPE = """case when similarity >= 0.95 then case when format_1 = format_2 and source_1 = source_2 then 'IDENTICAL'
                                         when source_1 = source_2 then 'SAME_CONTENT_DIFF_FORMAT' else 'CROSS_SOURCE_IDENTICAL' end
       when similarity >= 0.80 then case when source_1 = source_2 then 'HIGH_SIMILARITY_SAME_SOURCE' else 'HIGH_SIMILARITY_CROSS_SOURCE' end
       when similarity >= 0.60 then 'RELATED_VERSIONS' else 'LOW_SIMILARITY' end"""


def _sql(body: str, extra: str = "", views: str = "pairs", recursive: bool = False) -> str:
    return with_views(views, body, extra, recursive)


def _buckets(thresholds) -> str:
    rows = ", ".join(
        f"({i}, {low}::double, {high}::double)" for i, (low, high) in enumerate(zip(thresholds, thresholds[1:]))
    )
    last = len(thresholds) - 2
    return f"""buckets(bucket, bucket_min, bucket_max) as (values {rows}),
bucketed as (select p.*, b.bucket from pairs p join buckets b
   on p.similarity >= b.bucket_min and (p.similarity < b.bucket_max or (b.bucket = {last} and p.similarity = b.bucket_max))),
hist as (select b.*, (select count(*) from bucketed x where x.bucket = b.bucket) as pairs, (select count(*) from pairs) as total from buckets b)"""


BUCKETS = _buckets(ops.BUCKETS)
HISTOGRAM = """select printf('[%.1f-%.1f)', bucket_min, bucket_max) as bucket_label, bucket_min, bucket_max, pairs,
    pairs * 100.0::double / total as percentage, repeat('█', cast(floor(pairs * 100.0::double / total / 2.5) as integer)) as bar from hist"""
FP = "fps as (select asset_id, source, format, fingerprint from fingerprint where processing_status = 'SUCCESS' and fingerprint is not null and duration > 0)"
SAMPLED = """sampled as (select * from (select *, row_number() over (partition by bucket
    order by md5(concat_ws('|', '42', asset_id_1, file_key_1, asset_id_2, file_key_2)), asset_id_1, file_key_1, asset_id_2, file_key_2)::integer as pair_number
  from bucketed) where pair_number <= 5)"""
STORED = """stored as (select case when format_1 = 'wav' then file_key_2 else file_key_1 end as f1,
    case when format_1 = 'wav' then file_key_1 else file_key_2 end as f2,
    case when format_1 = 'wav' then asset_id_2 else asset_id_1 end as a1, case when format_1 = 'wav' then asset_id_1 else asset_id_2 end as a2
  from pairs where similarity >= 0.9)"""
IS_STORED = """exists (select 1 from stored s where (s.a1 = p.asset_id_1 and s.f1 = p.file_key_1 and s.a2 = p.asset_id_2 and s.f2 = p.file_key_2)
    or (s.a1 = p.asset_id_2 and s.f1 = p.file_key_2 and s.a2 = p.asset_id_1 and s.f2 = p.file_key_1))"""
STATUS = """case when similarity >= {0} then '{4}' when similarity >= {1} then '{5}' when similarity >= {2} then '{6}'
     when similarity >= {3} then '{7}' else '{8}' end as {9}_status"""


def _status(name: str) -> str:
    table = labels.STATUS_TABLES[name]
    return STATUS.format(*(cut for cut, _ in table[:4]), *(text for _, text in table), name)


SQL = {
    "pair_records": _sql(
        f"""select a.asset_id as asset_id_1, b.asset_id as asset_id_2, a.asset_id = b.asset_id as is_same_asset, 1.0::double as similarity,
             case when a.format = b.format and a.source = b.source then 'IDENTICAL'
                  when a.source = b.source then 'SAME_CONTENT_DIFF_FORMAT' else 'CROSS_SOURCE_IDENTICAL' end as duplicate_type,
             a.file_key as file_key_1, a.format as format_1, a.source as source_1, a.duration as duration_1,
             b.file_key as file_key_2, b.format as format_2, b.source as source_2, b.duration as duration_2, abs(a.duration - b.duration) as duration_diff
           from usable a join (select fingerprint, min(file_key) as first_key from usable group by fingerprint) f on a.file_key = f.first_key
           join usable b on b.fingerprint = f.fingerprint and b.file_key <> f.first_key""",
        "usable as (select * from fingerprint where processing_status = 'SUCCESS' and fingerprint is not null and duration > 0)",
        "fingerprint",
    ),
    "classify_pairs": _sql(f"select file_key_1, file_key_2, similarity, {DUPLICATE_TYPE} as duplicate_type from pairs"),
    "similarity_status": _sql(
        f"select file_key_1, file_key_2, {_status('format')}, {_status('version')}, {_status('copies')} from pairs"
    ),
    "experiment_types": _sql(
        """select case when similarity >= 0.99 then case when format_1 = format_2 then 'IDENTICAL' else 'SAME_CONTENT_DIFF_FORMAT' end
             when similarity >= 0.90 then 'VERY_HIGH_SIMILARITY' when similarity >= 0.80 then 'HIGH_SIMILARITY'
             when similarity >= 0.60 then 'RELATED_VERSIONS' else 'DIFFERENT_ARRANGEMENTS' end as duplicate_type, count(*) as pairs
           from pairs where similarity >= 0.75 group by 1"""
    ),
    "pair_arithmetic": _sql(
        """select file_key_1, file_key_2, abs(duration_1 - duration_2) as duration_diff, duration_1 / nullif(duration_2, 0) as size_ratio,
             abs(duration_1 - duration_2) / nullif(duration_2, 0) * 100 as size_diff_pct,
             abs(length(file_key_1) - length(file_key_2))::integer as length_diff from pairs"""
    ),
    "pair_warnings": _sql(
        """select file_key_1, file_key_2, concat_ws(',', case when abs(duration_1 - duration_2) > 1 then 'duration difference' end,
             case when duration_1 / (duration_2 + 100) < 0.5 then 'low bitrate ratio' end,
             case when similarity < 0.85 then 'low bit similarity' end, case when similarity < 0.9 then 'low score' end) as warnings from pairs"""
    ),
    "pairs_above_threshold": _sql("select file_key_1, file_key_2, similarity from pairs where similarity >= 0.75"),
    "pairs_attribute_filters": _sql(
        "select file_key_1, file_key_2, format_1, source_1, source_2 from pairs where format_1 = format_2 and source_1 <> source_2"
    ),
    "pairs_filter_counts": _sql(
        """select count(*) as loaded, count(*) filter (format_1 = format_2 and source_1 = source_2) as kept,
             count(*) filter (not (format_1 = format_2 and source_1 = source_2)) as filtered_out from pairs"""
    ),
    "size_ratio_prefilter": _sql(
        """select file_key_1, file_key_2, duration_1, asset_id_2 from pairs
           where not (duration_1 > 0 and cast(asset_id_2 as double) > 0
             and greatest(duration_1, cast(asset_id_2 as double)) / least(duration_1, cast(asset_id_2 as double)) > 10)"""
    ),
    "pairs_on_air": _sql(
        """select file_key_1, file_key_2, similarity from pairs where (asset_id_1, source_1) in (select (asset_id, source) from air)
             and (asset_id_2, source_2) in (select (asset_id, source) from air)""",
        """air as (select distinct asset_id, case product_indicator when 1 then 'catalog_a' when 3 then 'catalog_b' else 'unknown' end as source
             from asset where last_status_group = 'ON_AIR' and product_indicator in (1, 3) and asset_type = 'Music')""",
        "pairs asset",
    ),
    "pairs_with_fingerprints": _sql(
        """select p.file_key_1, p.file_key_2, x.fingerprint as fingerprint_1, y.fingerprint as fingerprint_2 from pairs p
           left join fps x on x.asset_id = asset_id_1 and x.source = source_1 and x.format = format_1
           left join fps y on y.asset_id = asset_id_2 and y.source = source_2 and y.format = format_2""",
        FP,
        "pairs fingerprint",
    ),
    "new_pairs_only": _sql(f"select file_key_1, file_key_2, similarity from pairs p where not {IS_STORED}", STORED),
    "distinct_pair_assets": _sql(
        "select asset_id_1 as asset_id, source_1 as source from pairs union select asset_id_2, source_2 from pairs"
    ),
    "pairs_by_type": _sql(f"select {DUPLICATE_TYPE} as duplicate_type, count(*) as pairs from pairs group by 1"),
    "pairs_by_similarity_range": _sql(
        """select case when similarity >= 0.95 then '0.95+' when similarity >= 0.90 then '0.90-0.95' when similarity >= 0.80 then '0.80-0.90'
             when similarity >= 0.60 then '0.60-0.80' else '<0.60' end as similarity_range, count(*) as pairs, min(similarity) as lowest
           from pairs group by 1"""
    ),
    "pair_totals": _sql(
        """select count(*) as total_duplicates, count(*) filter (source_1 <> source_2) as cross_source,
             count(*) filter (asset_id_1 = asset_id_2) as same_asset, count(*) filter (asset_id_1 <> asset_id_2) as different_asset from pairs"""
    ),
    "pair_breakdown": _sql(
        "select format_1, concat(source_1, '↔', source_2) as source_pair, count(*) as pairs from pairs group by 1, 2"
    ),
    "similarity_histogram": _sql(HISTOGRAM, BUCKETS),
    "similarity_histogram_custom": _sql(HISTOGRAM, _buckets(CUSTOM)),
    "similarity_cdf": _sql(
        """select printf('[%.1f-%.1f)', bucket_min, bucket_max) as bucket_label, pairs,
             (sum(pairs) over (order by bucket_min))::bigint * 100.0::double / total as cumulative_pct from hist""",
        BUCKETS,
    ),
    "similarity_insights": _sql(
        """select total_pairs, exact_pairs, high_pairs, low_pairs,
             (select printf('[%.1f-%.1f)', bucket_min, bucket_max) from hist order by pairs desc, bucket_min limit 1) as modal_bucket,
             (select max(pairs) from hist) as modal_pairs,
             exact_pairs * 100.0::double / total_pairs as exact_pct, high_pairs * 100.0::double / total_pairs as high_pct,
             low_pairs * 100.0::double / total_pairs as low_pct
           from (select count(*) as total_pairs, count(*) filter (similarity >= 1.0) as exact_pairs,
                        count(*) filter (similarity >= 0.8) as high_pairs, count(*) filter (similarity < 0.5) as low_pairs from pairs)""",
        BUCKETS,
    ),
    "similarity_summary": _sql(
        """select count(similarity) as comparisons, round(avg(similarity), 6) as average, max(similarity) as highest, min(similarity) as lowest,
             round(median(similarity), 6) as median, count(*) filter (similarity >= 0.99) as identical,
             count(*) filter (similarity >= 0.90 and similarity < 0.99) as very_high, count(*) filter (similarity >= 0.80 and similarity < 0.90) as high,
             count(*) filter (similarity >= 0.50 and similarity < 0.80) as medium, count(*) filter (similarity < 0.50) as low,
             count(*) filter (similarity >= 0.95) as version_very_high, count(*) filter (similarity >= 0.80 and similarity < 0.95) as version_high
           from pairs"""
    ),
    "pairs_ranked": _sql("select file_key_1, file_key_2, similarity from pairs order by similarity desc, 1, 2"),
    "stratified_sample": _sql(
        "select bucket, pair_number, file_key_1, file_key_2, similarity from sampled", BUCKETS + ",\n" + SAMPLED
    ),
    "sample_bundle": _sql(
        """select bucket, total_pairs, count(*) as sampled,
             to_json(list({'pair_number': pair_number, 'asset_id_1': asset_id_1, 'asset_id_2': asset_id_2, 'similarity': similarity,
                           'fingerprint_1': fingerprint_1, 'fingerprint_2': fingerprint_2} order by pair_number))::varchar as pairs
           from (select s.*, x.fingerprint as fingerprint_1, y.fingerprint as fingerprint_2, h.pairs as total_pairs from sampled s
             join hist h using (bucket)
             left join fps x on x.asset_id = asset_id_1 and x.source = source_1 and x.format = format_1
             left join fps y on y.asset_id = asset_id_2 and y.source = source_2 and y.format = format_2)
           group by bucket, total_pairs""",
        BUCKETS + ",\n" + SAMPLED + ",\n" + FP,
        "pairs fingerprint",
    ),
    "random_sample": with_views(
        "fingerprint",
        """select song_id, product_indicator, asset_type, group_key, copy_count from songs
           order by md5(concat_ws('|', '42', song_id, product_indicator)), song_id, product_indicator limit 5""",
        PER_SONG,
    ),
}
