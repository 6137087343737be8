"""Scans, exact detection, its reports and the audit suite."""

from __future__ import annotations

from pyspark.sql import functions as F

from dupelens.operators import exact, quality
from dupelens.plans.exact_detection import detect, duplicated_assets
from dupelens.queries.views import with_views
from dupelens.runtime import materialize
from dupelens.sources import fingerprints as reader
from dupelens.sources import fixtures

USABLE = """usable as (select * from fingerprint
  where processing_status = 'SUCCESS' and fingerprint is not null and duration > 0)"""

# Members of duplicate groups: one row per (fingerprint, asset, source).
MEMBERS = (
    USABLE
    + """,
reps as (select fingerprint, asset_id, source, min(file_key) as file_key from usable group by all),
grp as (select fingerprint, count(*) as copy_count,
               min((source, asset_id, file_key)) as first_seen,
               string_agg(distinct source, ', ' order by source) as sources,
               count(distinct source) > 1 as is_cross_source
        from reps group by fingerprint having count(*) > 1),
members as (select r.*, g.copy_count, g.first_seen, g.sources, g.is_cross_source
            from reps r join grp g using (fingerprint))"""
)

PER_SONG = (
    MEMBERS
    + """,
picked as (select asset_id as song_id, case source when 'catalog_a' then 1 when 'catalog_b' then 3 else 0 end as product_indicator,
                  source as own_source, fingerprint,
                  row_number() over (partition by asset_id, source order by first_seen, file_key) as rn
           from members),
songs as (select p.song_id, p.product_indicator, 'music' as asset_type, p.fingerprint as group_key,
                 p.own_source, any_value(m.copy_count) as copy_count,
                 list({'product_indicator': case m.source when 'catalog_a' then 1 when 'catalog_b' then 3 else 0 end,
                       'song_id': m.asset_id} order by m.source, m.asset_id)
                   filter (m.asset_id <> p.song_id or m.source <> p.own_source) as duplicates
          from picked p join members m using (fingerprint) where p.rn = 1
          group by all)"""
)


def _usable(spark, sf):
    return reader.usable(fixtures.fingerprint(spark, sf))


def _groups(spark, sf):
    return exact.group_summary(_usable(spark, sf))


def _found(spark, sf):
    return detect(fixtures.fingerprint(spark, sf))


def _songs(spark, sf):
    return duplicated_assets(fixtures.fingerprint(spark, sf))


def _report(spark, sf):
    members = _found(spark, sf).members
    return exact.group_report(members, exact.summary_of(exact.duplicate_groups(members)))


def _both(spark, sf, operator, *more):
    """An operator over songs, written once, and members."""
    found = _found(spark, sf)
    return operator(materialize(found.songs, "songs"), found.members, *more)


def _of_labelled(spark, sf):
    """The duplicates of the songs that the labels name."""
    found = _found(spark, sf)
    asked = fixtures.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("song_id")).distinct()
    return exact.duplicates_of(found.songs.join(asked, "song_id", "left_semi"), found.members)


def _suite(spark, sf):
    return _both(spark, sf, quality.suite, "1", 3)


SPARK = {
    "duplicated_assets": _songs,
    "duplicates_of_song": _of_labelled,
    "scan_fingerprints": lambda s, d: reader.scan(fixtures.fingerprint(s, d)),
    "scan_fingerprints_by_duration": lambda s, d: reader.scan_by_duration(fixtures.fingerprint(s, d)),
    "exact_duplicate_groups": lambda s, d: exact.duplicate_members(_usable(s, d)).select(
        "fingerprint", "asset_id", "source", "file_key", "copy_count"
    ),
    "duplicate_group_report": _report,
    "high_copy_groups": lambda s, d: exact.high_copy(_groups(s, d), 3),
    "cross_source_groups": lambda s, d: exact.cross_source(_groups(s, d)),
    "groups_of_asset": lambda s, d: exact.groups_of_asset(_usable(s, d), "1"),
    "copy_count_distribution": lambda s, d: exact.copy_count_distribution(_groups(s, d)),
    "top_duplicate_groups": lambda s, d: exact.top_groups(_usable(s, d)),
    "preview_rows": lambda s, d: _both(s, d, exact.preview),
    "dq_duplicate_keys": lambda s, d: quality.duplicate_keys(_songs(s, d)),
    "dq_completeness": lambda s, d: quality.completeness(_songs(s, d)),
    "dq_asset_type": lambda s, d: quality.asset_types(_songs(s, d)),
    "dq_indicator_domain": lambda s, d: quality.indicator_domain(_songs(s, d)),
    "dq_array_format": lambda s, d: quality.array_format(quality.entries_json(_found(s, d).members)),
    "dq_reciprocity": lambda s, d: _both(s, d, quality.missing_reciprocals),
    "dq_known_key": lambda s, d: quality.known_key(_songs(s, d), "1", 3),
    "dq_multi_indicator": lambda s, d: quality.multi_indicator(_songs(s, d)),
    "dq_statistics": lambda s, d: quality.statistics(_songs(s, d)),
    "dq_array_size_distribution": lambda s, d: quality.array_size_distribution(_songs(s, d)),
    "dq_suite": _suite,
    "dq_summary": lambda s, d: quality.suite_summary(_suite(s, d)),
}


def _songs_sql(body: str) -> str:
    return with_views("fingerprint", body, PER_SONG)


def _members_sql(body: str) -> str:
    return with_views("fingerprint", body, MEMBERS)


EDGES = """,
edges as (select song_id, product_indicator, d.song_id as listed_song_id, d.product_indicator as listed_indicator
          from (select song_id, product_indicator, unnest(duplicates) as d from songs)),
missing as (select e.* from edges e
            where exists (select 1 from songs k
                          where k.song_id = e.listed_song_id and k.product_indicator = e.listed_indicator)
              and not exists (select 1 from edges r
                              where r.song_id = e.listed_song_id and r.product_indicator = e.listed_indicator
                                and r.listed_song_id = e.song_id and r.listed_indicator = e.product_indicator))"""

CHECKS = (
    EDGES
    + """,
checks as (
  select 'duplicate_keys' as check_name,
         (select count(*) from (select 1 from songs group by song_id, product_indicator having count(*) > 1)) as findings
  union all select 'completeness', (select count(*) filter (song_id is null) + count(*) filter (product_indicator is null)
         + count(*) filter (asset_type is null) + count(*) filter (duplicates is null) from songs)
  union all select 'asset_type', (select count(distinct asset_type) from songs where asset_type <> 'music')
  union all select 'indicator_domain', (select count(distinct product_indicator) from songs where product_indicator not in (1, 3))
  union all select 'array_format', (select count(*) from songs
         where duplicates is null or len(list_filter(duplicates, lambda d: d.product_indicator is null or d.song_id is null)) > 0)
  union all select 'reciprocity', (select count(*) from missing)
  union all select 'known_key', (select greatest(count(*) - 1, 0) from songs where song_id = '1' and product_indicator = 3)
  union all select 'multi_indicator', (select count(*) from (select 1 from songs group by song_id having count(distinct product_indicator) > 1))),
suite as (select check_name, findings, findings = 0 or check_name = 'multi_indicator' as passed from checks)"""
)

SQL = {
    "duplicated_assets": _songs_sql(
        "select song_id, product_indicator, asset_type, group_key, copy_count from songs"
    ),
    "duplicates_of_song": _songs_sql(
        """select s.song_id, s.product_indicator, m.asset_id as duplicate_song_id, m.source as duplicate_source,
                  case m.source when 'catalog_a' then 1 when 'catalog_b' then 3 else 0 end as duplicate_indicator
           from songs s join members m on m.fingerprint = s.group_key
           where s.song_id in (select cast(doc_id as varchar) from labels) and (m.asset_id <> s.song_id or m.source <> s.own_source)"""
    ),
    "scan_fingerprints": with_views(
        "fingerprint", "select asset_id, file_key, format, duration, fingerprint, source from usable order by source, asset_id", USABLE
    ),
    "scan_fingerprints_by_duration": with_views(
        "fingerprint",
        """select asset_id, file_key, format, duration, fingerprint, coalesce(file_size, 0) as file_size, source
           from usable order by duration, source, asset_id""",
        USABLE,
    ),
    "exact_duplicate_groups": _members_sql("select fingerprint, asset_id, source, file_key, copy_count from members"),
    "duplicate_group_report": _members_sql(
        """select group_id, copy_count, is_cross_source, sources, asset_id, source, left(fingerprint, 50) || '...' as fingerprint_preview
           from (select *, row_number() over (order by copy_count desc, md5(fingerprint), fingerprint) as group_id from grp)
           join (select fingerprint, asset_id, source from members) using (fingerprint)"""
    ),
    "high_copy_groups": _members_sql(
        "select fingerprint, copy_count, is_cross_source, sources from grp where copy_count >= 3"
    ),
    "cross_source_groups": _members_sql(
        "select fingerprint, copy_count, is_cross_source, sources from grp where is_cross_source"
    ),
    "groups_of_asset": _members_sql(
        """select fingerprint, copy_count, is_cross_source, sources from grp
           where fingerprint in (select fingerprint from members where asset_id = '1')"""
    ),
    "copy_count_distribution": _members_sql(
        """select copy_count, count(*) as groups, count(*) filter (is_cross_source) as cross_source_groups
           from grp group by copy_count"""
    ),
    "top_duplicate_groups": _members_sql(
        """select fingerprint, copy_count, is_cross_source,
                  string_agg(asset_id, ', ' order by source, asset_id) filter (pos <= 5)
                    || case when copy_count > 5 then ', ...' else '' end as assets
           from (select m.*, row_number() over (partition by fingerprint order by source, asset_id) as pos
                 from members m
                 where fingerprint in (select fingerprint from grp order by copy_count desc, fingerprint limit 5))
           group by fingerprint, copy_count, is_cross_source"""
    ),
    "preview_rows": _songs_sql(
        """select song_id, product_indicator, asset_type,
                  to_json(duplicates[1:3])::varchar
                    || case when len(duplicates) > 3 then ' +' || (len(duplicates) - 3) || ' more' else '' end as preview
           from songs order by song_id, product_indicator limit 5"""
    ),
    "dq_duplicate_keys": _songs_sql(
        """select song_id, product_indicator, count(*) as cnt from songs
           group by song_id, product_indicator having count(*) > 1 order by cnt desc, 1, 2 limit 10"""
    ),
    "dq_completeness": _songs_sql(
        """select count(*) as total_rows, count(song_id) as song_id_count, count(product_indicator) as product_count,
                  count(asset_type) as asset_type_count, count(duplicates) as duplicates_count,
                  count(*) filter (song_id is null) as null_song_id,
                  count(*) filter (product_indicator is null) as null_product,
                  count(*) filter (asset_type is null) as null_asset_type,
                  count(*) filter (duplicates is null) as null_duplicates
           from songs"""
    ),
    "dq_asset_type": _songs_sql("select asset_type, count(*) as cnt from songs group by asset_type"),
    "dq_indicator_domain": _songs_sql(
        "select product_indicator, count(*) as cnt, product_indicator in (1, 3) as is_valid from songs group by product_indicator"
    ),
    "dq_array_format": _songs_sql(
        """select count(*) as total_rows,
                  count(*) filter (not json_valid(to_json(duplicates)::varchar)) as unparsable,
                  count(*) filter (json_type(to_json(duplicates)) <> 'ARRAY') as not_a_list,
                  count(*) filter (len(list_filter(duplicates, lambda d: d.product_indicator is null or d.song_id is null)) > 0) as missing_keys
           from (select [{'product_indicator': case source when 'catalog_a' then 1 when 'catalog_b' then 3 else 0 end,
                          'song_id': asset_id}] as duplicates from members)"""
    ),
    "dq_reciprocity": with_views(
        "fingerprint",
        """select a.group_key, b.group_key as other_group, count(*) as missing
           from missing m join songs a using (song_id, product_indicator)
           join songs b on b.song_id = m.listed_song_id and b.product_indicator = m.listed_indicator
           group by all""",
        PER_SONG + EDGES,
    ),
    "dq_known_key": _songs_sql("select count(*) as occurrences from songs where song_id = '1' and product_indicator = 3"),
    "dq_multi_indicator": _songs_sql(
        """select song_id, count(distinct product_indicator) as indicator_count from songs
           group by song_id having count(distinct product_indicator) > 1"""
    ),
    "dq_statistics": _songs_sql(
        """select count(*) as total_songs, count(distinct song_id) as unique_song_ids,
                  count(*) filter (product_indicator = 1) as catalog_a_count,
                  count(*) filter (product_indicator = 3) as catalog_b_count
           from songs"""
    ),
    "dq_array_size_distribution": _songs_sql(
        """select len(duplicates)::integer as dup_count, count(*) as songs from songs
           group by 1 order by dup_count desc limit 10"""
    ),
    "dq_suite": with_views("fingerprint", "select * from suite", PER_SONG + CHECKS),
    "dq_summary": with_views(
        "fingerprint",
        """select count(*) as total, count(*) filter (passed) as passed, bool_and(passed) as all_passed,
                  coalesce(string_agg(check_name, ', ' order by check_name) filter (not passed), '') as failed
           from suite""",
        PER_SONG + CHECKS,
    ),
}
