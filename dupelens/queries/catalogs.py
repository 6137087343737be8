"""Catalog reads, backlog and key handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from dupelens.functions import mapping, names
from dupelens.operators import backlog as work
from dupelens.queries.views import with_views
from dupelens.sources import catalogs, fixtures, query
from dupelens.sources import fingerprints as reader


def _tables(spark, sf):
    return {
        name: getattr(fixtures, name)(spark, sf) for name in ("asset", "asset_map", "asset_file", "asset_format")
    }


def _a_files(spark, sf):
    t = _tables(spark, sf)
    return catalogs.files_of_a(t["asset"], t["asset_map"], t["asset_file"])


def _b_files(spark, sf):
    return catalogs.files_of_b(**_tables(spark, sf))


def _backlog(source, retry):
    return lambda s, d: work.backlog(source, _tables(s, d), fixtures.processed(s, d), retry)


def _summary_text(summary):
    return summary.select(
        "asset_id",
        "num_file_keys",
        F.array_join("file_keys", ",").alias("file_keys"),
        F.array_join("formats", ",").alias("formats"),
        F.to_json("key_format_pairs").alias("key_format_pairs"),
        F.to_json("format_to_file_key").alias("format_to_file_key"),
    )


def _requested(spark, sf):
    """Ids asked for: customers with an urgent order."""
    urgent = fixtures.table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return urgent.select(F.col("o_custkey").cast("string").alias("asset_id"))


def _labelled(spark, sf):
    return fixtures.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("asset_id"))


def _json_rows(spark, sf):
    """Per asset the JSON texts a summary would hold; some without pairs, some broken."""
    summary = catalogs.format_summary(catalogs.latest_per_format(_a_files(spark, sf), "role"), "role")
    state = fixtures.asset(spark, sf).select("asset_id", "last_status_group", "balance")
    pairs = (
        F.when(F.col("balance") > 9000, "[{broken")
        .when(F.col("last_status_group") == "ON_AIR", F.to_json("key_format_pairs"))
    )
    return summary.join(state, "asset_id").select(
        "asset_id", pairs.alias("key_format_pairs"), F.to_json("file_keys").alias("file_keys")
    )


def _ordered_keys(spark, sf):
    return names.ordered_distinct(fixtures.asset_map(spark, sf), "externalid", "id")


def _normalised(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.concat(F.lit("0"), F.col("o_custkey"))
    )
    return fixtures.table(spark, sf, "orders").select(
        "o_orderkey", mapping.normalised_id(raw).alias("asset_id"), F.lit("catalog_a").alias("source"),
        F.lit(0).alias("file_size"),
    )


def _sources(spark, sf):
    source = F.when(F.col("lang") == "en", F.upper(_doc_source())).when(F.col("lang") == "fr", F.col("source"))
    return (
        fixtures.table(spark, sf, "documents")
        .select("doc_id", source.otherwise(_doc_source()).alias("source"))
        .withColumn("product_indicator", mapping.indicator_of_source("source"))
    )


def _doc_source():
    return F.when(F.col("doc_id") % 2 == 0, "catalog_a").otherwise("catalog_b")


def _defaults(spark, sf):
    t = _tables(spark, sf)
    rows = (
        catalogs.join_files(t["asset"], t["asset_map"], t["asset_file"])
        .join(t["asset_format"], F.col("asset_id") == F.col("product_id"), "left")
        .select(
            "asset_id",
            F.col("filekey").alias("file_key"),
            mapping.format_from_id("format_id", default=None).alias("file_format"),
            F.when(F.col("role") != "STEM", F.col("l_quantity").cast("int")).alias("file_size"),
            F.when(F.col("product_indicator") == 3, "catalog_b").alias("source"),
        )
    )
    return work.with_defaults(rows)


def _version_names(spark, sf):
    tag = (
        F.when(F.col("p_type") == "ECONOMY", "_-_Master_v3_-_260722_-_IV_-_ORG_")
        .when(F.col("p_type") == "PROMO", "_-_Master_v3_-_230522_-_BOV_-_ORG_")
        .when(F.col("p_type") == "LARGE", "_-_Master_v3_-_260722_-_SV_No_LeadVocals-ORG")
        .when(F.col("p_type") == "SMALL", "_-_260722_-_SV_No_LeadVocals_BOV_")
        .when(F.col("p_type") == "MEDIUM", "_-_Master_v3_")
        .otherwise("_-_EXT_")
    )
    suffix = F.when(F.col("p_size") < 20, ".mp3").when(F.col("p_size") < 40, ".wav").otherwise("")
    name = F.concat(F.col("p_partkey"), F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_")), tag, suffix)
    return fixtures.table(spark, sf, "part").select(
        "p_partkey", name.alias("file_name"), *names.version_columns(name)
    )


def _file_names(spark, sf):
    suffix = F.when(F.col("role") == "CORE", ".wav").when(F.col("role") == "MP3", ".mp3").otherwise(".zip")
    return fixtures.asset_file(spark, sf).select(
        "filekey", names.file_name_from_key(F.concat("role", F.lit("/"), "filekey", suffix)).alias("file_name")
    )


def _output_names(spark, sf):
    fp = fixtures.fingerprint(spark, sf)
    return fp.select(
        "file_key",
        names.output_name(F.col("asset_id"), F.col("source"), F.upper("format")).alias("output_name"),
        names.safe_label(F.concat_ws(" / ", "asset_id", "source", "format")).alias("label"),
    )


def _param(spark, sf):
    return query.run(
        spark,
        """select source, format, count(*) as files, max(duration) as longest from {fingerprint}
           where processing_status = :status and duration >= :shortest group by source, format""",
        {"status": "SUCCESS", "shortest": 100.0},
        fingerprint=fixtures.fingerprint(spark, sf),
    )


SPARK = {
    "format_from_role": lambda s, d: fixtures.asset_file(s, d).select(
        "filekey", "role", mapping.format_from_role("role").alias("file_format")
    ),
    "format_from_id_default": lambda s, d: _b_files(s, d).select(
        "asset_id", "file_key", mapping.format_from_id("format_id").alias("file_format")
    ),
    "format_from_id_strict": lambda s, d: _b_files(s, d)
    .withColumn("format", F.upper(mapping.format_from_id("format_id", default=None)))
    .where(F.col("format").isNotNull())
    .select("asset_id", "file_key", "format"),
    "normalise_ids": _normalised,
    "source_indicator": _sources,
    "indicator_source": lambda s, d: fixtures.asset(s, d).select(
        "asset_id",
        mapping.source_of_indicator(
            F.when(F.col("asset_type") == "Sfx", 2).otherwise(F.col("product_indicator"))
        ).alias("source"),
    ),
    "backlog_defaults": _defaults,
    "catalog_filters": lambda s, d: catalogs.assets_of_a(fixtures.asset(s, d))
    .withColumn("catalog", F.lit("catalog_a"))
    .unionByName(catalogs.assets_of_b(fixtures.asset(s, d)).withColumn("catalog", F.lit("catalog_b"))),
    "asset_files_join": lambda s, d: _a_files(s, d).select("asset_id", "file_key", "role"),
    "asset_files_left_format": lambda s, d: _b_files(s, d).select("asset_id", "file_key", "format_id"),
    "backlog_unprocessed": lambda s, d: work.unprocessed(_a_files(s, d), fixtures.processed(s, d)).select(
        "asset_id", "file_key", "role"
    ),
    "backlog_with_retries": lambda s, d: work.unprocessed(_a_files(s, d), fixtures.processed(s, d), True).select(
        "asset_id", "file_key", "role"
    ),
    "backlog_catalog_a": _backlog("catalog_a", False),
    "backlog_catalog_b": _backlog("catalog_b", False),
    "backlog_catalog_a_retry": _backlog("catalog_a", True),
    "backlog_catalog_b_retry": _backlog("catalog_b", True),
    "files_for_assets": lambda s, d: catalogs.files_for_assets(**_tables(s, d), asset_ids=_requested(s, d)),
    "latest_file_per_format": lambda s, d: catalogs.latest_per_format(_a_files(s, d), "role").select(
        "asset_id", "role", "file_key"
    ),
    "asset_format_summary": lambda s, d: _summary_text(
        catalogs.format_summary(catalogs.latest_per_format(_a_files(s, d), "role"), "role")
    ),
    "catalog_a_summary": lambda s, d: _summary_text(
        catalogs.summary_of_a(*(_tables(s, d)[n] for n in ("asset", "asset_map", "asset_file")))
    ),
    "catalog_b_summary": lambda s, d: _summary_text(catalogs.summary_of_b(**_tables(s, d))),
    "keys_from_json": lambda s, d: names.keys_from_json(_json_rows(s, d)),
    "keys_from_json_counts": lambda s, d: names.unparsable_json(_json_rows(s, d)),
    "ordered_distinct_keys": _ordered_keys,
    "lookup_fingerprints": lambda s, d: reader.lookup(fixtures.fingerprint(s, d), _labelled(s, d)),
    "first_file_per_asset": lambda s, d: reader.first_file(fixtures.fingerprint(s, d), _labelled(s, d)),
    "lookup_asset": lambda s, d: reader.lookup_one(fixtures.fingerprint(s, d), "7"),
    "param_query": _param,
    "file_name_from_key": _file_names,
    "file_name_from_url": lambda s, d: fixtures.table(s, d, "pages").select(
        "page_id", names.file_name_from_url("url", F.col("page_id")).alias("file_name")
    ),
    "version_label": _version_names,
    "output_names": _output_names,
}

A_FILES = """a_files as (select a.asset_id, f.filekey as file_key, f.role, f.createdat as created_at
  from asset a join asset_map m on a.asset_id = m.externalid join asset_file f on m.id = f.songid
  where a.product_indicator = 1 and a.asset_type = 'Music' and f.role in ('CORE', 'MP3'))"""
B_FILES = """b_files as (select a.asset_id, f.filekey as file_key, pf.format_id, f.createdat as created_at
  from asset a join asset_map m on a.asset_id = m.externalid join asset_file f on m.id = f.songid
  left join asset_format pf on pf.product_id = a.asset_id
  where a.product_indicator = 3 and a.asset_sub_type ilike '%music%' and f.resolution_format = 1)"""
A_VIEWS = "asset asset_map asset_file"
B_VIEWS = "asset asset_map asset_file asset_format"
BY_ID = "case format_id when 1 then 'wav' when 2 then 'mp3' when 3 then 'aiff' else {0} end"


def _latest(files: str, fmt: str) -> str:
    return f"""latest as (select * from (
      select *, row_number() over (partition by asset_id, {fmt} order by created_at desc, file_key) as rn
      from {files}) where rn = 1)"""


def _summary(fmt: str) -> str:
    return f"""select asset_id, count(*) as num_file_keys,
        string_agg(file_key, ',' order by {fmt}, file_key) as file_keys,
        string_agg({fmt}, ',' order by {fmt}, file_key) as formats,
        to_json(list({{'file_key': file_key, 'format': {fmt}}} order by {fmt}, file_key))::varchar as key_format_pairs,
        to_json(map(list({fmt} order by {fmt}), list(file_key order by {fmt})))::varchar as format_to_file_key
      from latest group by asset_id"""


def _backlog_sql(catalog: str, retry: bool) -> str:
    files, views, cte = ("a_files", A_VIEWS, A_FILES) if catalog == "catalog_a" else ("b_files", B_VIEWS, B_FILES)
    fmt = "case role when 'CORE' then 'wav' else lower(role) end" if catalog == "catalog_a" else BY_ID.format("'mp3'")
    condition = "p.asset_id is null" + (" or p.any_error = 1" if retry else "")
    todo = f"""todo as (select f.*, {fmt} as file_format from {files} f
      left join processed p on p.asset_id = f.asset_id and p.file_key = f.file_key where {condition})"""
    return with_views(
        views + " processed",
        f"select asset_id, file_key, file_format, 0 as file_size, '{catalog}' as source from latest",
        f"{cte},\n{todo},\n{_latest('todo', 'file_format')}",
    )


JSON_ROWS = (
    A_FILES
    + ",\n"
    + _latest("a_files", "role")
    + """,
json_rows as (select s.asset_id,
   case when a.balance > 9000 then '[{broken' when a.last_status_group = 'ON_AIR' then s.key_format_pairs end as key_format_pairs,
   s.file_keys
 from (select asset_id, to_json(list({'file_key': file_key, 'format': role} order by role, file_key))::varchar as key_format_pairs,
              to_json(list(file_key order by role, file_key))::varchar as file_keys
       from latest group by asset_id) s join asset a using (asset_id))"""
)
DOC_SOURCE = "case when doc_id % 2 = 0 then 'catalog_a' else 'catalog_b' end"

SQL = {
    "format_from_role": with_views(
        "asset_file",
        "select filekey, role, case when role = 'CORE' then 'wav' else lower(role) end as file_format from asset_file",
    ),
    "format_from_id_default": with_views(
        B_VIEWS, f"select asset_id, file_key, {BY_ID.format(chr(39) + 'mp3' + chr(39))} as file_format from b_files", B_FILES
    ),
    "format_from_id_strict": with_views(
        B_VIEWS,
        f"select * from (select asset_id, file_key, upper({BY_ID.format('null')}) as format from b_files) where format is not null",
        B_FILES,
    ),
    "normalise_ids": """select o_orderkey,
        cast(try_cast(case when o_orderstatus = 'P' then o_orderpriority else concat('0', o_custkey) end as integer) as varchar) as asset_id,
        'catalog_a' as source, 0 as file_size from orders""",
    "source_indicator": f"""select doc_id, source, case lower(source) when 'catalog_a' then 1 when 'catalog_b' then 3 else 0 end as product_indicator
      from (select doc_id, case lang when 'en' then upper({DOC_SOURCE}) when 'fr' then source else {DOC_SOURCE} end as source from documents)""",
    "indicator_source": with_views(
        "asset",
        """select asset_id, case case when asset_type = 'Sfx' then 2 else product_indicator end
             when 1 then 'catalog_a' when 3 then 'catalog_b' else 'unknown' end as source from asset""",
    ),
    "backlog_defaults": with_views(
        B_VIEWS,
        """select a.asset_id, f.filekey as file_key,
             coalesce(case pf.format_id when 1 then 'wav' when 2 then 'mp3' when 3 then 'aiff' end, 'mp3') as file_format,
             coalesce(case when f.role <> 'STEM' then cast(f.l_quantity as integer) end, 0) as file_size,
             coalesce(case when a.product_indicator = 3 then 'catalog_b' end, 'catalog_a') as source
           from asset a join asset_map m on a.asset_id = m.externalid join asset_file f on m.id = f.songid
           left join asset_format pf on pf.product_id = a.asset_id""",
    ),
    "catalog_filters": with_views(
        "asset",
        """select asset_id, 'catalog_a' as catalog from asset where product_indicator = 1 and asset_type = 'Music'
           union all select asset_id, 'catalog_b' from asset where product_indicator = 3 and asset_sub_type ilike '%music%'""",
    ),
    "asset_files_join": with_views(A_VIEWS, "select asset_id, file_key, role from a_files", A_FILES),
    "asset_files_left_format": with_views(B_VIEWS, "select asset_id, file_key, format_id from b_files", B_FILES),
    "backlog_unprocessed": with_views(
        A_VIEWS + " processed",
        """select f.asset_id, f.file_key, f.role from a_files f left join processed p
             on p.asset_id = f.asset_id and p.file_key = f.file_key where p.asset_id is null""",
        A_FILES,
    ),
    "backlog_with_retries": with_views(
        A_VIEWS + " processed",
        """select f.asset_id, f.file_key, f.role from a_files f left join processed p
             on p.asset_id = f.asset_id and p.file_key = f.file_key where p.asset_id is null or p.any_error = 1""",
        A_FILES,
    ),
    "backlog_catalog_a": _backlog_sql("catalog_a", False),
    "backlog_catalog_b": _backlog_sql("catalog_b", False),
    "backlog_catalog_a_retry": _backlog_sql("catalog_a", True),
    "backlog_catalog_b_retry": _backlog_sql("catalog_b", True),
    "files_for_assets": with_views(
        B_VIEWS,
        f"""select asset_id, file_key, case role when 'CORE' then 'wav' else lower(role) end as file_format, 0 as file_size, 'catalog_a' as source
              from a_files where asset_id in (select asset_id from wanted)
            union all
            select asset_id, file_key, {BY_ID.format(chr(39) + 'mp3' + chr(39))}, 0, 'catalog_b'
              from b_files where asset_id in (select asset_id from wanted)""",
        A_FILES + ",\n" + B_FILES
        + ",\nwanted as (select distinct cast(o_custkey as varchar) as asset_id from orders where o_orderpriority = '1-URGENT')",
    ),
    "latest_file_per_format": with_views(
        A_VIEWS, "select asset_id, role, file_key from latest", A_FILES + ",\n" + _latest("a_files", "role")
    ),
    "asset_format_summary": with_views(A_VIEWS, _summary("role"), A_FILES + ",\n" + _latest("a_files", "role")),
    "catalog_a_summary": with_views(
        A_VIEWS,
        _summary("role") + " order by num_file_keys desc, asset_id limit 100",
        A_FILES + ",\n" + _latest("a_files", "role"),
    ),
    "catalog_b_summary": with_views(
        B_VIEWS,
        _summary("format") + " order by num_file_keys desc, asset_id limit 100",
        B_FILES
        + f",\nstrict as (select * from (select *, upper({BY_ID.format('null')}) as format from b_files) where format is not null),\n"
        + _latest("strict", "format"),
    ),
    "keys_from_json": with_views(
        A_VIEWS,
        """select asset_id, pos, file_key from (
             select asset_id, cast(unnest(range(len(ks))) as integer) as pos, unnest(ks) as file_key from (
               select asset_id, case when key_format_pairs is null then cast(file_keys::json as varchar[])
                 when json_valid(key_format_pairs) then cast(json_extract_string(key_format_pairs, '$[*].file_key') as varchar[]) end as ks
               from json_rows) where ks is not null)""",
        JSON_ROWS,
    ),
    "keys_from_json_counts": with_views(
        A_VIEWS,
        "select count(*) as total_rows, count(*) filter (not json_valid(coalesce(key_format_pairs, file_keys))) as broken_rows from json_rows",
        JSON_ROWS,
    ),
    "ordered_distinct_keys": with_views(
        "asset_map", "select externalid, min(id) as first_position from asset_map group by externalid"
    ),
    "lookup_fingerprints": with_views(
        "fingerprint",
        """select asset_id, source, format, max_by(fingerprint, file_key) as fingerprint from fingerprint
           where processing_status = 'SUCCESS' and fingerprint is not null
             and asset_id in (select cast(doc_id as varchar) from labels)
           group by asset_id, source, format""",
    ),
    "first_file_per_asset": with_views(
        "fingerprint",
        """select asset_id, min(file_key) as file_key from fingerprint
           where processing_status = 'SUCCESS' and asset_id in (select cast(doc_id as varchar) from labels) group by asset_id""",
    ),
    "lookup_asset": with_views(
        "fingerprint",
        """select file_key, source, format from fingerprint
           where asset_id = '7' and processing_status = 'SUCCESS' and fingerprint is not null order by file_key limit 1""",
    ),
    "param_query": with_views(
        "fingerprint",
        """select source, format, count(*) as files, max(duration) as longest from fingerprint
           where processing_status = 'SUCCESS' and duration >= 100 group by source, format""",
    ),
    "file_name_from_key": with_views(
        "asset_file",
        """select filekey, case when role in ('CORE', 'MP3') then filekey || case role when 'CORE' then '.wav' else '.mp3' end
             else filekey || '.zip.mp3' end as file_name from asset_file""",
    ),
    "file_name_from_url": """select page_id, case when name = '' then page_id || '.bin' else name end as file_name
      from (select page_id, list_last(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')) as name from pages)""",
    "version_label": """select p_partkey, file_name,
        case when contains(file_name, 'SV_No_LeadVocals') then 'SV No LeadVocals' when contains(file_name, '_BOV_') then 'BOV'
             when contains(file_name, '_IV_') then 'IV' else 'Master' end as version,
        upper(regexp_extract(file_name, '(\\.[^./]+)$', 1)) as format,
        contains(file_name, 'Master_v3') as master, contains(file_name, 'SV_No_LeadVocals') as sv_no_lead,
        contains(file_name, '_BOV_') as bov, contains(file_name, '_IV_') as iv
      from (select p_partkey, p_partkey || '_' || replace(p_name, ' ', '_') || case p_type
          when 'ECONOMY' then '_-_Master_v3_-_260722_-_IV_-_ORG_' when 'PROMO' then '_-_Master_v3_-_230522_-_BOV_-_ORG_'
          when 'LARGE' then '_-_Master_v3_-_260722_-_SV_No_LeadVocals-ORG' when 'SMALL' then '_-_260722_-_SV_No_LeadVocals_BOV_'
          when 'MEDIUM' then '_-_Master_v3_' else '_-_EXT_' end
          || case when p_size < 20 then '.mp3' when p_size < 40 then '.wav' else '' end as file_name from part)""",
    "output_names": with_views(
        "fingerprint",
        """select file_key, 'asset_' || asset_id || '_' || source || '.' || format as output_name,
             asset_id || source || format as label from fingerprint""",
    ),
}
