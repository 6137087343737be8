"""Ingest, validation, sinks, resumable and streaming writes; results are read back from what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from dupelens.functions import validation
from dupelens.operators import run_stats
from dupelens.operators.pairs import with_labels
from dupelens.plans.exact_detection import detect
from dupelens.queries.exact import PER_SONG
from dupelens.queries.pairs import IS_STORED, STORED, _stored
from dupelens.queries.views import with_views
from dupelens.runtime import fresh_path, materialize
from dupelens.schemas import PAIR
from dupelens.sinks import exports, tables
from dupelens.sources import fixtures, pair_files
from dupelens.streaming import ingest as streaming

PAIR_COLUMNS = (
    "asset_id_1", "asset_id_2", "is_same_asset", "similarity", "duplicate_type", "file_key_1", "format_1", "source_1",
    "duration_1", "file_key_2", "format_2", "source_2", "duration_2", "duration_diff",
)


def _validated_rows(uploads):
    status = validation.status_columns(F.col("file_size"), F.col("duration"), F.col("fingerprint"), F.col("content_type"))
    return uploads.select("asset_id", "file_key", "source", "file_size", "duration", "fingerprint", "created_at", *status)


def _validated(spark, sf):
    return _validated_rows(fixtures.uploads(fixtures.table(spark, sf, "events")))


def _ingest_columns(rows, *more):
    return rows.select("asset_id", "file_key", "source", "file_size", "processing_status", "error_message", *more)


def _validate(spark, sf):
    return _validated(spark, sf).select(
        "file_key", "processing_status", "error_message", F.array_join("warnings", ",").alias("warnings")
    )


def _ingest_status(spark, sf):
    path = fresh_path(spark, "ingest")
    rows = _ingest_columns(_validated(spark, sf))
    for source in ("catalog_a", "catalog_b"):
        tables.append(rows.where(F.col("source") == source), path)
    return spark.read.schema(rows.schema).parquet(path)


def _upsert(spark, sf):
    current = materialize(_ingest_columns(_validated(spark, sf)), "ingest-v1")
    retried = (
        current.where((F.col("processing_status") == "ERROR") & (F.col("file_size") >= validation.MIN_BYTES))
        .withColumn("processing_status", F.lit("SUCCESS"))
        .withColumn("error_message", F.lit(None).cast("string"))
    )
    return materialize(tables.upsert(current, retried, ["asset_id", "file_key"]), "ingest-v2")


def _stats(spark, sf):
    stats = run_stats.processing_stats(_validated(spark, sf))
    for name in ("first_processed", "last_processed"):
        stats = stats.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return stats


def _round_trip(spark, sf, write, read):
    """Writes the two result tables and reads them back: songs, each with the members counted in its group."""
    back = {}
    for name, rows in detect(fixtures.fingerprint(spark, sf)).tables().items():
        path = fresh_path(spark, f"exported-{name}")
        write(rows, path)
        back[name] = read(spark.read.schema(rows.schema), path)
    counted = back["members"].groupBy("group_key").agg(F.count(F.lit(1)).alias("members"))
    return back["songs"].join(counted, "group_key")


def _csv(spark, sf):
    return _round_trip(
        spark, sf, exports.to_csv, lambda r, path: r.option("header", True).option("escape", '"').csv(path)
    )


def _jsonl(spark, sf):
    return _round_trip(spark, sf, exports.to_jsonl, lambda r, path: r.json(path))


def _refresh(spark, sf):
    """Each table is refreshed twice; the second version replaces the first."""
    database = "dupelens_refresh"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def twice(rows, path):
        name = f"{database}.{path.rpartition('/')[2].replace('-', '_')}"
        tables.full_refresh(rows.limit(0), name)
        tables.full_refresh(rows, name)

    return _round_trip(spark, sf, twice, lambda r, path: spark.table(f"{database}.{path.rpartition('/')[2].replace('-', '_')}"))


def _append(spark, sf):
    path = fresh_path(spark, "pairs")
    rows = with_labels(fixtures.pairs(spark, sf))
    tables.append(rows.where("source_1 = source_2"), path, "json")
    tables.append(rows.where("source_1 <> source_2"), path, "json")
    return spark.read.schema(PAIR).json(path)


def _result_lines(spark, sf):
    """A result file: pair records as JSON, some lines cut off, some without a score."""
    text = F.to_json(F.struct(*PAIR_COLUMNS))
    line = F.when(F.col("score") < 0.05, F.concat(F.lit('{"asset_id_1": "'), F.col("asset_id_1"))).otherwise(text)
    pairs = with_labels(fixtures.pairs(spark, sf)).withColumn("score", F.col("similarity"))
    scored = pairs.withColumn("similarity", F.when(F.col("score") >= 0.06, F.col("score")))
    path = fresh_path(spark, "result-lines")
    scored.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def _read_lines(spark, sf):
    lines = pair_files.read_jsonl(spark, _result_lines(spark, sf))
    state = (
        F.when(F.col(pair_files.CORRUPT).isNotNull(), "malformed").when(pair_files.is_error(), "incomplete").otherwise("ok")
    )
    return lines.groupBy(state.alias("state")).agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("similarity"), 3).alias("similarity_sum")
    )


def _split(spark, sf):
    return tables.split_upload(pair_files.read_jsonl(spark, _result_lines(spark, sf)), _stored(spark, sf))


def _upload(spark, sf):
    return tables.new_rows(_split(spark, sf)).select("asset_id_1", "file_key_1", "asset_id_2", "file_key_2", "similarity")


#: Files that the streams read one by one, and partitions of the tables they write.
DROPS = 3
BUCKETS = 8


def _drops(spark, frame, name):
    """``frame`` as a stream of files, one per micro-batch."""
    path = fresh_path(spark, name)
    frame.repartition(DROPS).write.parquet(path)
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _stream_ingest(spark, sf):
    """Failed uploads that can be retried come a second time, an hour later and mended; later rows of a key count."""
    uploads = _ingest_columns(_validated(spark, sf), "created_at")
    retried = (
        uploads.where((F.col("processing_status") == "ERROR") & (F.col("file_size") >= validation.MIN_BYTES))
        .withColumn("processing_status", F.lit("SUCCESS"))
        .withColumn("error_message", F.lit(None).cast("string"))
        .withColumn("created_at", F.col("created_at") + F.expr("interval 1 hour"))
    )
    rows = uploads.unionByName(retried)
    store = streaming.records_store(fresh_path(spark, "stream-ingest"), rows.schema, ["asset_id", "file_key"], ["created_at"], BUCKETS)
    streaming.ingest(_drops(spark, rows, "uploads"), lambda batch: batch, store, fresh_path(spark, "stream-checkpoint"), compact_every=2)
    return store.latest(spark).drop("created_at")


def _stream_pairs(spark, sf):
    """Pairs that arrive in several batches, some of them a second time in the other orientation."""
    path = fresh_path(spark, "stream-pairs")
    rows = with_labels(fixtures.pairs(spark, sf))
    swapped = rows.where("similarity > 0.9").select(
        *(F.col(c.replace("_1", "_3").replace("_2", "_1").replace("_3", "_2")).alias(c) for c in rows.columns)
    )
    source = _drops(spark, rows.unionByName(swapped), "pairs")
    streaming.upload_pairs(source, path, fresh_path(spark, "stream-checkpoint"), compact_every=2, buckets=BUCKETS)
    stored = streaming.read_batches(spark, path, PAIR)
    low, high = F.least("file_key_1", "file_key_2"), F.greatest("file_key_1", "file_key_2")
    return stored.select(low.alias("file_key_1"), high.alias("file_key_2"), "similarity", "duplicate_type")


def _created(spark, sf):
    """The three result tables, made where they are missing, filled, and made again: what they hold."""
    database = "dupelens_created"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tables.create_tables(spark, database)
    rows = {
        "audio_fingerprint": fixtures.fingerprint(spark, sf),
        "audio_detected_duplicates": with_labels(fixtures.pairs(spark, sf)),
        "duplicated_assets": detect(fixtures.fingerprint(spark, sf)).songs,
    }
    held = []
    for name, frame in rows.items():
        table = f"{database}.{name}"
        fields = tables.TABLES[name].fields
        filled = frame.select(
            *((F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields)
        )
        tables.full_refresh(filled, table)
    tables.create_tables(spark, database)
    for name in rows:
        back = spark.table(f"{database}.{name}")
        held.append(back.agg(F.lit(name).alias("table_name"), F.lit(len(back.columns)).alias("columns"), F.count(F.lit(1)).alias("rows")))
    return held[0].unionByName(held[1]).unionByName(held[2])


def _error_bodies(spark, sf):
    body = F.concat_ws(" ", F.upper("event_type"), "props")
    return fixtures.table(spark, sf, "events").select("event_id", validation.is_error_body(body).alias("is_error_page"))


def _error_messages(spark, sf):
    kind = F.col("user_id") % 5
    message = (
        F.when(kind == 0, "Audio could NOT be decoded: ")
        .when(kind == 1, "No such file: ")
        .when(kind == 2, "Permission denied: ")
        .when(kind == 3, "Connection timeout after ")
        .otherwise("unknown ")
    )
    return (
        fixtures.table(spark, sf, "events")
        .where("event_type = 'error'")
        .select("event_id", validation.error_category(F.concat(message, "props")).alias("category"))
    )


SPARK = {
    "validate_records": _validate,
    "ingest_status_rows": _ingest_status,
    "upsert_retry": _upsert,
    "processing_stats": _stats,
    "run_summary": lambda s, d: run_stats.run_summary(_validated(s, d), 12.5),
    "platform_summary": lambda s, d: run_stats.platform_summary(_validated(s, d), ["catalog_a", "catalog_b"]),
    "error_body_detector": _error_bodies,
    "error_category": _error_messages,
    "export_csv_roundtrip": _csv,
    "export_jsonl_roundtrip": _jsonl,
    "full_refresh_roundtrip": _refresh,
    "pairs_append_roundtrip": _append,
    "read_pairs_jsonl": _read_lines,
    "idempotent_upload": _upload,
    "upload_counts": lambda s, d: tables.upload_counts(_split(s, d)),
    "created_tables": _created,
    "stream_ingest": _stream_ingest,
    "stream_pair_upload": _stream_pairs,
}

INGESTED = "select asset_id, file_key, source, file_size, processing_status, error_message from validated"
SONGS = with_views(
    "fingerprint",
    """select song_id, product_indicator, asset_type, group_key, copy_count,
              (select count(*) from members m where m.fingerprint = s.group_key) as members from songs s""",
    PER_SONG,
)
TYPED = """typed as (select *, case when similarity >= 0.95 then case when format_1 = format_2 and source_1 = source_2 then 'IDENTICAL'
      when source_1 = source_2 then 'SAME_CONTENT_DIFF_FORMAT' else 'CROSS_SOURCE_IDENTICAL' end
    when similarity >= 0.80 then case when source_1 = source_2 then 'HIGH_SIMILARITY_SAME_SOURCE' else 'HIGH_SIMILARITY_CROSS_SOURCE' end
    when similarity >= 0.60 then 'RELATED_VERSIONS' else 'LOW_SIMILARITY' end as duplicate_type from pairs)"""

SQL = {
    "validate_records": with_views(
        "validated", "select file_key, processing_status, error_message, warnings from validated"
    ),
    "ingest_status_rows": with_views("validated", INGESTED),
    "upsert_retry": with_views(
        "validated",
        """select asset_id, file_key, source, file_size,
             case when file_size >= 1024 then 'SUCCESS' else processing_status end as processing_status,
             case when file_size >= 1024 then null else error_message end as error_message from validated""",
    ),
    "processing_stats": with_views(
        "validated",
        """select count(*) as total_records, count(*) filter (processing_status = 'SUCCESS') as successful,
             count(*) filter (processing_status = 'ERROR') as failed,
             round(avg(duration) filter (processing_status = 'SUCCESS'), 6) as avg_duration,
             strftime(min(created_at), '%Y-%m-%d %H:%M:%S.%f') as first_processed,
             strftime(max(created_at), '%Y-%m-%d %H:%M:%S.%f') as last_processed from validated""",
    ),
    "run_summary": with_views(
        "validated",
        """select count(*) as processed, count(*) filter (processing_status = 'SUCCESS') as successful,
             count(*) filter (processing_status <> 'SUCCESS') as failed,
             count(*) filter (processing_status = 'SUCCESS') * 100.0::double / count(*) as success_rate,
             count(*) / 12.5::double as rate_per_second from validated""",
    ),
    "platform_summary": with_views(
        "validated",
        """select a + b > 0 as overall_success, a > 0 as catalog_a_success, b > 0 as catalog_b_success, a + b as total_downloads,
             a as catalog_a_downloads, b as catalog_b_downloads
           from (select count(*) filter (source = 'catalog_a' and processing_status = 'SUCCESS') as a,
                        count(*) filter (source = 'catalog_b' and processing_status = 'SUCCESS') as b from validated)""",
    ),
    "error_body_detector": """select event_id, strlen(concat_ws(' ', upper(event_type), props)) < 1024
        and regexp_matches(lower(concat_ws(' ', upper(event_type), props)), 'error|not found|access denied|forbidden|unauthorized|invalid') as is_error_page
      from events""",
    "error_category": """select event_id, case user_id % 5 when 0 then 'decode' when 1 then 'missing' when 2 then 'permission'
        when 3 then 'timeout' else 'other' end as category from events where event_type = 'error'""",
    "export_csv_roundtrip": SONGS,
    "export_jsonl_roundtrip": SONGS,
    "full_refresh_roundtrip": SONGS,
    "pairs_append_roundtrip": with_views(
        "pairs",
        """select asset_id_1, asset_id_2, asset_id_1 = asset_id_2 as is_same_asset, similarity, duplicate_type, file_key_1, format_1, source_1,
             duration_1, file_key_2, format_2, source_2, duration_2, abs(duration_1 - duration_2) as duration_diff from typed""",
        TYPED,
    ),
    "read_pairs_jsonl": with_views(
        "pairs",
        """select case when similarity < 0.05 then 'malformed' when similarity < 0.06 then 'incomplete' else 'ok' end as state, count(*) as lines,
             round(sum(case when similarity >= 0.06 then similarity end), 3) as similarity_sum from pairs group by 1""",
    ),
    "idempotent_upload": with_views(
        "pairs",
        f"select asset_id_1, file_key_1, asset_id_2, file_key_2, similarity from pairs p where similarity >= 0.06 and not {IS_STORED}",
        STORED,
    ),
    "upload_counts": with_views(
        "pairs",
        f"""select count(*) filter (similarity >= 0.06 and not known) as uploaded, count(*) filter (similarity >= 0.06 and known) as skipped,
              count(*) filter (similarity < 0.06) as errors from (select p.*, {IS_STORED} as known from pairs p)""",
        STORED,
    ),
    "created_tables": with_views(
        "fingerprint pairs",
        """select 'audio_fingerprint' as table_name, COLS_F::integer as columns, count(*) as rows from fingerprint
           union all select 'audio_detected_duplicates', COLS_P::integer, count(*) from pairs
           union all select 'duplicated_assets', COLS_D::integer, (select count(*) from songs)""",
        PER_SONG,
    )
    .replace("COLS_F", str(len(tables.TABLES["audio_fingerprint"].fields)))
    .replace("COLS_P", str(len(tables.TABLES["audio_detected_duplicates"].fields)))
    .replace("COLS_D", str(len(tables.TABLES["duplicated_assets"].fields))),
    "stream_ingest": with_views(
        "validated",
        """select asset_id, file_key, source, file_size,
             case when file_size >= 1024 then 'SUCCESS' else processing_status end as processing_status,
             case when file_size >= 1024 then null else error_message end as error_message from validated""",
    ),
    "stream_pair_upload": with_views(
        "pairs",
        """select least(file_key_1, file_key_2) as file_key_1, greatest(file_key_1, file_key_2) as file_key_2, similarity, duplicate_type
           from typed""",
        TYPED,
    ),
}
