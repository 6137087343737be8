"""Fuzzy detection that goes on where an earlier run was stopped.

Clusters are dealt into batches. A batch writes its pairs and errors to folders of its own attempt; then one file of the
ledger names the finished clusters together with that attempt. Only rows whose cluster and attempt stand in the ledger
count, so a batch that was lost on the way leaves nothing behind, and a finished one is never repeated. A table of runs
keeps the settings and a checksum of the records: results of other settings or other records are never mixed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dupelens.plans import fuzzy_detection as fuzzy

LEDGER = "run string, attempt string, cluster_start double, records bigint"
RUNS = "run string, event string, at timestamp, settings string, state string"
ERRORS = (
    "error_type string, error_message string, timestamp timestamp, cluster_start double, asset_id string, file_key string, "
    "fingerprint string, format string, source string, duration double, comparisons bigint"
)
PAIRS = (
    "cluster_start double, fingerprint_1 string, source_1 string, format_1 string, fingerprint_2 string, source_2 string, "
    "format_2 string, similarity double, duplicate_type string, files_1 bigint, files_2 bigint, file_pairs bigint"
)


def _table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """The table of that name, made empty where it is missing."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{name}")
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def _state(blocked: fuzzy.Blocked) -> str:
    """Number and checksum of the records: equal for equal records in any order."""
    key = F.xxhash64("cluster_start", "fingerprint", "source", "format", "asset_id", "file_key")
    n, total = blocked.records.agg(F.count(F.lit(1)), F.sum(key.cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


def _note(spark: SparkSession, path: str, run: str, event: str, settings: str, state: str) -> None:
    row = spark.range(1).select(
        F.lit(run).alias("run"), F.lit(event).alias("event"), F.current_timestamp().alias("at"),
        F.lit(settings).alias("settings"), F.lit(state).alias("state"),
    )
    row.write.mode("append").parquet(f"{path}/runs")


def current_run(spark: SparkSession, path: str) -> tuple[str, str, str, bool] | None:
    """(run, settings, state, finished) of the run that was started last."""
    runs = _table(spark, path, "runs", RUNS)
    last = runs.where("event = 'started'").orderBy(F.desc("at"), "run").limit(1).collect()
    if not last:
        return None
    finished = runs.where((F.col("run") == last[0]["run"]) & (F.col("event") == "finished")).count() > 0
    return last[0]["run"], last[0]["settings"], last[0]["state"], finished


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """Finished clusters of the current run."""
    current = current_run(spark, path)
    return _table(spark, path, "ledger", LEDGER).where(F.col("run") == (current[0] if current else ""))


def remaining(blocked: fuzzy.Blocked, path: str) -> DataFrame:
    """cluster_start, records of the clusters that the current run has not finished."""
    sizes = blocked.records.groupBy("cluster_start").agg(F.count(F.lit(1)).alias("records"))
    return sizes.join(_ledger(blocked.records.sparkSession, path), "cluster_start", "left_anti")


def batch_of(cluster_start: str, batches: int) -> Column:
    """The batch of a cluster: by a digest, as lengths are often round numbers."""
    digest = F.md5(F.floor(cluster_start).cast("string"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(batches))


def _of_clusters(blocked: fuzzy.Blocked, clusters: DataFrame) -> fuzzy.Blocked:
    # One row per cluster, as many as tolerances fit into the range of durations: records and content stay where they are.
    wanted = F.broadcast(clusters.select("cluster_start"))
    return fuzzy.Blocked(
        blocked.records.join(wanted, "cluster_start", "left_semi"),
        blocked.durations,
        blocked.classes.join(wanted, "cluster_start", "left_semi"),
    )


def run(
    blocked: fuzzy.Blocked,
    path: str,
    mode: str = "all",
    threshold: float = fuzzy.DEFAULT_THRESHOLD,
    resume: bool = True,
    batches: int = 8,
    most_batches: int | None = None,
) -> bool:
    """Runs detection batch by batch below ``path``; true once all clusters are finished.

    ``resume`` goes on with a run that was stopped; without it, or after a finished one, a run starts with nothing done.
    ``most_batches`` stops early.
    """
    spark = blocked.records.sparkSession
    settings, state = f"mode={mode} threshold={threshold!r} batches={batches}", _state(blocked)
    current = current_run(spark, path)
    if resume and current and not current[3]:
        name = current[0]
        if current[1:3] != (settings, state):
            raise ValueError(f"the stopped run has other settings or records ({current[1]}); resume=False starts anew")
    else:
        name = uuid.uuid4().hex
        _note(spark, path, name, "started", settings, state)
    left = remaining(blocked, path).withColumn("batch", batch_of("cluster_start", batches))
    todo = sorted(row["batch"] for row in left.select("batch").distinct().collect())
    for batch in todo[:most_batches]:
        clusters = left.where(F.col("batch") == batch)
        attempt = uuid.uuid4().hex
        found = fuzzy.compare(_of_clusters(blocked, clusters), mode, threshold)
        found.pairs.write.parquet(f"{path}/pairs/attempt={attempt}")
        found.errors.write.parquet(f"{path}/errors/attempt={attempt}")
        done = clusters.select(F.lit(name).alias("run"), F.lit(attempt).alias("attempt"), "cluster_start", "records")
        # One file, so that its appearance finishes the whole batch at once.
        done.coalesce(1).write.mode("append").parquet(f"{path}/ledger")
    complete = most_batches is None or len(todo) <= most_batches
    if complete:
        _note(spark, path, name, "finished", settings, state)
    return complete


def _finished_rows(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    stored = f"{schema}, attempt string"
    spark.createDataFrame([], stored).write.mode("ignore").partitionBy("attempt").parquet(f"{path}/{name}")
    done = _ledger(spark, path).select("attempt", "cluster_start")
    rows = spark.read.schema(stored).parquet(f"{path}/{name}")
    return rows.join(done, ["attempt", "cluster_start"], "left_semi").drop("attempt")


def pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of the finished clusters of the current run."""
    return _finished_rows(spark, path, "pairs", PAIRS)


def errors(spark: SparkSession, path: str) -> DataFrame:
    """Files that could not be compared, of the finished clusters of the current run."""
    return _finished_rows(spark, path, "errors", ERRORS)
