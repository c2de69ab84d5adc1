"""Reports over the run log: one row per object and run with records, status and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_runs(run_log: DataFrame, by: str = "object", order: str = "run") -> DataFrame:
    """The latest run of each object with the sum of its records as ``total_records``."""
    rest = [c for c in run_log.columns if c != by]
    out = run_log.groupBy(by).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"), F.sum("records").alias("total_records"))
    return out.select(by, *[F.col(f"_r.{c}").alias(c) for c in rest], "total_records")


def failed_objects(run_log: DataFrame, by: str = "object", order: str = "run") -> DataFrame:
    """The objects whose latest run failed: they are read again from their old checkpoint."""
    return last_runs(run_log, by, order).where("status = 'ERROR'")


def object_statistics(run_log: DataFrame, by: str = "object", order: str = "run") -> DataFrame:
    """Last run, its records, all records, keys as ``name(value)`` and the status with its description."""
    status = F.when(F.coalesce("status_description", F.lit("")) == "", F.col("status")).otherwise(F.concat("status", F.lit(" ("), "status_description", F.lit(")")))
    keys = F.concat_ws(", ", F.transform(F.map_entries("keys"), lambda e: F.concat(e["key"], F.lit("("), e["value"], F.lit(")"))))
    return last_runs(run_log, by, order).select(by, F.col(order).alias("last_run"), F.col("records").alias("last_records"), "total_records", keys.alias("key_values"), status.alias("status"))


def dashboard(run_log: DataFrame, by: str = "object", order: str = "run") -> DataFrame:
    """One row: objects, objects whose latest run failed, records of all runs."""
    return last_runs(run_log, by, order).agg(F.count("*").alias("total_objects"), F.count_if(F.col("status") == "ERROR").alias("failed_objects"), F.sum("total_records").alias("total_records"))


def statistics(run_log: DataFrame, by: str = "object") -> DataFrame:
    """Every object's latest read and delete synchronisation and its totals over all runs of the log (``plans.run``).

    Of runs that began at the same time any one is the latest. What an object never did is null; totals are 0.
    """
    reads, syncs = F.col("action") == "READ", F.col("action") == "DELETE_SYNC"
    last = lambda which, value, name: F.max_by(F.when(which, F.col(value)), F.when(which, F.col("start_ts"))).alias(name)
    total = lambda value, name: F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(name)
    keys = F.concat_ws(", ", F.transform(F.map_entries("keys"), lambda e: F.concat(e["key"], F.lit("("), e["value"], F.lit(")"))))
    return run_log.withColumn("key_values", keys).groupBy(by).agg(
        F.max_by("read_type", "start_ts").alias("read_type"),
        last(reads, "start_ts", "last_read_start"), last(reads, "end_ts", "last_read_end"), last(reads, "records", "last_read_records"), last(reads, "key_values", "last_read_keys"),
        last(reads, "status", "last_read_status"), last(reads, "status_description", "last_read_status_description"),
        last(syncs, "start_ts", "last_delete_sync_start"), last(syncs, "end_ts", "last_delete_sync_end"), last(syncs, "records", "last_delete_sync_keys"),
        total(F.when(reads, F.col("records")), "total_records"), total(F.size("ddls"), "total_ddls"), total("object_reload", "total_object_reloads"), total("schema_reload", "total_schema_reloads"), F.max("commit_id").alias("last_commit_id"))


def totals(run_log: DataFrame, by: str = "object") -> DataFrame:
    """One row for the job: objects by kind and by their latest status, times of the latest read and delete synchronisation, all records, last sign of life and start."""
    now = statistics(run_log, by)
    latest = last_runs(run_log.select(by, "records", "status", "start_ts", "end_ts"), by, "start_ts")
    both = now.join(latest.select(by, "status", "end_ts"), by)
    return both.agg(
        F.count("*").alias("total_objects"), F.count_if(F.col("status") == "ERROR").alias("failed_objects"), F.count_if(F.col("read_type") == "SNAPSHOT").alias("snapshot_objects"), F.count_if(F.col("read_type") == "INCREMENTAL").alias("incremental_objects"), F.count_if(F.col("read_type") == "SNAPSHOT + LOG_BASED").alias("log_based_objects"),
        F.max("last_read_start").alias("last_read_start"), F.max("last_read_end").alias("last_read_end"), F.max("last_delete_sync_start").alias("last_delete_sync_start"), F.max("last_delete_sync_end").alias("last_delete_sync_end"),
        F.coalesce(F.sum("total_records"), F.lit(0)).cast("long").alias("total_records"), F.max("end_ts").alias("last_heartbeat"), F.greatest(F.max("last_read_start"), F.max("last_delete_sync_start")).alias("last_job_start"))
