"""Append-only sinks: baselines, audit log, run ledger (SNK1, SNK2, SNK6).

A target is either a catalog table name or a storage path (anything containing "/").
History tables are partitioned by the date of the measurement (``measured_on``, UTC), so a folder a
day, whatever the number of tables and measurements. A measurement written again with the same
table and time replaces its own rows (``replace_rows``), so re-running a capture after a failure
never duplicates rows. Next to a history stands a small table of each measured table's newest time
(``<target>_newest``, a row per table): ``latest`` reads only the dates it names. One history has one
writer at a time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType, TimestampType

from driftgate.operators.baseline import latest_baseline
from driftgate.operators.profile import PROFILE_SCHEMA, profile_tables, with_measurement
from driftgate.session import written

AUDIT_SCHEMA = StructType(
    PROFILE_SCHEMA.fields + [StructField("measurement_ts", TimestampType(), False)]
)
BASELINE_SCHEMA = StructType(
    AUDIT_SCHEMA.fields + [StructField("baseline_version", IntegerType(), False)]
)
#: The date of the time in UTC, not in the writer's zone; ``measurement_ts`` stays a column.
MEASURED_ON = "measured_on"
HISTORY_KEYS = ("table_name", "measurement_ts")
NEWEST_SCHEMA = StructType(
    [StructField("table_name", StringType()), StructField("measurement_ts", TimestampType()), StructField(MEASURED_ON, DateType())]
)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def append(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    replace_partitions: bool = False,
) -> None:
    """Append ``df`` to a table or path.

    ``replace_partitions`` overwrites only the partitions ``df`` writes to (dynamic
    partition overwrite): re-running the same write replaces its rows instead of adding
    them twice, and every other partition stays.
    """
    writer = df.write.format(fmt)
    if replace_partitions:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark = df.sparkSession
    if _is_path(target):
        writer.save(target)
    elif replace_partitions and spark.catalog.tableExists(target):
        # saveAsTable would replace the whole table; inserting replaces the partitions only.
        insert = df.select(*spark.read.table(target).columns).write.mode("overwrite")
        insert.option("partitionOverwriteMode", "dynamic").insertInto(target)
    else:
        writer.saveAsTable(target)


def read(spark: SparkSession, target: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Read a table or path written by ``append``."""
    if not _is_path(target):
        df = spark.read.table(target)
        return df.select(schema.fieldNames()) if schema is not None else df
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(target)
    return df.select(schema.fieldNames()) if schema is not None else df


def exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def replace_rows(df: DataFrame, target: str, partition: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    """Store ``df`` in a target partitioned by ``partition``, in place of stored rows with the same keys.

    Only the partitions that ``df`` falls in are rewritten: their rows with other keys (an anti-join) and
    the new ones, written beside the target first, then put in by dynamic partition overwrite. Storing
    the same rows again changes nothing, and a write that failed half-way is repeated as it is.
    """
    spark = df.sparkSession
    rows = written(df, "replacing")
    if exists(spark, target):
        touched = [r[0] for r in rows.select(partition).distinct().collect()]
        old = read(spark, target, fmt, rows.schema).filter(F.col(partition).isin(touched))
        new = rows.select(*[F.col(k).alias(f"_{k}") for k in (*keys, partition)]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*keys, partition)]
        kept = old.join(new, same, "left_anti").select(*rows.columns)
        rows = written(kept.unionByName(rows), "replaced")
    append(rows.repartition(partition), target, fmt, (partition,), replace_partitions=True)


def newest_target(target: str) -> str:
    return target.rstrip("/") + "_newest"


def _store_history(rows: DataFrame, target: str, fmt: str, replace_same_time: bool) -> None:
    spark = rows.sparkSession
    day = F.date_from_unix_date(F.floor(F.unix_micros("measurement_ts") / F.lit(86_400_000_000)).cast("int"))
    dated = rows.withColumn(MEASURED_ON, day)
    if replace_same_time:
        replace_rows(dated, target, MEASURED_ON, HISTORY_KEYS, fmt)
    else:
        append(dated, target, fmt, (MEASURED_ON,))
    # the history is complete before the newest times name it; if they are lost they are taken from it again
    beside, fields = newest_target(target), NEWEST_SCHEMA.fieldNames()
    known = beside if exists(spark, beside) else target
    stored = read(spark, known, fmt, NEWEST_SCHEMA).unionByName(dated.select(*fields))
    newest = stored.groupBy("table_name").agg(F.max("measurement_ts").alias("measurement_ts"), F.max(MEASURED_ON).alias(MEASURED_ON))
    writer = written(newest.coalesce(1), "newest").write.format(fmt).mode("overwrite")
    writer.save(beside) if _is_path(beside) else writer.saveAsTable(beside)


def latest(
    spark: SparkSession, target: str, table_names: str | Sequence[str] | None = None, fmt: str = "parquet", schema: StructType = BASELINE_SCHEMA
) -> DataFrame:
    """All rows of each table's newest measurement in a stored history (AGG17), by the table of newest
    times: only the dates it names are read, as literals in the partition filter. A history written without
    that table is read whole (``latest_baseline``)."""
    names = [table_names] if isinstance(table_names, str) else table_names
    beside = newest_target(target)
    if not exists(spark, beside):
        return latest_baseline(read(spark, target, fmt, schema), names)
    newest = read(spark, beside, fmt, NEWEST_SCHEMA)
    if names is not None:
        newest = newest.filter(F.col("table_name").isin(list(names)))
    days = [r[0] for r in newest.select(MEASURED_ON).distinct().collect()]
    whole = StructType([*schema.fields, StructField(MEASURED_ON, DateType())])
    rows = read(spark, target, fmt, whole).filter(F.col(MEASURED_ON).isin(days))
    return rows.join(newest.select(*HISTORY_KEYS), list(HISTORY_KEYS), "left_semi").select(schema.fieldNames())


def _now_literal() -> _dt.datetime:
    # Captured once per call, so the stored rows and the returned rows carry the same time.
    return _dt.datetime.now(_dt.timezone.utc)


def _measure(frames, columns, exclude_columns, measurement_ts):
    ts = measurement_ts if measurement_ts is not None else _now_literal()
    prof = profile_tables(frames, columns, exclude_columns)
    return with_measurement(prof, F.lit(ts).cast("timestamp")), ts


def _stored(spark, target, fmt, schema, names, ts) -> DataFrame:
    return read(spark, target, fmt, schema).filter(
        F.col("table_name").isin(list(names)) & (F.col("measurement_ts") == F.lit(ts).cast("timestamp"))
    )


def capture_baseline(
    frames: Mapping[str, DataFrame],
    target: str,
    columns: Sequence[str] | None = None,
    exclude_columns: Iterable[str] | None = None,
    measurement_ts: _dt.datetime | str | None = None,
    baseline_version: int = 1,
    fmt: str = "parquet",
    replace_same_time: bool = True,
) -> DataFrame:
    """Profile the tables and append the profiles to the baseline history (SNK1).

    Returns the stored rows (read back), not a lazily recomputed profile. With
    ``replace_same_time`` (default) a capture with the same table and time as an earlier
    one replaces it, so a retried capture is not stored twice; ``False`` appends.
    """
    measured, ts = _measure(frames, columns, exclude_columns, measurement_ts)
    rows = measured.withColumn("baseline_version", F.lit(baseline_version).cast("int"))
    _store_history(rows.select(BASELINE_SCHEMA.fieldNames()), target, fmt, replace_same_time)
    spark = rows.sparkSession
    return _stored(spark, target, fmt, BASELINE_SCHEMA, frames.keys(), ts)


def log_measurement(
    frames: Mapping[str, DataFrame],
    target: str,
    columns: Sequence[str] | None = None,
    exclude_columns: Iterable[str] | None = None,
    measurement_ts: _dt.datetime | str | None = None,
    fmt: str = "parquet",
    replace_same_time: bool = True,
) -> DataFrame:
    """Profile the tables and append the profiles to the audit log (SNK2); see
    ``capture_baseline`` for ``replace_same_time``."""
    measured, ts = _measure(frames, columns, exclude_columns, measurement_ts)
    _store_history(measured.select(AUDIT_SCHEMA.fieldNames()), target, fmt, replace_same_time)
    return _stored(measured.sparkSession, target, fmt, AUDIT_SCHEMA, frames.keys(), ts)


def read_baselines(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return read(spark, target, fmt, BASELINE_SCHEMA)


def read_audit_log(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return read(spark, target, fmt, AUDIT_SCHEMA)
