"""Bronze landing: create-if-absent table with lineage columns (SNK3-SNK5, PRJ5).

The statements are plain Spark SQL; Spark parses, plans and runs them. A second call
for an existing target is a no-op (create-if-absent, not refresh). The rows landed are counted
by the statement that writes them (an observed metric), so no count reads the table again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _quote_ident(name: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Statement:
    name: str
    sql: str


def plan(
    source: str,
    target: str,
    fmt: str = "parquet",
    source_system: str | None = None,
    location: str | None = None,
    schema_location: str | None = None,
    ingest_ts: str | None = None,
    source_label: str | None = None,
    if_absent: bool = True,
) -> tuple[Statement, ...]:
    """The two statements: ensure the target schema, then CTAS with lineage columns.

    ``source`` is a table or view name; ``source_system`` defaults to its schema part and
    ``source_label`` (the ``source_file_path`` value) to ``source`` itself.
    ``ingest_ts`` (a timestamp literal) replaces ``current_timestamp()`` when results
    must repeat. ``if_absent=False`` lets the second statement fail for an existing target.
    """
    parts = target.split(".")
    if len(parts) < 2:
        raise ValueError("target must be schema.table or catalog.schema.table")
    schema = ".".join(parts[:-1])
    label = source_label if source_label is not None else source
    src_parts = label.split(".")
    system = source_system if source_system is not None else (src_parts[-2] if len(src_parts) > 1 else "")
    ts = f"CAST({_sql_string(ingest_ts)} AS TIMESTAMP)" if ingest_ts else "current_timestamp()"
    schema_sql = f"CREATE SCHEMA IF NOT EXISTS {_quote_ident(schema)}"
    if schema_location:
        schema_sql += f" LOCATION {_sql_string(schema_location)}"
    ctas = (
        f"CREATE TABLE {'IF NOT EXISTS ' if if_absent else ''}{_quote_ident(target)} USING {fmt}"
        + (f" LOCATION {_sql_string(location)}" if location else "")
        + f" AS SELECT *, {ts} AS ingest_ts, {_sql_string(system)} AS source_system, "
        f"{_sql_string(label)} AS source_file_path FROM {_quote_ident(source)}"
    )
    return (Statement("ensure_target_schema", schema_sql), Statement("create_target_with_lineage", ctas))


def _land(spark: SparkSession, source: str, target: str, plan_args: dict) -> int | None:
    """Run both statements; the rows the second one wrote, None if the target came to be meanwhile."""
    seen, view = Observation(), f"landing_{uuid.uuid4().hex[:12]}"
    label = plan_args.get("source_label")
    spark.table(source).observe(seen, F.count(F.lit(1)).alias("rows")).createOrReplaceTempView(view)
    try:
        for st in plan(view, target, if_absent=False, **{**plan_args, "source_label": source if label is None else label}):
            spark.sql(st.sql)
        return seen.get["rows"]
    except AnalysisException:
        if spark.catalog.tableExists(target):
            return None
        raise
    finally:
        spark.catalog.dropTempView(view)


def materialize(
    spark: SparkSession,
    source: str,
    target: str,
    dry_run: bool = False,
    **plan_args,
) -> DataFrame:
    """Run (or dry-run) the plan; one-row report (SNK5).

    Dry run: executed false, exists-after = exists-before, 2 attempted, 0 executed.
    ``rows_landed`` is what this call wrote: NULL for a dry run or an existing target.
    """
    statements = plan(source, target, **plan_args)
    before = spark.catalog.tableExists(target)
    executed, landed = 0, None
    if not dry_run and before:
        for st in statements:
            spark.sql(st.sql)
            executed += 1
    elif not dry_run:
        landed = _land(spark, source, target, plan_args)
        executed = len(statements)
    after = spark.catalog.tableExists(target) if not dry_run else before
    return spark.createDataFrame(
        [(target, not dry_run, before, after, len(statements), executed, landed)],
        "target string, executed boolean, target_exists_before boolean, target_exists_after boolean, "
        "statements_attempted int, statements_executed int, rows_landed long",
    )
