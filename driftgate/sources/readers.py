"""Readers: CSV as strings, catalog tables, and the gate configuration JSON (SRC1-SRC3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from driftgate.functions.columns import LINEAGE_COLUMNS
from driftgate.functions.entropy import DEFAULT_DROP_PCT, DEFAULT_HEALTH_FLOOR, DEFAULT_SPIKE_PCT

# Fixed values that must equal the reference's: gate comparison operators and types, the
# default baseline staleness, and the provenance fields every run must carry.
GATE_OPS = (">=", "<=", ">", "<", "==")
GATE_TYPES = ("FAIL", "WARN")
DEFAULT_STALENESS_DAYS = 30
PROVENANCE_FIELDS = (
    "experiment_id",
    "run_id",
    "git_commit",
    "git_branch",
    "catalog_name",
    "operator",
    "started_at_utc",
)

GATE_SCHEMA = StructType(
    [
        StructField("metric", StringType()),
        StructField("type", StringType()),
        StructField("op", StringType()),
        StructField("threshold", DoubleType()),
        StructField("reason", StringType()),
    ]
)

CONFIG_SCHEMA = StructType(
    [
        StructField("experiment_id", StringType()),
        StructField("schema_variant", StringType()),
        StructField("gates", ArrayType(GATE_SCHEMA)),
        StructField(
            "guardrails",
            StructType(
                [
                    StructField("execution_mode", StringType()),
                    StructField("allowed_catalog_tiers", ArrayType(StringType())),
                    StructField("require_unity_catalog", BooleanType()),
                    StructField("entropy_baseline_required_before_gold", BooleanType()),
                    StructField("drift_detection_columns_excluded", ArrayType(StringType())),
                ]
            ),
        ),
        StructField(
            "entropy_thresholds",
            StructType(
                [
                    StructField("collapse_pct", DoubleType()),
                    StructField("spike_pct", DoubleType()),
                    StructField("health_score_floor", DoubleType()),
                    StructField("baseline_staleness_days", IntegerType()),
                ]
            ),
        ),
        StructField(
            "decision_rule",
            StructType(
                [
                    StructField("pass", StringType()),
                    StructField("warn", StringType()),
                    StructField("fail", StringType()),
                    StructField("gold_blocked", StringType()),
                ]
            ),
        ),
        StructField("minimum_provenance_fields", ArrayType(StringType())),
    ]
)


def read_csv_strings(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with a header, every column a string (SRC1). Empty fields read as NULL."""
    return (
        spark.read.option("header", header)
        .option("inferSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by 1-3 part name (SRC2)."""
    return spark.read.table(name)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """The raw gate configuration (one row per JSON document), with an explicit schema.

    An explicit schema keeps integer-only thresholds as doubles. A single JSON document
    spanning several lines is the expected form; JSON-lines files with one document per
    line also work with ``multiLine`` left on.
    """
    return spark.read.schema(CONFIG_SCHEMA).option("multiLine", True).json(path)


CORRUPT = "_corrupt_record"


def read_configs(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Every gate document below ``path`` (a folder, file or glob on any store), read by the executors.

    Columns: those of ``read_config``, then ``source_file``, ``modified`` and ``_corrupt_record``. A file
    holds one document or an array of them, or with ``lines`` one document a line. A document
    that is no JSON of this shape has its text in ``_corrupt_record``.
    """
    schema = StructType([*CONFIG_SCHEMA.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("multiLine", not lines).option("mode", "PERMISSIVE")
    docs = reader.option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True).json(path)
    names = CONFIG_SCHEMA.fieldNames()
    return docs.select(*names, F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("modified"), CORRUPT)


def current_configs(documents: DataFrame) -> DataFrame:
    """One document per experiment of ``read_configs``: the last modified file's, of equally old
    files that with the greatest path, of one file's the ASCII-greatest document. Corrupt documents take
    no part; see ``corrupt_configs``."""
    names = CONFIG_SCHEMA.fieldNames()
    rank = F.struct("modified", "source_file", F.to_json(F.struct(*names)))
    good = _experiment(documents.filter(F.col(CORRUPT).isNull()))
    return good.groupBy("experiment_id").agg(F.max_by(F.struct(*names), rank).alias("c")).select("c.*")


def corrupt_configs(documents: DataFrame) -> DataFrame:
    """(source_file, experiment_id, document) of the documents that could not be read; the experiment
    if that much could be made out."""
    return documents.filter(F.col(CORRUPT).isNotNull()).select("source_file", "experiment_id", F.col(CORRUPT).alias("document"))


def config_from_text(spark: SparkSession, text: str) -> DataFrame:
    """The gate configuration from JSON text held by the driver (a small local file)."""
    raw = spark.createDataFrame([(text,)], "json string")
    return raw.select(F.from_json("json", CONFIG_SCHEMA).alias("c")).select("c.*")


def _experiment(cfg: DataFrame) -> DataFrame:
    return cfg.withColumn("experiment_id", F.coalesce(F.col("experiment_id"), F.lit("")))


def gates_frame(config: DataFrame) -> DataFrame:
    """One row per configured gate, in file order (SRC3, SCL5).

    Columns: experiment_id, position (1-based), gate_id ("{type}-{position}"), metric,
    gate_type, op, threshold, reason. An unknown op or type raises when the frame is evaluated: a
    misspelt type would not vote, so its gate could be passed by.
    """
    cfg = _experiment(config)
    g = cfg.select("experiment_id", F.posexplode("gates").alias("_pos", "_g"))

    def checked(value: Column, known: tuple[str, ...], what: str) -> Column:
        unknown = F.raise_error(F.concat(F.lit(f"unknown gate {what}: "), F.coalesce(value, F.lit("NULL"))))
        return F.when(value.isin(*known), value).otherwise(unknown)

    gate_type = checked(F.col("_g.type"), GATE_TYPES, "type")
    return g.select(
        "experiment_id",
        (F.col("_pos") + 1).cast("int").alias("position"),
        F.concat(gate_type, F.lit("-"), (F.col("_pos") + 1).cast("string")).alias("gate_id"),
        F.col("_g.metric").alias("metric"),
        gate_type.alias("gate_type"),
        checked(F.col("_g.op"), GATE_OPS, "op").alias("op"),
        F.col("_g.threshold").alias("threshold"),
        F.col("_g.reason").alias("reason"),
    )


def thresholds_frame(config: DataFrame) -> DataFrame:
    """Entropy thresholds per experiment, with the reference defaults where missing."""
    cfg = _experiment(config)
    et = F.col("entropy_thresholds")
    excluded = F.coalesce(
        F.col("guardrails.drift_detection_columns_excluded"),
        F.array(*[F.lit(c) for c in LINEAGE_COLUMNS]),
    )
    return cfg.select(
        "experiment_id",
        F.coalesce(et["collapse_pct"], F.lit(DEFAULT_DROP_PCT)).alias("drop_pct"),
        F.coalesce(et["spike_pct"], F.lit(DEFAULT_SPIKE_PCT)).alias("spike_pct"),
        F.coalesce(et["health_score_floor"], F.lit(DEFAULT_HEALTH_FLOOR)).alias("health_floor"),
        F.coalesce(et["baseline_staleness_days"], F.lit(DEFAULT_STALENESS_DAYS))
        .cast("int")
        .alias("baseline_staleness_days"),
        excluded.alias("excluded_columns"),
    )
