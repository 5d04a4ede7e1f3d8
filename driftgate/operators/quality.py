"""Quality engine: route rows to clean / quarantine by ordered rules (CMP1, AGG12, AGG18).

A row is attributed to the first rule it fails; later rules only see rows that passed
all earlier ones. Row rules become one ``coalesce(when(rule1), when(rule2), ...)``
projection; no per-rule EXCEPT, no per-rule action.

Rules that compare rows (duplicates, ``FailingRows``) work on thin rows if the frame carries a row
identity (``operators.identity``): only identity, key digest and order columns are ranked or
joined, the failing identities are written, and the full rows learn of them by a join. Building
such an outcome runs one thin job per rule of that kind. Without an identity a duplicate rule ranks
whole rows, in one branch and without any job while building; ``FailingRows`` need the identity.

Duplicates are ranked in two steps: first inside (key, input partition), so a key holding a third of
all rows is split across as many tasks as it spans input partitions, then the first rows of a
key's partitions among each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from driftgate.functions.columns import ref
from driftgate.functions.entropy import group_key, round_exact
from driftgate.functions.rules import NO_ACTION, Duplicates, FailingRows, Rule
from driftgate.operators.identity import ROW_ID, flagged, is_identified
from driftgate.session import written

REASON = "failure_reason"
ROUTE = "route"
_POS = "_rule_pos"

RESULT_SCHEMA = StructType(
    [
        StructField("rule_position", IntegerType(), False),
        StructField("rule_name", StringType(), False),
        StructField("column_name", StringType(), False),
        StructField("passed", BooleanType(), False),
        StructField("records_checked", LongType(), False),
        StructField("records_failed", LongType(), False),
        StructField("failure_ratio", DoubleType(), False),
        StructField("action_taken", StringType(), False),
    ]
)


def _dup_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe composite key; strings are keyed by their SHA-256 digest (see group_key)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for i, k in enumerate(keys):
        if isinstance(types[k], StringType):
            parts.append(group_key(ref(k)).alias(f"k{i}"))
        else:
            parts.append(ref(k).alias(f"k{i}"))
    return F.struct(*parts)


def _losers(base: DataFrame, survivor: Column, order_by: Sequence[str]) -> tuple[DataFrame, Column]:
    """``base`` (with ``_dk``) ranked, and whether a row is a survivor after the first of its key (of
    rows that tie in the order, any one is the first)."""
    order = [survivor.desc(), *[ref(c) for c in order_by]]
    local = base.withColumn("_sp", F.spark_partition_id())
    local = local.withColumn("_rn", F.row_number().over(Window.partitionBy("_dk", "_sp").orderBy(*order)))
    # One group of a key holds the first rows of its partitions; its other rows stay apart.
    local = local.withColumn("_sg", F.when(F.col("_rn") == 1, F.lit(-1)).otherwise(F.col("_sp")))
    ranked = local.withColumn("_rk", F.row_number().over(Window.partitionBy("_dk", "_sg").orderBy(*order, "_sp")))
    return ranked, survivor & ~((F.col("_rn") == 1) & (F.col("_rk") == 1))


def _mark_duplicates(df: DataFrame, pos: int, dup: Duplicates) -> DataFrame:
    """Set ``_rule_pos`` = pos on surviving rows after the first of their key, on whole rows."""
    ranked, lost = _losers(df.withColumn("_dk", _dup_key(df, dup.keys)), F.col(_POS).isNull(), dup.order_by)
    return ranked.withColumn(_POS, F.when(lost, F.lit(pos)).otherwise(F.col(_POS))).drop("_dk", "_sp", "_rn", "_sg", "_rk")


def _failing_ids(df: DataFrame, rule: Rule) -> DataFrame:
    """The identities, written, of the rows of ``df`` (with ``_rule_pos``) that fail a rule on rows."""
    survivors = df.filter(F.col(_POS).isNull())
    if isinstance(rule.check, FailingRows):
        found = rule.check.find(survivors.drop(_POS), rule.column)
        if ROW_ID not in found.columns:
            raise ValueError(f"rule {rule.name!r}: the failing rows must keep the column {ROW_ID!r}")
        ids = found.select(ROW_ID).distinct()
    else:
        dup = rule.check
        order = list(dict.fromkeys(dup.order_by))
        thin = survivors.select(ROW_ID, _dup_key(df, dup.keys).alias("_dk"), *[ref(c) for c in order])
        ranked, lost = _losers(thin, F.lit(True), dup.order_by)
        ids = ranked.filter(lost).select(ROW_ID)
    return written(ids, "failing_rows")


def _mark_rows(df: DataFrame, pos: int, rule: Rule) -> DataFrame:
    """Set ``_rule_pos`` = pos on the surviving rows that fail a rule on rows, by their identity."""
    marked = flagged(df, _failing_ids(df, rule), "_fails")
    return marked.withColumn(_POS, F.coalesce(F.col(_POS), F.when(F.col("_fails"), F.lit(pos)))).drop("_fails")


def tag(df: DataFrame, rules: Sequence[Rule], all_failures: bool = False) -> DataFrame:
    """Input rows plus ``failure_reason`` (NULL = clean) and ``_rule_pos`` (1-based).

    ``all_failures`` adds ``all_failures array<string>``: every row rule the row fails,
    each evaluated on the row as it is (rules that compare rows are not part of it).
    """
    cur = df
    if all_failures:
        names = [F.when(r.failing(), F.lit(r.name)) for r in rules if r.is_predicate]
        cur = cur.withColumn(
            "all_failures",
            F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.array().cast("array<string>"),
        )
    pending: Column | None = None
    for pos, rule in enumerate(rules, start=1):
        if rule.is_predicate:
            hit = F.when(rule.failing(), F.lit(pos))
            pending = hit if pending is None else F.coalesce(pending, hit)
            continue
        cur = cur.withColumn(_POS, pending if pending is not None else F.lit(None).cast("int"))
        if is_identified(df):
            cur = _mark_rows(cur, pos, rule)
        elif rule.is_duplicates:
            cur = _mark_duplicates(cur, pos, rule.check)
        else:
            raise ValueError(f"rule {rule.name!r} returns rows: give the frame an identity (operators.identity)")
        pending = F.col(_POS)
    cur = cur.withColumn(_POS, pending if pending is not None else F.lit(None).cast("int"))
    # A CASE, not element_at over a literal array: Catalyst marks the latter non-nullable
    # and would fold "failure_reason IS NULL" to false.
    reason = F.lit(None).cast("string")
    if rules:
        reason = F.when(F.col(_POS) == 1, F.lit(rules[0].name))
        for pos, rule in enumerate(rules[1:], start=2):
            reason = reason.when(F.col(_POS) == pos, F.lit(rule.name))
    return cur.withColumn(REASON, reason)


def _count_columns(rules: Sequence[Rule]) -> list[Column]:
    pos = F.col(_POS)
    counts = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(pos.isNull()).alias("clean"),
        F.count_if(pos.isNotNull()).alias("quarantined"),
    ]
    return counts + [F.count_if(pos == i).alias(f"r{i}") for i in range(1, len(rules) + 1)]


def rule_results(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule (AGG12) from one row of counts: failed count, ratio, passed, action (NONE
    when 0 failed). ``records_checked`` is the original total for every rule, as in the reference.
    """
    spark = counts.sparkSession
    if not rules:
        return spark.createDataFrame([], RESULT_SCHEMA)
    per_rule = counts.select(
        "total",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("rule_position"), F.lit(r.name).alias("rule_name"), F.lit(r.column).alias("column_name"),
                        F.lit(r.action).alias("action"), F.col(f"r{i}").alias("failed"),
                    )
                    for i, r in enumerate(rules, start=1)
                ]
            )
        ),
    )
    failed, total = F.col("failed"), F.col("total")
    ratio = F.when(total > 0, round_exact(failed / total, 4)).otherwise(F.lit(0.0))
    return per_rule.select(
        "rule_position",
        "rule_name",
        "column_name",
        (failed == 0).alias("passed"),
        total.cast("long").alias("records_checked"),
        failed.cast("long").alias("records_failed"),
        ratio.alias("failure_ratio"),
        F.when(failed > 0, F.col("action")).otherwise(F.lit(NO_ACTION)).alias("action_taken"),
    )


def quality_ratios(counts: DataFrame) -> DataFrame:
    """One row (AGG18) from one row of counts: pass and quarantine ratio; NULL on empty input."""
    total = F.col("total").cast("double")
    return counts.select(
        F.col("total").alias("records_checked"),
        F.col("clean").alias("records_clean"),
        F.col("quarantined").alias("records_quarantined"),
        F.try_divide(F.col("clean").cast("double"), total).alias("quality_pass_ratio"),
        F.try_divide(F.col("quarantined").cast("double"), total).alias("quarantine_ratio"),
    )


@dataclass
class QualityOutcome:
    """Lazily evaluated outputs of one rule evaluation.

    ``tagged`` is the single source of truth; ``clean`` and ``quarantine`` are filters
    of it, so every output that is run tags the rows again. ``route`` writes both sides and
    counts them in one pass.
    """

    tagged: DataFrame
    rules: tuple[Rule, ...]
    input_columns: tuple[str, ...]
    quarantine_columns: tuple[str, ...] = ()

    @property
    def clean(self) -> DataFrame:
        return self.tagged.filter(F.col(REASON).isNull()).select([ref(c) for c in self.input_columns])

    @property
    def quarantine(self) -> DataFrame:
        cols = [ref(c) for c in (self.quarantine_columns or self.input_columns)] + [F.col(REASON)]
        return self.tagged.filter(F.col(REASON).isNotNull()).select(cols)

    @property
    def clean_set_semantics(self) -> DataFrame:
        """The reference's EXCEPT DISTINCT routing: distinct input rows minus every failing row.

        Identical rows collapse into one, and for a duplicate rule on fully equal rows
        all copies leave the clean set (SET1). Kept for compatibility only.
        """
        cols = [ref(c) for c in self.input_columns]
        rows = self.tagged.groupBy(*cols).agg(F.bool_or(F.col(REASON).isNotNull()).alias("_any_failed"))
        return rows.filter(~F.col("_any_failed")).drop("_any_failed")

    @property
    def counts(self) -> DataFrame:
        """One row: total, clean, quarantined and per-rule failure counts, from one aggregate."""
        return self.tagged.agg(*_count_columns(self.rules))

    @property
    def results(self) -> DataFrame:
        """One row per rule (AGG12), see ``rule_results``."""
        return rule_results(self.counts, self.rules)

    @property
    def ratios(self) -> DataFrame:
        """One row (AGG18), see ``quality_ratios``."""
        return quality_ratios(self.counts)


def evaluate(df: DataFrame, rules: Sequence[Rule], all_failures: bool = False) -> QualityOutcome:
    """Apply ``rules`` in order; see ``QualityOutcome`` for the outputs.

    With ``all_failures`` the quarantine also lists every row rule a row fails. The outputs do not
    carry the row identity.
    """
    names = [r.name for r in rules]
    if REASON in df.columns or _POS in df.columns:
        raise ValueError(f"input already has a {REASON!r} or {_POS!r} column")
    if len(set(names)) != len(names):
        raise ValueError(f"rule names must be unique: {names}")
    inputs = tuple(c for c in df.columns if c != ROW_ID)
    cols = inputs + (("all_failures",) if all_failures else ())
    outcome = QualityOutcome(tag(df, rules, all_failures), tuple(rules), inputs)
    outcome.quarantine_columns = cols
    return outcome


@dataclass
class Routed:
    """A routed load: both sides as written, and the counts that the write observed."""

    clean: DataFrame
    quarantine: DataFrame
    counts: DataFrame
    rules: tuple[Rule, ...]

    @property
    def results(self) -> DataFrame:
        return rule_results(self.counts, self.rules)

    @property
    def ratios(self) -> DataFrame:
        return quality_ratios(self.counts)


def route(outcome: QualityOutcome, path: str, fmt: str = "parquet") -> Routed:
    """Write clean and quarantined rows below ``path`` and count them, all in one pass over the input.

    The rule counts are observed by the write itself (``DataFrame.observe``), so results and ratios
    read nothing; the sides are read back from the written folders.
    """
    spark = outcome.tagged.sparkSession
    seen = Observation()
    cols = [ref(c) for c in (outcome.quarantine_columns or outcome.input_columns)] + [F.col(REASON)]
    side = F.when(F.col(REASON).isNull(), F.lit("clean")).otherwise(F.lit("quarantine"))
    rows = outcome.tagged.observe(seen, *_count_columns(outcome.rules)).select(*cols, side.alias(ROUTE))
    rows.write.format(fmt).partitionBy(ROUTE).save(path)
    names = ["total", "clean", "quarantined", *[f"r{i}" for i in range(1, len(outcome.rules) + 1)]]
    counts = spark.createDataFrame([tuple(seen.get[n] for n in names)], ", ".join(f"{n} long" for n in names))
    back = spark.read.format(fmt).schema(rows.schema).load(path)
    clean = back.filter(F.col(ROUTE) == "clean").select([ref(c) for c in outcome.input_columns])
    return Routed(clean, back.filter(F.col(ROUTE) == "quarantine").drop(ROUTE), counts, outcome.rules)


def write_routed(outcome: QualityOutcome, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write clean and quarantined rows in one pass, partitioned by ``route``
    (``route=clean`` / ``route=quarantine``)."""
    cols = [ref(c) for c in outcome.input_columns] + [F.col(REASON)]
    route = F.when(F.col(REASON).isNull(), F.lit("clean")).otherwise(F.lit("quarantine"))
    (
        outcome.tagged.select(*cols, route.alias("route"))
        .write.mode(mode)
        .format(fmt)
        .partitionBy("route")
        .save(path)
    )


def union_quarantine(frames: Sequence[DataFrame]) -> DataFrame:
    """Quarantine rows of several tables in one frame; missing columns become NULL (SET2)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
