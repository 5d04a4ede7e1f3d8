"""Gate expressions: measured values, comparison by op string, details text, labels, publication decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: verdicts, the not-measured marker and the gate
# display labels.
PASS, WARN, FAIL, INCOMPLETE = "PASS", "WARN", "FAIL", "INCOMPLETE"
NOT_MEASURED = "NOT_MEASURED"
NOT_APPLICABLE = "N/A"


def measured(value: Column) -> Column:
    """The value, or NULL where it is not a number. Spark orders NaN above every number, so an
    unchecked NaN would pass every ``>=`` gate; nothing that is not a number counts as measured."""
    return F.when(~F.isnan(value.cast("double")), value)


def compare(value: Column, op: Column, threshold: Column) -> Column:
    """``value {op} threshold``; NULL for an unknown op, a NULL or a NaN on either side (SCL4)."""
    value, threshold = measured(value), measured(threshold)
    return (
        F.when(op == ">=", value >= threshold)
        .when(op == "<=", value <= threshold)
        .when(op == ">", value > threshold)
        .when(op == "<", value < threshold)
        .when(op == "==", value == threshold)
    )


def details(value: Column, op: Column, threshold: Column) -> Column:
    """"{measured} {op} {threshold}" or NOT_MEASURED (SCL5)."""
    text = F.concat_ws(" ", value.cast("string"), op, threshold.cast("string"))
    return F.when(measured(value).isNull(), F.lit(NOT_MEASURED)).otherwise(text)


def label(passed: Column, gate_type: Column) -> Column:
    """Display label (SCL7): PASS; a failed WARN gate WARN; a failed gate FAIL; unknown N/A."""
    return (
        F.when(passed, F.lit(PASS))
        .when(~passed & (gate_type == WARN), F.lit(WARN))
        .when(~passed, F.lit(FAIL))
        .otherwise(F.lit(NOT_APPLICABLE))
    )


def gold_allowed(verdict: Column) -> Column:
    """Publication decision (SCL6): PASS and WARN publish, FAIL and INCOMPLETE block."""
    return verdict.isin(PASS, WARN)
