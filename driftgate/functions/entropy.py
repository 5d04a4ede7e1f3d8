"""Column expressions for profiles and drift: category values, entropy class, drift direction.

All built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from driftgate.functions.columns import ref

# Fixed values that must equal the reference's: entropy class labels and the upper bounds
# of normalised entropy for each class (CONSTANT when distinct <= 1 or H == 0).
CLASS_BOUNDS = (
    ("VERY_LOW", 0.15),
    ("LOW", 0.40),
    ("MODERATE", 0.70),
    ("HIGH", 0.90),
)
CLASS_TOP = "VERY_HIGH"
CLASS_CONSTANT = "CONSTANT"

# Drift directions.
STABLE, COLLAPSE, SPIKE = "STABLE", "COLLAPSE", "SPIKE"

# Default drift thresholds.
DEFAULT_DROP_PCT = 0.50
DEFAULT_SPIKE_PCT = 0.50
DEFAULT_HEALTH_FLOOR = 0.70


def category(name: str, data_type: DataType) -> Column:
    """The category a value falls in: its string form; NULL stays NULL (its own category).

    Floating point ``-0.0`` is folded into ``0.0`` first (``x + 0.0``), so that the
    distinct count and the entropy agree on what one value is.
    """
    c = ref(name)
    if isinstance(data_type, DoubleType):
        c = c + F.lit(0.0)
    elif isinstance(data_type, FloatType):
        c = c + F.lit(0.0).cast("float")
    return c.cast("string")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Seed of the second hash of a text key.
SECOND_SEED = 7


def category_key_sql(name: str, data_type: DataType) -> tuple[str, str]:
    """SQL text of the two numbers of ``category_key``."""
    c = _q(name)
    if isinstance(data_type, (ByteType, ShortType, IntegerType, LongType)):
        parts = (f"CAST({c} AS BIGINT)", "0L")
    elif isinstance(data_type, BooleanType):
        parts = (f"CAST(CAST({c} AS INT) AS BIGINT)", "0L")
    elif isinstance(data_type, DateType):
        parts = (f"CAST(unix_date({c}) AS BIGINT)", "0L")
    elif isinstance(data_type, TimestampType):
        parts = (f"unix_micros({c})", "0L")
    elif isinstance(data_type, TimestampNTZType):
        parts = (f"xxhash64({c})", "0L")
    elif isinstance(data_type, (DoubleType, FloatType)):
        parts = (f"xxhash64(CAST({c} AS DOUBLE))", "0L")
    else:
        if isinstance(data_type, BinaryType):
            text = c
        elif isinstance(data_type, (ArrayType, StructType, MapType)):
            text = f"to_json(named_struct('v', {c}), map('ignoreNullFields', 'false'))"
        else:
            text = f"CAST({c} AS STRING)"
        parts = (f"xxhash64({text})", f"xxhash64({SECOND_SEED}, octet_length({text}), {text})")
    return tuple(f"CASE WHEN {c} IS NOT NULL THEN {p} END" for p in parts)


def category_key(name: str, data_type: DataType) -> Column:
    """A grouping key of two numbers for the category of a value: struct<l bigint, h bigint>, both
    NULL for NULL, so that grouping stays on Spark's fast path for primitive keys.

    Exact, in ``l`` alone: integers, booleans and dates as themselves, timestamps as microseconds;
    floating point and zone-free timestamps as the XXH64 of their 64 bits, which maps 64-bit values one to
    one (Spark hashes -0.0 as 0.0 and every NaN alike). Everything else (binary, text, and arrays,
    structs and maps as JSON, which tells ``["a, b"]`` from ``["a", "b"]``) becomes two 64-bit XXH64
    with different seeds, the second over the length too: grouping by the key equals grouping by the
    value but for two texts that agree in all 128 bits, by chance with a probability of about 1e-19
    among 10^10 different texts. XXH64 is no defence against texts made to collide.
    """
    l, h = category_key_sql(name, data_type)
    return F.expr(f"named_struct('l', {l}, 'h', {h})")


def group_key(value: Column) -> Column:
    """The shuffle key of a text value where a rule rejects rows by it: the SHA-256 digest, 32 bytes."""
    return F.unhex(F.sha2(value, 256))


def entropy_from_counts(n: Column, distinct: Column, sum_flogf: Column) -> Column:
    """Shannon entropy in bits from n = sum(f), distinct groups and sum(f*log2 f).

    H = log2(n) - sum(f*log2 f)/n, rounded to 6 places; 0.0 when there is at most one group.
    """
    h = F.log2(n.cast("double")) - sum_flogf / n.cast("double")
    return F.when(distinct <= 1, F.lit(0.0)).otherwise(round_exact(h, 6))


def normalized_entropy(entropy: Column, distinct: Column) -> Column:
    """H / log2(distinct) of the already rounded H, rounded to 6; 0.0 when distinct <= 1."""
    return F.when(distinct <= 1, F.lit(0.0)).otherwise(
        round_exact(entropy / F.log2(distinct.cast("double")), 6)
    )


def entropy_class_sql(entropy: str, normalized: str, distinct: str) -> str:
    """SQL text of ``entropy_class``."""
    whens = " ".join(f"WHEN {normalized} < {bound} THEN '{label}'" for label, bound in CLASS_BOUNDS)
    return (
        f"CASE WHEN {distinct} <= 1 OR {entropy} = 0.0 THEN '{CLASS_CONSTANT}' {whens} "
        f"ELSE '{CLASS_TOP}' END"
    )


def entropy_class(entropy: Column, normalized: Column, distinct: Column) -> Column:
    """Human label of an entropy level (SCL1)."""
    expr = F.when((distinct <= 1) | (entropy == 0.0), F.lit(CLASS_CONSTANT))
    for label, bound in CLASS_BOUNDS:
        expr = expr.when(normalized < bound, F.lit(label))
    return expr.otherwise(F.lit(CLASS_TOP))


def drift_columns(
    baseline: Column,
    current: Column,
    drop_pct: Column | float = DEFAULT_DROP_PCT,
    spike_pct: Column | float = DEFAULT_SPIKE_PCT,
) -> dict[str, Column]:
    """Per-column drift verdict from baseline and current entropy (SCL2).

    Comparisons are strict: a change of exactly -drop_pct is STABLE. Magnitude and
    stability are not rounded.
    """
    drop = drop_pct if isinstance(drop_pct, Column) else F.lit(float(drop_pct))
    spike = spike_pct if isinstance(spike_pct, Column) else F.lit(float(spike_pct))
    both_zero = (baseline == 0.0) & (current == 0.0)
    base_zero = baseline == 0.0
    pct = (current - baseline) / F.nullif(baseline, F.lit(0.0))
    direction = (
        F.when(both_zero, F.lit(STABLE))
        .when(base_zero, F.lit(SPIKE))
        .when(pct < -drop, F.lit(COLLAPSE))
        .when(pct > spike, F.lit(SPIKE))
        .otherwise(F.lit(STABLE))
    )
    magnitude = F.when(both_zero, F.lit(0.0)).when(base_zero, F.lit(1.0)).otherwise(F.abs(pct))
    stability = (
        F.when(both_zero, F.lit(1.0))
        .when(base_zero, F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(pct)))
    )
    return {
        "drift_detected": direction != F.lit(STABLE),
        "drift_direction": direction,
        "drift_magnitude": magnitude,
        "stability_score": stability,
    }


def round_exact_sql(x: str, digits: int) -> str:
    """SQL text of ``round_exact`` for the SQL expression ``x``."""
    sc = f"CAST({float(10 ** digits)!r} AS DOUBLE)"
    a = f"abs(CAST(({x}) AS DOUBLE))"
    p = f"({a} * {sc})"
    c = f"({a} * CAST(134217729.0 AS DOUBLE))"
    hi = f"({c} - ({c} - {a}))"
    lo = f"({a} - {hi})"
    e = f"(({hi} * {sc} - {p}) + {lo} * {sc})"
    k = f"CAST(floor({p}) AS DOUBLE)"
    t = f"(({p} - {k}) - CAST(0.5 AS DOUBLE))"
    odd = f"(pmod({k}, CAST(2.0 AS DOUBLE)) = CAST(1.0 AS DOUBLE))"
    up = f"(CASE WHEN {t} > 0 THEN true WHEN {t} < 0 THEN false WHEN {e} > 0 THEN true WHEN {e} < 0 THEN false ELSE {odd} END)"
    r = f"((CASE WHEN {up} THEN {k} + CAST(1.0 AS DOUBLE) ELSE {k} END) / {sc})"
    return f"(CASE WHEN ({x}) < 0 THEN -{r} ELSE {r} END)"


def round_exact(x: Column | str, digits: int) -> Column:
    """Round to ``digits`` places the way Python's ``round`` does: on the exact binary value
    of the double, half-even only on exact ties.

    Spark's ``round`` rounds HALF_UP on the shortest decimal string. Here the exact
    product x * 10^d is recovered as p + e with Dekker's two-product (Veltkamp split),
    and the fraction of p decides, with e breaking apparent ties. Plain double
    arithmetic only, so it stays inside whole-stage codegen. ``x`` may be a Column or
    SQL text (cheaper to build: one call to the JVM).
    """
    if isinstance(x, str):
        return F.expr(round_exact_sql(x, digits))
    return _round_column(x, digits)


def _round_column(x: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    a = F.abs(x)
    p = a * F.lit(scale)
    c = a * F.lit(134217729.0)
    hi = c - (c - a)
    lo = a - hi
    e = (hi * F.lit(scale) - p) + lo * F.lit(scale)
    k = F.floor(p).cast("double")
    t = (p - k) - F.lit(0.5)
    up = F.when(t > 0, True).when(t < 0, False).when(e > 0, True).when(e < 0, False)
    even_up = F.pmod(k, F.lit(2.0)) == F.lit(1.0)
    n = F.when(F.coalesce(up, even_up), k + F.lit(1.0)).otherwise(k)
    r = n / F.lit(scale)
    return F.when(x < 0, -r).otherwise(r)
