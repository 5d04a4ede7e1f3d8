"""Declarative row-quality rules (QR1-QR5).

A rule names the rows that *fail* it. Row rules are boolean Columns, so Catalyst sees
and optimises them; the duplicate rule is a marker that the engine expands into a
partition-bounded ranking (see ``driftgate.operators.quality``); a rule on rows gets the frame
itself and returns its failing rows, so it may join another table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.functions.columns import ref

# Fixed values that must equal the reference's: rule actions and the earliest valid date.
ACTIONS = ("QUARANTINE", "REJECT", "LOG")
NO_ACTION = "NONE"
EARLIEST_VALID_DATE = "2009-01-01"


@dataclass(frozen=True)
class Duplicates:
    """Rows after the first per key fail. NULL keys form one group.

    "First" is the smallest ``order_by`` value; rows tied on it are broken by the
    input partition they were read from, then arbitrarily. Give a unique tie-break
    (e.g. a primary key) as the last ``order_by`` column for a repeatable choice.
    """

    keys: tuple[str, ...]
    order_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class FailingRows:
    """``find`` gets the rows that passed every earlier rule, with their identity, and the rule's
    column, and returns those that fail: any frame that still has the identity. A row returned
    twice fails once."""

    find: Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True, eq=False)
class Rule:
    """``check`` is a boolean Column (true = fails), a function column-name -> Column,
    a ``Duplicates`` marker or ``FailingRows``. A NULL check result counts as passing."""

    name: str
    column: str
    check: Column | Callable[[str], Column] | Duplicates | FailingRows
    action: str = "QUARANTINE"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}; expected one of {ACTIONS}")

    @property
    def is_duplicates(self) -> bool:
        return isinstance(self.check, Duplicates)

    @property
    def is_predicate(self) -> bool:
        """Whether a row fails by its own values alone."""
        return not isinstance(self.check, (Duplicates, FailingRows))

    def failing(self) -> Column:
        if isinstance(self.check, Column):
            return self.check
        if not self.is_predicate:
            raise TypeError("rules that compare rows are not row predicates")
        return self.check(self.column)


def _date(value: str | _dt.date | Column | None, default: Column) -> Column:
    if value is None:
        return default
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def not_null(column: str, name: str | None = None, action: str = "QUARANTINE") -> Rule:
    """QR1: NULL fails."""
    return Rule(name or f"{column}_not_null", column, lambda c: ref(c).isNull(), action)


def positive(column: str, name: str | None = None, action: str = "QUARANTINE") -> Rule:
    """QR2: NULL or <= 0 fails (NaN passes, since NaN <= 0 is false)."""
    def check(name_: str) -> Column:
        c = ref(name_)
        return c.isNull() | (c <= F.lit(0))

    return Rule(name or f"{column}_positive", column, check, action)


def valid_date_range(
    column: str,
    name: str | None = None,
    action: str = "QUARANTINE",
    as_of: str | _dt.date | Column | None = None,
    earliest: str | _dt.date | Column | None = None,
) -> Rule:
    """QR3: NULL, later than ``as_of`` (default today) or before ``earliest`` fails.

    A timestamp later on the ``as_of`` day fails too: the date compares as midnight.
    """
    def check(name_: str) -> Column:
        c = ref(name_)
        upper = _date(as_of, F.current_date())
        lower = _date(earliest, F.lit(EARLIEST_VALID_DATE).cast("date"))
        return c.isNull() | (c > upper) | (c < lower)

    return Rule(name or f"{column}_date_range", column, check, action)


def no_duplicates(
    keys: str | Sequence[str],
    order_by: str | Sequence[str] = (),
    name: str | None = None,
    action: str = "QUARANTINE",
) -> Rule:
    """QR4: every row after the first of its key fails."""
    ks = (keys,) if isinstance(keys, str) else tuple(keys)
    ob = (order_by,) if isinstance(order_by, str) else tuple(order_by)
    return Rule(name or f"{'_'.join(ks)}_unique", ",".join(ks), Duplicates(ks, ob), action)


def custom(name: str, column: str, check: Column | Callable[[str], Column], action: str = "QUARANTINE") -> Rule:
    """QR5: a user rule; ``check`` marks failing rows."""
    return Rule(name, column, check, action)


def custom_rows(
    name: str, column: str, find: Callable[[DataFrame, str], DataFrame], action: str = "QUARANTINE"
) -> Rule:
    """QR5 over rows: ``find(rows, column)`` returns the failing rows of the frame it is given, e.g.
    by a join with another table. The frame needs a row identity (``operators.identity``)."""
    return Rule(name, column, FailingRows(find), action)


def reference(
    column: str,
    other: DataFrame,
    other_column: str | None = None,
    name: str | None = None,
    action: str = "QUARANTINE",
    nulls_fail: bool = False,
) -> Rule:
    """QR5 as a foreign key: a value that ``other`` does not have fails; NULL passes unless ``nulls_fail``.

    Only the identity and the column meet the distinct keys of ``other``, by an equi-join.
    """

    def find(rows: DataFrame, name_: str) -> DataFrame:
        keys = other.select(ref(other_column or name_).alias("_key")).distinct()
        known = rows if nulls_fail else rows.filter(ref(name_).isNotNull())
        return known.join(keys, ref(name_) == F.col("_key"), "left_anti")

    return custom_rows(name or f"{column}_reference", column, find, action)
