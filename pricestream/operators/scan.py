"""Skew-safe ordered scans per key: running sum, last value before, first value after.

A plain ``Window.partitionBy(key).orderBy(t)`` puts all rows of a key into one task. That
is right for keys of up to ``rows_per_cell`` rows. A longer key is cut into cells first:
Spark's own range exchange deals its rows by (key, order), the number of the range is the cell,
and the dealt rows are written once so that cells stay what they are. All other rows have the
cell ``WHOLE``. From there on one plan serves both: a window by (cell, key) after one hash
exchange, and, where a key has several cells, one small row per (cell, key) with what the
other cells of the key pass on.

Rows of ordinary keys are shuffled once and never sampled; rows of a long key are shuffled
twice, whether they lie in one second or in a year. The result equals a plain window over the
key (tests check this). A null key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.session import materialize

CELL = "__cell"
#: Place of a row in its cell, where a later row is looked for.
PLACE = "__place"
#: Cell of the rows of keys that are not cut.
WHOLE = -1
_START, _HERE = Window.unboundedPreceding, Window.currentRow


class Running(NamedTuple):
    """A running value: ``sum`` of a column up to and with this row, its ``last`` non-null value so far (with
    this row if ``inclusive``), or its ``next`` non-null value after this row."""

    kind: str
    value: str
    inclusive: bool = True

    def local(self, w) -> Column:
        """Over the window ``w``; that of a ``next`` goes backwards. Looked for forwards, in a frame from each row to
        the end of the key, a value would cost the rest of the key for every row."""
        if self.kind == "next":
            return F.last(self.value, ignorenulls=True).over(w.rowsBetween(_START, -1))
        w = w.rowsBetween(_START, _HERE if self.inclusive else -1)
        return F.sum(self.value).over(w) if self.kind == "sum" else F.last(self.value, ignorenulls=True).over(w)

    def of_cell(self, order: Sequence[str]) -> Column:
        """What a cell passes on, as an aggregate over its rows."""
        if self.kind == "sum":
            return F.sum(self.value)
        pick = F.max_by if self.kind == "last" else F.min_by
        return pick(self.value, F.when(F.col(self.value).isNotNull(), F.struct(*order)))

    def from_others(self, w, column: str) -> Column:
        """What the other cells of the key pass on to a cell; the window ``w`` of a ``next`` goes backwards."""
        w = w.rowsBetween(_START, -1)
        return F.sum(column).over(w) if self.kind == "sum" else F.last(column, ignorenulls=True).over(w)

    def both(self, local: Column, other: Column) -> Column:
        return local + F.coalesce(other, F.lit(0)) if self.kind == "sum" else F.coalesce(local, other)


class Dealt(NamedTuple):
    """Rows with ``__cell``; ``cut`` is the written table of the cut keys' rows, None if no key is cut."""

    rows: DataFrame
    cut: DataFrame | None
    key: str
    order: tuple[str, ...]


def deal(df: DataFrame, key: str, order: Sequence[str], rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL,
         counts: DataFrame | None = None) -> Dealt:
    """``df`` with its cells. ``counts`` (``key``, __n): rows of each key, or at least as many, where
    they are known already; else they are counted (pre-aggregated before the shuffle)."""
    if counts is None:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    long = counts.where(F.col("__n") > rows_per_cell)  # at most (all rows / rows_per_cell) keys
    rows = long.agg(F.sum("__n")).first()[0]
    if not rows:
        return Dealt(df.withColumn(CELL, F.lit(WHOLE)), None, key, tuple(order))
    long = materialize(long, "long_keys")
    ranges = -(-rows // rows_per_cell)
    cut = (_match(df, long.select(key), [key], "left_semi").repartitionByRange(ranges, key, *order)
           .withColumn(CELL, F.spark_partition_id()))
    cut = materialize(cut, "cells")
    rest = _match(df, long.select(key), [key], "left_anti").withColumn(CELL, F.lit(WHOLE))
    return Dealt(rest.unionByName(cut), cut, key, tuple(order))


def scan(dealt: Dealt, **values: Running) -> DataFrame:
    """The dealt rows with a column for each running value; partitioned by (cell, key)."""
    of_key = Window.partitionBy(CELL, dealt.key)
    forwards, backwards = of_key.orderBy(*dealt.order), of_key.orderBy(F.desc(PLACE))
    rows = dealt.rows
    columns = [*rows.columns, *values]
    for name, v in values.items():
        if v.kind != "next":
            rows = rows.withColumn(name, v.local(forwards))
    later = {name: v for name, v in values.items() if v.kind == "next"}
    if later:  # rows that tie in the order have the same places both ways
        rows = rows.withColumn(PLACE, F.row_number().over(forwards))
        for name, v in later.items():
            rows = rows.withColumn(name, v.local(backwards))
    rows = rows.select(*columns)
    if dealt.cut is None:
        return rows
    rows = _match(rows, carries(dealt.cut, [dealt.key], dealt.order, **values), [CELL, dealt.key], "left")
    for name, v in values.items():
        rows = rows.withColumn(name, v.both(F.col(name), F.col(f"__from_{name}")))
    return rows.select(*columns)


def carries(cut: DataFrame, keys: Sequence[str], order: Sequence[str], **values: Running) -> DataFrame:
    """__cell, ``keys`` and, for each running value, __from_NAME: what the key's other cells pass on. One row per
    cell and key, added up before the shuffle."""
    parts = cut.groupBy(CELL, *keys).agg(*[v.of_cell(order).alias(f"__cell_{n}") for n, v in values.items()])
    forwards, backwards = (Window.partitionBy(*keys).orderBy(o) for o in (F.asc(CELL), F.desc(CELL)))
    return parts.select(CELL, *keys, *[v.from_others(backwards if v.kind == "next" else forwards, f"__cell_{n}")
                                       .alias(f"__from_{n}") for n, v in values.items()])


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """An equi-join on ``keys`` in which nulls are equal; the right side's keys go."""
    right = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(Column.__and__, [left[c].eqNullSafe(right[f"__r_{c}"]) for c in keys])
    return left.join(right, on, how).drop(*[f"__r_{c}" for c in keys])


def running_sum(df: DataFrame, key: str, order: Sequence[str], value: str, out: str,
                rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL) -> DataFrame:
    """``out`` = sum of ``value`` over all earlier rows and this row of the key, in ``order``."""
    return scan(deal(df, key, order, rows_per_cell), **{out: Running("sum", value)}).select(*df.columns, out)


def running_last(df: DataFrame, key: str, order: Sequence[str], value: str, out: str, inclusive: bool = True,
                 rows_per_cell: int = K.DEFAULT_ROWS_PER_CELL, counts: DataFrame | None = None) -> DataFrame:
    """``out`` = the last non-null ``value`` among earlier rows of the key (and
    this row when ``inclusive``), in ``order``. ``counts``: see ``deal``."""
    done = scan(deal(df, key, order, rows_per_cell, counts), **{out: Running("last", value, inclusive)})
    return done.select(*df.columns, out)
