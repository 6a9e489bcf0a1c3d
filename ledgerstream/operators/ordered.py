"""Scans over a whole order without one task for all of it: ranges of the order, and what each carries over from the others.

Rows are dealt into ranges of their order and stored, so that a second pass sees the same ranges. The first pass gives one summary a range
(sums, the last row, the first value); the driver adds these up, at most one row a shuffle partition, whatever the table's size.
The second pass is a window within each range, joined with what comes from before or behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


class Ordered:
    """``df`` in the order of the columns ``by``. Rows of equal ``by`` are in one range, in no certain order among themselves."""

    def __init__(self, df: DataFrame, *by: str):
        from ..streaming.tables import stored

        self.by, self.columns = by, df.columns
        self.rows = stored(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id().cast("long")), "ordered")
        self.place = F.struct(*by)
        within = Window.partitionBy("_part")
        self.upward, self.downward = within.orderBy(*by), within.orderBy(*[F.desc(c) for c in by])

    def _carried(self, summary: Column, fold, backwards: bool = False) -> DataFrame:
        """Each range's rows with ``_carry``: ``fold(carry, summary)`` over the ranges before it (or behind it), None at the first."""
        got = self.rows.groupBy("_part").agg(summary.alias("_s"))
        kind = got.schema["_s"].dataType
        out, carry = [], None
        for r in sorted(got.collect(), key=lambda r: -r["_part"] if backwards else r["_part"]):
            out.append((r["_part"], carry))
            carry = fold(carry, r["_s"])
        rows = self.rows.sparkSession.createDataFrame(out, StructType([StructField("_p", LongType()), StructField("_carry", kind)]))
        return self.rows.join(F.broadcast(rows), F.col("_part") == F.col("_p"), "left")

    def running(self, **sums: Column) -> DataFrame:
        """Each row with sums, under the given names, over the rows up to it; those of equal ``by`` count all at once."""
        total = F.struct(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in sums.items()])
        rows = self._carried(total, lambda carry, s: s if carry is None else tuple(a + b for a, b in zip(carry, s, strict=True)))
        return rows.select(*self.columns, *[(F.coalesce(F.sum(c).over(self.upward), F.lit(0)) + F.coalesce(F.col(f"_carry.{n}"), F.lit(0))).cast("long").alias(n) for n, c in sums.items()])

    def neighbour(self, name: str, *columns: str, behind: bool) -> DataFrame:
        """Each row with ``name``, a struct of the next (``behind``) or previous row's ``columns``; null where there is none."""
        row = F.struct(*columns)
        end = F.min_by(row, self.place) if behind else F.max_by(row, self.place)
        rows = self._carried(end, lambda carry, s: s, backwards=behind)
        return rows.select(*self.columns, F.coalesce(F.lead(row).over(self.upward) if behind else F.lag(row).over(self.upward), F.col("_carry")).alias(name))

    def nearest(self, name: str, value: Column) -> DataFrame:
        """Each row with ``name``: ``value`` of the first row from it on that has one."""
        there = F.when(value.isNotNull(), self.place)
        rows = self._carried(F.min_by(value, there), lambda carry, s: carry if s is None else s, backwards=True)
        # Going down, the last value seen is the nearest one behind: a running frame, where one to the end is quadratic.
        return rows.select(*self.columns, F.coalesce(F.last(value, True).over(self.downward.rowsBetween(Window.unboundedPreceding, 0)), F.col("_carry")).alias(name))
