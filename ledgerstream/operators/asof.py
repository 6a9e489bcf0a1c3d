"""The as-of join: is an id tracked at a row's ledger? By intervals that are sent where they are few, else by buckets of ledgers.

Intervals of an id don't overlap, so at most one matches a row. Up to ``SENT_INTERVALS`` of them are broadcast (the number is measured),
and rows stay where they are. Beyond that both sides are dealt by id; an id with more than ``HOT_ROWS`` rows is dealt by id and
bucket of ledgers as well, so many tasks share it, and its intervals go to each bucket that they reach into. Rows without an id match
nothing: they are left out of the shuffle where they need not come back, and dealt evenly where they do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Intervals (about 100 bytes each) that every task may hold; rows of an id from which on it is cut by ledgers.
SENT_INTERVALS, HOT_ROWS = 200_000, 2_000_000


def are_few(intervals: DataFrame) -> bool:
    """Whether intervals may be broadcast; reads no more of them than it takes to tell."""
    return intervals.limit(SENT_INTERVALS + 1).count() <= SENT_INTERVALS


def within(ledger: Column) -> Column:
    return (ledger >= F.col("_f")) & (F.col("_t").isNull() | (ledger < F.col("_t")))


def named(intervals: DataFrame) -> DataFrame:
    return intervals.select(F.col("contract_id").alias("_c"), F.col("from_ledger").alias("_f"), F.col("to_ledger").alias("_t"))


def bucketed(rows: DataFrame, intervals: DataFrame, id_col: str, ledger_col: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a bucket ``_b``, for a join by id and bucket; ids of few rows have the one bucket 0.

    Ids that are hot are counted (map-side first); there are at most one in ``HOT_ROWS`` rows of them, and they are sent."""
    span = rows.agg(F.min(ledger_col).alias("_low"), F.max(ledger_col).alias("_high"))
    hot = rows.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_h")).agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS)
    # As many buckets as the id's rows need, if ledgers are alike.
    hot = hot.crossJoin(F.broadcast(span)).select("_h", "_low", "_high", F.greatest(F.lit(1), F.floor((F.col("_high") - F.col("_low") + 1) * HOT_ROWS / F.col("_n"))).cast("long").alias("_w"))
    bucket = lambda at: F.floor((at - F.col("_low")) / F.col("_w"))
    # Rows without an id are dealt by what else they have.
    spread = F.when(F.col(id_col).isNull(), F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if kind == "bigint"]), F.lit(1 << 20)))
    left = rows.join(F.broadcast(hot), F.col(id_col) == F.col("_h"), "left").withColumn("_b", F.coalesce(bucket(F.col(ledger_col)), spread, F.lit(0).cast("long"))).drop("_h", "_low", "_high", "_w")
    last = F.least(F.coalesce(F.col("_t") - 1, F.col("_high")), F.col("_high"))
    reach = F.when(F.col("_h").isNull(), F.array(F.lit(0).cast("long"))).when(F.col("_f") <= F.col("_high"), F.sequence(bucket(F.greatest("_f", "_low")), F.greatest(bucket(F.greatest("_f", "_low")), bucket(last)))).otherwise(F.array().cast("array<bigint>"))
    right = named(intervals).join(F.broadcast(hot), F.col("_c") == F.col("_h"), "left").select("_c", "_f", "_t", F.explode(reach).alias("_b"))
    return left, right


def tracked_at(df: DataFrame, intervals: DataFrame, id_col: str, ledger_col: str = "ledger_seq", flag: str = "is_tracked") -> DataFrame:
    """``df`` with a flag: the id is tracked at the row's ledger. No row is doubled or lost, null ids aren't tracked."""
    if are_few(intervals):
        out = df.join(F.broadcast(named(intervals)), (F.col(id_col) == F.col("_c")) & within(F.col(ledger_col)), "left")
    else:
        left, right = bucketed(df, intervals, id_col, ledger_col)
        out = left.join(right.withColumnRenamed("_b", "_rb"), (F.col(id_col) == F.col("_c")) & (F.col("_b") == F.col("_rb")) & within(F.col(ledger_col)), "left").drop("_b", "_rb")
    return out.withColumn(flag, F.col("_c").isNotNull()).drop("_c", "_f", "_t")
