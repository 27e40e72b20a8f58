"""Global order without a single task: ordinals, even groups and dictionaries.

Rows are dealt out by ranges of the order, sorted within their range and numbered
there; the numbers of rows in the ranges before are added. Only those counts, one
a range, meet in one place. The sorted rows are written before they are counted,
since a second run could cut the ranges elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.sources.scratch import written

#: Bits of a row's number in its range, as monotonically_increasing_id has them.
LOCAL = 33
#: Distinct values that may be broadcast when a column is encoded; with more, the join is left to Spark.
BROADCAST_VALUES = 100_000


def ordinals(df: DataFrame, order: Sequence[str | Column], name: str = "ordinal", start: int = 0) -> DataFrame:
    """df with its rows' places in the order, from `start` on, without gaps. Ties are numbered in any order: give a key that tells rows apart where that matters."""
    n = _ranges(df)
    held = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    held = written(held, "ordinals")
    # the shift leaves the range's number; AQE may have joined ranges, which keeps them in order
    place = F.shiftright("_id", LOCAL)
    counts = held.groupBy(place.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_range", before.alias("_before"))
    out = held.join(F.broadcast(offsets), place == F.col("_range"))
    return out.withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << LOCAL) - 1)) + start).drop("_id", "_range", "_before")


def _ranges(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def even_groups(df: DataFrame, order: Sequence[str], n: int, name: str = "group") -> DataFrame:
    """df with the number (from 1) of each row's group of n even ones, larger groups first, as ntile(n) over the order has it."""
    held = written(ordinals(df, order, "_o"), "groups")
    total = held.agg(F.count(F.lit(1)).alias("_total"))
    size, more = F.floor(F.col("_total") / n), F.col("_total") % n
    large = more * (size + 1)
    group = F.when(F.col("_o") < large, F.floor(F.col("_o") / (size + 1))).otherwise(more + F.floor((F.col("_o") - large) / F.greatest(size, F.lit(1)))) + 1
    return held.crossJoin(F.broadcast(total)).withColumn(name, group.cast("int")).drop("_o", "_total")


def beside(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Columns of both, row by row of their orders: a positional concatenation as a join on ordinals. Raises if one has more rows."""
    a, b = ordinals(left, left_order, "_o"), ordinals(right, right_order, "_o")
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"{n} rows beside {m}")
    return a.join(b, "_o").drop("_o")


# --- dictionaries

def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the distinct values, not null, with codes 0, 1, 2... in their order: the same in any run on any partitioning."""
    return ordinals(df.select(F.col(column).alias("value")).where("value is not null").distinct(), ["value"], "code").select("value", F.col("code").cast("long").alias("code"))


def encode(df: DataFrame, column: str, codes: DataFrame, name: str | None = None) -> DataFrame:
    """df with the column's codes instead of it, or as `name` beside it; null for null and for values that the dictionary lacks."""
    small = codes.limit(BROADCAST_VALUES + 1).count() <= BROADCAST_VALUES
    right = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    out = df.join(F.broadcast(right) if small else right, F.col(column) == F.col("_value"), "left").drop("_value")
    return out.withColumnRenamed("_code", name) if name else out.withColumn(column, F.col("_code")).drop("_code")


def decode(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """df with the values of the column's codes."""
    right = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    return df.join(right, F.col(column) == F.col("_code"), "left").withColumn(column, F.col("_value")).drop("_value", "_code")


def unify(*dictionaries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One dictionary of all values, and (source, old, code): what each dictionary's codes become; source is its place among the arguments."""
    tagged = [d.select(F.lit(i).alias("source"), "value", F.col("code").alias("old")) for i, d in enumerate(dictionaries)]
    both = tagged[0]
    for d in tagged[1:]:
        both = both.unionByName(d)
    whole = written(dictionary(both, "value"), "dictionary")
    return whole, both.join(whole, "value").select("source", "old", "code")


def recode(df: DataFrame, column: str, remap: DataFrame, source: int) -> DataFrame:
    """df with the unified dictionary's codes instead of its own."""
    own = remap.where(F.col("source") == source).select(F.col("old").alias("_old"), F.col("code").alias("_new"))
    return df.join(own, F.col(column) == F.col("_old"), "left").withColumn(column, F.col("_new")).drop("_old", "_new")
