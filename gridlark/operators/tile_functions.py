"""Tile functions that SQL calls: table functions over a TABLE argument, one call a tile.

The function says itself how its table is to be parted and ordered, and which
columns it gives: SQL names a table, the function sees each tile's rows.

    SELECT * FROM tile_statistics(TABLE(samples), 'tile_lat, tile_lon', 't2')
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn, SelectedColumn


def _names(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


@udtf
class TileStatistics:
    """Of each tile: its keys, the number of values, their mean and deviation (biased), least and largest one.

    Values come one at a time and only sums of them are held (Welford's), so a
    tile may have any number of rows. Null and NaN don't count; a tile without
    values has a row with n = 0.
    """

    def __init__(self, analyzed: AnalyzeResult | None = None):
        self.keys, self.n, self.mean, self.m2, self.lo, self.hi = None, 0, 0.0, 0.0, math.inf, -math.inf

    @staticmethod
    def analyze(table: AnalyzeArgument, keys: AnalyzeArgument, value: AnalyzeArgument) -> AnalyzeResult:
        by, column = _names(keys.value), value.value
        fields = {f.name.lower(): f for f in table.dataType.fields}
        for name in (*by, column):
            if name.lower() not in fields:
                raise ValueError(f"the table has no column {name}")
        out = [T.StructField(k, fields[k.lower()].dataType) for k in by]
        out += [T.StructField("n", T.LongType()), *(T.StructField(x, T.DoubleType()) for x in ("mean", "std", "lo", "hi"))]
        return AnalyzeResult(schema=T.StructType(out), partitionBy=[PartitioningColumn(k) for k in by], select=[SelectedColumn(c) for c in (*by, column)])

    def eval(self, row, keys: str, value: str):
        if self.keys is None:
            self.keys = tuple(row[k] for k in _names(keys))
        x = row[value]
        if x is None or x != x:
            return
        x = float(x)
        self.n += 1
        off = x - self.mean
        self.mean += off / self.n
        self.m2 += off * (x - self.mean)
        self.lo, self.hi = min(self.lo, x), max(self.hi, x)

    def terminate(self):
        if self.keys is not None:
            some = self.n > 0
            yield (*self.keys, self.n, self.mean if some else None, math.sqrt(self.m2 / self.n) if some else None, self.lo if some else None, self.hi if some else None)


def register(spark: SparkSession) -> None:
    """Makes the functions known to SQL."""
    spark.udtf.register("tile_statistics", TileStatistics)


def tile_statistics(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The function over a DataFrame."""
    from pyspark.sql import functions as F

    return TileStatistics(df.asTable(), F.lit(", ".join(keys)), F.lit(value))
