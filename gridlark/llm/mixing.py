"""Mixing sources to target weights (operator 9).

Tokens are aggregated per source, targets follow from the weights, and each
document is emitted floor(rate) times plus one hash-seeded Bernoulli copy with
probability equal to the fraction of its source's rate.

Edge cases: a null text has size 0; a null source is a source of its own, last
in the order; a source without words has target 0 and rate 0; an empty table
gives an empty result. Equal doc_ids share one draw, so reruns agree; a null
doc_id draws by its text, so that of a source of such rows a part is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.llm._shared import SPACE, Scratch, prefix, quoted, text_of, without

#: Words that the mix may take from a source, as a multiple of its size.
MOST_RATE = 3.0
WEIGHTS = (1, 2, 3)
#: Sources whose table may be broadcast; with more, the join is left to Spark.
BROADCAST_SOURCES = 4096


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_RATE) -> DataFrame:
    """(source, source_size) to (source, source_size, target), by water filling.

    The sources that reach most * size are those with the smallest ratio of size
    to weight: sorted by it, a source is capped if, with all before it capped,
    its weighted share of what remains would exceed its limit. One pass over the
    aggregated sources replaces repeated resharing. Only the per-source table
    (one row a source) is sorted in one place.
    """
    ranked = sizes.withColumn("_k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_k") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped_before = F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    w_left = F.sum("_w").over(everywhere) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    # level: words a unit of weight, were exactly the sources before this one capped
    shared = ranked.select("*", ((F.sum("source_size").over(everywhere) - capped_before) / w_left).alias("_level"))
    free = F.col("_cap") >= F.col("_level") * F.col("_w")
    # the first uncapped source in this order has the final level
    first = F.min(F.when(free, F.struct((F.col("_cap") / F.col("_w")).alias("r"), F.col("_k").alias("k"), F.col("_level").alias("level")))).over(everywhere)
    return shared.select(
        "source", "source_size",
        F.when(first.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), first["level"] * F.col("_w"))).alias("target"),
    )


def draw(key: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the key alone, or on the text where that is null: 32 bits of MD5."""
    name = F.coalesce(key.cast("string"), F.concat(F.lit("null "), text))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_RATE) -> DataFrame:
    """docs with size, source_size, target, copies and taken.

    Neither side of the join has texts unless the caller keeps them: sizes are
    counted in the scan. The per-source table is written and its rows are
    counted: few are broadcast, so that no text is shuffled; with many, Spark
    joins and splits a hot source.
    """
    docs = without(docs, MADE).withColumn("size", n_words(text_of(docs)))
    own = f"{prefix(docs.columns)}source"
    per = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    per = Scratch(docs.sparkSession, "mixing").save(per.select(F.col("source").alias(own), "source_size", "target"))
    per = F.broadcast(per) if per.count() <= BROADCAST_SOURCES else per
    out = docs.join(per, docs["source"].eqNullSafe(per[own]), "inner").drop(own)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + (draw(F.col("doc_id"), text_of(out)) < rate - whole).cast("long")
    return out.withColumn("copies", copies.cast("long")).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))


MADE = ("size", "source_size", "target", "copies", "taken")


def emit_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_RATE) -> DataFrame:
    """The mixed documents: each as often as its copies, with the input's columns."""
    whole = docs.select("doc_id", "source", "text", F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("whole"))
    planned = plan_mix(whole, weights, most).where("copies > 0")
    return planned.select("whole", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("whole.*")
