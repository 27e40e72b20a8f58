"""Filter interaction audit by mask histograms (operator 13).

Native expressions give each document a mask of the filters it fails; grouping by
text gives the smallest doc_id that has it. Documents of a part are then counted
by mask: 32 cells a part hold all that any order of the five filters can show.
What each order keeps and removes at each step, and the Shapley values, are sums
over cells, whatever the number of documents.

Edge cases: a null text is empty, a null part is the empty string and counts with
it; a null doc_id is no smaller than any other and has no smaller one; texts are
the same if their SHA-256 are; a document is good or toxic if any of its labels
says so, and rows with equal doc_ids share their labels; without labels it is
neither; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.llm._shared import SPACE, Scratch

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
COUNTS = ("n", "good", "toxic")


def measured(docs: DataFrame, part: str = "source") -> DataFrame:
    """(doc_id, part, mask, digest): bits of the filters that the text alone decides, A the lowest."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(f"[^{SPACE}]+"), F.lit(0)))
    n, different = F.size("words"), F.size(F.array_distinct("words"))
    fails = [
        n < 200,
        100 * different < 50 * n,
        100 * F.regexp_count("text", F.lit("[A-Z]")) > 2 * F.char_length("text"),
        F.col("text").rlike("[#$%&*|]"),
    ]
    mask = sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def cells(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, n, good, toxic): arrays of the CELLS counts of documents, good and toxic ones, by mask.

    The measures are written once, a short row a document. Groups of copies and of
    documents of a part are summed before they are shuffled. The grouped sides of
    both joins are written too, so that Spark shuffles both sides for the join
    alone and can split a hot text or a hot (null) doc_id; no bound is known for
    either, so neither is broadcast.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    rows = scratch.save(measured(docs, part))
    copied = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("digest", "least")
    copied = scratch.save(copied)
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))])
    said = scratch.save(said)
    held = rows.join(copied.hint("merge"), "digest", "left").join(said.hint("merge"), "doc_id", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    held = held.select("part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    one = held.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return one.groupBy("part").agg(*[F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)) for m in range(CELLS)]).alias(c) for c in COUNTS])


def steps() -> list[tuple[str, int, int, int]]:
    """(filter_order, step, filter's bit, bits of those before it) of every order."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for k, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            out.append(("".join(order), k + 1, bit, before))
            before |= bit
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows a part."""
    plan = steps()
    # what a step shows depends on its filter and on the set before it: 80 cases
    cases = sorted({x[2:] for x in plan})
    orders = {case: sum(x[2:] == case for x in plan) for case in cases}
    at = {case: i + 1 for i, case in enumerate(cases)}

    def total(counts: str, holds) -> Column:
        """Sum of the cells whose mask holds."""
        one = lambda m: F.when(holds(m), F.element_at(counts, m + 1)).otherwise(F.lit(0).cast("long"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(CELLS - 1)), F.lit(0).cast("long"), lambda acc, m: acc + one(m))

    def shown(c: Column) -> Column:
        bit, before = c["bit"], c["before"]
        fails = lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) == 0)
        return F.struct(
            bit.alias("bit"), c["orders"].alias("orders"),
            total("n", lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
            total("n", fails).alias("removed"),
            total("n", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
            F.element_at("n", bit + 1).alias("unique_fails"),
            total("good", fails).alias("good_lost"),
            total("toxic", fails).alias("toxic_lost"),
        )

    all_cases = F.array(*[F.struct(F.lit(bit).alias("bit"), F.lit(before).alias("before"), F.lit(orders[bit, before]).alias("orders")) for bit, before in cases])
    by_part = cells(docs, labels, part).select("part", F.transform(all_cases, shown).alias("cases"))
    all_steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(at[bit, before]).alias("at")) for o, k, bit, before in plan])
    out = by_part.select("part", "cases", F.explode(all_steps).alias("o")).withColumn("c", F.element_at("cases", F.col("o.at")))
    shapley = F.aggregate(F.filter("cases", lambda x: x["bit"] == F.col("c.bit")), F.lit(0).cast("long"), lambda acc, x: acc + x["removed"] * x["orders"])
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return out.select("part", "o.filter_order", F.col("o.step").cast("int").alias("step"), *[F.col(f"c.{x}").cast("long").alias(x) for x in names], shapley.alias("shapley"))
