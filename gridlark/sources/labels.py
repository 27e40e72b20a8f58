"""Label metadata as tables: nested XML labels as paths and values, fuzzy lookup, fields of records.

A file's root is parsed into a VARIANT, whatever its elements are. Levels of it are
taken apart by joins with variant_explode until no element has content left; the
depth is that of the deepest label. A VARIANT would hold 1.10 as the number 1.1, so
texts are marked with a character before they are parsed, which keeps them texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.sources.scratch import written

#: What attributes and the text of an element with attributes are called.
ATTRIBUTE, TEXT = "_", "_VALUE"
#: What marks texts and attributes; texts lose it if they have it themselves.
MARK = "\u2063"
#: What may stand before the root element.
PROLOG = r"(?s)\A\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*"
#: Levels of elements that a label may have.
MOST_LEVELS = 32


def read_xml_labels(spark: SparkSession, path: str, root: str, pattern: str = "*.xml") -> DataFrame:
    """(file, path, value) of every element and attribute with a text, in labels whose root element is `root`.

    path has the names from the root down, joined by /; of several elements of one
    name each has its number, from 0, in brackets. Namespace prefixes stay; an
    attribute's name begins with _. Empty elements have the value null.
    """
    files = spark.read.options(recursiveFileLookup="true", pathGlobFilter=pattern).text(path, wholetext=True).where(F.col("value").rlike(PROLOG + f"<{root}[\\s/>]"))
    body = F.regexp_replace("value", PROLOG, "")
    marked = F.regexp_replace(F.regexp_replace(body, r">([^<>]*[^<>\s][^<>]*)<", f">{MARK}$1<"), r"=\s*(['\"])", f"=$1{MARK}")
    # inside a higher-order function, as Spark's generated code for this parser does not compile
    parsed = F.get(F.transform(F.array(marked), lambda x: F.from_xml(x, F.lit("variant"), {"attributePrefix": ATTRIBUTE, "valueTag": TEXT})), F.lit(0))
    now = files.select(F.col("_metadata.file_path").alias("file"), F.lit(root).alias("path"), parsed.alias("v"))
    done = None
    for _ in range(MOST_LEVELS):
        now = written(now.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)), "labels")
        leaves = now.where("kind not in ('OBJECT', 'ARRAY')").select("file", F.regexp_replace("path", f"/{TEXT}$", "").alias("path"), F.replace(F.try_variant_get("v", "$", "string"), F.lit(MARK), F.lit("")).alias("value"))
        done = leaves if done is None else done.union(leaves)
        now = now.where("kind in ('OBJECT', 'ARRAY')")
        if now.isEmpty():
            return done
        below = now.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        name = F.when(F.col("kind") == "ARRAY", F.concat(F.col("path"), F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat_ws("/", F.col("path"), F.col("key")))
        now = below.select("file", name.alias("path"), F.col("value").alias("v"))
    raise ValueError(f"labels have more than {MOST_LEVELS} levels")


def find(labels: DataFrame, names: Sequence[str]) -> DataFrame:
    """(file, asked, path, value): of each file and name asked for the element that fits best: its last name is the same, the same but for case, or has it in it but for case; of equal ones the first path."""
    asked = F.explode(F.array(*[F.lit(n) for n in names])).alias("asked")
    held = labels.select("file", "path", "value", F.regexp_extract("path", r"([^/\[]+)(?:\[\d+\])?$", 1).alias("_name"), asked)
    low = F.lower("_name")
    rank = F.when(F.col("_name") == F.col("asked"), 0).when(low == F.lower("asked"), 1).when(low.contains(F.lower("asked")), 2)
    best = held.withColumn("_rank", rank).where("_rank is not null").groupBy("file", "asked").agg(F.min(F.struct("_rank", "path", "value")).alias("best"))
    return best.select("file", "asked", "best.path", "best.value")


def as_records(labels: DataFrame, fields: dict[str, str]) -> DataFrame:
    """A row a file: fields maps columns to the names that find() looks for; null where a label has none."""
    found = find(labels, sorted(set(fields.values())))
    return found.groupBy("file").agg(*[F.max(F.when(F.col("asked") == name, F.col("value"))).alias(column) for column, name in fields.items()])
