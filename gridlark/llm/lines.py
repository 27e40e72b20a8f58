"""Line dedup (operator 5): levelled sorted runs of line hashes.

`LineRuns` keeps, as in a log-structured merge tree, levels of sorted runs of
(key hash, number of documents). A run is bucketed by its key and each bucket is
sorted, so that runs meet bucket by bucket in merge joins and an existing run is
never shuffled again. A batch of documents is reduced to its keys and counts,
which are bucketed once; it is merge-anti-joined with the keys that a run knows
to be common, and added as a run of the first level. When a level holds `fanout`
runs they are merged, two at a time, into one run of the next. The common keys
are those whose counts, over all runs, reach `min_docs`.

Edge cases: a null or empty text is one empty line; an empty key (a blank line)
is never common; equal lines of a document count once; repeated rows count as
documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.llm._shared import Scratch, map_texts, prefix, slices, texts, with_outputs

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BLANK = b" \t\n\x0b\x0c\r"
#: Common keys that a broadcast may hold: 16 bytes each. Beyond it, a join.
BROADCAST_KEYS = 200_000
BATCHES = 4
FANOUT = 2

OUT = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("n_lines", T.LongType()),
    T.StructField("n_dropped", T.LongType()),
])


def line_key(line: bytes) -> bytes:
    return line.translate(LOWER).strip(BLANK)


def hashed_keys(text: str) -> list[bytes | None]:
    """A 16-byte hash of each line's key; None for an empty one."""
    digest = xxhash.xxh3_128_digest
    return [digest(k) if (k := x.strip(BLANK)) else None for x in text.encode().translate(LOWER).split(b"\n")]


def document_keys(docs: DataFrame, batches: int) -> DataFrame:
    """(part, key): each document's distinct keys; part spreads documents over the batches."""
    one = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("part"), "text")

    def run(incoming):
        for whole in incoming:
            for b in slices(whole):
                parts, keys = [], []
                for part, text in zip(b.column("part").to_pylist(), texts(b.column("text"))):
                    own = {k for k in hashed_keys(text) if k}
                    keys.extend(own)
                    parts.extend([part] * len(own))
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(keys, pa.binary())], names=["part", "key"])

    return one.mapInArrow(run, "part int, key binary")


class LineRuns:
    """Levelled sorted runs of (key, n); n is the number of documents, held at min_docs at most."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = FANOUT, scratch: Scratch | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.scratch = scratch or Scratch(spark, "runs")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]

    def _write(self, counts: DataFrame) -> DataFrame:
        """A run: counts dealt out by key already, so each task writes one bucket, sorted."""
        name, path = f"gridlark_run_{uuid.uuid4().hex}", self.scratch.path()
        counts.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(self.buckets, "key").sortBy("key").saveAsTable(name)
        out = self.spark.table(name)
        out._gridlark_path, out._gridlark_table = path, name
        return out

    def _drop(self, *runs: DataFrame) -> None:
        for r in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {r._gridlark_table}")
        self.scratch.drop(*runs)

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def anti(self, counts: DataFrame) -> DataFrame:
        """A batch's counts without the keys that a run knows to be common: no later count matters for them.

        The anti join is written as an outer one: Spark would move it below the
        sums, and a hot key would be shuffled once a document.
        """
        for run in self.runs():
            known = run.where(F.col("n") >= self.min_docs).select("key", F.lit(True).alias("known"))
            counts = counts.join(known.hint("merge"), "key", "left").where("known is null").drop("known")
        return counts

    def merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs as one, by a merge join of their sorted buckets."""
        a, b = a.select("key", F.col("n").alias("_a")), b.select("key", F.col("n").alias("_b"))
        n = F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0))
        return a.join(b.hint("merge"), "key", "full").select("key", F.least(n, F.lit(self.min_docs)).cast("long").alias("n"))

    def add(self, keys: DataFrame) -> None:
        """A batch: a row for each document and key. Counts are summed before their shuffle, which deals them into buckets."""
        counts = keys.groupBy("key").agg(F.least(F.count(F.lit(1)), F.lit(self.min_docs)).cast("long").alias("n"))
        self.levels[0].append(self._write(self.anti(counts)))
        self._compact()

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        while len(runs) > 1:
            a, b, *runs = runs
            runs = [self._write(self.merged(a, b)), *runs]
            self._drop(a, b)
        return runs[0]

    def _compact(self) -> None:
        at = 0
        while at < len(self.levels) and len(self.levels[at]) >= self.fanout:
            merged, self.levels[at] = self._merge(self.levels[at]), []
            if at + 1 == len(self.levels):
                self.levels.append([])
            self.levels[at + 1].append(merged)
            at += 1

    def common(self) -> DataFrame:
        """The keys found in min_docs documents or more. All runs become one."""
        if not self.runs():
            return self.spark.createDataFrame([], "key binary")
        self.levels = [[self._merge(self.runs())]]
        return self.levels[0][0].where(F.col("n") >= self.min_docs).select("key")

    def close(self) -> None:
        self._drop(*self.runs())
        self.levels = [[]]


def without_lines(texts_: list[str], drops) -> dict[str, list]:
    """The texts without the lines whose key hashes are in their set of `drops`, and how many lines there were and go."""
    made = {"text": [], "n_lines": [], "n_dropped": []}
    for text, drop in zip(texts_, drops):
        own = text.split("\n")
        stay = [x for x, k in zip(own, hashed_keys(text)) if k not in drop] if drop else own
        made["text"].append(text if len(stay) == len(own) else "\n".join(stay))
        made["n_lines"].append(len(own))
        made["n_dropped"].append(len(own) - len(stay))
    return made


def drop_common(docs: DataFrame, common: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """docs with text of the lines that stay, n_lines and n_dropped.

    The set of common keys is broadcast if it is counted to be small, else each
    document's own common keys come by joins on the key and on the document.
    """
    found = common.limit(most + 1).collect()
    if len(found) > most:
        return _drop_by_join(docs, common)
    held = docs.sparkSession.sparkContext.broadcast(frozenset(bytes(r["key"]) for r in found))

    def start():
        drop = held.value
        return lambda column: without_lines(column, [drop] * len(column))

    return map_texts(docs, start, OUT)


def _drop_by_join(docs: DataFrame, common: DataFrame) -> DataFrame:
    def pairs(incoming):
        for whole in incoming:
            for b in slices(whole):
                ids, keys = [], []
                for i, text in zip(b.column("id").to_pylist(), texts(b.column("text"))):
                    own = {k for k in hashed_keys(text) if k}
                    keys.extend(own)
                    ids.extend([i] * len(own))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["id", "key"])

    # a hash of id and text names a row here, so that null and repeated ids need no rule
    p = prefix(docs.columns)
    named = docs.withColumn(f"{p}id", F.xxhash64("doc_id", "text"))
    per = named.select(F.col(f"{p}id").alias("id"), "text").mapInArrow(pairs, "id long, key binary").distinct()
    mine = per.join(common, "key").groupBy(F.col("id").alias(f"{p}id")).agg(F.collect_set("key").alias(f"{p}keys"))
    joined = named.join(mine, f"{p}id", "left").drop(f"{p}id")
    schema, keep = with_outputs(docs.schema, OUT)
    at, names = [c.lower() for c in docs.columns].index("text"), schema.fieldNames()

    def run(incoming):
        for whole in incoming:
            for b in slices(whole, whole.schema.names[at]):
                made = without_lines(texts(b.column(at)), [set(k or ()) for k in b.column(b.num_columns - 1).to_pylist()])
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], *(pa.array(made[f.name], pa.string() if f.name == "text" else pa.int64()) for f in OUT)], names=names)

    return joined.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_docs: int = 10, batches: int = BATCHES, most: int = BROADCAST_KEYS) -> DataFrame:
    """docs without the lines whose keys are in min_docs documents or more.

    text becomes the lines that stay; n_lines and n_dropped are added.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    keys = scratch.save(document_keys(docs, batches), by="part")
    runs = LineRuns(spark, min_docs, scratch=scratch)
    for part in range(batches):
        runs.add(keys.where(F.col("part") == part).select("key"))
    common = scratch.save(runs.common())
    runs.close()
    scratch.drop(keys)
    return drop_common(docs, common, most)
