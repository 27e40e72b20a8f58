"""Target-distribution importance resampling (operator 12).

A feature is a run of 1 to `size` words; it is counted in one of BUCKETS buckets,
for the documents and for the texts that stand for the target distribution. The
gains of the buckets are an array of fixed size, and a document's weight is the
sum of the gains of its features, taken from the array. Weight plus Gumbel noise
that depends on the doc_id alone is the score, and the highest scores are drawn.

1. Every partition's eligible rows are sorted, a run of at most RUN rows at a
   time; runs are written in blocks that carry their first score.
2. Scores that cut the runs into ranges of about RANGE rows are taken from the
   blocks' first rows. Blocks are cut there, and rows of a range are counted.
3. Each range that the draw reaches is merged by one tournament tree over the
   runs that have rows in it. Blocks come to it in the order of their first rows,
   so that a run has one block open at a time; the last range stops at the exact
   count. A range's ranks begin where those of the ranges before end.

Edge cases: a null text has no words; a null doc_id is hashed as the word null
and is the largest in ties; rows with equal doc_id and score stay rows of their
own, in any order; with fewer than `least` words no row is drawn; empty tables,
of documents or of targets, give what the formulas give.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.llm._shared import Scratch, map_texts, prefix, quoted, slices, texts, without

BUCKETS = 10_000
#: Rows of a run that a task sorts at once, of a block of a run, and for which a merging task is made.
RUN, BLOCK, RANGE = 1 << 20, 1 << 12, 1 << 21
#: Words that a worker remembers the buckets of.
CACHE_WORDS = 300_000
#: Upper case to lower case, and all ASCII that is no letter or digit to a blank.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: What a null doc_id counts as in ties.
NULL_ID = (1 << 63) - 1


class Buckets(dict):
    """The bucket of a feature's bytes."""

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % BUCKETS
        return value


def features(text: str, size: int, known: Buckets) -> np.ndarray:
    """The buckets of the text's features, repeats included."""
    words = text.encode().translate(WORDS).split()
    out = [np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
    for n in range(2, size + 1):
        out.append(np.fromiter((known[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)), np.int64, max(0, len(words) - n + 1)))
    return np.concatenate(out)


def bucket_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How many features all texts have in each bucket: a row a bucket goes to the driver."""
    def run(batches):
        known, total = Buckets(), np.zeros(BUCKETS, np.int64)
        for whole in batches:
            for b in slices(whole):
                for t in texts(b.column("text")):
                    total += np.bincount(features(t, size, known), minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of how much more frequent a bucket is among the targets)."""
    s, t = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: F.Column, seed: str) -> F.Column:
    """floor(1000 * Gumbel noise) of a doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def score_documents(docs: DataFrame, gain: np.ndarray, size: int = 1, seed: str = "2024") -> DataFrame:
    """docs with n_features, weight, score and the number of words, n_words."""
    def start():
        known = Buckets()

        def work(column):
            out = {f.name: [] for f in MADE}
            for t in column:
                f = features(t, size, known)
                out["n_features"].append(len(f))
                out["weight"].append(int(gain[f].sum()))
                out["n_words"].append(len(f) if size == 1 else len(t.encode().translate(WORDS).split()))
            return out

        return work

    made = map_texts(without(docs, ["score"]), start, MADE)
    return made.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


MADE = T.StructType([T.StructField(n, T.LongType()) for n in ("n_features", "weight", "n_words")])

#: What a run's row is: minus its score, doc_id, row; sorted so.
ROW = np.dtype([("order", np.int64), ("id", np.int64), ("row", np.int64)])
KEY = ROW.names


def sorted_runs(rows: DataFrame) -> DataFrame:
    """(run, block, n, head_order, head_id, head_row, data): each partition's rows (doc_id, score, row), sorted, RUN at a time."""
    def run(batches):
        me, k, held, many = TaskContext.get().partitionId(), 0, [], 0

        def write():
            nonlocal k
            own = np.sort(np.concatenate(held), order=KEY)
            for i in range(0, len(own), BLOCK):
                part = own[i : i + BLOCK]
                yield pa.RecordBatch.from_arrays([pa.array([me << 20 | k], pa.int64()), pa.array([i // BLOCK], pa.int64()), pa.array([len(part)], pa.int64()), *(pa.array([int(part[0][c])], pa.int64()) for c in KEY), pa.array([part.tobytes()], pa.binary())], names=RUN_NAMES)
            k += 1

        for b in batches:
            own = np.empty(b.num_rows, ROW)
            own["order"], own["row"] = -b.column("score").to_numpy(), b.column("row").to_numpy()
            own["id"] = b.column("doc_id").fill_null(NULL_ID).to_numpy()
            held.append(own)
            many += len(own)
            if many >= RUN:
                yield from write()
                held, many = [], 0
        if many:
            yield from write()

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "score", "row").mapInArrow(run, "run long, block long, n long, head_order long, head_id long, head_row long, data binary")


RUN_NAMES = ["run", "block", "n", "head_order", "head_id", "head_row", "data"]


def range_cuts(runs: DataFrame, rows: int, size: int) -> np.ndarray:
    """Rows at which the order is cut into ranges of about `size` rows: evenly among at most 64 block heads a range."""
    parts = -(-rows // size)
    if parts <= 1:
        return np.zeros(0, ROW)
    heads = runs.select("head_order", "head_id", "head_row")
    share = min(1.0, 64.0 * parts * BLOCK / rows)
    found = heads.where(F.pmod(F.xxhash64(*[f"head_{c}" for c in KEY]), F.lit(1 << 24)) < int(share * (1 << 24))).toArrow()
    own = np.empty(found.num_rows, ROW)
    for c in KEY:
        own[c] = found.column(f"head_{c}").to_numpy()
    own.sort(order=KEY)
    return np.unique(own[np.arange(1, parts) * len(own) // parts]) if len(own) >= parts else own


def cut_blocks(runs: DataFrame, cuts: np.ndarray) -> DataFrame:
    """runs with blocks cut where ranges begin, and the range."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                own = np.frombuffer(b.column("data")[i].as_py(), ROW)
                at = [0, *np.searchsorted(own, cuts, "left").tolist(), len(own)] if len(cuts) else [0, len(own)]
                for k, (x, y) in enumerate(zip(at, at[1:])):
                    if y > x:
                        part = own[x:y]
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), b.column("run").slice(i, 1), pa.array([y - x], pa.int64()), *(pa.array([int(part[0][c])], pa.int64()) for c in KEY), pa.array([part.tobytes()], pa.binary())], names=["range", "run", *RUN_NAMES[2:]])

    return runs.mapInArrow(run, "range int, run long, n long, head_order long, head_id long, head_row long, data binary")


class Tournament:
    """A tree of losers over runs: the least row of all, again and again; a run joins when its block comes.

    Leaves hold (row, leaf) and a leaf without a row loses to all. An inner node
    keeps the loser of its match, so that a new row of the winner's leaf meets the
    losers on its way up only.
    """

    def __init__(self):
        self.size, self.tree, self.rows = 1, [None], [None]
        self.leaf: dict[int, int] = {}
        self.winner: int | None = None

    def _before(self, a: int | None, b: int | None) -> bool:
        x, y = None if a is None else self.rows[a], None if b is None else self.rows[b]
        return x is not None and (y is None or x <= y)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        a, b = (a, b) if self._before(a, b) else (b, a)
        self.tree[node] = b
        return a

    def put(self, run: int, row: tuple) -> None:
        """The first row of a run's block; all rows in the tree are greater, and the run has none there."""
        if (at := self.leaf.get(run)) is None:
            at = self.leaf[run] = len(self.leaf)
            if at >= self.size or self.winner is None:
                self.size = max(self.size, 1 << at.bit_length())
                self.rows += [None] * (self.size - len(self.rows))
                self.tree = [None] * self.size
                self.rows[at] = row
                self.winner = self._build(1)
                return
        # the leaf wins all matches: where one from its side has lost, the other side's winner, who lost further up or not at all, is the loser now
        self.rows[at] = row
        child, node, open_ = at + self.size, (at + self.size) // 2, None
        while node:
            lost = self.tree[node] + self.size
            if lost >> (lost.bit_length() - child.bit_length()) == child:
                if open_ is not None:
                    self.tree[open_] = lost - self.size
                open_ = node
            child, node = node, node // 2
        if open_ is not None:
            self.tree[open_] = self.winner
        self.winner = at

    def advance(self, row: tuple | None) -> None:
        """The winner's run goes on with another row, or none."""
        self.rows[self.winner] = row
        self.replay(self.winner)

    def replay(self, at: int) -> None:
        node = (at + self.size) // 2
        while node:
            if not self._before(at, self.tree[node]):
                at, self.tree[node] = self.tree[node], at
            node //= 2
        self.winner = at

    def least(self) -> tuple | None:
        return None if self.winner is None else self.rows[self.winner]

    def second(self) -> tuple | None:
        """The least row but the winner: it has lost to the winner."""
        best, node = None, (self.winner + self.size) // 2
        while node:
            row = self.rows[self.tree[node]]
            if row is not None and (best is None or row < best):
                best = row
            node //= 2
        return best


def merged(blocks, most: int):
    """Arrays of the `most` least rows of blocks (run, array) that come in the order of their first rows, in order."""
    tree, open_, given = Tournament(), {}, 0

    def step(bound: tuple | None):
        """Takes from the winner's block all rows up to the next run's row and `bound`."""
        nonlocal given
        run = names[tree.winner]
        own, at = open_[run]
        limit = min((x for x in (tree.second(), bound) if x is not None), default=None)
        end = len(own) if limit is None else max(at + 1, int(np.searchsorted(own, np.array(limit, ROW), "right")))
        end = min(end, at + most - given)
        given += end - at
        out = own[at:end]
        if end < len(own):
            open_[run] = own, end
            tree.advance(tuple(own[end].tolist()))
        else:
            del open_[run]
            tree.advance(None)
        return out

    names: dict[int, int] = {}
    for run, own in blocks:
        head = tuple(own[0].tolist())
        while given < most and (x := tree.least()) is not None and x <= head:
            yield step(head)
        if given >= most:
            return
        open_[run] = own, 0
        tree.put(run, head)
        names[tree.leaf[run]] = run
    while given < most and tree.least() is not None:
        yield step(None)


def draw(rows: DataFrame, most: int, eligible: int, scratch: Scratch, size: int = RANGE) -> DataFrame:
    """(row, rank) of the `most` first of the rows (doc_id, score, row): highest score first, ties to the smaller doc_id."""
    runs = scratch.save(sorted_runs(rows))
    cut = scratch.save(cut_blocks(runs, range_cuts(runs, eligible, size)))
    scratch.drop(runs)
    before, plan = 0, {}
    for r in cut.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():  # a row a range
        if before < most:
            plan[r["range"]] = before, min(r["n"], most - before)
        before += r["n"]

    def run(batches):
        def parts():
            for b in batches:
                for i in range(b.num_rows):
                    yield b.column("range")[i].as_py(), b.column("run")[i].as_py(), np.frombuffer(b.column("data")[i].as_py(), ROW)

        rest = parts()
        now = next(rest, None)
        while now is not None:
            k = now[0]

            def own():
                nonlocal now
                while now is not None and now[0] == k:
                    yield now[1], now[2]
                    now = next(rest, None)

            first, n = plan[k]
            blocks, held, many = own(), [], 0
            for part in merged(blocks, n):
                held.append(part["row"])
                many += len(part)
                if many >= BLOCK:
                    yield ranked(held, first)
                    first, held, many = first + many, [], 0
            if many:
                yield ranked(held, first)
            for _ in blocks:  # what the draw did not need
                pass

    def ranked(held, first):
        row = np.concatenate(held)
        return pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.arange(first + 1, first + 1 + len(row)))], names=["row", "rank"])

    wanted = cut.where(F.col("range") <= (max(plan) if plan else -1))
    return wanted.repartition("range").sortWithinPartitions("range", "head_order", "head_id", "head_row").mapInArrow(run, "row long, rank long")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), least: int = 20, size: int = 1, seed: str = "2024") -> DataFrame:
    """docs without text, with n_features, weight, score and rank; of N rows of at least `least` words, floor(share * N) have a rank.

    docs: doc_id and text; target: text. What is read again later is a row of
    numbers a document; texts are read twice and never shuffled.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    gain = gains(bucket_counts(docs, size), bucket_counts(target, size))
    scored = score_documents(docs, gain, size, seed)
    p = prefix(scored.columns)
    scored = scratch.save(scored.drop("text").withColumn(f"{p}row", F.monotonically_increasing_id()))
    able = scored.where(F.col("n_words") >= least)
    n = able.count()
    most = share[0] * n // share[1]
    drawn = scratch.save(draw(able.select("doc_id", "score", F.col(f"{p}row").alias("row")), most, n, scratch))
    kept = [F.col(quoted(c)) for c in scored.columns if c not in ("n_words", f"{p}row") and c.lower() != "rank"]
    none = F.lit(None).cast("long").alias("rank")
    last = drawn.where(F.col("rank") == most).first() if most else None
    if last is None:
        return scored.select(*kept, none)
    # only rows up to the last one drawn are shuffled to meet their ranks
    place = F.struct((-F.col("score")).alias("order"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col(f"{p}row").alias("row"))
    edge = scored.where(F.col(f"{p}row") == last["row"]).select(place.alias("x")).first()["x"]
    within = (F.col("n_words") >= least) & (place <= F.struct(*[F.lit(edge[c]).cast("long").alias(c) for c in KEY]))
    ranked = scored.where(within).join(drawn.select(F.col("row").alias(f"{p}row"), F.col("rank").alias(f"{p}rank")), f"{p}row")
    return ranked.select(*kept, F.col(f"{p}rank").alias("rank")).union(scored.where(~within).select(*kept, none))
