"""Approximate nearest neighbours by learned partitions (operator 4).

A bounded sample (SAMPLE rows) gets a neighbour graph, which is cut into parts
of nearly equal size with few cut edges. A small classifier learns to name a
vector's part from the vector. Every row of the table is filed under its most
probable part; a query is routed to its several most probable parts, and all
their rows are reranked by exact cosine. How many parts are probed is measured:
held-out sample rows are searched among held-out rows, and the fewest probes
that find TARGET of their neighbours are taken. A table of more rows than
MOST_PARTS parts should hold has a second level: each part gets a router of its
own, fitted on a bounded sample of the part (SUB_SAMPLE rows), rows are filed
under parts of parts, and queries are routed through both levels.

Rows of a part are dealt into blocks of bounded size, and so are its queries: a
part with a third of all rows is many small tasks. Queries with fewer than k
hits in their parts are searched again in all parts.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without an id, take no part, nor do vectors whose
dimension is not the most frequent one (of equals, the largest); rows with one
id are one vector each but never neighbours of each other; ties go to the
smaller id; with k candidates or fewer all are returned; an empty table gives
an empty result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.llm._shared import Scratch

#: Rows of the sample that the graph and the classifier are fitted on, a third of them held out.
SAMPLE = 9000
#: Rows of a part's sample that its own router is fitted on.
SUB_SAMPLE = 3000
#: Rows for which one part is made, and the most parts of a level.
PART_ROWS, MOST_PARTS = 1000, 128
#: Share of held-out neighbours that the probes must find.
TARGET = 0.95
GRAPH_K, HIDDEN, EPOCHS = 10, 96, 30
#: Rows and queries of a block.
BLOCK = 8000


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that its largest component is near one: squares stay finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of each row of unit vectors, by blocks of rows."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 1024):
        s = x[i : i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i : i + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _bisect(x: np.ndarray, rows: np.ndarray, parts: int, label: np.ndarray, first: int, rng: np.random.Generator) -> None:
    """Splits rows in proportion to their parts along the direction between two centres."""
    if parts == 1:
        label[rows] = first
        return
    c = x[rng.choice(rows, 2, replace=False)]
    for _ in range(6):
        side = x[rows] @ (c[0] - c[1]) > 0
        if side.all() or not side.any():
            break
        c = np.stack([x[rows[side]].mean(axis=0), x[rows[~side]].mean(axis=0)])
    order = rows[np.argsort(x[rows] @ (c[0] - c[1]), kind="stable")]
    half = parts // 2
    cut = len(rows) * half // parts
    _bisect(x, order[:cut], half, label, first, rng)
    _bisect(x, order[cut:], parts - half, label, first + half, rng)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 5, slack: float = 1.1) -> np.ndarray:
    """A part for each node: nodes move to where most of their neighbours are while parts stay below their limit."""
    rng = np.random.default_rng(11)
    label = np.zeros(len(x), np.int64)
    _bisect(x, np.arange(len(x)), parts, label, 0, rng)
    most = int(np.ceil(len(x) / parts * slack))
    held = np.bincount(label, minlength=parts)
    back = [[] for _ in range(len(x))]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            back[j].append(i)
    around = [np.array(row + b) for row, b in zip(graph.tolist(), back)]
    for _ in range(sweeps):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(label[around[i]], minlength=parts)
            own, best = label[i], int(votes.argmax())
            if votes[best] > votes[own] and held[best] < most:
                held[own] -= 1
                held[best] += 1
                label[i] = best
                moved += 1
        if not moved:
            break
    return label


class Router:
    """A one-hidden-layer classifier from unit vectors to parts."""

    def __init__(self, dim: int, parts: int, probes: int = 1):
        rng = np.random.default_rng(5)
        self.parts, self.probes = parts, probes
        self.w = [rng.normal(0, (2 / dim) ** 0.5, (dim, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]

    def fit(self, x: np.ndarray, target: np.ndarray) -> None:
        """Cross entropy to soft targets, by Adam."""
        rng = np.random.default_rng(6)
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 256):
                b = order[i : i + 256]
                h = np.maximum(x[b] @ self.w[0] + self.w[1], 0)
                z = h @ self.w[2] + self.w[3]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                d = (p / p.sum(axis=1, keepdims=True) - target[b]) / len(b)
                dh = (d @ self.w[2].T) * (h > 0)
                t += 1
                for k, g in enumerate((x[b].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.w[k] -= 0.004 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def filed(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x).argmax(axis=1)

    def routed(self, x: np.ndarray, probes: int) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :probes]


def fit_router(sample: np.ndarray, parts: int, k: int, target: float = TARGET) -> Router:
    """The router for a sample of vectors; its probes are measured on a third of the sample."""
    x = unit(scaled(sample.astype(np.float64)))
    cut = len(x) * 2 // 3
    train, held = x[:cut], x[cut:]
    parts = min(parts, max(1, cut // 20))
    router = Router(x.shape[1], parts)
    if parts == 1:
        return router
    graph = neighbour_graph(train, GRAPH_K)
    label = balanced_parts(train, graph, parts)
    soft = np.zeros((len(train), parts))
    np.add.at(soft, (np.arange(len(train)), label), 1.0)
    np.add.at(soft, (np.repeat(np.arange(len(train)), graph.shape[1]), label[graph].ravel()), 1.0)
    router.fit(train, soft / soft.sum(axis=1, keepdims=True))
    near = neighbour_graph(held, k)
    order = np.argsort(-router.scores(held), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(len(held), 0), axis=1)
    needed = np.sort(np.take_along_axis(rank, router.filed(held)[near], axis=1).ravel())
    router.probes = int(needed[min(len(needed) - 1, int(np.ceil(len(needed) * target)) - 1)]) + 1
    return router


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, x): the rows that take part, with x as doubles."""
    x = F.col(column).cast("array<double>")
    held = vectors.select(F.col(id_column).cast("long").alias("id"), x.alias("x"))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    return held.where(F.col("id").isNotNull() & F.col("x").isNotNull() & fine)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.float64).reshape(len(column), -1)


def file_rows(rows: DataFrame, router: Router, query: Column) -> DataFrame:
    """(id, v, part, probes) of every row: v is the vector's bytes; probes are the parts of a query, else null."""


    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            raw = scaled(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
            x = unit(raw)
            asked = b.column("q").to_numpy(zero_copy_only=False).astype(bool)
            probes: list = [None] * b.num_rows
            if asked.any():
                for i, p in zip(np.flatnonzero(asked), router.routed(x[asked], router.probes).tolist()):
                    probes[i] = p
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([v.tobytes() for v in raw], pa.binary()), pa.array(router.filed(x).astype(np.int32)), pa.array(probes, pa.list_(pa.int32()))],
                names=["id", "v", "part", "probes"],
            )

    return rows.withColumn("q", F.coalesce(query, F.lit(False))).mapInArrow(run, "id long, v binary, part int, probes array<int>")


def _by_hash(ids: np.ndarray) -> np.ndarray:
    """An order of the ids that depends on nothing else."""
    return np.argsort(ids * np.int64(-7046029254386353131), kind="stable")


def fit_below(filed: DataFrame, sizes: dict[int, int], k: int, target: float, part_rows: int, most_parts: int, sample: int) -> dict[int, Router]:
    """A router for each part, fitted in a task on a sample of the part. At most MOST_PARTS small models go to the driver."""
    shares = F.create_map(*[F.lit(x) for p, n in sizes.items() for x in (p, int(min(1.0, sample / n) * (1 << 24)))])
    picked = filed.where(F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1 << 24)) < shares[F.col("part")]).select("part", "id", "v")

    def fit(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        x = _matrix(table.column("v"))[_by_hash(table.column("id").to_numpy())]
        router = fit_router(x, min(most_parts, max(1, -(-sizes[part] // part_rows))), k, target)
        return pa.table({"part": pa.array([part], pa.int32()), "router": pa.array([pickle.dumps(router)], pa.binary())})

    return {r["part"]: pickle.loads(r["router"]) for r in picked.groupBy("part").applyInArrow(fit, "part int, router binary").collect()}


def file_below(filed: DataFrame, routers: dict[int, Router], most_parts: int) -> DataFrame:
    """filed with parts of parts: part * most_parts + the part's own part; probes likewise. A part without a sample has one."""
    held = filed.sparkSession.sparkContext.broadcast(routers)

    def run(batches):
        below = held.value
        for b in batches:
            if not b.num_rows:
                continue
            x, part = unit(_matrix(b.column("v"))), b.column("part").to_numpy()
            leaf = part.astype(np.int64) * most_parts
            for p in np.unique(part).tolist():
                if p in below:
                    own = part == p
                    leaf[own] += below[p].filed(x[own])
            probes = b.column("probes").to_pylist()
            for i, own in enumerate(probes):
                if own is not None:
                    probes[i] = [p * most_parts + s for p in own for s in (below[p].routed(x[i : i + 1], below[p].probes)[0].tolist() if p in below else [0])]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(leaf.astype(np.int32)), pa.array(probes, pa.list_(pa.int32()))], names=["id", "v", "part", "probes"])

    return filed.mapInArrow(run, "id long, v binary, part int, probes array<int>")


def best_of_block(table: pa.Table, k: int) -> pa.Table:
    """The k nearest rows of a block to each of its queries. Reranked in the same order of operations for every pair."""
    is_query = table.column("is_query").to_numpy()
    ids = table.column("id").to_numpy()
    x = _matrix(table.column("v"))
    norm = np.sqrt((x * x).sum(axis=1))
    qs, rs = np.flatnonzero(is_query), np.flatnonzero(~is_query)
    out_q, out_r, out_s = [], [], []
    u = x[rs] / norm[rs][:, None] if len(rs) else x[rs]
    for i in range(0, len(qs), 256):
        q = qs[i : i + 256]
        if not len(rs):
            break
        s = (x[q] / norm[q][:, None]) @ u.T
        s[ids[q][:, None] == ids[rs][None, :]] = -np.inf
        if len(rs) > k:
            least = -np.partition(-s, k - 1, axis=1)[:, k - 1] - 1e-12
        else:
            least = np.full(len(q), -2.0)
        a, b = np.nonzero((s >= least[:, None]) & (s > -np.inf))
        for lo in range(0, len(a), 50_000):
            aa, bb = q[a[lo : lo + 50_000]], rs[b[lo : lo + 50_000]]
            out_q.append(aa)
            out_r.append(bb)
            out_s.append((x[aa] * x[bb]).sum(axis=1) / (norm[aa] * norm[bb]))
    if not out_q:
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    q, r, s = (np.concatenate(z) for z in (out_q, out_r, out_s))
    order = np.lexsort((ids[r], -s, q))
    q, r, s = q[order], r[order], s[order]
    start = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1]
    place = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    keep = place < k
    return pa.table({"query_id": ids[q[keep]], "vec_id": ids[r[keep]], "score": s[keep]})


def search(filed: DataFrame, queries: DataFrame, parts: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score, rank). queries: (id, v, probes); parts: (part, n, asked), a row a part."""
    parts = parts.select("part", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.col("asked") / BLOCK)).cast("int").alias("askers"))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = filed.select("id", "v", "part").join(F.broadcast(parts), "part").withColumn("block", deal("blocks")).withColumn("asker", every("askers"))
    asks = queries.select("id", "v", F.explode("probes").alias("part")).join(F.broadcast(parts), "part").withColumn("asker", deal("askers")).withColumn("block", every("blocks"))
    names = ["part", "block", "asker", "id", "v"]
    both = rows.select(*names, F.lit(False).alias("is_query")).union(asks.select(*names, F.lit(True).alias("is_query")))
    found = both.groupBy("part", "block", "asker").applyInArrow(lambda t: best_of_block(t, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, query: Column, k: int = 5, id_column: str = "vec_id", column: str = "embedding", sample: int = SAMPLE, part_rows: int = PART_ROWS, most_parts: int = MOST_PARTS, sub_sample: int = SUB_SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row where `query` (a condition on `id`) holds.

    sample bounds the rows that go to the driver, where the first router is fitted.
    """
    scratch = Scratch(vectors.sparkSession, "nearest")
    held = usable(vectors, id_column, column)
    dims = held.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("d").desc()).first()
    n, dim = (dims["n"], dims["d"]) if dims else (0, 1)
    held = held.where(F.size("x") == dim)
    if n:
        share = min(1.0, sample / n)
        picked = held.where(F.pmod(F.xxhash64("id"), F.lit(1 << 24)) < int(share * (1 << 24))).limit(2 * sample).toArrow()
        x = picked.column("x").combine_chunks().flatten().to_numpy().reshape(-1, dim)[_by_hash(picked.column("id").to_numpy())]
    else:
        x = np.zeros((0, dim))
    levels = 2 if n > most_parts * part_rows else 1
    target = TARGET ** (1 / levels)
    router = fit_router(x, min(most_parts, max(1, n // part_rows)), k, target)
    filed, all_parts = scratch.save(file_rows(held, router, query)), router.probes == router.parts
    if levels == 2 and router.parts > 1:
        sizes = {r["part"]: r["n"] for r in filed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a part
        routers = fit_below(filed, sizes, k, target, part_rows, most_parts, sub_sample)
        above, filed = filed, scratch.save(file_below(filed, routers, most_parts))
        scratch.drop(above)
        all_parts = all_parts and all(r.probes == r.parts for r in routers.values())
    queries = filed.where("probes is not null")
    sizes = filed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count("probes").alias("own"))
    asked = queries.select(F.explode("probes").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("asked"))
    parts = scratch.save(sizes.join(asked, "part", "left").na.fill(0, ["asked"]))
    found = scratch.save(search(filed, queries, parts, k))
    short = queries.join(found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("hits")), "id", "left").where(F.coalesce("hits", F.lit(0)) < min(k, n - 1)).select("id", "v")
    if n and not all_parts and not short.isEmpty():
        # all parts in one row; every part's limit on askers must hold for the short queries: all may be of one kind
        every = parts.agg(F.collect_list("part").alias("probes"))
        most = short.count()
        again = search(filed, short.crossJoin(F.broadcast(every)), parts.select("part", "n", F.lit(most).alias("asked")), k)
        found = found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(scratch.save(again))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
