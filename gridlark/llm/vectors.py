"""Embedding near-dedup by Euclidean p-stable hashing (operator 11).

Vectors of one label that have a cosine of `least` or more are linked. Rows with
one label and equal components are one node. A node's normalised vector is
projected on random directions, and each projection is cut into cells of WIDTH
(a Gaussian projection is 2-stable: two vectors share a cell with a chance that
depends on their distance alone). The cells of `depth` projections are a bucket;
there are `tables` of them, and all that meet in a bucket are checked exactly.

* depth is the least for which a vector has about MATES unrelated ones beside it
  in a bucket, by the distances of a sample of at most SAMPLE vectors of the most
  frequent label; it grows with the logarithm of the table. tables follows: a pair
  at REACH times the limit's angle meets nowhere with a chance of MISS at most.
* A bucket with more than BLOCK units is dealt into blocks, and every pair of
  blocks is a task's group. A pair is counted in the first bucket that it shares,
  so no pair has to be written to be told apart; blocks return how many links each
  unit has and links that join components, never all pairs.
* Crowds of near copies are counted without being paired: of a bucket with DENSE
  nodes or more, those within a fraction of the limit's angle from their mean
  direction are a ball. All in a ball are linked, by the triangle inequality; a
  ball is then one unit with a radius. Two units are all linked, not linked at
  all, or, where the radii leave that open, their members are compared.

Edge cases: a row whose vector is null, empty, zero or holds null or non-finite
components, or whose label is null, is linked with nothing and is a component of
its own; vectors of different dimension are not compared; rows with equal or
null ids stay rows of their own, and a component is named by its smallest id,
null if it has none; an empty table gives an empty result. Labels other than
whole numbers are told apart by 64 bits of hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.llm._shared import Scratch
from gridlark.llm.components import connect
from gridlark.llm.neighbours import scaled, unit

#: Width of a cell of a projection of unit vectors.
WIDTH = 2.2
#: Unrelated units that a bucket should hold beside one, and the chance that a pair shares no bucket.
MATES, MISS = 48, 0.01
#: Multiple of the limit's angle up to which MISS holds: balls are found by their centres.
REACH = 4 / 3
MOST_DEPTH = 40
#: Projections that a task holds at a time.
PROJECTIONS = 2_000_000
#: Vectors on which the depth is measured.
SAMPLE = 2000
#: Units of a block; nodes from which a bucket is looked through for a ball, in so many tables; a ball's largest radius, as a share of the limit's angle.
BLOCK, DENSE, ROUNDS, RADIUS = 512, 256, 4, 1 / 3
#: Dense buckets that may be broadcast; with more, the join is left to Spark.
BROADCAST_BUCKETS = 20_000
#: Slack of what is decided by angles instead of the exact cosine.
EPS = 1e-6


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of `dim` components from their bytes, as doubles: 4 or 8 bytes a component."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.float32 if len(flat) == 4 * dim * len(column) else np.float64).reshape(-1, dim).astype(np.float64)


def directions(dim: int, tables: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Random directions and offsets of all projections."""
    rng = np.random.default_rng([20240611, dim])
    return rng.normal(size=(tables * depth, dim)).T, rng.uniform(0, WIDTH, tables * depth)


def buckets(u: np.ndarray, made: tuple[np.ndarray, np.ndarray], tables: int) -> np.ndarray:
    """32 bits that name the bucket of each unit vector in each table; PROJECTIONS numbers at a time."""
    step = max(1, PROJECTIONS // made[0].shape[1])
    if len(u) > step:
        return np.concatenate([buckets(u[i : i + step], made, tables) for i in range(0, len(u), step)])
    cells = np.floor((u @ made[0] + made[1]) / WIDTH).astype(np.int64).reshape(len(u), tables, -1)
    h = np.full(cells.shape[:2], 0x9E3779B97F4A7C15, np.uint64)
    for k in range(cells.shape[2]):
        h = (h ^ cells[:, :, k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.uint32)


def meets(d: np.ndarray | float) -> np.ndarray | float:
    """The chance that vectors at Euclidean distance d share a cell of one projection."""
    t = WIDTH / np.maximum(d, 1e-12)
    below = np.vectorize(lambda x: 0.5 * math.erfc(x / math.sqrt(2)))
    return 1 - 2 * below(t) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - np.exp(-t * t / 2))


def fit(sample: np.ndarray, most: int, least: float) -> tuple[int, int]:
    """(depth, tables) for labels of up to `most` nodes: pairs of the sample beyond twice the limit's angle are the unrelated ones."""
    limit, depth = math.acos(least), 1
    if len(sample) > 1:
        u = unit(scaled(sample))
        s = (u @ u.T)[np.triu_indices(len(u), 1)]
        far = s[s < math.cos(min(math.pi, 2 * limit))]
        if len(far):
            # distances in bins: the chance to meet is smooth
            n, edge = np.histogram(np.sqrt(np.maximum(0, 2 - 2 * far)), 200, (0.0, 2.0))
            p = meets((edge[1:] + edge[:-1]) / 2)
            while depth < MOST_DEPTH and most * float((n * p**depth).sum()) / len(s) > MATES:
                depth += 1
    near = float(meets(2 * math.sin(min(math.pi, REACH * limit) / 2)))
    return depth, max(1, math.ceil(math.log(MISS) / math.log(1 - near**depth)))


def describe(vectors: DataFrame, id_column: str, column: str, label: str) -> DataFrame:
    """(row, vec_id, lab, dim, v, fp) of every row; v, the components' bytes, and fp, which names label and vector, are null where nothing can be linked."""
    kind = vectors.schema[column].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    whole = isinstance(vectors.schema[label].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    lab = vectors[label].cast("long") if whole else F.when(vectors[label].isNotNull(), F.xxhash64(vectors[label].cast("string")))
    held = vectors.select(F.monotonically_increasing_id().alias("row"), vectors[id_column].cast("long").alias("vec_id"), lab.alias("lab"), vectors[column].cast("array<float>" if single else "array<double>").alias("x"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, lab = b.column("x"), b.column("lab").to_pylist()
            sizes = np.diff(x.offsets.to_numpy()) if x.null_count == 0 else np.array([0 if v is None else v for v in pc.list_value_length(x).to_pylist()])
            flat = x.flatten()
            bad = flat.is_null().to_numpy(zero_copy_only=False)
            values = flat.fill_null(0).to_numpy(zero_copy_only=False)
            bad |= ~np.isfinite(values)
            ends = np.cumsum(sizes)
            v, fp = [], []
            for i, (n, end) in enumerate(zip(sizes.tolist(), ends.tolist())):
                own = values[end - n : end]
                if lab[i] is None or not n or bad[end - n : end].any() or not own.any():
                    v.append(None)
                    fp.append(None)
                else:
                    v.append(own.tobytes())
                    fp.append(xxhash.xxh3_128_digest(lab[i].to_bytes(8, "big", signed=True) + v[-1]))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), b.column("lab"), pa.array(sizes.astype(np.int32)), pa.array(v, pa.binary()), pa.array(fp, pa.binary())], names=["row", "vec_id", "lab", "dim", "v", "fp"])

    return held.mapInArrow(run, "row long, vec_id long, lab long, dim int, v binary, fp binary")


def with_keys(units: DataFrame, depth: int, tables: int) -> DataFrame:
    """units with keys: 4 bytes a table."""
    schema = T.StructType([*units.schema, T.StructField("keys", T.BinaryType())])

    def run(batches):
        made: dict[int, tuple] = {}
        for b in batches:
            dims, keys = b.column("dim").to_numpy(), np.empty(b.num_rows, object)
            for d in np.unique(dims).tolist():
                if d not in made:
                    made[d] = directions(d, tables, depth)
                own = np.flatnonzero(dims == d)
                found = buckets(unit(scaled(matrix(b.column("v").take(pa.array(own)), d))), made[d], tables)
                keys[own] = [k.astype(">u4").tobytes() for k in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(keys), pa.binary())], names=schema.fieldNames())

    return units.mapInArrow(run, schema)


def key_of(table: int) -> F.Column:
    return F.substring("keys", 4 * table + 1, 4)


def angles(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Angles between the rows of u and v, precise where they are small."""
    return 2 * np.arcsin(np.minimum(1.0, np.sqrt(((u - v) ** 2).sum(axis=1)) / 2))


def balls(free: DataFrame, table: int, radius: float, scratch: Scratch) -> tuple[DataFrame, DataFrame] | None:
    """(node, ball) of the nodes in a ball, and (unit, lab, dim, v, r, w) of the balls of one table's dense buckets; None if no bucket is dense.

    free: (node, lab, dim, v, w, keys). Sums of vectors are made a batch at a time
    before they are shuffled; no bucket is held by one task.
    """
    held = free.withColumn("key", key_of(table))
    dense = held.groupBy("lab", "dim", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= DENSE).select("lab", "dim", "key")
    dense = scratch.save(dense.withColumn("bucket", F.monotonically_increasing_id()))
    if not (n := dense.count()):
        return None
    light = lambda df: F.broadcast(df) if n <= BROADCAST_BUCKETS else df
    rows = scratch.save(held.join(light(dense), ["lab", "dim", "key"]).select("bucket", "node", "lab", "dim", "v", "w"))

    def sums(batches):
        for b in batches:
            bucket, dims = b.column("bucket").to_numpy(), b.column("dim").to_numpy()
            for k in np.unique(bucket).tolist():
                own = np.flatnonzero(bucket == k)
                total = unit(scaled(matrix(b.column("v").take(pa.array(own)), int(dims[own[0]])))).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["bucket", "total"])

    def centre(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in t.column("total").to_pylist())
        length = np.sqrt((total * total).sum())
        ok = length > 0
        return pa.table({"bucket": t.column("bucket").slice(0, int(ok)), "centre": pa.array([(total / length).tobytes()] if ok else [], pa.binary())})

    centres = scratch.save(rows.mapInArrow(sums, "bucket long, total binary").groupBy("bucket").applyInArrow(centre, "bucket long, centre binary"))

    def inside(batches):
        for b in batches:
            bucket, dims, v = b.column("bucket").to_numpy(), b.column("dim").to_numpy(), b.column("v")
            for k in np.unique(bucket).tolist():
                own = np.flatnonzero(bucket == k)
                d, first = int(dims[own[0]]), int(own[0])
                # the centre as the vectors are kept: any point serves, if angles are taken from that one
                c = np.frombuffer(b.column("centre")[first].as_py(), np.float64).astype(np.float32 if len(v[first].as_py()) == 4 * d else np.float64)
                a = angles(unit(scaled(matrix(v.take(pa.array(own)), d))), unit(c.astype(np.float64)[None, :]))
                ok = own[a <= radius]
                picked = b.take(pa.array(ok))
                yield pa.RecordBatch.from_arrays([*(picked.column(x) for x in ("bucket", "node", "lab", "dim", "w")), pa.array(a[a <= radius]), pa.array([c.tobytes()] * len(ok), pa.binary())], names=["bucket", "node", "lab", "dim", "w", "r", "v"])

    near = scratch.save(rows.join(light(centres), "bucket").mapInArrow(inside, "bucket long, node long, lab long, dim int, w long, r double, v binary"))
    found = near.groupBy("bucket").agg(F.min("node").alias("unit"), F.count(F.lit(1)).alias("k"), *[F.first(c).alias(c) for c in ("lab", "dim", "v")], F.max("r").alias("r"), F.sum("w").alias("w"))
    found = scratch.save(found.where(F.col("k") >= DENSE // 4))
    members = scratch.save(near.select("bucket", "node").join(light(found.select("bucket", F.col("unit").alias("ball"))), "bucket").select("node", "ball"))
    scratch.drop(dense, rows, centres, near)
    return members, found.select("unit", "lab", "dim", "v", "r", "w")


def groups(batches, names: list[str]):
    """The rows of each run of equal values of `names` in a sorted stream, as tables; a run may span batches."""
    held: list[pa.RecordBatch] = []

    def same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int) -> bool:
        return all(a.column(n)[i].as_py() == b.column(n)[j].as_py() for n in names)

    for b in batches:
        if not b.num_rows:
            continue
        new = np.zeros(b.num_rows, bool)
        for n in names:
            c = b.column(n)
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        new[0] = bool(held) and not same(held[-1], held[-1].num_rows - 1, b, 0)
        at = np.flatnonzero(new).tolist()
        for i, j in zip([0, *at], [*at, b.num_rows]):
            if i in at and held:
                yield pa.Table.from_batches(held)
                held = []
            if j > i:
                held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


class Found:
    """What is found in a group: links of each unit or node, links that join components, pairs whose members must be compared."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.many: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []
        self.open: list[tuple[int, int]] = []

    def _root(self, x: int) -> int:
        while (p := self.parent.setdefault(x, x)) != x:
            self.parent[x] = x = self.parent[p]
        return x

    def link(self, a: int, b: int, wa: int, wb: int) -> None:
        self.many[a] = self.many.get(a, 0) + wb
        self.many[b] = self.many.get(b, 0) + wa
        x, y = self._root(a), self._root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.edges.append((min(a, b), max(a, b)))

    def batch(self) -> pa.RecordBatch:
        rows = [(0, a, None, n) for a, n in self.many.items()] + [(1, a, b, None) for a, b in self.edges] + [(2, a, b, None) for a, b in self.open]
        cols = list(zip(*rows)) if rows else [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])], names=["kind", "a", "b", "n"])


FOUND = "kind int, a long, b long, n long"


def exact(x: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of rows of x have a cosine of least or more, in double precision."""
    norm = np.sqrt((x * x).sum(axis=1))
    return (x[i] * x[j]).sum(axis=1) / (norm[i] * norm[j]) >= least


def compare(t: pa.Table, least: float, found: Found) -> None:
    """Checks a block pair of one bucket. t: (t, p, q, unit, dim, v, r, w, keys, mine)."""
    table, p, q = (t.column(c)[0].as_py() for c in ("t", "p", "q"))
    mine = t.column("mine").to_numpy()
    left, right = np.flatnonzero(mine == p), np.flatnonzero(mine == q)
    if not len(left) or not len(right) or len(t) < 2:
        return
    name, r, w = (t.column(c).to_numpy() for c in ("unit", "r", "w"))
    x = scaled(matrix(t.column("v"), t.column("dim")[0].as_py()))
    u, limit = unit(x), math.acos(least)
    wide = np.cos(np.minimum(math.pi, limit + r[left][:, None] + r[right][None, :] + EPS))
    i, j = np.nonzero(u[left] @ u[right].T >= wide)
    i, j = left[i], right[j]
    if p == q:
        i, j = i[i < j], j[i < j]
    if table and len(i):
        keys = np.frombuffer(b"".join(t.column("keys").to_pylist()), np.uint32).reshape(len(t), -1)[:, :table]
        first = np.concatenate([~(keys[i[a : a + 50_000]] == keys[j[a : a + 50_000]]).any(axis=1) for a in range(0, len(i), 50_000)])
        i, j = i[first], j[first]
    round_ = (r[i] > 0) | (r[j] > 0)
    angle = angles(u[i], u[j])
    linked = np.where(round_, angle + r[i] + r[j] <= limit - EPS, exact(x, i, j, least))
    unknown = round_ & ~linked & (angle - r[i] - r[j] <= limit + EPS)
    for a, b, wa, wb in zip(name[i[linked]].tolist(), name[j[linked]].tolist(), w[i[linked]].tolist(), w[j[linked]].tolist()):
        found.link(a, b, wa, wb)
    found.open += [(min(a, b), max(a, b)) for a, b in zip(name[i[unknown]].tolist(), name[j[unknown]].tolist())]


def compare_members(t: pa.Table, least: float, found: Found) -> None:
    """Checks blocks of the members of two units. t: (a, b, side, node, dim, v, w)."""
    side = t.column("side").to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return
    name, w = t.column("node").to_numpy(), t.column("w").to_numpy()
    x = scaled(matrix(t.column("v"), t.column("dim")[0].as_py()))
    u = unit(x)
    i, j = np.nonzero(u[left] @ u[right].T >= least - EPS)
    i, j = left[i], right[j]
    ok = exact(x, i, j, least)
    for a, b, wa, wb in zip(name[i[ok]].tolist(), name[j[ok]].tolist(), w[i[ok]].tolist(), w[j[ok]].tolist()):
        found.link(a, b, wa, wb)
    if ok.any():  # units are connected inside
        found.edges = [(t.column("a")[0].as_py(), t.column("b")[0].as_py())]


def each_group(rows: DataFrame, names: list[str], check, least: float) -> DataFrame:
    """FOUND of every group of rows, many small groups to a task."""
    def run(batches):
        for t in groups(batches, names):
            found = Found()
            check(t, least, found)
            if found.many or found.open:
                yield found.batch()

    return rows.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, FOUND)


def dealt(units: DataFrame, tables: int, scratch: Scratch) -> DataFrame:
    """A row for each unit, table and block that the unit's own block meets."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.struct(t.alias("t"), F.substring("keys", t * 4 + 1, F.lit(4)).alias("key")))
    large = units.select("lab", "dim", F.explode(keys).alias("k")).groupBy("lab", "dim", "k.t", "k.key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > BLOCK)
    large = scratch.save(large.select("lab", "dim", "t", "key", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks")))
    rows = units.withColumn("_k", F.explode(keys)).select(*units.columns, F.col("_k.t").alias("t"), F.col("_k.key").alias("key"))
    rows = rows.join(F.broadcast(large) if large.count() <= BROADCAST_BUCKETS else large, ["lab", "dim", "t", "key"], "left")
    rows = rows.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.withColumn("_o", other).withColumn("p", F.least("mine", "_o")).withColumn("q", F.greatest("mine", "_o")).drop("_o", "blocks")


def opened(pairs: DataFrame, members: DataFrame, least: float, scratch: Scratch) -> DataFrame | None:
    """FOUND, by node, of the pairs of units that radii leave open; None if there is none. members: (unit, node, dim, v, w)."""
    pairs = scratch.save(pairs)
    if pairs.isEmpty():
        return None
    size = members.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n"))
    size = lambda x, n, s=size: s.select(F.col("unit").alias(x), F.col("n").alias(n))
    known = pairs.join(size("a", "na"), "a").join(size("b", "nb"), "b")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def side(k: int, x: str, own: str, other: str, n_own: str, n_other: str) -> DataFrame:
        rows = known.join(members.withColumnRenamed("unit", x), x)
        rows = rows.withColumn(own, F.pmod(F.xxhash64("node"), F.col(n_own)).cast("int")).withColumn(other, every(n_other))
        return rows.select("a", "b", "p", "q", F.lit(k).alias("side"), "node", "dim", "v", "w")

    both = side(0, "a", "p", "q", "na", "nb").union(side(1, "b", "q", "p", "nb", "na"))
    return scratch.save(each_group(both, ["a", "b", "p", "q"], compare_members, least))


def near_vectors(vectors: DataFrame, least: float = 0.93, id_column: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: how many other rows it is linked with directly, the smallest id that links reach, and whether that is its own.

    least: above zero. The sample that the depth is measured on goes to the driver, at most 2 * SAMPLE vectors.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    described = scratch.save(describe(vectors, id_column, column, label))
    first = F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id")
    nodes = described.where("fp is not null").groupBy("fp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("w"), *[F.first(c).alias(c) for c in ("lab", "dim", "v")])
    nodes = scratch.save(nodes.withColumn("node", F.monotonically_increasing_id()))
    top = nodes.groupBy("lab", "dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lab", "dim").first()
    sample, dim, most = np.zeros((0, 1)), 1, 0
    if top:
        dim, most = top["dim"], top["n"]
        own = nodes.where((F.col("lab") == top["lab"]) & (F.col("dim") == dim))
        share = int(min(1.0, SAMPLE / most) * (1 << 24))
        sample = matrix(own.where(F.pmod(F.xxhash64("node"), F.lit(1 << 24)) < share).select("v").limit(2 * SAMPLE).toArrow().column("v"), dim)
    depth, tables = fit(sample, most, least)
    hashed = scratch.save(with_keys(nodes.select("node", "lab", "dim", "v", "w"), depth, tables))

    free, members, whole = hashed, [], []
    for t in range(min(ROUNDS, tables)):
        found = balls(free, t, RADIUS * math.acos(least), scratch)
        if found is None:
            break
        members.append(found[0])
        whole.append(found[1])
        free = free.join(found[0], "node", "left_anti")
    units = free.select(F.col("node").alias("unit"), "lab", "dim", "v", F.lit(0.0).alias("r"), "w", "keys")
    of_node = free.select("node", F.col("node").alias("unit"))
    for m, b in zip(members, whole):
        units = units.unionByName(with_keys(b, depth, tables))
        of_node = of_node.union(m.select("node", F.col("ball").alias("unit")))
    units, of_node = scratch.save(units), scratch.save(of_node)

    pairs = scratch.save(each_group(dealt(units, tables, scratch), ["lab", "dim", "t", "key", "p", "q"], compare, least))
    more = opened(pairs.where("kind = 2").select("a", "b"), hashed.select("node", "dim", "v", "w").join(of_node, "node"), least, scratch) if whole else None
    edges, many = pairs.where("kind = 1").select("a", "b"), pairs.where("kind = 0")
    if more is not None:
        edges = edges.union(more.where("kind = 1").select("a", "b"))
    parts = connect(edges, scratch)

    # of every node: the rows of its unit but one, those of linked units, and those of linked nodes of units that are linked in part
    out = nodes.select("node", "fp", "first").join(of_node, "node").join(units.select("unit", F.col("w").alias("own")), "unit")
    out = out.join(many.groupBy(F.col("a").alias("unit")).agg(F.sum("n").alias("beside")), "unit", "left").join(parts.withColumnRenamed("node", "unit"), "unit", "left")
    links = F.col("own") - 1 + F.coalesce("beside", F.lit(0))
    if more is not None:
        out = out.join(more.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("apart")), "node", "left")
        links = links + F.coalesce("apart", F.lit(0))
    out = scratch.save(out.select("fp", "first", links.cast("long").alias("n_links"), F.coalesce("component", "unit").alias("component")))
    scratch.drop(hashed, units, of_node, pairs)
    smallest = out.groupBy("component").agg(F.min("first").alias("least"))
    named = scratch.save(out.join(smallest, "component").select("fp", "n_links", F.col("least.vec_id").alias("c")))
    rows = described.select("vec_id", "fp").join(named, "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("vec_id")).otherwise(F.col("c"))
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
