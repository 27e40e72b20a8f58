"""MinHash near-dedup with an LSH forest (operator 3).

Rows with equal shingle sets are one node. A node has a MinHash signature of
TREES * DEPTH values; tree t orders the nodes by its own DEPTH of them. The
sorted orders are dealt out by range. In an order, the nodes that share their
first `min_depth` values are a region: in a small region all pairs are
candidates, in a denser one a node meets the neighbour with the longest common
prefix and the region's first node, so that the depth that counts grows with
the density. A one-bit sketch of the signature sieves candidates; the rest are
confirmed on full shingle sets. Links make components. Of a dense region that is
left with more than one component, the nodes outside its largest component meet
the largest one and each other in blocks, so that density loses no link: full
sets decide, a pair is looked at in the first of its common regions only, and a
block leaves links that join components, not all pairs.

A link at the threshold shares no region with a chance of MISS at most, and is
lost by the sieve with a chance of SIEVE at most. A text of a mixed region is
sent once for each block of the other side, at most TREES * blocks times.

Edge cases: a row without words has an empty set and is linked with nothing;
with fewer words than a shingle its whole sequence is one shingle; every row is
a document of its own, also where doc_ids repeat or are null; a component is
named by its smallest doc_id, null if it has none; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.llm._shared import Scratch, prefix, slices, texts
from gridlark.llm.components import connect
from gridlark.llm.lines import LOWER

TREES, DEPTH = 16, 8
HASHES = TREES * DEPTH
#: Chance that a link just at the threshold is in no region together, and that the sieve loses it.
MISS, SIEVE = 2e-5, 1e-8
#: Nodes of a region up to which all its pairs are candidates.
SMALL = 16
#: Nodes of a block when a dense region is compared across components.
BLOCK = 300
#: Shingles of a block.
BLOCK_SHINGLES = 150_000
#: Rows of a sorted order that a task holds.
TASK_ROWS = 160_000
#: Words that a worker remembers the hashes of.
CACHE_WORDS = 300_000
#: Regions with more than one component that may be broadcast; with more, the join is left to Spark.
BROADCAST_REGIONS = 100_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of `size` words."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - size + 1)
    h = np.full(n, 0x51_7C_C1_B7_27_22_0A_95 if len(w) >= size else len(w), np.uint64)
    for j in range(min(size, len(w))):
        h = (h ^ w[j : j + n]) * np.uint64(0x9E_37_79_B9_7F_4A_7C_15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng(20240607).integers(0, 1 << 32, (2, HASHES), np.uint64).astype(np.uint32)
    return made[0] | np.uint32(1), made[1]


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 2048):
        np.minimum(out, ((h[i : i + 2048, None] ^ b) * a).min(axis=0), out=out)
    return out


def sketch(sig: np.ndarray) -> bytes:
    return np.packbits((sig * np.uint32(0x9E3779B1)) >> np.uint32(31)).tobytes()


def labels(sig: np.ndarray) -> bytes:
    """DEPTH 16-bit values for each tree, big-endian so that bytes sort as values."""
    return ((sig * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(">u2").tobytes()


def min_depth(similarity: float) -> int:
    """The most values that a region can ask for if a link at the threshold may be missed with chance MISS."""
    return max(d for d in range(1, DEPTH + 1) if d == 1 or (1 - similarity**d) ** TREES <= MISS)


def least_bits(similarity: float) -> int:
    """Equal sketch bits that a link has but for a chance of SIEVE: two signatures agree in a bit with chance (1 + similarity) / 2."""
    p, below, k = (1 + similarity) / 2, 0.0, 0
    while (below := below + math.comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)) <= SIEVE:
        k += 1
    return k


MEASURES = T.StructType([T.StructField("row", T.LongType()), T.StructField("n_shingles", T.LongType()), *(T.StructField(x, T.BinaryType()) for x in ("fp", "label", "sketch"))])


def describe(docs: DataFrame, size: int, p: str) -> DataFrame:
    """docs with MEASURES under prefix p: row names a row once this is written, fp its set; fp, label and sketch are null for an empty set."""
    held = docs.withColumn(f"{p}row", F.monotonically_increasing_id())
    made = [f"{p}{f.name}" for f in MEASURES]
    schema = T.StructType([*docs.schema, *(T.StructField(n, f.dataType) for n, f in zip(made, MEASURES))])
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        hashes, (a, b) = WordHashes(), permutations()
        for whole in batches:
            for batch in slices(whole, whole.schema.names[at]):
                n, fp, lab, sk = [], [], [], []
                for t in texts(batch.column(at)):
                    s = shingle_set(t, size, hashes)
                    n.append(len(s))
                    if len(s):
                        sig = signature(s, a, b)
                        fp.append(xxhash.xxh3_128_digest(s.tobytes()))
                        lab.append(labels(sig))
                        sk.append(sketch(sig))
                    else:
                        for x in (fp, lab, sk):
                            x.append(None)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), *(pa.array(x, pa.binary()) for x in (fp, lab, sk))], names=schema.fieldNames())

    return held.mapInArrow(run, schema)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int16)


def _alike(nodes, n, sk, i, j, num, den, bits):
    """Which of the pairs (i, j) of rows may be links, by set sizes and sketches."""
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    ok = (nodes[i] != nodes[j]) & (small * den >= large * num)
    i, j = i[ok], j[ok]
    same = HASHES - _popcount(sk[i] ^ sk[j])
    ok = same >= bits
    i, j = i[ok], j[ok]
    return np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j]), same[ok]


def _arrays(batches):
    """The rows of a task as arrays, in their order."""
    t = pa.Table.from_batches(batches)
    width = lambda name, kind, k: np.frombuffer(b"".join(t.column(name).to_pylist()), kind).reshape(-1, k)
    return t.column("node").to_numpy(), t.column("n_shingles").to_numpy(), width("sketch", np.uint64, HASHES // 64), width("key", np.uint8, 1 + 2 * DEPTH)


def _regions(key, depth):
    """Of each row of a piece of a sorted order: the first row, the number and the size of its region."""
    head = key[:, : 1 + 2 * depth]
    new = np.r_[True, (head[1:] != head[:-1]).any(axis=1)]
    first = np.flatnonzero(new)
    region = np.cumsum(new) - 1
    return first, region, np.diff(np.r_[first, len(key)])[region]


def _pairs_of(key, depth, everything):
    """Candidate row pairs of a piece of a sorted order."""
    first, region, size = _regions(key, depth)
    at = np.arange(len(key))
    dense = (size > SMALL) & (at > first[region]) & (not everything)
    left, right = [first[region[dense]], at[dense] - 1], [at[dense], at[dense]]
    for off in range(1, len(key) if everything else SMALL):
        i = np.flatnonzero((region[off:] == region[:-off]) & (everything | (size[off:] <= SMALL)))
        if everything and not len(i):
            break
        left.append(i)
        right.append(i + off)
    return np.concatenate(left), np.concatenate(right)


PAIRS = "a long, b long, bits int, edge int, node long, n_shingles long, sketch binary, key binary"


def candidates(forest: DataFrame, rows: int, depth: int, num: int, den: int, bits: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(a, b, bits) from the sorted orders, and the rows of dense regions.

    forest: (node, n_shingles, sketch, key), key = tree and label. A region that
    a task's border cuts counts as dense here; its size is known later.
    """
    parts = max(1, rows // TASK_ROWS)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        me = TaskContext.get().partitionId()
        nodes, n, sk, key = _arrays(held)
        a, b, same = _alike(nodes, n, sk, *_pairs_of(key, depth, False), num, den, bits)
        none = lambda k, kind: pa.nulls(k, kind)

        def rows_of(part, edge):
            k = len(part)
            return pa.RecordBatch.from_arrays([none(k, pa.int64()), none(k, pa.int64()), none(k, pa.int32()), pa.array([edge] * k, pa.int32()), pa.array(nodes[part]), pa.array(n[part]), pa.array([sk[i].tobytes() for i in part], pa.binary()), pa.array([key[i].tobytes() for i in part], pa.binary())], names=PAIR_NAMES)

        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(same, pa.int32()), *(none(len(a), k) for k in (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=PAIR_NAMES)
        # the first and last rows of the task, for the regions that its borders cut
        for edge, part in ((me - 1, np.arange(min(SMALL, len(nodes)))), (me, np.arange(max(0, len(nodes) - SMALL), len(nodes)))):
            yield rows_of(part, edge)
        _, region, size = _regions(key, depth)
        dense = np.flatnonzero((size > SMALL) | (region == 0) | (region == region[-1]))
        for i in range(0, len(dense), 10_000):
            yield rows_of(dense[i : i + 10_000], None)

    found = scratch.save(forest.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node").mapInArrow(run, PAIRS))

    def border(table):
        t = table.sort_by([("key", "ascending"), ("node", "ascending")])
        nodes, n, sk, key = _arrays(t.to_batches())
        a, b, same = _alike(nodes, n, sk, *_pairs_of(key, depth, True), num, den, bits)
        return pa.table({"a": a, "b": b, "bits": pa.array(same, pa.int32())})

    edges = found.where("edge is not null").select("edge", "node", "n_shingles", "sketch", "key")
    across = edges.groupBy("edge").applyInArrow(border, "a long, b long, bits int")
    dense = found.where("a is null and edge is null").select("node", "n_shingles", "sketch", F.substring("key", 1, 1 + 2 * depth).alias("region"))
    return found.where("a is not null").select("a", "b", "bits").union(across), dense


PAIR_NAMES = ["a", "b", "bits", "edge", "node", "n_shingles", "sketch", "key"]


def verify(pairs: DataFrame, held: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough. held: (node, packed text)."""
    both = pairs.join(held.select(F.col("node").alias("a"), F.col("packed").alias("x")), "a").join(held.select(F.col("node").alias("b"), F.col("packed").alias("y")), "b")

    def run(batches):
        hashes, open_ = WordHashes(), zstandard.ZstdDecompressor()
        sets = lambda z: shingle_set(open_.decompress(z).decode(), size, hashes)
        for whole in batches:
            for batch in slices(whole, "x"):
                keep, last = [], (None, None)
                for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                    if last[0] != a:
                        last = a, sets(x)
                    p, q = last[1], sets(y)
                    both = np.intersect1d(p, q, assume_unique=True).size
                    keep.append(den * both >= num * (p.size + q.size - both))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def packed_texts(rows: DataFrame) -> DataFrame:
    """(row, packed): texts compressed before they are shuffled. rows: (row, text)."""
    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for b in slices(whole):
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([press.compress(t.encode()) for t in texts(b.column("text"))], pa.binary())], names=["row", "packed"])

    return rows.mapInArrow(run, "row long, packed binary")


def _common(codes: np.ndarray, starts: np.ndarray, mask: np.ndarray, i: int, j: np.ndarray) -> np.ndarray:
    """How many elements row i's set shares with each of the sets of rows j. mask: a scratch byte for each element."""
    own = codes[starts[i] : starts[i + 1]]
    mask[own] = 1
    sizes = starts[j + 1] - starts[j]
    at = np.repeat(starts[j] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    shared = np.add.reduceat(mask[codes[at]], np.r_[0, np.cumsum(sizes)[:-1]], dtype=np.int64)
    mask[own] = 0
    return shared


def _mixed(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(region, main, mb, rb) of the dense regions with more than one component: the largest one, its blocks and those of the rest."""
    per = rows.groupBy("region", "component").agg(F.count(F.lit(1)).alias("k"), F.sum("n_shingles").alias("s"))
    top = F.max(F.struct("k", "s", "component")).alias("top")
    found = per.groupBy("region").agg(F.sum("k").alias("k"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("components"), top)
    blocks = lambda k, s: F.greatest(F.lit(1), F.ceil(k / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    found = found.where((F.col("k") > SMALL) & (F.col("components") > 1))
    return scratch.save(found.select("region", F.col("top.component").alias("main"), blocks(F.col("top.k"), F.col("top.s")).alias("mb"), blocks(F.col("k") - F.col("top.k"), F.col("s") - F.col("top.s")).alias("rb")))


def _dealt(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of mixed regions with main, mine and tasks: the largest component's blocks meet the rest's, and those meet each other."""
    held = rows.join(mixed, "region").withColumn("main", F.col("component") == F.col("main"))
    held = held.withColumn("mine", F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("mb")).otherwise(F.col("rb"))).cast("int"))
    every = lambda n, task: F.transform(F.sequence(F.lit(0), F.col(n) - 1), task)
    task = lambda kind, p, q: F.struct(F.lit(kind).alias("kind"), p.alias("p"), q.alias("q"))
    mine = F.col("mine")
    of_main = every("rb", lambda j: task(0, mine, j))
    of_rest = F.concat(every("mb", lambda i: task(0, i, mine)), every("rb", lambda j: task(1, F.least(mine, j), F.greatest(mine, j))))
    return held.withColumn("tasks", F.when(F.col("main"), of_main).otherwise(of_rest)).drop("mb", "rb")


def _across(parts: DataFrame, dense: DataFrame, held: DataFrame, size: int, depth: int, num: int, den: int, bits: int, scratch: Scratch) -> DataFrame | None:
    """Links (a, b) that join components of a dense region; None if no region has more than one.

    Sketches sieve the pairs of different components and full sets decide; pairs
    that are no links leave no row.
    dense: (node, n_shingles, sketch, region); held: (node, label, packed).
    """
    rows = scratch.save(dense.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")))
    mixed = _mixed(rows, scratch)
    if not (n := mixed.count()):
        return None
    members = _dealt(rows, F.broadcast(mixed) if n <= BROADCAST_REGIONS else mixed).join(held, "node")
    members = members.withColumn("task", F.explode("tasks")).select("region", "task.kind", "task.p", "task.q", "main", "mine", "node", "n_shingles", "sketch", "component", "label", "packed")

    def compare(table):
        hashes, open_ = WordHashes(), zstandard.ZstdDecompressor()
        node, n, comp, mine, main = (table.column(c).to_numpy() for c in ("node", "n_shingles", "component", "mine", "main"))
        tree = table.column("region")[0].as_py()[0]
        sk = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(-1, HASHES // 64)
        before = np.frombuffer(b"".join(table.column("label").to_pylist()), ">u2").reshape(-1, TREES, DEPTH)[:, :tree, :depth]
        kind, p, q = (table.column(c)[0].as_py() for c in ("kind", "p", "q"))
        left, right = np.flatnonzero(main if kind == 0 else mine == p), np.flatnonzero(~main if kind == 0 else mine == q)
        if len(right) < len(left):
            left, right = right, left
        if not len(left):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        sets = [shingle_set(open_.decompress(z).decode(), size, hashes) for z in table.column("packed").to_pylist()]
        starts = np.r_[0, np.cumsum([len(x) for x in sets])]
        values, codes = np.unique(np.concatenate(sets), return_inverse=True)
        del sets
        mask = np.zeros(len(values), np.uint8)
        comp, found = comp.copy(), []
        for i in left:
            j = right[(comp[right] != comp[i]) & (node[right] > node[i] if kind and p == q else True)]
            j = j[(np.minimum(n[i], n[j]) * den >= np.maximum(n[i], n[j]) * num)]
            j = j[HASHES - _popcount(sk[i] ^ sk[j]) >= bits]
            if tree and len(j):  # pairs with an earlier region in common are looked at there
                j = j[~(before[i] == before[j]).all(axis=2).any(axis=1)]
            if not len(j):
                continue
            shared = _common(codes, starts, mask, i, j)
            for k in j[den * shared >= num * (n[i] + n[j] - shared)]:
                if comp[k] != comp[i]:
                    found.append((min(node[i], node[k]), max(node[i], node[k])))
                    comp[comp == comp[k]] = comp[i]
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return scratch.save(members.groupBy("region", "kind", "p", "q").applyInArrow(compare, "a long, b long"))


def _grouped(docs: DataFrame, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame, str]:
    """docs with measures, written; (fp, first) of every set, first being (no_id, doc_id, row) of its component's first row; the prefix of the measures."""
    scratch, p = Scratch(docs.sparkSession, "near"), prefix(docs.columns)
    depth, bits = min_depth(num / den), least_bits(num / den)
    described = scratch.save(describe(docs, size, p))
    m = lambda *names: [F.col(f"{p}{x}").alias(x) for x in names]
    doc_id = F.col("doc_id").cast("long")
    rows = described.where(f"{p}fp is not null").select(*m("row", "n_shingles", "fp", "label", "sketch"), F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"), F.col(f"{p}row").alias("row")).alias("first"))
    # nodes: one a set; a group of copies is summed before the shuffle
    nodes = rows.groupBy("fp").agg(F.min("first").alias("first"), *[F.first(x).alias(x) for x in ("n_shingles", "label", "sketch")])
    nodes = scratch.save(nodes.withColumn("node", F.monotonically_increasing_id()))
    forest = nodes.select("node", "n_shingles", "sketch", F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.concat(F.unhex(F.lpad(F.hex(t), 2, "0")), F.substring("label", t * 2 * DEPTH + 1, F.lit(2 * DEPTH))))).alias("key"))
    pairs, dense = candidates(forest, nodes.count() * TREES, depth, num, den, bits, scratch)
    pairs = scratch.save(pairs.groupBy("a", "b").agg(F.max("bits").alias("bits")))

    # the texts of the nodes that any pair names or that a dense region holds, once: that of the first row of a set.
    # A merge join at every size: no bound is known for the number of nodes
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(dense.select("node")).distinct()
    wanted = nodes.select("node", "label", F.col("first.row").alias("row")).join(named, "node")
    own = packed_texts(described.where(f"{p}fp is not null").select(*m("row"), "text"))
    held = scratch.save(own.join(wanted.hint("merge"), "row").select("node", "label", "packed"))

    # each node's most alike candidate first: it leaves few pairs between components
    best = scratch.save(pairs.groupBy("b").agg(F.max_by("a", F.struct("bits", -F.col("a"))).alias("a")).select("a", "b"))
    links = scratch.save(verify(best, held, size, num, den))
    parts = scratch.save(connect(links, scratch))

    def between(more: DataFrame) -> DataFrame:
        side = lambda x: parts.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
        j = more.join(side("a"), "a", "left").join(side("b"), "b", "left")
        return j.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    rest = between(pairs).join(best, ["a", "b"], "left_anti")
    first, links = links, scratch.save(links.union(verify(rest, held, size, num, den)))
    scratch.drop(first, parts, best, pairs)
    parts = scratch.save(connect(links, scratch))
    more = _across(parts, dense, held, size, depth, num, den, bits, scratch)
    if more is not None and not more.isEmpty():
        scratch.drop(parts)
        parts = scratch.save(connect(links.union(more), scratch))
    scratch.drop(held, links)
    joined = nodes.select("fp", "node", "first").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = joined.groupBy("component").agg(F.min("first").alias("least"))
    named = scratch.save(joined.select("fp", "component").join(least, "component").select("fp", F.col("least").alias("first")))
    return described, named, p


def near_dedup(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: links are den * intersection >= num * union; kept is doc_id = component_id."""
    described, named, p = _grouped(docs.select("doc_id", "text"), size, num, den)
    rows = described.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"{p}n_shingles").alias("n_shingles"), F.col(f"{p}fp").alias("fp"))
    out = rows.join(named.select("fp", F.col("first.doc_id").alias("c")), "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("c"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one row of each component, the one with the smallest doc_id (of equals, any one); rows without words stay."""
    described, named, p = _grouped(docs, size, num, den)
    gone = described.where(f"{p}fp is not null").select(F.col(f"{p}row").alias("row"), F.col(f"{p}fp").alias("fp")).join(named, "fp").where(F.col("row") != F.col("first.row"))
    return described.join(gone.select(F.col("row").alias(f"{p}row")), f"{p}row", "left_anti").select(*docs.columns)
