"""Resampling, filter audit and vector dedup against plain brute force, on small fixtures with edge cases, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridlark.llm import audit, queries, resample, vectors
from gridlark.llm._shared import Scratch

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def documents():
    rng = random.Random(3)
    word = lambda: rng.choice(["alpha", "Beta", "gamma", "delta-epsilon", "é", "x1", "the", "of", "#tag"])
    rows = [(i, " ".join(word() for _ in range(rng.randrange(0, 300))), f"s{i % 3}") for i in range(80)]
    rows += [(100, None, None), (101, "", ""), (102, "A B C" * 500, "s0"), (103, rows[5][1], "s1"), (3, rows[3][1], "s2"), (104, rows[5][1], None), (None, rows[5][1], "s0"), (None, rows[6][1], "s0"), (105, "word " * 60_000, "s1")]
    return rows


@pytest.fixture(scope="module", params=["edge", "sf", "empty"])
def data(request, tmp_path_factory):
    """(folder, documents, benchmark texts, labels)"""
    if request.param == "sf":
        read = lambda t, *c: list(zip(*(pq.read_table(f"{SF}/{t}.parquet").to_pydict()[x] for x in c)))
        return SF, read("documents", "doc_id", "text", "source"), [x[0] for x in read("benchmark", "text")], read("labels", "doc_id", "quality", "toxic")
    rows = documents() if request.param == "edge" else []
    out = tmp_path_factory.mktemp(request.param)
    clash = {c: pa.array([7] * len(rows), pa.int64()) for c in ("score", "rank", "weight", "row", "_row", "mask", "part", "n")}
    cols = list(zip(*rows)) if rows else [(), (), ()]
    pq.write_table(pa.table({"doc_id": pa.array(cols[0], pa.int64()), "text": pa.array(cols[1], pa.string()), "source": pa.array(cols[2], pa.string())} | clash), out / "documents.parquet")
    target = ["Alpha alpha beta", None, "", "quite other words here"] if rows else []
    pq.write_table(pa.table({"item_id": pa.array(range(len(target)), pa.int64()), "text": pa.array(target, pa.string())}), out / "benchmark.parquet")
    labels = [(i, i % 2, None if i % 5 == 0 else (i % 3) // 2) for i in range(0, 100, 2)] + [(4, 1, 1), (None, 1, 1)] if rows else []
    lcols = list(zip(*labels)) if labels else [(), (), ()]
    pq.write_table(pa.table({c: pa.array(v, k) for c, v, k in zip(("doc_id", "quality", "toxic"), lcols, (pa.int64(), pa.int32(), pa.int32()))}), out / "labels.parquet")
    return str(out), rows, target, labels


def test_op12(spark, data):
    folder, rows, target, _ = data
    bucket = lambda w: zlib.crc32(w.encode()) % 10000
    words = [WORDS.findall((t or "").translate(LOWER)) for _, t, _ in rows]
    s, t = Counter(bucket(w) for x in words for w in x), Counter(bucket(w) for x in target for w in WORDS.findall((x or "").translate(LOWER)))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
    want = []
    for (i, _, _), x in zip(rows, words):
        weight = sum(gain(bucket(w)) for w in x)
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        want.append((i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in want if x[1] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    most = 10 * len(able) // 100
    got = [tuple(r) for r in queries.QUERIES["op12_resampling"](spark, folder).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert Counter(x[:4] for x in got) == Counter(want)
    drawn = sorted((x for x in got if x[4] is not None), key=lambda x: x[4])
    assert [x[4] for x in drawn] == list(range(1, most + 1)) and [x[:4] for x in drawn] == able[:most]


def brute_audit(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    least: dict[str, int] = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = defaultdict(list)
    for i, t, source in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        parts[source or ""].append((fails, i in good and i is not None, i in toxic and i is not None))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(gone)
                redundant = sum(d[0][f] and any(d[0][g] for g in order[:k]) for d in docs)
                unique = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                out[part, "".join(order), k + 1] = [len(left), len(gone), redundant, unique, sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_op13(spark, data):
    folder, rows, _, labels = data
    got = queries.QUERIES["op13_filter_audit"](spark, folder).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got} == brute_audit(rows, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in rows})


def test_audit_uses_no_python_worker(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    plan = audit.audit(read("documents"), read("labels"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("size, run, block", [(1, 50, 1000), (40, 7, 3), (1 << 20, 1000, 16), (40, 50, 16)])
def test_draws_are_exact_for_any_cut(spark, monkeypatch, tmp_path, size, run, block):
    """Many runs of several blocks, hot ties, cuts inside blocks: ranks are those of one sort."""
    monkeypatch.setattr(resample, "RUN", run)
    monkeypatch.setattr(resample, "BLOCK", block)
    rng = random.Random(run * block)
    rows = [(None if i % 50 == 0 else rng.randrange(200), 0 if i % 3 else rng.randrange(-50, 50), i) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, score long, row long").repartition(5)
    order = sorted(rows, key=lambda x: (-x[1], x[0] is None, x[0] or 0, x[2]))
    for most in (0, 123, 600):
        got = {r["row"]: r["rank"] for r in resample.draw(df, most, len(rows), Scratch(spark, "test"), size).collect()}
        assert got == {x[2]: k + 1 for k, x in enumerate(order[:most])}


def test_tournament_against_sort():
    rng = random.Random(9)
    for _ in range(60):
        runs = {k: np.sort(np.array([(rng.randrange(30), rng.randrange(4), k << 10 | j) for j in range(rng.randrange(1, 60))], resample.ROW), order=resample.KEY) for k in range(rng.randrange(1, 20))}
        step = rng.randrange(1, 9)
        blocks = sorted(((k, r[i : i + step]) for k, r in runs.items() for i in range(0, len(r), step)), key=lambda x: tuple(x[1][0].tolist()))
        whole = np.sort(np.concatenate(list(runs.values())), order=resample.KEY)
        most = rng.randrange(0, len(whole) + 1)
        got = list(resample.merged(iter(blocks), most))
        assert (np.concatenate(got) if got else whole[:0]).tolist() == whole[:most].tolist()


def test_longer_features_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c a b", "v1", 5), (2, "a b", "v2", 6)], "doc_id long, text string, other string, `RANK` int")
    out = resample.resample(docs, docs.limit(0).select("text"), (1, 2), 1, 2)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == ["doc_id", "other", "n_features", "weight", "score", "rank"]
    assert (got[1].n_features, got[2].n_features, got[1].other) == (9, 3, "v1") and sum(r["rank"] is not None for r in got.values()) == 1


# --- vectors

def brute_links(rows, least=0.93):
    """(n_links, component_id) of each row by its place."""
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        if v is not None and label is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and any(v):
            ok[k] = np.array(v, float)
    links = defaultdict(set)
    for a, x in ok.items():
        for b, y in ok.items():
            if a < b and rows[a][2] == rows[b][2] and len(x) == len(y) and float(x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, work = {k}, [k]
        while work:
            for b in links[work.pop()] - seen:
                seen.add(b)
                work.append(b)
        out.append((i, len(links[k]), min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)))
    return out


def near(rng, base, spread, n):
    return (base + rng.normal(0, spread, (n, len(base)))).astype(np.float32)


def vector_rows(rng, dim=24):
    rows, unit = [], lambda v: v / np.linalg.norm(v)
    for k in range(3):
        rows += [(len(rows) + j, v.tolist(), k) for j, v in enumerate(rng.normal(size=(60, dim)).astype(np.float32))]
        for spread, n in ((0.03, 40), (0.05, 30)):
            at = len(rows)
            rows += [(at + j, v.tolist(), k) for j, v in enumerate(near(rng, unit(rng.normal(size=dim)), spread, n))]
    copy = rows[5][1]
    rows += [(1000 + j, copy, 0) for j in range(25)] + [(1100, copy, 1), (1101, copy, None), (1102, [x * 3 for x in copy], 0)]
    rows += [(1200, None, 0), (1201, [], 0), (1202, [0.0] * dim, 0), (1203, [1.0] * (dim - 1) + [None], 0), (1204, [float("nan")] * dim, 0), (1205, [float("inf")] + [0.0] * (dim - 1), 0), (1206, [1.0, 2.0], 0), (1207, [2.0, 4.0], 0), (None, copy, 0), (None, None, 0), (7, rows[7][1], 0)]
    return rows


@pytest.mark.parametrize("dense, block", [(256, 512), (8, 10), (256, 10)])
def test_vectors_against_all_pairs(spark, monkeypatch, dense, block):
    """With small limits every way is taken: balls, members of units that are linked in part, blocks of a bucket."""
    monkeypatch.setattr(vectors, "DENSE", dense)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = vector_rows(np.random.default_rng(5))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = sorted((tuple(r)[:3] for r in vectors.near_vectors(df).collect()), key=repr)
    assert got == sorted(brute_links(rows), key=repr)


def test_balls_and_their_members(spark, monkeypatch):
    """A chain of wide groups around the limit: links between balls hold for some of their members only."""
    monkeypatch.setattr(vectors, "DENSE", 8)
    opened = []
    real = vectors.opened
    monkeypatch.setattr(vectors, "opened", lambda *a: opened.append(real(*a)) or opened[-1])
    rng, rows = np.random.default_rng(8), []
    a, b = np.eye(24)[0], np.eye(24)[1]
    for step in range(8):
        t = step * 0.35
        rows += [(len(rows) + j, v.tolist(), 1) for j, v in enumerate(near(rng, math.cos(t) * a + math.sin(t) * b, 0.012, 40))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted(tuple(r)[:3] for r in vectors.near_vectors(df.withColumn("label", F.lit("x"))).collect())
    assert got == sorted(brute_links(rows)) and opened[0] is not None


def test_contract_query_on_whole_table_and_empty(spark, tmp_path):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    rows = list(zip(t["vec_id"], t["embedding"], t["label"]))
    got = sorted(tuple(r) for r in queries.QUERIES["op11_vector_dedup"](spark, SF).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == sorted((i, n, c, i == c) for i, n, c in brute_links(rows))
    pq.write_table(pa.table({"vec_id": pa.array([], pa.int64()), "embedding": pa.array([], pa.list_(pa.float32())), "label": pa.array([], pa.int32())}), tmp_path / "embeddings.parquet")
    assert queries.QUERIES["op11_vector_dedup"](spark, str(tmp_path)).count() == 0


def test_tables_grow_slowly_and_pairs_at_the_limit_meet():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(1500, 64))
    small, large = vectors.fit(sample, 1000, 0.93), vectors.fit(sample, 10**9, 0.93)
    assert small[0] < large[0] <= vectors.MOST_DEPTH and large[1] < 2000
    depth, tables = vectors.fit(sample, 10_000, 0.93)
    x = vectors.unit(sample[:800])
    y = rng.normal(size=x.shape)
    y = vectors.unit(y - (y * x).sum(axis=1, keepdims=True) * x)
    limit = math.acos(0.93)
    made = vectors.directions(64, tables, depth)
    meet = (vectors.buckets(x, made, tables) == vectors.buckets(math.cos(limit) * x + math.sin(limit) * y, made, tables)).any(axis=1)
    assert meet.mean() >= 0.98
