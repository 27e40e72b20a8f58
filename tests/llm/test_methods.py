"""The operators' own interfaces and methods."""

from __future__ import annotations

import base64
import gzip

import duckdb
import numpy as np
import pytest

from gridlark.llm import lines, mixing, near_dedup, neighbours, queries, secrets, suffixes, toxicity
from gridlark.llm._shared import Scratch

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b)
    for c in columns:
        assert (a[c].isna() == b[c].isna()).all(), c
        x, y = a[c].dropna(), b[c].dropna()
        assert np.allclose(x, y.astype(float)) if x.dtype.kind == "f" else (x == y).all(), c


def test_line_runs_are_compacted_and_exact(spark):
    runs = lines.LineRuns(spark, min_docs=3, fanout=2, scratch=Scratch(spark, "t"))
    for batch in (["a", "b"], ["a"], ["a", "c", "b"], ["c"], ["c", "d"]):
        runs.add(spark.createDataFrame([(bytearray(x.encode()),) for x in batch], "key binary"))
    assert sum(map(len, runs.levels)) <= 3
    assert {bytes(r.key) for r in runs.common().collect()} == {b"a", b"c"}


def test_many_common_lines_are_joined_instead_of_broadcast(spark):
    docs = spark.createDataFrame([(i, f"x\nown {i}\ny") for i in range(12)] + [(None, None), (5, "x")], "doc_id long, text string")
    a, b = (sorted((r.doc_id or -1, r.text, r.n_dropped) for r in lines.dedup_lines(docs, 10, 2, most).collect()) for most in (100, 0))
    assert a == b and (5, "", 1) in a and (-1, "", 0) in a


def test_secrets_in_nested_layers():
    inner = "password = hunter2hunter2"
    wrapped = base64.b64encode(gzip.compress(base64.b64encode(inner.encode()))).decode()
    base, spans, layers = secrets.find("say " + inner)
    assert base == spans == [(4, 0, 4 + len(inner))] and layers == 0
    base, spans, layers = secrets.find("say " + wrapped + " end")
    assert not base and layers == 2
    assert spans and all(a >= 4 and b <= 4 + len(wrapped) for a, _, b in spans)
    assert secrets.find("%70assword%3Dhunter2hunter2")[1]


def test_near_dedup_links_across_a_dense_region(spark):
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 9))):
            w[k] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    sets = {i: frozenset(zip(*(t.split()[k:] for k in range(3)))) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100).collect()}
    assert got == {i: find(i) for i in sets}


def test_near_dedup_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, "only here in this row"), (3, "a b c d e f")], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in near_dedup.near_dedup(docs).collect())
    assert got == [("3", "3"), ("3", "3"), ("None", "3"), ("None", "None")]


@pytest.mark.parametrize("most_parts", [128, 3])
def test_router_recall_and_hot_vectors(spark, most_parts):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = np.concatenate([centres[rng.integers(0, 20, 4000)] + 0.6 * rng.normal(size=(4000, 16)), np.repeat(centres[:1], 2000, 0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    got = neighbours.nearest(df, F.col("id") % 100 == 0, k=5, sample=3000, part_rows=400, most_parts=most_parts).collect()
    assert len(got) == 300
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, 6000, 100):
        s = np.round(u @ u[q], 12)
        s[q] = -2
        best = np.lexsort((np.arange(len(s)), -s))[:5]
        hits += len(set(best.tolist()) & {r.vec_id for r in got if r.query_id == q})
        total += 5
    assert hits >= 0.9 * total


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_automaton_is_levenshtein_distance():
    terms = ["idiot", "moron", "disgusting", "ugly", "veq*", "chlla*"]
    automaton = toxicity.TermAutomaton(terms)
    rng = np.random.default_rng(4)
    words = {"idiot", "idoit", "idit", "idiots", "disgustng", "discustnig", "vequaire", "chlloando", "moroon", "x", "uglyy"}
    for t in terms:
        for _ in range(60):
            w = list(t.rstrip("*"))
            for _ in range(int(rng.integers(0, 3))):
                k = int(rng.integers(0, len(w) + 1))
                w[k : k + int(rng.integers(0, 2))] = list("abiou"[int(rng.integers(0, 5))]) if rng.random() < 0.7 else []
            words.add("".join(w))
    for w in words:
        want = {}
        for k, t in enumerate(terms):
            text = t.rstrip("*")
            d = min(levenshtein(text, w[:i]) for i in range(len(w) + 1)) if t.endswith("*") else levenshtein(text, w)
            if d <= toxicity.edits_of(text):
                want[k] = d
        assert dict(automaton.match(w)) == want, w


def test_contexts():
    a = toxicity.TermAutomaton(["idiot"])
    assert toxicity.find_matches("you are an 1d1ot", a) == [(0, 0, toxicity.ADDRESSED)]
    assert toxicity.find_matches('the word "idiot" is old', a)[0][2] == toxicity.QUOTED
    assert toxicity.find_matches("such an idiott there", a) == [(0, 1, toxicity.PLAIN)]
    m = toxicity.Model(["idiot"])
    assert m.score([(0, 0, toxicity.QUOTED)]) < m.score([(0, 0, toxicity.PLAIN)]) and m.score([]) < 0.1


def test_toxicity_on_held_out_rows(spark):
    rows = queries.QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1").toPandas().set_index("doc_id")
    labels = duckdb.sql("SELECT doc_id, toxic FROM read_parquet('/root/testdata/sf0.1/labels.parquet')").df().set_index("doc_id")
    held = rows.join(labels, how="inner").query("held_out")
    assert (held.predicted == held.toxic).mean() > 0.95
    assert held[held.toxic == 1].predicted.mean() > 0.75


def test_merge_of_front_coded_runs():
    rng = np.random.default_rng(5)
    runs = [sorted({bytes(rng.integers(97, 100, int(rng.integers(1, 12))).astype(np.uint8)) for _ in range(40)}) for _ in range(5)]
    got = list(suffixes.merge_runs([suffixes.decode(*suffixes.front_code(r)) for r in runs]))
    assert [(s, r) for _, s, r in got] == sorted((s, r) for r, run in enumerate(runs) for s in run)
    for (_, a, _), (n, b, _) in zip(got, got[1:]):
        common = 0
        while common < min(len(a), len(b)) and a[common] == b[common]:
            common += 1
        assert n == common


def test_emitted_mix_matches_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.plan_mix(docs).groupBy("source").sum("taken").collect()
    from pyspark.sql import functions as F

    mixed = mixing.emit_mix(docs)
    assert mixed.columns == docs.columns
    words = mixed.groupBy("source").agg(F.sum(mixing.n_words(F.coalesce("text", F.lit("")))).alias("n")).collect()
    assert {r["source"]: r["sum(taken)"] for r in plan if r["sum(taken)"]} == {r["source"]: r["n"] for r in words if r["n"]}
