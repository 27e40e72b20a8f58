"""Cases that lost data or depended on names, settings or sizes, for each operator."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridlark.llm import _shared, bpe, licenses, lines, mixing, near_dedup, quality, queries, secrets, suffixes, toxicity
from gridlark.llm._shared import Scratch
from gridlark.llm.components import connect

SF = "/root/testdata/sf0.001"
PLAIN = "password = hunter2hunter2"


# --- names, settings, tables

CLASH = ["SCORE", "_id", "_text", "_keys", "N_Lines", "Kept", "_src", "size", "_words", "row", "_row", "fp", "labels", "Ids", "whole", "_lang", "n_WORDS"]


@pytest.mark.parametrize("name, fn, new", [
    ("quality", quality.quality_rules, ["kept", "n_words"]),
    ("secrets", secrets.scan_documents, ["spans"]),
    ("near", near_dedup.drop_near_copies, []),
    ("lines", lambda d: lines.dedup_lines(d, 2, 2), ["n_lines"]),
    ("lines_joined", lambda d: lines.dedup_lines(d, 2, 2, 0), ["n_lines"]),
    ("toxicity", lambda d: toxicity.score_documents(d, toxicity.Model(["idiot*"])), ["score"]),
    ("mixing", mixing.emit_mix, []),
    ("plan", mixing.plan_mix, ["size", "taken"]),
    ("licenses", licenses.scan_licenses, ["labels", "n_words", "score"]),
])
def test_clashing_names_and_settings(spark, name, fn, new):
    rows = [(i, f"line one here\nown line {i} word you idiot", "en", "s", *[f"v{i}"] * len(CLASH)) for i in range(6)]
    docs = spark.createDataFrame(rows, ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in ["doc_id", "text", "lang", "source", *CLASH]))
    before = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.shuffle.partitions", "spark.sql.caseSensitive")}
    out = fn(docs)
    got = out.collect()
    assert before == {k: spark.conf.get(k) for k in before}
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    replaced = {c.lower() for c in new}
    for c in CLASH:
        if c.lower() not in {x.lower() for x in out.columns if x not in CLASH} | replaced:
            assert {r[c] for r in got} <= {f"v{i}" for i in range(6)}, c
    for c in new:
        assert c in out.columns


def test_temporary_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(_shared, "shared_dir", lambda _: f"file://{tmp_path}")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    with _shared.temporary():
        assert near_dedup.drop_near_copies(docs).count() > 0
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())
    tables = {t.name for t in spark.catalog.listTables()}
    lines.dedup_lines(docs, 10).count()
    assert {t.name for t in spark.catalog.listTables()} == tables


# --- op2

@pytest.mark.parametrize("text, spans", [
    ("%" + "25" * 5000 + "70assword%3Dhunter2hunter2", 2),
    ("&#38;" + "#38;" * 3000 + "#112;assword=hunter2hunter2", 1),
    ("\\x5c" + "x5c" * 3000 + "x70assword=hunter2hunter2", 1),
    (base64.b64encode(PLAIN.encode("utf-16")).decode(), 1),
    (base64.b64encode(("é " + PLAIN + " é").encode("utf-16-be")).decode(), 1),
    (base64.b64encode(b"x" + PLAIN.encode("utf-16-le")).decode(), 1),
    (base64.b64encode(lzma.compress(PLAIN.encode(), preset=9)).decode(), 1),
])
def test_chains_and_wide_characters(text, spans):
    assert 0 in {k for _, k, _ in secrets.find(text)[1]} and len(secrets.find(text)[1]) >= spans


def test_escapes_of_bytes_that_meet():
    assert secrets.find("token%253A%20%61bcdefg%2568")[1] == [(0, 0, 27)]
    assert secrets._unescape("%C3%A9%25C3%25A9\\u0041%zz", range(25), range(1, 26))[0] == "ééA%zz"


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, lambda x: gzip.compress(gzip.compress(x))])
@pytest.mark.parametrize("at", [10, 4090, 4096, 5000, 12000])
def test_streams_longer_than_a_piece(monkeypatch, pack, at):
    monkeypatch.setattr(secrets, "PIECE", 4096)
    monkeypatch.setattr(secrets, "OVERLAP", 256)
    r = random.Random(at)
    noise = "".join(r.choice("bcdé \n") for _ in range(20000))
    text = base64.b64encode(pack((noise[:at] + PLAIN + noise[at:]).encode())).decode()
    assert (4, 0, 4 + len(text.rstrip("="))) in secrets.find(f"say {text} end")[1]


def test_streams_end(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_INFLATED", 1 << 20)
    bomb = base64.b64encode(zlib.compress(bytes(8 << 20) + PLAIN.encode())).decode()
    assert secrets.find(bomb)[1] == []
    assert secrets.find(base64.b64encode(gzip.compress(PLAIN.encode())[:-6]).decode())[1]
    assert secrets.find(base64.b64encode(gzip.compress(b"BZh91AY not packed, " + PLAIN.encode())).decode())[1]


# --- op3

def test_rows_with_one_id_and_large_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = lambda t: t + " tail"
    rows = [(5, a), (5, b), (9, near(a)), (8, near(b)), (1 << 62, c), ((1 << 62) + 1, near(c)), ((1 << 63) - 1, "only one of these"), (None, near(c)), (-3, "x"), (-4, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in near_dedup.near_dedup(docs).collect()), key=str)
    want = [(5, 5), (5, 5), (9, 5), (8, 5), (1 << 62, 1 << 62), ((1 << 62) + 1, 1 << 62), ((1 << 63) - 1, (1 << 63) - 1), (None, 1 << 62), (-3, -4), (-4, -4)]
    assert got == sorted(want, key=str)
    assert sorted(r.text[:2] for r in near_dedup.drop_near_copies(docs).collect()) == ["a0", "b0", "c0", "on", "x"]


def test_a_dense_region_of_many_components(spark):
    """Thousands of texts that all share most of their words: families of near copies and texts between them."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for family in range(40):
        own = list(base)
        for k in rng.choice(200, 12, replace=False):
            own[k] = f"f{family}x{k}"
        for copy in range(int(rng.integers(1, 90))):
            w = list(own)
            for k in rng.choice(200, int(rng.integers(0, 5)), replace=False):
                w[k] = f"c{family}x{copy}x{k}"
            rows.append((len(rows), " ".join(w)))
    names: dict = {}
    x = np.zeros((len(rows), 60_000), np.float32)
    for i, t in rows:
        w = t.split()
        for s in zip(w, w[1:], w[2:]):
            x[i, names.setdefault(s, len(names))] = 1
    x = x[:, : len(names)]
    n, both = x.sum(axis=1), x @ x.T
    link = 100 * both >= 85 * (n[:, None] + n[None, :] - both)
    label = np.arange(len(rows))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(rows)).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    assert len(rows) > 1500 and 20 < len(set(label.tolist())) < len(rows)
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100).collect()}
    assert [got[i] for i in range(len(rows))] == label.tolist()


def test_bounds_of_the_sieve():
    for s in (0.8, 0.85):
        p, k = (1 + s) / 2, near_dedup.least_bits(s)
        tail = sum(near_dedup.math.comb(128, i) * p**i * (1 - p) ** (128 - i) for i in range(k))
        assert tail <= near_dedup.SIEVE
        assert (1 - s ** near_dedup.min_depth(s)) ** near_dedup.TREES <= near_dedup.MISS


# --- op5

def test_runs_meet_in_merge_joins_without_a_shuffle(spark):
    runs = lines.LineRuns(spark, min_docs=3, fanout=2, scratch=Scratch(spark, "t"))
    frame = lambda keys: spark.createDataFrame([(bytearray(x.encode()),) for x in keys], "key binary")
    runs.add(frame("aab"))
    runs.levels.append([])
    a, b = runs.runs()[0], runs._write(frame("bcd").groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    plan = runs.merged(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plan = runs.anti(b)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    batch = frame("ab").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    plan = runs.anti(batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("SortMergeJoin") < plan.index("Exchange") and "partial_count" in plan
    runs._drop(b)
    runs.close()


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_any_number_of_batches_gives_the_same_lines(spark, batches):
    rng = random.Random(batches)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "d", "e", "", " A "]) + rng.choice(["", "", str(i)]) for _ in range(5))) for i in range(40)]
    one, many = (sorted((r.doc_id, r.text) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 10, n).collect()) for n in (2, batches))
    assert one == many and any(len(t) < len(dict(rows)[i]) for i, t in one)


# --- op6

def test_every_code_point_alone_and_beside_others():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    theirs, own = Tokenizer.from_file(path), bpe.BpeCodec(path)
    theirs.no_truncation()
    theirs.no_padding()
    points = [chr(i) for i in range(0x32000) if not 0xD800 <= i < 0xE000 and not 0x3400 <= i < 0x9F00 and not 0x20000 <= i < 0x31000]
    texts = [f"a{c}A!{c}?1{c}{c} {c}̣q̕{c}" for c in points]
    for t, e in zip(texts, theirs.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(t) == e.ids, ascii(t)
    rng = random.Random(1)
    texts = ["".join(rng.choice(points) for _ in range(8)) for _ in range(20_000)]
    for t, e in zip(texts, theirs.encode_batch(texts, add_special_tokens=False)):
        assert own.encode_decode(t)[1] == theirs.decode(e.ids, skip_special_tokens=False), ascii(t)


# --- op7

def test_training_does_not_depend_on_the_order_of_rows(spark):
    docs, labels = (pq.read_table(f"{SF}/{x}.parquet").to_pandas() for x in ("documents", "labels"))
    docs = docs[["doc_id", "text"]]
    again = docs.assign(text=docs.text.str.upper())
    twice = spark.createDataFrame(docs.astype(object).where(docs.notna(), None)).unionByName(spark.createDataFrame(again.astype(object).where(again.notna(), None)))
    models = [toxicity.train(twice.repartition(n), spark.createDataFrame(labels[["doc_id", "toxic"]])) for n in (2, 5)]
    assert models[0].terms == models[1].terms and np.allclose(models[0].weights, models[1].weights)


# --- op8

def removed(rows: list[tuple[int, str]]) -> dict[int, str]:
    least: dict[bytes, int] = {}
    raw = sorted((i, t.encode()) for i, t in rows)
    for i, b in raw:
        for k in range(len(b) - 49):
            least.setdefault(b[k : k + 50], i)
    out = {}
    for i, b in raw:
        hit = bytearray(len(b))
        for k in range(len(b) - 49):
            if least[b[k : k + 50]] < i:
                hit[k : k + 50] = b"\1" * 50
        out[i] = hashlib.sha256(bytes(c for c, h in zip(b, hit) if not h)).hexdigest()
    return out


@pytest.mark.parametrize("hot", [1, 20, suffixes.HOT])
def test_an_anchor_in_many_documents(spark, hot):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    anchor = "the same twenty bytes"
    rows = [(i, f"{word(rng.randint(0, 40))}{word(3) if i % 5 else 'xyz' * 9}{anchor}{'zyx' * 9 if i % 3 else word(3)}{word(rng.randint(0, 40))}") for i in range(600)]
    rows += [((1 << 63) - 1, rows[7][1] * 3), (-5, rows[9][1] + "tail" * 20)]
    got = {r.doc_id: r.kept_sha256 for r in suffixes.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), hot).collect()}
    assert got == removed(rows)


def test_null_and_long_documents(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(suffixes.PIECE + 5000))
    rows = [(1, text), (2, text[suffixes.PIECE - 300 : suffixes.PIECE + 300]), (None, text[-400:]), (None, None), (3, "é" * 70)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffixes.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("1", len(text), 0), ("2", 600, 600), ("None", 400, 400), ("None", 0, 0), ("3", 140, 0)])


# --- op10

def test_all_notices_of_a_file_are_found(spark):
    notices = [t for _, t, _ in licenses.TEMPLATES]
    rows = [(0, "\n".join(notices)), (1, " ".join(reversed(notices)).upper()), (2, "ÀÉ İ " + notices[0])] + [(10 + i, f"{a} and {b}") for i, (a, b) in enumerate((a, b) for a in notices for b in notices if a < b)]
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    every = {label for label, _, _ in licenses.TEMPLATES}
    assert got[0] == got[1] == every
    label = {t: x for x, t, _ in licenses.TEMPLATES}
    for i, (a, b) in enumerate((a, b) for a in notices for b in notices if a < b):
        assert {label[a], label[b]} <= got[10 + i]


def test_queries_have_contract_columns(spark):
    for name in ("op1_quality_rules", "op9_mixing"):
        assert queries.QUERIES[name](spark, SF).columns[0] == "doc_id"


def test_scores_match_a_plain_search_of_all_terms(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"))

    def distance(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    near: dict[str, tuple[int, int] | None] = {}

    def nearest(word: str) -> tuple[int, int] | None:
        if word not in near:
            found = []
            for k, term in enumerate(model.terms):
                text, most = term.rstrip("*"), toxicity.edits_of(term.rstrip("*"))
                ends = range(max(0, len(text) - most), len(text) + most + 1) if term.endswith("*") else [len(word)]
                if not term.endswith("*") and abs(len(text) - len(word)) > most:
                    continue
                d = min(distance(text, word[:e]) for e in ends)
                if d <= most:
                    found.append((d, k))
            near[word] = min(found) if found else None
        return near[word]

    rows = docs.orderBy("doc_id").collect()[:60]
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    hits = 0
    for r in rows:
        held = (r.text or "").lower()
        at = [(m.span(), m.group()) for m in toxicity.TOKEN.finditer(held)]
        spans, words = [a for a, _ in at], [w for _, w in at]
        matches = [(n[1], n[0], toxicity.context_of(held, spans, words, i)) for i, w in enumerate(words) if (n := nearest(toxicity.folded(w)))]
        hits += len(matches)
        assert got[r.doc_id].n_matches == len(matches), r.doc_id
        assert got[r.doc_id].score == pytest.approx(model.score(matches))
    assert hits


def test_components_of_a_random_graph(spark):
    rng = np.random.default_rng(9)
    links = {tuple(sorted(map(int, x))) for x in rng.integers(0, 400, (260, 2)) if x[0] != x[1]} | {(1000 + i, 1001 + i) for i in range(60)}
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    frame = lambda rows: spark.createDataFrame(list(rows), "a long, b long")
    got = {r.node: r.component for r in connect(frame([*links, *list(links)[:20]]), Scratch(spark, "t")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connect(frame([]), Scratch(spark, "t")).count() == 0
