"""Every pipeline stage against brute force, on a table with edge cases, and the whole run."""

from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridlark.llm import _shared, mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = ("doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    common = quality.COMMON["en"]
    return " ".join(r.choice(common) if r.random() < 0.4 else "".join(r.choice("aeioulnrst") for _ in range(r.randint(3, 8))) for _ in range(n)).capitalize() + "."


BOILER = "subscribe to our letter and read more of this every day of the week, it is free for all who are here"
LONG = " ".join(prose(1000 + i, 300) for i in range(60))
ROWS = [(i, f"{prose(i, 90)}\n{prose(500 + i, 60)}" + (f"\n{BOILER}" if i % 2 else ""), "en", "abc"[i % 3]) for i in range(60)]
ROWS += [(100 + i, ROWS[i][1], "en", "c") for i in range(5)]
ROWS += [(200 + i, ROWS[i][1].replace(" the ", " a ", 1), "en", None) for i in range(5)]
ROWS += [(7, prose(7000, 120), "en", "a"), (None, prose(7001, 120), "en", "a"), (None, prose(7001, 120), "en", "b"), (None, None, None, None), (301, "", "en", "a"), (302, "  \n\t", "xx", "a")]
ROWS += [(303, "same words " * 60, "en", "a"), (304, LONG, "en", "b"), (305, "%$#& " * 200, "en", "b"), (7, prose(7000, 120), "en", "a"), (1 << 62, prose(9, 100), "en", "c"), (1 << 62, prose(10, 100), "en", "c")]


@pytest.fixture(scope="module", params=["edge", "empty"])
def folder(request, tmp_path_factory):
    rows = ROWS if request.param == "edge" else []
    out = tmp_path_factory.mktemp(request.param)
    cols = list(zip(*rows)) if rows else [(), (), (), ()]
    clash = {c: pa.array([3] * len(rows), pa.int64()) for c in ("KEPT", "_text", "_row", "N_LINES", "size", "row", "Copies", "_words", "whole", "n_tokens")}
    pq.write_table(pa.table({"doc_id": pa.array(cols[0], pa.int64()), **{n: pa.array(c, pa.string()) for n, c in zip(("text", "lang", "source"), cols[1:])}, "n_chars": pa.array([len(x or "") for x in cols[1]], pa.int64())} | clash), out / "documents.parquet")
    return str(out)


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """Of each stage: its input rows and its output rows."""
    out, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        made = stage(spark, docs, folder)
        made.write.parquet(path)
        after = spark.read.schema(made.schema).parquet(path)
        columns = ["doc_id", "text", "lang", "source"]
        out[name] = [tuple(r) for r in docs.select(*columns).collect()], [tuple(r) for r in after.select(*(columns if k < 4 else LAST)).collect()], after.columns
        docs = after
    return out


def test_columns(stages):
    for k, (name, (_, _, columns)) in enumerate(stages.items()):
        assert columns == (corpus_pipeline.COLUMNS if k < 4 else list(LAST)), name


def test_quality_rules(stages):
    before, after, _ = stages["quality_rules"]

    def base_fails(text):
        w = WORD.findall(text or "")
        at = defaultdict(list)
        for k in range(len(w) - 7):
            at[tuple(w[k : k + 8])].append(k)
        return len(w) < 20 or 100 * len({k + j for v in at.values() if len(v) > 1 for k in v for j in range(8)}) > 30 * len(w)

    good = Counter(r for r in before if not base_fails(r[1]))
    assert not Counter(after) - good
    # what the distributions reject besides is the text of signs alone, at least; clean prose stays
    assert sum(good.values()) - len(after) <= 2
    assert len(before) == 0 or not any(r[0] == 305 for r in after) and (304, LONG, "en", "b") in after


def test_line_dedup(stages):
    before, after, _ = stages["line_dedup"]
    key = lambda x: x.translate(LOWER).strip("\x20\x09\x0a\x0b\x0c\x0d")
    n = Counter(k for _, t, *_ in before for k in {key(x) for x in (t or "").split("\n")})
    want = [(i, "\n".join(x for x in (t or "").split("\n") if not key(x) or n[key(x)] < 10), *rest) for i, t, *rest in before]
    assert Counter(after) == Counter(want)
    assert not before or any(BOILER in (r[1] or "") for r in before) and not any(BOILER in r[1] for r in after)


def test_near_duplicates(stages):
    before, after, _ = stages["near_duplicates"]
    sets = []
    for _, t, *_ in before:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(before)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for i, r in enumerate(before):
        groups[find(i)].append(r)
    assert len(after) == len(groups)
    left = Counter(after)
    for rows in groups.values():
        least = min(rows, key=lambda r: (r[0] is None, r[0] or 0))
        hit = [r for r in left if r in rows and r[0] == least[0]]
        assert hit and left[hit[0]] > 0
        left[hit[0]] -= 1


def test_source_mix(stages):
    before, after, _ = stages["source_mix"]
    size = lambda t: len(WORD.findall(t or ""))
    total = defaultdict(int)
    for _, t, _, s in before:
        total[s] += size(t)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight, target, free, left = {s: k % 3 + 1 for k, s in enumerate(order)}, {}, set(order), sum(total.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > mixing.MOST_RATE * total[s]} or free
        target.update({s: min(mixing.MOST_RATE * total[s], unit * weight[s]) for s in full})
        left -= sum(target[s] for s in full)
        free -= full
    n, got = Counter(before), Counter(after)
    assert not set(got) - set(n)
    for r, k in n.items():
        rate = target[r[3]] / total[r[3]] if total[r[3]] else 0
        draw = int(hashlib.md5(("null" if r[0] is None else str(r[0])).encode()).hexdigest()[:8], 16) / 2**32
        whole = int(rate + 1e-12)
        assert got[r] == k * (whole + (draw < rate - whole))


def test_bpe_encode(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    before, after, _ = stages["bpe_encode"]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    want = Counter()
    for i, text, lang, source in before:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[i, lang, source, len(ids), struct.pack(f"<{len(ids)}I", *ids), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((*r[:4], bytes(r[4]), r[5]) for r in after) == want


def test_run_gives_the_last_stage_and_leaves_no_other_table(spark, stages, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(_shared, "shared_dir", lambda _: f"file://{tmp_path}")
    out = corpus_pipeline.run(spark, folder)
    got = Counter((*r[:4], bytes(r[4]), r[5]) for r in map(tuple, out.select(*LAST).collect()))
    assert got == Counter((*r[:4], bytes(r[4]), r[5]) for r in stages["bpe_encode"][1])
    assert len([p for d in tmp_path.iterdir() for p in d.iterdir() if not p.name.startswith(".")]) == 1


def test_distances_match_numpy(spark):
    import numpy as np

    texts = [f"{prose(i, 80)} {'!?' * (i % 7)} {i * 37}" for i in range(45)] + ["1 2 3 & * " * 40]
    docs = spark.createDataFrame([(i, t, "en", "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, _chars string")
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert got[0]._chars == "x"

    def classes(t):
        kind = lambda c: 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if c in " \t\n\x0b\x0c\r" else 3 if ord(c) > 127 else 4 if c.isdigit() else 5 if c in "#*$%&|<>" else 6 if 0x21 <= ord(c) <= 0x7E else 7
        return np.bincount([kind(c) for c in t], minlength=8) / len(t)

    def words(t):
        w = t.split()
        own = [quality.COMMON["en"].index(x) for x in (v.strip("(\"'.,;:!?)").lower() for v in w) if x in quality.COMMON["en"]]
        c = np.bincount(own, minlength=20).astype(float)
        return np.r_[c, len(w) - c.sum()] / len(w)

    def distance(p, q):
        m = (p + q) / 2
        part = lambda x: np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0]))
        return np.sqrt(max(0.0, (part(p) + part(q)) / 2))

    good = [t for i, t in enumerate(texts) if not got[i].base_failed and len(t) >= quality.MIN_CHARS]
    assert 30 <= len(good) < len(texts)
    ref_c, ref_w = np.mean([classes(t) for t in good], axis=0), np.mean([words(t) for t in good], axis=0)
    for i, t in enumerate(texts):
        assert got[i].class_distance == pytest.approx(distance(classes(t), ref_c), abs=1e-9)
        assert got[i].word_distance == pytest.approx(distance(words(t), ref_w) if len(t.split()) >= quality.MIN_WORDS else 0, abs=1e-9)
    few = quality.quality_rules(docs.limit(20)).agg(F.max("word_distance"), F.max("class_distance")).first()
    assert few[0] == 0 and few[1] > 0
