"""Dense regions with several components against all pairs; rows without ids in a mix."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gridlark.llm import mixing, near_dedup


def family(rng: random.Random, base: list[str], own: list[int], name: str, n: int, changed: int):
    """n texts of a base whose words at the places `own` are the family's, each with a few words of its own."""
    words = list(base)
    for k in own:
        words[k] = f"{name}{k}"
    for i in range(n):
        w = list(words)
        for k in rng.sample(range(len(w)), changed):
            w[k] = f"{name}u{i}x{k}"
        yield " ".join(w)


def components(sets, num, den):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if den * both >= num * (len(x) + len(sets[j]) - both):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("num, den, size", [(85, 100, 3), (80, 100, 5)])
@pytest.mark.parametrize("block", [300, 7])
def test_families_around_the_threshold(spark, monkeypatch, num, den, size, block):
    """Families whose members are linked across in part only: components are those of all pairs, also where a region comes in many blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(num)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(8):
        texts += family(rng, base, range(k * 12, k * 12 + rng.randrange(1, 5)), f"f{k}", 40, rng.randrange(0, 4))
    rng.shuffle(texts)
    shingles = lambda t: {tuple(t[i : i + size]) for i in range(len(t) - size + 1)}
    want = components([shingles(t.split()) for t in texts], num, den)
    got = near_dedup.near_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), size, num, den)
    assert [r.component_id for r in got.orderBy("doc_id").collect()] == want


def test_rows_without_ids_reach_their_sources_target(spark):
    rows = [(None, f"text {i} " + "word " * 20, "a") for i in range(400)] + [(i, "other words " * 40, "b") for i in range(400)]
    plan = mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    for r in plan:
        assert r.taken == pytest.approx(r.target, rel=0.1)
