"""Toxicity scores (operator 7): Levenshtein automata intersected with a lexicon trie.

The lexicon is a list of known terms and the terms that labelled documents
teach: word beginnings and whole words that stand in toxic documents and hardly
in others, chosen so that each covers toxic documents that no other one covers.
All terms are in one trie. The trie's product with a Levenshtein automaton is
made deterministic while it is used: a state is a set of (trie node, edits),
and most words reach the dead state after a few characters.

A match has a context: its window holds quotation marks or words of reporting,
or words of address, or neither. What a (term, edits) and a context are worth is
learned as log odds; a logistic regression on the worth of a document's matches
gives the score.

Fitted on at most SAMPLE labelled rows, in order of a hash of doc_id; every
document is scored on its whole text. Only texts are inputs of a score.

Edge cases: a null or empty text has no matches and the score of such; several
labels of one doc_id count as the largest, several texts as the first; null labels are no labels; without
labels of both classes the known terms and fixed weights are used; documents
without a doc_id are scored and not held out; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.llm._shared import Scratch, map_texts, slices, texts

#: Labelled rows that the lexicon and the weights are fitted on, about.
SAMPLE = 12_000
#: Letters of a beginning of a word that may be a term.
SHORTEST, LONGEST = 3, 10
#: A term has to gain so many toxic documents, or this share of them if that is more; each clean one that has it counts as four lost.
LEAST_GAIN, LEAST_SHARE = 4, 0.008
#: Words on each side of a match that its context is read from.
WINDOW = 6
#: Distinct terms that a counting task holds before it hands them on.
HELD_TERMS = 400_000
# Known terms, words of reporting and of address.
KNOWN = ["idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "imbecile", "dumbass", "retard", "bastard", "bitch", "asshole", "arschloch", "trottel", "depp", "schlampe", "connard", "salope", "abruti", "pendejo", "cabrón", "estúpido"]
REPORTING = {"said", "says", "called", "quote", "quoted", "word", "term", "wrote", "reported", "sagte", "zitat", "wort", "dit", "mot", "dijo", "palabra", "cita"}
ADDRESS = {"you", "your", "youre", "u", "du", "dich", "dein", "ihr", "tu", "toi", "vous", "ton", "te", "eres", "usted"}
QUOTES = "\"“”„«»"
TOKEN = re.compile(r"[^\W_]+(?:[@$!][^\W_]+)*")
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
PLAIN, ADDRESSED, QUOTED = 0, 1, 2
#: Worth of a match whose (term, edits) was not seen; share of it that a quoted match keeps if that was not seen.
UNSEEN, QUOTED_SHARE = (3.0, 1.0), 0.3

OUT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("n_matches", T.LongType())])


def edits_of(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class TermAutomaton:
    """Finds the terms near a word. A term that ends in '*' stands for all words that begin so."""

    DEAD = 0

    def __init__(self, terms: list[str], most_states: int = 200_000):
        self.terms, self.most_states = terms, most_states
        #: node: children, whole-word terms, beginning terms, most edits below
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[list[int]] = [[]]
        self.begins: list[list[int]] = [[]]
        self.most: list[int] = [0]
        self.allowed = [edits_of(t.rstrip("*")) for t in terms]
        for k, term in enumerate(terms):
            at, text = 0, term.rstrip("*")
            self.most[0] = max(self.most[0], self.allowed[k])
            for c in text:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    for table, new in ((self.children, {}), (self.whole, []), (self.begins, []), (self.most, 0)):
                        table.append(new)
                at = self.children[at][c]
                self.most[at] = max(self.most[at], self.allowed[k])
            (self.begins if term.endswith("*") else self.whole)[at].append(k)
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[frozenset, int] = {frozenset(): 0}
        self.states: list[frozenset] = [frozenset()]
        self.steps: list[dict[str, int]] = [{}]
        self.ends: list[tuple | None] = [()]
        self.start = self._name(self._closed({(0, 0)}))

    def _closed(self, items: set) -> frozenset:
        """With the term letters that the word leaves out, and with beginnings that are complete."""
        todo, out = list(items), set(items)
        while todo:
            node, e = todo.pop()
            if node < 0:
                continue
            more = [(-1 - k, e) for k in self.begins[node] if e <= self.allowed[k]]
            more += [(c, e + 1) for c in self.children[node].values() if e < self.most[c]]
            for x in more:
                if x not in out:
                    out.add(x)
                    todo.append(x)
        least: dict[int, int] = {}
        for node, e in out:
            least[node] = min(e, least.get(node, e))
        # fewer edits at a node make its other entries needless
        return frozenset(least.items())

    def _name(self, state: frozenset) -> int:
        found = self.ids.get(state)
        if found is None:
            found = self.ids[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            self.ends.append(None)
        return found

    def _step(self, at: int, c: str) -> int:
        out = set()
        for node, e in self.states[at]:
            if node < 0:
                out.add((node, e))
                continue
            children = self.children[node]
            if c in children:
                out.add((children[c], e))
            if e < self.most[node]:
                out.add((node, e + 1))
                out.update((x, e + 1) for x in children.values() if e < self.most[x])
        to = self.steps[at][c] = self._name(self._closed(out))
        return to

    def _end(self, at: int) -> tuple:
        found: dict[int, int] = {}
        for node, e in self.states[at]:
            for k in [-1 - node] if node < 0 else self.whole[node]:
                if e <= self.allowed[k]:
                    found[k] = min(e, found.get(k, e))
        self.ends[at] = tuple(sorted(found.items(), key=lambda x: (x[1], x[0])))
        return self.ends[at]

    def match(self, word: str) -> tuple:
        """((term, edits), ...) of the terms near the word, the nearest first."""
        if len(self.states) > self.most_states:
            self._forget()
        at, steps = self.start, self.steps
        for c in word:
            to = steps[at].get(c)
            at = self._step(at, c) if to is None else to
            if not at:
                return ()
        end = self.ends[at]
        return self._end(at) if end is None else end


def words_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def folded(word: str) -> str:
    return word if word.isalpha() else word.translate(LOOKALIKE)


def context_of(text: str, spans: list[tuple[int, int]], words: list[str], i: int) -> int:
    """How the match at word i is used, from the words and marks around it."""
    lo, hi = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
    before, after = text[spans[lo][0] : spans[i][0]], text[spans[i][1] : spans[hi - 1][1] + 1]
    near = words[lo:i] + words[i + 1 : hi]
    if any(q in before for q in QUOTES) and any(q in after for q in QUOTES) or not REPORTING.isdisjoint(near):
        return QUOTED
    return ADDRESSED if not ADDRESS.isdisjoint(near) else PLAIN


def find_matches(text: str, automaton: TermAutomaton) -> list[tuple[int, int, int]]:
    """(term, edits, context) of every word that is near a term."""
    held = text.lower()
    found = {}
    for w in set(TOKEN.findall(held)):
        m = automaton.match(folded(w))
        if m:
            found[w] = m[0]
    if not found:
        return []
    spans, words = [], []
    for m in TOKEN.finditer(held):
        spans.append(m.span())
        words.append(m.group())
    return [(*found[w], context_of(held, spans, words, i)) for i, w in enumerate(words) if w in found]


class Model:
    """Terms, what matches are worth, and the weights of the regression."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.worth: dict[tuple[int, int], float] = {}
        self.quoted = QUOTED_SHARE
        self.addressed = 1.2
        self.weights = np.array([1.2, 0.5, 0.3])
        self.bias = -3.0

    def features(self, matches: list[tuple[int, int, int]]) -> list[float]:
        """The two largest worths of distinct terms, and how many matches are worth something."""
        best: dict[int, float] = {}
        n = 0
        for term, e, ctx in matches:
            w = self.worth.get((term, e), UNSEEN[min(e, 1)])
            w *= self.quoted if ctx == QUOTED else self.addressed if ctx == ADDRESSED and w > 0 else 1.0
            n += w > 1
            best[term] = max(w, best.get(term, 0.0))
        top = sorted(best.values(), reverse=True)[:2] + [0.0, 0.0]
        return [top[0], top[1], math.log1p(n)]

    def score(self, matches: list[tuple[int, int, int]]) -> float:
        z = float(np.dot(self.weights, self.features(matches))) + self.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def learn(self, rows: list[tuple[int, list[tuple[int, int, int]]]]) -> None:
        """rows: (label, matches). Log odds of matches, then the regression by Newton steps."""
        total = Counter(y for y, _ in rows)
        if not total[0] or not total[1]:
            return
        seen = {y: Counter() for y in (0, 1)}
        contexts = {y: Counter() for y in (0, 1)}
        for y, matches in rows:
            seen[y].update({(t, e) for t, e, _ in matches})
            contexts[y].update({c for _, _, c in matches})
        odds = lambda p, n: math.log((p + 0.5) / (total[1] + 1)) - math.log((n + 0.5) / (total[0] + 1))
        self.worth = {k: max(-1.0, odds(seen[1][k], seen[0][k])) for k in {*seen[0], *seen[1]}}
        plain = odds(contexts[1][PLAIN], contexts[0][PLAIN])
        if contexts[0][QUOTED] + contexts[1][QUOTED] >= 20 and plain > 0:
            self.quoted = min(1.0, max(0.0, odds(contexts[1][QUOTED], contexts[0][QUOTED]) / plain))
        x = np.array([[*self.features(m), 1.0] for _, m in rows])
        y = np.array([r[0] for r in rows], float)
        w = np.zeros(4)
        ridge = np.diag([0.5, 0.5, 0.5, 1e-3])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights, self.bias = w[:3], float(w[3])


def beginnings(text: str) -> set[str]:
    """Whole words, and beginnings of words with a star."""
    out = set()
    for w in set(words_of(text)):
        w = folded(w)
        if w.isalpha():
            out.add(w)
            out.update(w[:k] + "*" for k in range(SHORTEST, min(LONGEST, len(w)) + 1))
    return out


def propose(sample: DataFrame, least: int) -> list[str]:
    """All terms of the sample that can gain `least` toxic documents, the best first."""

    def run(batches):
        held: dict[str, list[int]] = {}

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([v[1] for v in held.values()], pa.int64()), pa.array([v[0] for v in held.values()], pa.int64())], names=["term", "p", "n"])

        for whole in batches:
            for b in slices(whole):
                for text, y in zip(texts(b.column("text")), b.column("toxic").to_pylist()):
                    for t in beginnings(text):
                        held.setdefault(t, [0, 0])[y] += 1
                    if len(held) > HELD_TERMS:
                        yield from out()
                        held = {}
        yield from out()

    counts = sample.mapInArrow(run, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    rated = counts.where(F.col("p") - 4 * F.col("n") >= least).collect()
    return [r["term"] for r in sorted(rated, key=lambda r: (4 * r["n"] - r["p"], -len(r["term"]), r["term"]))]


def cover(sample: DataFrame, proposed: list[str], least: int) -> list[str]:
    """Few of the proposed terms that cover the toxic documents of the sample, each gaining `least` of them."""
    at = {t: i for i, t in enumerate(proposed)}

    def run(batches):
        for whole in batches:
            for b in slices(whole):
                hits = [[at[t] for t in beginnings(text) if t in at] for text in texts(b.column("text"))]
                yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(hits, pa.list_(pa.int32()))], names=["toxic", "hits"])

    rows = sample.mapInArrow(run, "toxic int, hits array<int>").toArrow().to_pylist()
    toxic = [r["hits"] for r in rows if r["toxic"]]
    wrong = np.zeros(len(proposed), np.int64)
    for r in rows:
        if not r["toxic"]:
            wrong[r["hits"]] += 1
    inside = np.zeros((len(toxic), len(proposed)), bool)
    for i, hits in enumerate(toxic):
        inside[i, hits] = True
    chosen, left = [], np.ones(len(toxic), bool)
    while left.any() and len(proposed):
        gain = inside[left].sum(axis=0) - 4 * wrong
        # of equals the first: proposed terms are in order of worth, then length
        best = max(range(len(proposed)), key=lambda k: (gain[k], len(proposed[k]), -k))
        if gain[best] < least:
            break
        chosen.append(proposed[best])
        left &= ~inside[:, best]
    return chosen


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows that are not held out. docs: doc_id, text; labels: doc_id, toxic."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "toxic")

    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    n = own.count()
    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24)) < int(min(1.0, sample / max(n, 1)) * (1 << 24)))
    # about `sample` rows, at most twice as many: small enough to broadcast
    # of several texts of one doc_id the first in order counts, so that reruns agree
    rows = docs.join(F.broadcast(picked.limit(2 * sample)), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = scratch.save(rows.select("text", "toxic"))
    least = max(LEAST_GAIN, math.ceil(LEAST_SHARE * (rows.agg(F.sum("toxic")).first()[0] or 0)))
    terms = cover(rows, propose(rows, least), least)
    known = [k + "*" for k in KNOWN if k + "*" not in terms]
    model = Model([*terms, *known])
    names = model.terms

    def run(batches):
        automaton = TermAutomaton(names)
        for whole in batches:
            for b in slices(whole):
                found = [[x for m in sorted(set(find_matches(t, automaton))) for x in m] for t in texts(b.column("text"))]
                yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"])

    made = rows.mapInArrow(run, "toxic int, found array<int>").toArrow().to_pylist()
    model.learn([(r["toxic"], list(zip(*[iter(r["found"])] * 3))) for r in made])
    scratch.drop(rows)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and n_matches."""
    def start():
        automaton = TermAutomaton(model.terms)

        def work(column):
            found = [find_matches(t, automaton) for t in column]
            return {"score": [model.score(m) for m in found], "n_matches": [len(m) for m in found]}

        return work

    return map_texts(docs, start, OUT)
