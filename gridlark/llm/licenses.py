"""License scans with a positional rare-token index (operator 10), in DataFrame functions only.

Every license is a template of words with mandatory key phrases. Document
frequencies of the templates' words come from all documents. The words of
highest inverse document frequency of each template are its postings: so many
of its places that any alignment which agrees well enough agrees in one of
them. A file's words are looked up in all postings at once. The differences
between a word's place in the file and in a template are the alignments to
compare word by word, and the best one of each template whose key phrase stands
in the file counts.

Edge cases: a null or empty text has no words and no labels; repeated rows are
scanned alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.llm._shared import Scratch, prefix, text_of, without
from gridlark.llm.quality import let

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Words of common license notices, and the phrases of which one must stand in a file.
TEMPLATES = [
    ("mit", "released under the mit license", ["under the mit license", "the mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ["www apache org licenses license 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license"]),
    ("lgpl", "licensed under the gnu lesser general public license version 2 1", ["gnu lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license version 3", ["gnu affero general public license"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify and or distribute this software"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software released into the public domain"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc", "creative commons attribution noncommercial"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa", "creative commons attribution sharealike"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0", "cc by 3 0", "creative commons attribution 4 0"]),
    ("cc0", "released under cc0 1 0 universal", ["cc0 1 0"]),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["may be used to endorse or promote products derived from this software"]),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", ["eclipse public license"]),
    ("boost", "distributed under the boost software license version 1 0", ["boost software license"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ["in no event will the authors be held liable for any damages arising from the use of this software"]),
    ("artistic", "you may distribute under the terms of either the gnu general public license or the artistic license", ["artistic license"]),
]
VOCABULARY = sorted({w for p in PHRASES for w in p.split()} | {w for _, t, keys in TEMPLATES for x in (t, *keys) for w in x.split()})
#: The share of a template's words that must agree.
LEAST = 0.5


def strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def words_of(text: Column) -> Column:
    cut = F.split(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), BREAK)
    return let(cut, lambda c: let(F.when(F.get(c, F.lit(0)) == "", F.lit(1)).otherwise(F.lit(0)), lambda a: F.slice(c, a + 1, F.greatest(F.lit(0), F.size(c) - a - F.when((F.size(c) > a) & (F.element_at(c, -1) == ""), F.lit(1)).otherwise(F.lit(0))))))


def places(words: Column, phrase: list[str]) -> Column:
    """Where the phrase's words stand consecutively."""
    first = F.filter(F.transform(words, lambda w, i: F.when(w == phrase[0], i)), lambda i: i.isNotNull())
    rest = lambda i: F.lit(True) if len(phrase) == 1 else _all([F.coalesce(F.get(words, i + k) == w, F.lit(False)) for k, w in enumerate(phrase) if k])
    return F.filter(first, lambda i: rest(i))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def has_words(present: Column, phrase: list[str]) -> Column:
    return _all([F.array_contains(present, w) for w in sorted(set(phrase))])


def indexed(docs: DataFrame, p: str) -> DataFrame:
    """docs without text, with n_words and under prefix p present (the licence words) and words where some phrase can stand."""
    held = without(docs.withColumn(f"{p}all", words_of(text_of(docs))), ["text"])
    present = F.col(f"{p}present")
    held = held.withColumns({"n_words": F.size(f"{p}all").cast("long"), f"{p}present": F.array_intersect(strings(VOCABULARY), F.col(f"{p}all"))})
    some = F.lit(False)
    for phrase in [*PHRASES, *(k for _, _, keys in TEMPLATES for k in keys)]:
        some = some | has_words(present, phrase.split())
    return held.withColumn(f"{p}words", F.when(some, F.col(f"{p}all"))).drop(f"{p}all")


def inverse_frequencies(made: DataFrame, p: str) -> dict[str, float]:
    """ln(documents / documents with the word) of each licence word: as many numbers as the templates have words."""
    n = made.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    rows = made.select(F.explode(f"{p}present").alias("w")).groupBy("w").agg(F.log(F.lit(float(max(n, 1))) / F.count(F.lit(1))).alias("idf")).collect()
    return {r["w"]: r["idf"] for r in rows}


def rare_places(template: list[str], idf: dict[str, float]) -> dict[str, list[int]]:
    """Postings of the rarest places: an alignment that differs in all of them agrees in fewer than LEAST."""
    most = len(template) - math.ceil(LEAST * len(template)) + 1
    out: dict[str, list[int]] = {}
    for i in sorted(range(len(template)), key=lambda i: (-idf.get(template[i], math.inf), i))[:most]:
        out.setdefault(template[i], []).append(i)
    return out


def alignments(words: Column, idf: dict[str, float]) -> Column:
    """(t, a): where in the file the first word of template t would stand, by one look at each word of the file."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (_, text, _) in enumerate(TEMPLATES):
        for w, at in rare_places(text.split(), idf).items():
            postings.setdefault(w, []).extend((t, i) for i in at)
    table = F.create_map(*[x for w, at in postings.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in at]))])
    hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*postings), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(table, h["w"]), lambda q: F.struct(q["t"].alias("t"), (h["i"] - q["i"]).alias("a"))))))


def _agreement(words: Column, at: Column, template: list[str]) -> Column:
    """The share of the template's words that stand in place."""
    same = [F.when(F.get(words, F.when(at + i >= 0, at + i)) == w, F.lit(1.0)).otherwise(F.lit(0.0)) for i, w in enumerate(template)]
    return F.coalesce(F.aggregate(F.array(*same), F.lit(0.0), lambda a, x: a + x) / len(template), F.lit(0.0))


def _best_agreement(words: Column, hits: Column, number: int, template: list[str]) -> Column:
    own = F.filter(hits, lambda h: h["t"] == number)
    return F.array_max(F.transform(own, lambda h: _agreement(words, h["a"], template)))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """docs without text, with n_words, n_base, first_word, last_word, base_labels, labels and score."""
    docs = without(docs, ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
    p = prefix(docs.columns)
    made = Scratch(docs.sparkSession, "licenses").save(indexed(docs, p))
    idf = inverse_frequencies(made, p)
    words, present, hits = F.col(f"{p}words"), F.col(f"{p}present"), F.col(f"{p}hits")
    none = F.array().cast("array<int>")
    found = {f"{p}hits": F.when(words.isNotNull(), alignments(words, idf))}
    for i, phrase in enumerate(PHRASES):
        w = phrase.split()
        found[f"{p}p{i}"] = F.when(words.isNotNull() & has_words(present, w), places(words, w)).otherwise(none)
    out = made.withColumns(found)
    phrases = {f"{p}p{i}": label for i, label in enumerate(PHRASES.values())}
    base = F.filter(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, label in phrases.items()]), lambda x: x.isNotNull())
    scores = {}
    for i, (_, text, keys) in enumerate(TEMPLATES):
        t = text.split()
        can = F.lit(False)
        for k in keys:
            can = can | (has_words(present, k.split()) & (F.size(places(words, k.split())) > 0))
        scores[f"{p}s{i}"] = F.when(words.isNotNull(), F.when(can, _best_agreement(words, hits, i, t))).otherwise(F.lit(None))
    out = out.withColumns({f"{p}at": F.flatten(F.array(*[F.col(c) for c in phrases])), f"{p}base": base}).withColumns(scores)
    by_label: dict[str, list[str]] = {}
    for i, (label, _, _) in enumerate(TEMPLATES):
        by_label.setdefault(label, []).append(f"{p}s{i}")
    best = {k: F.greatest(F.lit(0.0), *[F.coalesce(F.col(c), F.lit(0.0)) for c in v]) for k, v in by_label.items()}
    own = F.filter(F.array(*[F.when(v >= LEAST, F.lit(k)) for k, v in best.items()]), lambda x: x.isNotNull())
    top = F.greatest(*[F.when(v >= LEAST, v).otherwise(F.lit(0.0)) for v in best.values()])
    names = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(c)))
    out = out.withColumns({
        "n_base": F.size(f"{p}at").cast("long"),
        "first_word": F.array_min(f"{p}at").cast("long"), "last_word": F.array_max(f"{p}at").cast("long"),
        "base_labels": names(F.col(f"{p}base")), "labels": names(F.concat(f"{p}base", own)),
        "score": F.when(F.size(f"{p}base") > 0, F.lit(1.0)).otherwise(top),
    })
    return out.select(*[c for c in out.columns if not c.startswith(p)])
