"""License labels against the best of all alignments."""

from __future__ import annotations

import re

from gridlark.llm import licenses

BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
GPL = "licensed under the GNU General Public License version 3"
PROSE = "any person may obtain a copy of the software and publish it for any purpose; permission to modify and merge documentation files is granted free of charge"


def labels(text: str) -> set[str]:
    w = re.findall("[a-z0-9]+", text.lower())
    has = lambda p: any(w[k : k + len(p)] == p for k in range(len(w)))
    out = {label for p, label in licenses.PHRASES.items() if has(p.split())}
    for label, template, keys in licenses.TEMPLATES:
        t = template.split()
        best = max((sum(0 <= a + i < len(w) and w[a + i] == x for i, x in enumerate(t)) for a in range(-len(t), len(w))), default=0)
        if any(has(k.split()) for k in keys) and best >= licenses.LEAST * len(t):
            out.add(label)
    return out


def test_no_verified_template_is_lost(spark):
    common = [f"the gnu general public license is here {i}" for i in range(30)]
    notices = [t for _, t, _ in licenses.TEMPLATES]
    rows = [f"{BSD}\n{GPL}", f"{PROSE}\n{GPL}", f"x {BSD} {PROSE}", "\n".join(notices), "", *notices, *[f"{a} {b}" for a in notices[::3] for b in notices[1::4]]]
    cut = [" ".join(t.split()[k:]) + " " + " ".join(t.split()[:-k]) for t in notices for k in (2, 5)]
    rows += cut + common
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert {"bsd", "gpl"} <= set(got[0].labels.split(","))
    for i, text in enumerate(rows):
        assert set(filter(None, got[i].labels.split(","))) == labels(text), text
