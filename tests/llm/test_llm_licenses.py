"""License scan against a plain search."""

import re

import pytest

from reelmetrics.llm import licenses
from reelmetrics.llm.common import WORD


def _words(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _matches(text, templates, threshold):
    """Per template the best share of a block, and the first block with it that begins with a word of the template."""
    out, held = set(), _words(text)
    for label, template in templates.items():
        words, size = set(template.split()), licenses.block_words(template)
        best = {}
        for i, w in enumerate(held):
            if w in words:
                best.setdefault(len(words & set(held[i : i + size])), i)
        if best and max(best) >= threshold * len(words) - 1e-9:
            out.add((label, best[max(best)], max(best) / len(words)))
    return out


def _expected(i, text):
    words = _words(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
        places += found
        base |= {label} if found else set()
    matches = _matches(text, licenses.TEMPLATES, 0.8)
    labels = base | {m[0] for m in matches}
    score = 1.0 if base else max((m[2] for m in matches), default=0.0)
    ends = (min(places), max(places)) if places else (None, None)
    return (i, len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score)


GRANT = licenses.TEMPLATES["mit-grant"]
EXTRA = [
    (1, "Apache License apache-license; APACHE  LICENSE v2 gnu general public license gnu general public general public license"),
    (2, "MIT\nLicense mit license mit license cc/by CC_BY"),
    (3, "Redistribution and use in source and binary forms, with or without modification,\nare permitted"),
    (4, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that conditions are met"),
    (5, "éapache license café cc by nc"),
    (6, None),
    (7, ""),
    (7, "licensed under cc by sa 4.0"),
    (8, GRANT.replace(" ", "\n * ")),
    (9, "Redistribution and use in source and binary\nforms, with or without modification, are\npermitted provided that the following conditions\nare met:"),
    (10, "This Source Code Form is subject to the\n// terms of the Mozilla Public\n// License, v. 2.0."),
    (11, "released " + "x " * 120 + "under the mit " + "y " * 200 + "license"),
    (12, "a b " * 50 + "released under mit license " + "c d " * 50 + "released under the mit license"),
    (13, "released under the"),
    (14, "mit"),
]


def test_wrapped_notices_and_scattered_words(spark):
    got = {r.doc_id: r.labels.split(",") for r in licenses.license_scan(spark.createDataFrame(EXTRA, "doc_id bigint, text string")).collect()}
    assert "mit-grant" in got[8] and "bsd-terms" in got[9] and "mpl-notice" in got[10]
    assert got[11] == [""] and got[12] == ["mit", "mit-notice"] and got[13] == got[14] == [""]


def test_tables(spark, docs, odd, nothing):
    for table in (docs, odd, nothing, spark.createDataFrame(EXTRA, "doc_id bigint, text string")):
        rows = table.select("doc_id", "text").collect()
        got = sorted(map(tuple, licenses.license_scan(table).collect()), key=repr)
        assert got == sorted((_expected(*r) for r in rows), key=repr)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.75, 1.0])
def test_join_is_exact(spark, docs, threshold):
    templates = {"a": "the and of that", "b": "die der und", "c": "the zebra", "d": "", "e": "is"}
    texts = [r["text"] for r in docs.collect()]
    expected = sorted(m for t in {_lower(t) for t in texts} for m in _matches(t, templates, threshold))
    found = licenses.template_matches(docs, templates=templates, threshold=threshold).collect()
    assert sorted((r.label, r.start, r.containment) for r in found) == expected
    assert licenses.template_matches(docs, templates={"d": " "}, threshold=threshold).collect() == []


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
