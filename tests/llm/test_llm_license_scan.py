import re

import pytest

from wareloom.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates=ls.TEMPLATES, phrases=ls.PHRASES, k=ls.K, gap=ls.GAP, cover=ls.COVER):
    w = words(text)
    base = [(i, label) for phrase, label in phrases for p in [words(phrase)] for i in range(len(w)) if p and w[i : i + len(p)] == p]
    share, spans = 0.0, []
    for label, t in ((label, words(t)) for label, t in templates):
        size = min(k, len(t))
        votes = [(i, j) for i in range(len(w) - size + 1) for j in range(len(t) - size + 1) if t and w[i : i + size] == t[j : j + size]]
        bands = []
        for d in sorted({i - j for i, j in votes}):
            if not bands or d - bands[-1][-1] > gap:
                bands.append([])
            bands[-1].append(d)
        for band in bands:
            mine = [(i, j) for i, j in votes if i - j in band]
            covered = len({j + x for _, j in mine for x in range(size)})
            share = max(share, covered / len(t))
            if covered * 100 >= len(t) * cover:
                spans.append((label, min(i for i, _ in mine), max(i for i, _ in mine) + size - 1, covered, len(t)))
    labels = {x for _, x in base}
    at = [i for i, _ in base]
    return (len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {s[0] for s in spans})), 1.0 if base else share, sorted(spans))


MIT = ls.TEMPLATES[0][1]
TEXTS = [
    MIT, "x y z " + MIT.replace("without limitation", "with no limit and no bound at all").upper() + " tail", MIT + "\n" + MIT, " ".join(MIT.split()[:60]),
    "Released under the MIT License. mit-license MIT  LICENSE", "the Apache License, the general public license; apache. license", "Licensed under CC BY-NC 4.0", "licensed under cc by",
    ls.TEMPLATES[2][1].replace("any later version", "any newer one"), "permission is hereby granted " * 500, "mit", "license mit license", "Licence ünder MIT License日本", "",
    "Redistribution and use in source and (binary) forms, with or without any modification, are permitted provided that the following conditions are met",
]


def rows(out):
    return sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, [tuple(s) for s in r.spans]) for r in out.collect()], key=lambda r: (r[0] is None, str(r)))


def test_planted_texts_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, labels string, hash int")
    out = ls.scan(df)
    assert "hash" in out.columns and out.columns.count("labels") == 1
    got = rows(out)
    assert got == sorted([(i, *brute(t)) for i, t in enumerate(TEXTS)], key=lambda r: (False, str(r)))
    found = {r[0]: r[6] for r in got}
    assert found[0] == found[1] == found[2] == "mit" and found[3] == "" and found[6] == "cc-by-nc" and found[8] == "gpl" and found[14] == "bsd"
    assert [len(r[8]) for r in got if r[0] == 2] == [2]  # two copies are two spans


@pytest.mark.parametrize("gap,cover,k", [(0, 50, 3), (100, 95, 2)])
def test_other_parameters(spark, gap, cover, k):
    templates = [("a", "one two three four five"), ("b", "one"), ("none", " - "), (None, "never shown")]
    phrases = [("three", "c"), ("", "empty"), ("four five", "d")]
    texts = ["one two three", "one x two three four five", "zero", None, "one two three x four five one two three four five", "ONE"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, *brute(t, [x for x in templates if x[0]], phrases, k, gap, cover)) for i, t in enumerate(texts)]
    assert rows(ls.scan(df, templates, phrases, k, gap, cover)) == sorted(want, key=lambda r: (False, str(r)))


def test_odd_rows_and_a_shuffled_gram_join(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(ls, "BROADCAST_GRAMS", 0)
    texts = odd_docs.select("doc_id", "text")
    assert rows(ls.scan(odd_docs)) == sorted([(r.doc_id, *brute(r.text)) for r in texts.collect()], key=lambda r: (r[0] is None, str(r)))
    assert ls.scan(no_docs).count() == 0


def test_no_python_and_no_shuffled_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rest = [f for f in docs.schema.fields if f.name != "text"]
    plan = ls._matches(docs, *ls.template_grams(spark, ls.TEMPLATES, ls.PHRASES), rest)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan and "InArrow" not in plan
