import itertools
import math

import numpy as np

from pyspark.sql import functions as F

import corpus_pipeline
from wareloom.llm import quality as q


def test_messages_against_enumeration():
    rng = np.random.default_rng(4)
    s, stay = rng.standard_normal(9), np.array([0.7, 1.3])
    first = np.array([0, 4, 5, 9])
    f, b = q.messages(s, first, stay)
    for a, e in zip(first[:-1], first[1:]):
        good, total = np.zeros(e - a), 0.0
        for y in itertools.product((0, 1), repeat=int(e - a)):
            w = math.exp(sum(s[a + i] for i in range(e - a) if y[i]) + sum(stay[y[i]] for i in range(1, e - a) if y[i] == y[i - 1]))
            good += w * np.array(y)
            total += w
        assert np.allclose(q._sigmoid((f + b)[a:e]), good / total)


def test_line_features():
    raw = b"ab AB ab ab\n\n|!x\n"
    data = np.frombuffer(raw + b"" + b"zz", dtype=np.uint8)
    own, size, first = q.line_features(data, np.array([0, 0, len(raw), len(raw) + 2]))
    assert size.tolist() == [0, 11, 0, 3, 0, 2] and first.tolist() == [0, 1, 5, 6]
    assert math.isclose(own[1][0], 6 / 11, rel_tol=1e-6) and own[1][-1] == 0 and own[0][-1] == 1
    assert math.isclose(own[1][q.CLASSES + 3], 2 / 4 + 1 / 4, rel_tol=1e-6)  # AB repeats ab, ab ab; case is folded


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    from wareloom.llm.queries import op10_quality_crf

    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    out = op10_quality_crf(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in out.join(labels, "doc_id").collect() if r.held_out]
    assert len(held) > 50 and sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in held)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, None), (7, 0, 0), (9, 0, 1), (9, 0, 1), (99, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = q.classify(odd_docs, labels)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert {r.score for r in q.classify(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in q.classify(odd_docs, labels.where("quality = 1")).collect()} == {1.0}
    assert q.classify(no_docs, labels).count() == 0


def test_line_odds_are_those_of_the_wide_matrix(monkeypatch):
    monkeypatch.setattr(q, "BLOCK", 3)
    rng = np.random.default_rng(7)
    own, first = rng.standard_normal((11, q.WIDTH)), np.array([0, 1, 6, 11])
    model = {"mean": rng.standard_normal(q.WIDTH), "spread": rng.random(q.WIDTH) + 0.5, "w": rng.standard_normal(3 * q.WIDTH + 3)}
    wide = q.with_neighbours((own - model["mean"]) / model["spread"], first) @ model["w"]
    assert np.allclose(q.line_odds(model, own, first), wide)


def test_the_sample_gives_no_document_up():
    assert q.allowance([5, 5, 5], 100) == 5 and q.allowance([], 100) == 1
    for lines, total in (([100, 1, 2, 50], 60), ([1000] * 10, 50), ([7, 7, 7], 2)):
        most = q.allowance(lines, total)
        assert most >= 1 and sum(min(n, most) for n in lines) <= max(total, len(lines))
        assert sum(min(n, most + 1) for n in lines) > total
    assert q.parts(10, 10) == [(0, 10)]
    for n, most in ((1000, 130), (1000, 1), (65, 64), (10**6, 999)):
        runs = q.parts(n, most)
        assert all(b - a <= q.CHAIN and 0 <= a < b <= n for a, b in runs) and sum(b - a for a, b in runs) <= most
        assert all(x[1] <= y[0] for x, y in zip(runs, runs[1:])) and (len(runs) == 1 or runs[-1][1] == n)


def test_a_long_labelled_document_leaves_the_others_in(spark, monkeypatch):
    """Bound of 50 lines, one document of 100: the model is still that of the labels."""
    monkeypatch.setattr(q, "SAMPLE_LINES", 50)
    good, bad = "This is a fine sentence of plain words.", "$$$ BUY!!! NOW|||"
    texts = [(i, "\n".join([good if i % 2 else bad] * (100 if i == 4 else 3))) for i in range(12)]
    docs = spark.createDataFrame(texts + texts[:2], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] * 2, "doc_id long, quality int")
    model = q.train(docs, labels)
    assert "curve" in model
    rows = q.score(docs, model).collect()
    assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in rows) and len(rows) == 14


def test_the_operator_against_a_plain_computation(spark):
    """Scores of the whole operator against enumerated labelings of each text's lines, with the fitted model."""
    good, bad = "This is a fine sentence of plain words.", "$$$ BUY!!! NOW|||"
    docs = spark.createDataFrame([(i, "\n".join([good if (i + j) % 3 else bad for j in range(i % 5)])) for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(30)], "doc_id long, quality int")
    model = q.train(docs, labels.where(~q.held_out()))
    want = {}
    for r in docs.collect():
        raw = np.frombuffer(r.text.encode(), np.uint8)
        own, size, first = q.line_features(raw, np.array([0, len(raw)]))
        s = q.with_neighbours((own - model["mean"]) / model["spread"], first) @ model["w"]
        marginal, total = np.zeros(len(s)), 0.0
        for y in itertools.product((0, 1), repeat=len(s)):
            w = math.exp(sum(a for a, b in zip(s, y) if b) + sum(model["stay"][y[i]] for i in range(1, len(s)) if y[i] == y[i - 1]))
            marginal, total = marginal + w * np.array(y), total + w
        quality = float((marginal / total * (size + 1)).sum() / (size + 1).sum())
        odds = math.log(min(max(quality, 1e-6), 1 - 1e-6) / (1 - min(max(quality, 1e-6), 1 - 1e-6)))
        want[r.doc_id] = 1 / (1 + math.exp(-(odds * model["curve"][0] + model["curve"][1])))
    out = q.classify(docs, labels).collect()
    assert len(out) == 30 and all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-6) for r in out)


def test_near_dedup_of_rows_that_share_ids(spark):
    """Each row is judged by its own text: the copy goes though its doc_id stays with another text."""
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base), (2, base + " z"), (2, other), (3, other + " y"), (4, ""), (4, other + " x"), (5, base), (5, base), (6, "own " + " ".join(f"u{i}" for i in range(9))), (6, base + " q")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t), "x") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string")
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    assert plain((r.doc_id, r.text) for r in out.collect()) == plain([(1, base), (2, other), (4, ""), rows[8]])
    twins = spark.createDataFrame([(7, base), (7, base + " b")], "doc_id long, text string")
    assert corpus_pipeline.near_dedup(spark, twins, "").count() == 1


def test_mixing_of_one_text_in_two_sources(spark):
    from wareloom.llm.mixing import mix

    rows = [(1, "A", "one two three"), (1, "B", "one two three"), (2, "A", "four five"), (3, None, "six"), (3, None, "six"), (4, "B", "seven " * 9), (4, "B", None)]
    docs = spark.createDataFrame([(d, t, "en", s, 1, "x") for d, s, t in rows], "doc_id long, text string, lang string, source string, n_chars long, digest string")
    got = {}
    for r in corpus_pipeline.mixing(spark, docs, "").collect():
        assert (r.doc_id, r.source, r.text) not in got and r.digest == "x"
        got[r.doc_id, r.source, r.text] = (r["size"], r.source_size, r.target, r.taken)
    want = {}
    plan = mix(docs.withColumn("copy_of", F.col("text"))).where("taken > 0").collect()
    for r in plan:
        k = (r.doc_id, r.source, r.copy_of)
        want[k] = (r["size"], r.source_size, r.target, r.taken + (want[k][3] if k in want else 0))
    assert got == want and len(got) >= 3


def plain(rows):
    return sorted(map(tuple, rows), key=str)


def test_stages_on_odd_rows(spark, odd_docs, no_docs, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "mixing":
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "line_dedup":
            assert out.count() == docs.count()
        if name == "near_dedup":
            assert 6 in kept and 7 not in kept and 8 not in kept and None in kept
            assert out.where("doc_id = 9").count() == 1
        if name == "decontamination":
            assert not kept & {10} and {1, 6, 9} <= kept
        if name == "mixing":
            assert out.where("taken <= 0 or taken > 3 * size").count() == 0


def test_pipeline_against_its_stages(spark, sf):
    """Near-dedup and decontamination of the pipeline's own input against brute force."""
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parent))
    from test_llm_decontaminate import brute as contaminated
    from test_llm_lines_tokens import brute_lines
    from test_llm_near_dup import brute as groups

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]
    good = stages["quality"](spark, docs, sf).collect()
    df = spark.createDataFrame(good, docs.schema)
    lined = stages["line_dedup"](spark, df, sf)
    want = [(d, t) for d, t, _, _ in brute_lines([(r.doc_id, r.text) for r in good])]
    assert plain((r.doc_id, r.text) for r in lined.collect()) == plain(want)
    assert lined.where("n_chars <> length(text)").count() == 0
    near = stages["near_dedup"](spark, lined, sf)
    keep = {d for d, _, _, k in groups(want, k=5) if k}
    assert plain((r.doc_id, r.text) for r in near.collect()) == plain((d, t) for d, t in want if d in keep)
    clean = stages["decontamination"](spark, near, sf)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated([(d, t) for d, t in want if d in keep], items) if r[-1]}
    assert {r.doc_id for r in clean.collect()} == keep - bad
    last = stages["mixing"](spark, clean, sf)
    whole = corpus_pipeline.run(spark, sf)
    assert plain(last.collect()) == plain(whole.collect())
