import math

import numpy as np
import pytest

from wareloom.llm import language_id as li
from wareloom.llm.token_counts import model_path


def brute(vocabulary, word, p):
    """Sum over all segmentations, one by one."""
    known = {t: i for i, t in enumerate(vocabulary.texts)}

    def walk(rest):
        if not rest:
            return 1.0
        total = 0.0
        for n in range(1, len(rest) + 1):
            i = known.get(rest[:n], vocabulary.n - 1 if n == 1 else None)
            if i is not None:
                total += p[i] * walk(rest[n:])
        return total

    return walk(li.MARK + word)


def test_forward_sums_all_segmentations():
    v = li.pieces(model_path())
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(v.n), size=2).T
    words = ["the", "a", "\u00fcber", "x\ua66e", "international"]
    got = li.score_words(v, words, p)
    for i, w in enumerate(words):
        for lang in range(2):
            assert math.isclose(got[i, lang], math.log(brute(v, w, p[:, lang])), rel_tol=1e-9)


def test_expected_counts_are_the_gradient():
    v = li.pieces(model_path())
    p = np.full((v.n, 1), 1e-9)
    for t in ("\u2581", "t", "h", "e", "th", "he", "\u2581t", "the"):
        p[v.texts.index(t)] = 0.1
    counts = li.expected_counts(v, ["the"], np.array([[2.0]]), p)
    # every segmentation's characters add up to the word's
    lengths = np.array([len(t) for t in v.texts] + [1])
    assert math.isclose(float(lengths @ counts[:, 0]), 2 * len("the") + 2, rel_tol=1e-9)
    eps, i = 1e-6, v.texts.index("th")
    q = p.copy()
    q[i] += eps
    slope = (li.score_words(v, ["the"], q) - li.score_words(v, ["the"], p))[0, 0] / eps
    assert math.isclose(2 * slope * p[i, 0], counts[i, 0], rel_tol=1e-3)


def brute_long(vocabulary, word, p):
    """log of the sum over all segmentations, by a plain table of log sums."""
    known = {t: i for i, t in enumerate(vocabulary.texts)}
    text, table = li.MARK + word, [0.0]
    for j in range(1, len(text) + 1):
        terms = []
        for n in range(1, min(j, vocabulary.longest) + 1):
            i = known.get(text[j - n : j], vocabulary.n - 1 if n == 1 else None)
            if i is not None:
                terms.append(table[j - n] + math.log(p[i]))
        top = max(terms)
        table.append(top + math.log(sum(math.exp(t - top) for t in terms)))
    return table[-1]


def long_words():
    rng = np.random.default_rng(5)
    letters = np.array(list("thearinogs\u00fc\u65e5\ua66e"))
    return ["".join(rng.choice(letters, n)) for n in (33, 34, 40, 40, 64, 129, 1000, 2500)] + ["t" * 3000, "\ua66e" * 1500]


def test_runs_of_any_length_are_summed_whole(monkeypatch):
    v = li.pieces(model_path())
    p = np.random.default_rng(0).dirichlet(np.ones(v.n), size=3).T
    words = long_words()
    for block in (li.LONG_BLOCK, 50):
        monkeypatch.setattr(li, "LONG_BLOCK", block)
        got = li.score_words(v, words, p)
        for i, w in enumerate(words):
            for lang in range(3):
                assert math.isclose(got[i, lang], brute_long(v, w, p[:, lang]), rel_tol=1e-9)
    # the two ways of working a word agree where both apply
    monkeypatch.setattr(li, "RUN", 4)
    short = ["international", "the\u65e5the", "thinking"]
    rolled = li.score_words(v, short, p)
    counts = np.array([[1.0, 0, 2], [3, 1, 0], [0, 1, 1]])
    rolled_counts = li.expected_counts(v, short, counts, p)
    monkeypatch.setattr(li, "RUN", 32)
    assert np.allclose(rolled, li.score_words(v, short, p)) and np.allclose(rolled_counts, li.expected_counts(v, short, counts, p))


def test_expected_counts_of_long_runs(monkeypatch):
    v = li.pieces(model_path())
    p = np.random.default_rng(1).dirichlet(np.ones(v.n), size=2).T
    words = long_words()
    counts = np.random.default_rng(2).integers(0, 3, (len(words), 2)).astype(float)
    want = li.expected_counts(v, words, counts, p)
    monkeypatch.setattr(li, "LONG_BLOCK", 40)
    assert np.allclose(want, li.expected_counts(v, words, counts, p), rtol=1e-7, atol=1e-12)
    # expected uses, weighted by their lengths, make up all characters
    lengths = np.array([len(t) for t in v.texts] + [1])
    assert np.allclose(lengths @ want, counts.T @ np.array([len(w) + 1 for w in words]), rtol=1e-7)
    eps, i, lang = 1e-7, v.texts.index("th"), 1
    q = p.copy()
    q[i, lang] += eps
    slope = ((li.score_words(v, words, q) - li.score_words(v, words, p))[:, lang] * counts[:, lang]).sum() / eps
    assert math.isclose(slope * p[i, lang], want[i, lang], rel_tol=1e-3)


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(li, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "some text", x) for i, x in enumerate(["a", "b", "c"])], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2"):
        li.train(docs)


def test_many_languages_are_worked_in_small_blocks(monkeypatch):
    v = li.pieces(model_path())
    p = np.random.default_rng(3).dirichlet(np.ones(v.n), size=5).T
    words = [f"word{'abc'[i % 3]}" for i in range(50)]
    want = li.score_words(v, words, p)
    monkeypatch.setattr(li, "CELLS_AT_ONCE", 7)
    assert max(len(at) for at, _ in li._by_length(words, 5)) == 1
    assert np.array_equal(want, li.score_words(v, words, p))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    from wareloom.llm.queries import op2_language_id

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op2_language_id(spark, sf).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd_docs, no_docs):
    rows = li.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {3, 4, 5, 12} <= und and 13 not in und and 1 not in und
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert li.identify(no_docs).count() == 0
    none = li.predict(odd_docs, ([], np.zeros((li.pieces(model_path()).n, 0)), np.zeros(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}
