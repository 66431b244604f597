import random
import re

import numpy as np
import pytest

from wareloom.llm import near_dup as nd
from wareloom.llm.components import components

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = SPACE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return set() if not w else {tuple(w)} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k=4, percent=80):
    sets = [(d, shingle_set(t, k)) for d, t in rows]
    comp = {i: i for i in range(len(rows))}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                comp[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s), least[root(i)], d == least[root(i)]) for i, (d, s) in enumerate(sets))


def edited(rng, words, times):
    out = list(words)
    for _ in range(times):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def test_chains_and_groups_against_brute_force(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for base in range(12):
        words = [f"b{base}x{rng.randrange(300)}" for _ in range(rng.choice([6, 40, 150]))]
        text = " ".join(words)
        for _ in range(12):  # a chain: each an edit of the one before
            rows.append((n * 7 % 1000, text))
            text = edited(rng, text.split(), rng.choice([0, 1, 2]))
            n += 1
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(60):  # a passage that most of a document's words come from, at similarity about 0.6
        rows.append((2000 + i, passage + " " + " ".join(f"q{i}r{j}" for j in range(14))))
    got = sorted(tuple(r) for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect())
    assert got == brute(rows)


def test_superminhash_registers():
    """Level-wise work gives the minimum over all (element, level) pairs, and estimates the similarity."""
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 3).astype(np.uint64)
    e = nd.mix(hashes + np.uint64(77))
    want = np.full(nd.M, np.iinfo(np.uint64).max, np.uint64)
    seen = []
    for level in range(nd.M):
        at = nd._register(e, level).astype(int)
        seen.append(at)
        value = (np.uint64(level) << np.uint64(48)) | (nd.mix(e + np.uint64((level + 1) * nd.BASE % 2**64)) >> np.uint64(16))
        for a, v in zip(at, value):
            want[a] = min(want[a], v)
    assert all(len(set(x)) == nd.M for x in np.array(seen).T)  # each element visits every register once
    assert (nd.signatures(np.zeros(3, int), hashes, 1)[0] == want).all()
    errors = []
    for _ in range(30):
        pool = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = np.sort(pool[:270]), np.sort(pool[30:])  # 240 / 300
        sig = nd.signatures(np.repeat([0, 1], [270, 270]), np.concatenate([a, b]), 2)
        errors.append((sig[0] == sig[1]).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def test_sketch_keeps_pairs_at_the_limit():
    rng = np.random.default_rng(8)
    for _ in range(40):
        pool = rng.integers(0, 2**63, 1000).astype(np.uint64)
        a, b = np.sort(pool[:900]), np.sort(pool[100:])  # 800 / 1000
        sketch = nd._nibbles(nd.signatures(np.repeat([0, 1], [900, 900]), np.concatenate([a, b]), 2))
        assert nd._EQUAL[sketch[0] ^ sketch[1]].sum() >= nd.least_equal(80)


def test_blocks_against_brute_force(spark, monkeypatch):
    """Stragglers around a large group, over many small blocks."""
    monkeypatch.setattr(nd, "BLOCK", 16)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, edited(rng, words, rng.choice([1, 2, 4, 6, 8]))) for i in range(220)]
    got = sorted(tuple(r) for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect())
    want = brute(rows)
    assert len({r[2] for r in want}) > 20 and got == want


def test_hot_group_gives_few_candidates(spark):
    """400 near copies of one text: linear candidates, one component."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, edited(rng, words, 2)) for i in range(400)]
    out = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in out} == {0} and sum(r.kept for r in out) == 1


def test_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in nd.near_duplicates(odd_docs, k=4).collect()]
    assert len(rows) == odd_docs.count()
    by = {}
    for d, n, c, k in rows:
        by.setdefault(d, []).append((n, c, k))
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)] and by[5] == [(0, 5, True)]
    assert [x[1:] for x in by[7]] == [(6, False)] and [x[1:] for x in by[8]] == [(6, False)]
    assert by[9][0] == by[9][1] and by[9][0][1:] == (9, True)
    assert sorted(by[11]) == [(1, 10, False), (2, 11, True)]  # rows of one doc_id are judged by their own texts
    assert all(x[1] is None and x[2] for x in by[None])
    assert nd.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("n", [0, 1, 50])
def test_components_of_a_path(spark, n):
    links = spark.createDataFrame([((i * 17) % 101, ((i + 1) * 17) % 101) for i in range(n)] + [(500, 501), (501, 500), (7, 7)][: n], "a long, b long").repartition(5)
    got = {r.node: r.component for r in components(links).collect()}
    if n == 50:
        nodes = [(i * 17) % 101 for i in range(51)]
        assert {got[x] for x in nodes} == {min(nodes)} and got[501] == got[500] == 500
    elif n == 0:
        assert got == {}
