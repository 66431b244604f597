import math

import numpy as np
import pytest

from wareloom.llm import embedding_dedup as ed


def brute(rows, cosine=0.95):
    ok = [(i, v, ed.unit(x)) for i, (v, x) in enumerate(rows)]
    links = {i: [] for i, _, _ in ok}
    for i, v, x in ok:
        for j, w, y in ok[:i]:
            if None not in (v, w) and x is not None and y is not None and len(x) == len(y) and float((x * y).sum()) >= cosine:
                links[i].append(j)
                links[j].append(i)
    out = []
    for i, v, _ in ok:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min(rows[j][0] for j in seen) if v is not None else None
        out.append((v, len(links[i]), c, v is None or c == v))
    return out


@pytest.mark.parametrize("few", [0, 16])
def test_against_brute_force_in_full(spark, monkeypatch, few):
    monkeypatch.setattr(ed, "FEW", few)
    rng = np.random.default_rng(3)
    rows = []
    for c in range(6):
        center = rng.standard_normal(16)
        for _ in range(rng.choice([1, 5, 300])):  # over one block
            rows.append(center + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.2]))
    rows += [rng.standard_normal(16) for _ in range(100)]
    rows += [[0.0] * 16, None, [], [1.0, float("nan")], [float("inf")] * 16, [None, 1.0], [1e300, 1e300], [2e300, 2e300], [3.0], [5.0], [-5.0]]
    rows = [(int((k * 37) % 4001), None if x is None else [None if v is None else float(v) for v in x]) for k, x in enumerate(rows)]
    rows += [rows[0], (rows[1][0], rows[2][1]), (None, rows[0][1]), (None, None)]
    df = spark.createDataFrame([(v, x, "k", "n") for v, x in rows], "vec_id long, embedding array<double>, n_links string, kept string")
    got = [tuple(r) for r in ed.near_vectors(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert ed.near_vectors(df.limit(0)).count() == 0


def test_collision_probability():
    rng = np.random.default_rng(0)
    for d in (0.2, 0.7, 1.4):
        a = rng.standard_normal(200_000)
        u = rng.uniform(0, ed.WIDTH, 200_000)
        same = (np.floor(u / ed.WIDTH) == np.floor((u + d * a) / ed.WIDTH)).mean()
        assert math.isclose(same, ed.collision(d), abs_tol=0.005)
    for n in (10, 10**5, 10**9):
        k, tables = ed.parameters(n, 0.95)
        assert (1 - ed.collision(math.sqrt(0.1)) ** k) ** tables <= ed.MISS * 1.01
        assert ed.collision(math.sqrt(2)) ** k <= 0.25 / n * 1.01
