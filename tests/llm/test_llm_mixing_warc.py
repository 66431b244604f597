import hashlib
import random
import re

import pytest

from wareloom.llm import mixing, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(1, 2, 3), epochs=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:  # reshare the excess until none is above
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > epochs * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
            free.discard(s)


def test_mix_is_fair_queueing(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", "c", "d", None, "hot", "hot", "hot"]), "w " * rng.randrange(0, 60)) for i in range(3000)] + [(5, "tiny", "one two")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix(df).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t))
    want, budget, taken = brute_targets(sizes), sum(sizes.values()), {}
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * budget
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(out) == len(rows) and budget - 60 <= sum(taken.values()) <= budget
    assert all(abs(taken[s] - want[s]) <= 2 * 60 for s in sizes)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, again), key=str)


def test_mix_odd_rows(odd_docs, no_docs, spark):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "s", "")], "doc_id long, source string, text string")
    assert [(r.size, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0), (0, 0)]


def test_one_source_takes_itself(spark):
    df = spark.createDataFrame([(i, "s", "x y z") for i in range(50)], "doc_id long, source string, text string")
    assert [(r.target, r.taken) for r in mixing.mix(df).collect()] == [(150.0, 3)] * 50


def test_mixing_plan_is_native(odd_docs):
    assert "Python" not in mixing.mix(odd_docs)._jdf.queryExecution().executedPlan().toString()


PAGES = [(5, "http://a/", "<p>" + "same payload " * 20), (3, "http://b/", "<p>" + "same payload " * 20), (9, None, "<p>" + "same payload " * 20), (None, "http://c/", "<p>" + "same payload " * 20),
         (1, "http://d/\r\nX-Page-Id: 7", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n" * 10 + "é"), (8, "u", "x" * 99), (10, "u", "x" * 99),
         (11, "u", "y" * 100), (12, "u", "y" * 100), (13, "u", "ü" * 1_000_000), (13, "u", "ü" * 1_000_000)]


def test_archives_round_trip(spark, tmp_path):
    df = spark.createDataFrame([p + ("t", "r") for p in PAGES], "page_id long, url string, html string, record_type string, payload string").repartition(4)
    path = str(tmp_path / "warc")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive(df, path).collect()), key=str)
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        again = len(raw) >= 100 and i != first[h or ""]
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None))
    assert got == sorted(want, key=str)
    import gzip
    import pathlib

    records = [x for f in pathlib.Path(path).glob("part-*") for x in warc.parse(gzip.decompress(f.read_bytes()))]
    assert len(records) == len(PAGES)
    for fields, block in records:
        assert int(fields["Content-Length"]) == len(block) and fields["WARC-Record-ID"].startswith("<urn:uuid:")
        assert fields["WARC-Type"] == "response" or block == b"" and "WARC-Refers-To" in fields


def test_archives_of_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive(df, str(tmp_path / "none")).count() == 0


def test_broken_archive_raises():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\n\r\n"))


def test_mixing_keeps_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", "x y", "k", 7, "s"), (2, "b", "z", "k", 7, "s")], "doc_id long, source string, text string, _key string, _slice int, _until string")
    rows = mixing.mix(df).collect()
    assert len(rows) == 2 and all((r._key, r._slice, r._until) == ("k", 7, "s") for r in rows)
