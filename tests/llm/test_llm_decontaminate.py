import hashlib
import re

import pytest

from wareloom.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = tokens(text)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, names = tokens(text), set(), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if (got := windows.get(tuple(w[i : i + m]))) is not None:
                    hit |= set(range(i, i + m))
                    names |= got
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def words(a, b):
    return " ".join(f"t{i}" for i in range(a, b))


DOCS = [(1, words(0, 40)), (2, "x " * 30 + words(5, 18).upper() + " y" * 300), (3, words(0, 12)), (4, "alpha, BETA!"), (5, None), (6, ""), (7, "..."),
        (8, words(90, 103) + " q " + words(90, 103) + " alpha beta alpha beta"), (9, "ä" * 5 + " solo solo"), (None, words(3, 30)), (1, words(0, 40)),
        (10, words(0, 50000))]
ITEMS = [(1, words(0, 30)), (10, words(90, 103)), (2, "Alpha beta"), (3, "solo"), (4, ""), (5, None), (None, words(60, 75)), (1, words(0, 30)), (11, words(10, 60))]


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_against_brute_force(spark, block):
    docs = spark.createDataFrame([(d, t, "z") for d, t in DOCS], "doc_id long, text string, n_hit string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [tuple(r) for r in decontaminate(docs, items, block_bytes=block).drop("text").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(brute(DOCS, ITEMS), key=key)


def test_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate(no_docs, items).count() == 0
    rows = decontaminate(odd_docs, items.limit(0)).collect()
    assert len(rows) == odd_docs.count() and not any(r.contaminated or r.n_hit for r in rows)


def test_repeated_items_do_not_fill_a_block(spark):
    from wareloom.llm import decontaminate as dc

    text = "one two three four five six seven " * 10
    items = spark.createDataFrame([(1, text)] * 500 + [(2, text), (3, "other words " * 20)], "item_id long, text string")
    blocks = list(dc._blocks(items, 1 << 20))
    assert sorted(x for b in blocks for x in b) == sorted([("1", text), ("2", text), ("3", "other words " * 20)])
    many = spark.createDataFrame([(i, f"{i} {text}") for i in range(64)], "item_id long, text string")
    sizes = [sum(len(t) + 16 for _, t in b) for b in dc._blocks(many, 4000)]
    assert len(sizes) > 4 and max(sizes) <= 2 * 4000
