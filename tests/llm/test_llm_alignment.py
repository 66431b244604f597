import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wareloom.llm import alignment as al
from wareloom.llm import queries


LETTERS = al._byte_letters()


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(al.model_path(al.A_FILE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=al.model_path(al.B_FILE))


def brute_tokens(tokenizers, text):
    """(ids, bytes) of both tokenizers from whole texts, or None."""
    a, b = tokenizers
    want = (" " + (text or "")).encode()
    if not text:
        return None
    one = a.encode(" " + text, add_special_tokens=False)
    bytes_a = [bytes(LETTERS[c] for c in t) for t in one.tokens]
    two = b.encode(text)
    bytes_b = []
    for p in b.encode(text, out_type=str):
        bytes_b.append(bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" and p[-1] == ">" else p.replace("▁", " ").encode())
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    return one.ids, bytes_a, two, bytes_b


def brute(tokenizers, texts):
    held, counts = [], Counter()
    for text in texts:
        got = brute_tokens(tokenizers, text)
        if got is None:
            held.append(None)
            continue
        ids_a, bytes_a, ids_b, bytes_b = got
        ends = [np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b)]
        ending = defaultdict(list)
        for e, j in zip(ends[1], ids_b):
            ending[e].append(j)
        links = [(i, j) for i, e in zip(ids_a, ends[0]) for j in ending.get(e, ())]
        groups, x, y = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            p, q = bisect_left(ends[0], e) + 1, bisect_left(ends[1], e) + 1
            groups.append(",".join(map(str, ids_a[x:p])) + "|" + ",".join(map(str, ids_b[y:q])))
            x, y = p, q
        counts.update(links)
        held.append((len(ids_a), len(ids_b), len(groups), links, ";".join(groups)))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for h in held:
        if h is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((h[0], h[1], h[2], len(h[3]), sum(counts[x] == top[x[1]] for x in h[3]), sum(counts[x] for x in h[3]), h[4]))
    return out


key = lambda r: (r[0] is None, r[0] or 0, r[1:])


@pytest.mark.parametrize("frequent", [1 << 17, 40, 1])
def test_alignment_of_odd_texts(spark, tokenizers, odd_docs, frequent, monkeypatch):
    monkeypatch.setattr(al, "CACHE_CHARS", 100)
    extra = [(20, "<|endoftext|> <s> </s>"), (21, "with ▁ mark"), (22, "a\x00b\x01"), (23, "  two  spaces \n\n x\ty "), (24, "it's we'll ½ ３ \U0001f600 café"), (25, "x"), (26, " ")]
    rows = [(r.doc_id, r.text) for r in odd_docs.collect() if not r.text or len(r.text) < 100_000] + extra
    df = spark.createDataFrame([(*r, "old", 1) for r in rows], "doc_id long, text string, groups string, _row int")
    out = al.align(df, frequent=frequent)
    assert out.columns == ["doc_id", "_row", *al.MADE]
    want = [(d, *w) for (d, _), w in zip(rows, brute(tokenizers, [t for _, t in rows]))]
    assert sorted(map(tuple, out.drop("_row").collect()), key=key) == sorted(want, key=key)


def test_query_on_the_whole_table(spark, tokenizers, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    want = [(d.doc_id, *w[:-1], sha(w[-1])) for d, w in zip(docs, brute(tokenizers, [d.text for d in docs]))]
    out = queries.QUERIES["op11_token_alignment"](spark, sf)
    got = [tuple(r) for r in out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    assert sorted(got) == sorted(want)
    assert {f.dataType.simpleString() for f in out.schema.fields} == {"bigint", "string"}


def test_alignment_of_an_empty_table(spark, no_docs):
    assert al.align(no_docs).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab' \n\t.,1é日_<s>½▁")) | st.characters(exclude_categories=["Cs"]), max_size=80))
def test_segments_give_the_tokens_of_the_whole(text):
    pair = al.load(al.model_path(al.A_FILE), al.model_path(al.B_FILE))
    cut = al.segments(text)
    assert " ".join(cut) == text
    encode = lambda t: pair.a.encode(t, add_special_tokens=False).ids
    assert [i for c in cut for i in encode(" " + c)] == encode(" " + text)
    assert [i for c in cut for i in pair.b.encode(c)] == pair.b.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)))
def test_galloping_ranks(one, two):
    a, b = (np.array(sorted(x), dtype=np.int64) for x in (one, two))
    if len(a):
        assert al.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
    at_a, at_b = al.common_ends(a, b)
    assert a[at_a].tolist() == b[at_b].tolist() == sorted(one & two)
