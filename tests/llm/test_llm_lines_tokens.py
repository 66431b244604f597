import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wareloom.llm import token_counts as tc
from wareloom.llm.line_dedup import dedup_lines
from wareloom.llm.mph import PerfectHash, build

SPACE = " \t\n\x0b\x0c\r"


def brute_lines(rows, least=10):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(SPACE))
    owners = {}
    for d, t in rows:
        if d is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= least:
                    owners.setdefault(key(x), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(owners.get(key(x), ())) < 2 or min(owners[key(x)]) == d]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("group", [1 << 20, 1])
def test_lines_against_brute_force(spark, odd_docs, group, monkeypatch):
    from wareloom.llm import line_dedup

    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 7)
    rows = [(i, "\n".join(f"  Line number {(i * j) % 23} {'é' * 3}" if j % 3 else f"s{j % 5}" for j in range(i % 9))) for i in range(40)]
    rows += [(r.doc_id, r.text) for r in odd_docs.collect()]
    df = spark.createDataFrame([(d, t, "c", "m", 5) for d, t in rows], "doc_id long, text string, n_dropped string, marked string, row int")
    out = dedup_lines(df, group_bytes=group)
    assert out.columns == ["doc_id", "text", "marked", "row", "n_lines", "n_dropped"]
    got = [tuple(r) for r in out.select("doc_id", "text", "n_lines", "n_dropped").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(brute_lines(rows), key=key)


def test_lines_of_few_documents_can_stay(spark):
    rows = [(i, "held by three\n" + ("held by just two" if i < 2 else "held by nobody else")) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_dropped for r in dedup_lines(df, min_docs=3).orderBy("doc_id").collect()] == [0, 1, 1]
    assert [r.n_dropped for r in dedup_lines(df).orderBy("doc_id").collect()] == [0, 2, 1]


def test_lines_empty_and_extra_columns(odd_docs, no_docs):
    out = dedup_lines(odd_docs)
    assert out.count() == odd_docs.count() and {"size", "taken", "n_dropped"} <= set(out.columns)
    assert dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
    h = PerfectHash(build(keys))
    assert sorted(h.index(keys).tolist()) == list(range(len(keys)))
    other = np.arange(10, dtype=np.uint64)
    assert ((h.index(other) >= -1) & (h.index(other) < max(1, len(keys)))).all()


def test_perfect_hash_with_equal_keys():
    h = PerfectHash(build(np.array([5, 5, 9], dtype=np.uint64)))
    assert len(set(h.index(np.array([5, 9], dtype=np.uint64)).tolist())) == 2


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \n\t▁.,é日<s>/0 ")) | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_pre_token_lengths_add_up(text):
    sp = tc.load(tc.model_path())
    assert sum(tc.length(sp, t) * n for t, n in tc.pre_tokens(text).items()) == len(sp.encode(text))


def test_counts_on_whole_table_and_odd_rows(spark, sf, odd_docs, no_docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tc.model_path())
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    for df, few in ((docs, tc.FREQUENT), (odd_docs, 3)):
        got = tc.count_tokens(df, frequent=few).select("text", "n_bytes", "n_tokens", "over_limit").collect()
        assert len(got) == df.count()
        for r in got:
            n = len(sp.encode(r.text or ""))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 4096)
    assert tc.count_tokens(no_docs).count() == 0


def test_tables_hold_no_long_pre_tokens(spark):
    import pyarrow as pa

    long = "\u65e5\u672c\u8a9e" * 5000
    docs = spark.createDataFrame([(1, f"{long} {long} word word"), (2, long), (3, "word")], "doc_id long, text string")
    assert set(tc.frequent_lengths(docs, tc.model_path())) == {"word"}
    batches = tc._frequent([pa.RecordBatch.from_arrays([pa.array([long, "a " + long])], ["text"])])
    assert [t for b in batches for t in b.column("token").to_pylist()] == ["a"]
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(docs).collect()}
    sp = tc.load(tc.model_path())
    assert got == {1: len(sp.encode(f"{long} {long} word word")), 2: len(sp.encode(long)), 3: 1}


def test_a_large_index_stays_in_its_tasks(spark, monkeypatch):
    """Beyond the broadcast bound: a hot line is dealt over salts, no shard reaches the driver, small sort batches split shards."""
    from pyspark.sql import DataFrame

    from wareloom.llm import line_dedup

    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 5)
    rows = [(i, "the very same line everywhere\n" + "\n".join(f"line {j} of a few documents" for j in range(i % 50))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = []
    monkeypatch.setattr(DataFrame, "collect", lambda self, real=DataFrame.collect: seen.append(self.columns) or real(self))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = dedup_lines(df, group_bytes=1)
        assert not any("hash" in c for c in seen)
        got = sorted(tuple(r) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert got == sorted(brute_lines(rows))
