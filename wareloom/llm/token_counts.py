"""Token counts by a two-tier lookup of pre-token lengths.

For a sentencepiece model whose pieces hold the space mark only in front (and
no line feed), a text's tokens are the sum over its pre-tokens: a run of space
marks with the characters up to the next space or line feed, or a line feed
with the characters up to the next.  No merge crosses their borders, so each
can be encoded alone; the model is checked for this.

How: every task counts the pre-tokens of its texts with bounded memory and
hands up its most frequent ones; the ``frequent`` most frequent of all are
encoded once and broadcast as a hash table from pre-token to length.
Documents look up that table, then the worker's cache of earlier misses, and
encode what is left.  Pre-tokens are never shuffled; only the bounded lists of
the tasks are.  The table only saves time: counts do not depend on it.  Table, lists
and cache hold pre-tokens of at most ``KEPT_CHARS`` characters, so their bytes are
bounded with their entries; longer ones (a line without spaces, say) are encoded where they stand.

Defined cases: null text is empty; an empty text has 0 bytes and 0 tokens;
repeated rows are counted one by one; an empty table gives no rows;
``n_bytes``, ``n_tokens`` and ``over_limit`` of the input are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.session import ship_package

MODEL = "piece_bpe_32k.model"
FREQUENT, PER_TASK, HELD, CACHED = 1 << 16, 1 << 13, 1 << 18, 1 << 18
KEPT_CHARS = 48
MARK = "▁"
_SLOW = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*")
_models: dict = {}


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """The processor of a model file, once per process; refuses a model that pre-tokens cannot be cut from."""
    if path not in _models:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if MARK in piece.lstrip(MARK) or "\n" in piece and len(piece) > 1:
                raise ValueError(f"piece {piece!r} crosses pre-tokens")
        for probe in ("a", " a  b", "a\nb \n c ", "  "):
            if sum(length(sp, t) * n for t, n in pre_tokens(probe).items()) != len(sp.encode(probe)):
                raise ValueError(f"{path} does not split into pre-tokens")
        _models[path] = sp
    return _models[path]


def pre_tokens(text: str) -> Counter:
    """Pre-tokens with counts; the first space mark of each is left out."""
    if not text:
        return Counter()
    if "  " in text or " \n" in text or text[0] == " " or text[-1] == " " or MARK in text:
        return Counter([t[1:] if t[0] == MARK else t for t in _SLOW.findall(MARK + text.replace(" ", MARK))])
    return Counter(text.replace("\n", " \n").split(" "))


def length(sp, token: str) -> int:
    """Tokens of one pre-token."""
    if not token:
        return 1  # a space mark alone
    n = len(sp.encode(token.replace(MARK, " ")))
    return n - 1 if token[0] == "\n" else n  # a line feed stands without the mark that the library puts first


def _frequent(batches):
    """Task: the most frequent pre-tokens; counts under 2 go when more than HELD are held."""
    held: Counter = Counter()
    for batch in batches:
        for text in batch.column("text"):
            held.update({t: n for t, n in pre_tokens(text.as_py() or "").items() if len(t) <= KEPT_CHARS})
            if len(held) > HELD:
                held = Counter(dict(held.most_common(HELD // 4)))
    top = held.most_common(PER_TASK)
    if top:
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["token", "n"])


def frequent_lengths(docs: DataFrame, path: str, frequent: int = FREQUENT) -> dict[str, int]:
    tops = docs.select("text").mapInArrow(_frequent, "token string, n long")
    best = tops.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(frequent)
    sp = load(path)
    return {r.token: length(sp, r.token) for r in best.select("token").toLocalIterator()}


def _count(path: str, table):
    def run(batches):
        sp, known, cache = load(path), table.value, {}
        for batch in batches:
            out = []
            for text in batch.column("text"):
                n = 0
                for token, times in pre_tokens(text.as_py() or "").items():
                    size = known.get(token)
                    if size is None:
                        size = cache.get(token)
                        if size is None:
                            size = length(sp, token)
                            if len(token) <= KEPT_CHARS:
                                if len(cache) >= CACHED:
                                    cache.clear()
                                cache[token] = size
                    n += size * times
                out.append(n)
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            columns["n_tokens"] = pa.array(out, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""
    sc = docs.sparkSession.sparkContext
    ship_package(docs.sparkSession)
    path = path or model_path()
    plain = docs.drop("n_bytes", "n_tokens", "over_limit")
    table = sc.broadcast(frequent_lengths(docs, path, frequent))
    sized = plain.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema.fields)
    out = sized.mapInArrow(_count(path, table), f"{schema}, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
