"""Cross-tokenizer alignment by galloping intersection of token ends.

Tokenizer A is a byte-level BPE file, tokenizer B a sentencepiece model that
puts a space first; both encode space + text, without special tokens.  Byte
offsets at which a token of A and a token of B end cut both into groups.  The
tokens of A and B that end at one such offset are linked; as every token has
bytes, an offset ends one token of each, so there is a link to a group.

How: texts are cut into segments at single spaces between visible characters: no
pre-token of A and no piece of B crosses them (the files are checked for this), so a
segment's end is a common end.  A worker aligns each segment it meets once and keeps it in a
cache of bounded size; a run without such a space is one segment.  New segments are
encoded and their ends laid out on one byte line.  The shorter list of ends
drives the search in the longer: each end gallops (steps of 1, 2, 4 ...) from the rank of
an earlier driving end and finishes by binary search, all ends of a level in
step.  Common ends slice the groups, and rank differences give the token ranges
of a group.  Links are counted by
(A id, B id) in one aggregation.  Documents look up the ``frequent`` most
frequent pairs in a broadcast table of that size; the rarer pairs of each
document, and only those, join the counts, so no pair is hot in that join.

Defined cases: null and empty texts, and those whose joined token bytes differ
from space + text (a text with U+2581, for one), have zeros and empty
``groups``; repeated rows are aligned one by one and all count; an empty table
gives no rows; made columns of the input are replaced.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.llm.text_hash import slices
from wareloom.llm.token_counts import load as load_pieces
from wareloom.llm.token_counts import model_path
from wareloom.session import cut_lineage, ship_package

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
RUN_BYTES, FREQUENT, STRIDE = 1 << 19, 1 << 17, 4
ENCODED, CACHE_CHARS = 1 << 13, 3 << 19  # segments encoded at a time; a worker's cache starts anew beyond so many characters
MARK = "▁"
MADE = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
_loaded: dict = {}


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: visible Latin-1 characters stand for themselves, the rest follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_bytes(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(MARK, " ").encode("utf-8")


class Pair:
    """Both tokenizers of a process: encoders, bytes of every id, and the id texts that make up ``groups``."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        shape = json.loads(self.a.to_str())
        pre = shape["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or shape["normalizer"]:
            raise ValueError(f"{path_a} is not a plain byte-level tokenizer")
        self.b = load_pieces(path_b)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        self.bytes_b = [_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        if not all(self.bytes_a[i] for i in vocabulary.values()) or not all(self.bytes_b):
            raise ValueError("a token without bytes ends nowhere")
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.cache = Segments()
        self.digits = [b"%d%s" % (i, end) for n, ends in ((len(self.bytes_a), (b",", b"|")), (len(self.bytes_b), (b",", b";"))) for end in ends for i in range(n)]


def load(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Pair(path_a, path_b)
    return _loaded[path_a, path_b]


def segments(text: str) -> list[str]:
    """The parts of a text; each is encoded with a space in front."""
    return _CUT.split(text)


class Numbers(dict):
    """Numbers in the order of first use."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class Segments:
    """Aligned segments by number: token and group counts, group texts, and links in one flat array."""

    def __init__(self):
        self.number = Numbers()
        self.chars = 0
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 3), dtype=np.int64)  # n_a, n_b, n_groups; all 0 where a tokenizer does not give the bytes back
        self.links = np.zeros(0, dtype=np.int64)
        self.ends = np.zeros(1, dtype=np.int64)

    def codes(self, pair: Pair, texts: list[str]) -> list[int]:
        """Numbers of segments; new ones are aligned."""
        first = len(self.number)
        out = list(map(self.number.__getitem__, texts))
        fresh = list(self.number)[first:] if len(self.number) > first else []
        for a in range(0, len(fresh), ENCODED):
            part = fresh[a : a + ENCODED]
            sizes, groups, links = align_segments(pair, part)
            self.sizes = np.concatenate([self.sizes, sizes])
            self.groups += groups
            self.links = np.concatenate([self.links, links])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes[:, 2])])
            self.chars += sum(map(len, part))
        return out

    def links_of(self, codes: np.ndarray) -> np.ndarray:
        """The links of segments in a row."""
        begin, n = self.ends[codes], self.sizes[codes, 2]
        return self.links[np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)]


def gallop(driver: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many of ``other`` lie below each of ``driver`` (both ascending): exponential, then binary search from an earlier driver's rank."""
    n, size = len(driver), len(other)
    low = np.zeros(n, dtype=np.int64)
    if n > STRIDE:
        low = np.repeat(gallop(driver[::STRIDE], other), STRIDE)[:n]
    high = np.full(n, size, dtype=np.int64)
    live, step = np.arange(n), 1
    while len(live):
        probe = np.minimum(low[live] + step - 1, size)
        below = np.zeros(len(live), dtype=bool)
        inside = probe < size
        below[inside] = other[probe[inside]] < driver[live[inside]]
        high[live[~below]] = probe[~below]
        live = live[below]
        low[live] = probe[below] + 1
        step *= 2
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) // 2
        below = other[middle] < driver[live]
        low[live[below]], high[live[~below]] = middle[below] + 1, middle[~below]
        live = live[low[live] < high[live]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in ``a`` and in ``b`` of the ends they share; the shorter list drives."""
    if len(a) > len(b):
        two, one = common_ends(b, a)
        return one, two
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = gallop(a, b)
    same = b[np.minimum(rank, len(b) - 1)] == a
    return np.flatnonzero(same), rank[same]


def align_segments(pair: Pair, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(n_a, n_b and n_groups of each segment, group texts, links of all); nothing where a tokenizer does not give the bytes back."""
    full = [" " + t for t in texts]
    want = "".join(full).encode("utf-8")
    size = np.array(list(map(len, full)) if len(want) == sum(map(len, full)) else [len(t.encode("utf-8")) for t in full], dtype=np.int64)
    good = np.ones(len(texts), dtype=bool)
    held = []
    for ids, entry, sizes in ((([e.ids for e in pair.a.encode_batch_fast(full, add_special_tokens=False)]), pair.bytes_a, pair.size_a), (pair.b.encode(texts, num_threads=1), pair.bytes_b, pair.size_b)):
        n, flat = np.array(list(map(len, ids)), dtype=np.int64), list(chain.from_iterable(ids))
        token = np.array(flat, dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[token])])[np.cumsum(n)]
        if b"".join(map(entry.__getitem__, flat)) != want or (ends != np.cumsum(size)).any():
            good &= [b"".join([entry[i] for i in x]) == t.encode("utf-8") for x, t in zip(ids, full)]
        held.append((n, token))
    (n_a, a), (n_b, b) = ((n * good, ids[np.repeat(good, n)]) for n, ids in held)

    at_a, at_b = common_ends(np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b]))
    n_groups = np.bincount(np.repeat(np.arange(len(texts)), n_a)[at_a], minlength=len(texts))
    # A's tokens of a group, then B's; a group's last token carries the mark that ends its side
    len_a, len_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    code_a, code_b = a.copy(), b + 2 * len(pair.bytes_a)
    code_a[at_a] += len(pair.bytes_a)
    code_b[at_b] += len(pair.bytes_b)
    laid = np.empty(len(a) + len(b), dtype=np.int64)
    laid[np.arange(len(a)) + np.repeat(at_b - len_b + 1, len_a)] = code_a
    laid[np.arange(len(b)) + np.repeat(at_a + 1, len_b)] = code_b
    parts = list(map(pair.digits.__getitem__, laid.tolist()))
    ends = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    groups = [b"".join(parts[x:y])[:-1].decode("ascii") for x, y in zip(ends[:-1], ends[1:])]
    return np.stack([n_a, n_b, n_groups], axis=1), groups, (a[at_a] << 32) | b[at_b]


def align_run(pair: Pair, texts: list[str]) -> dict[str, list]:
    """Counts, groups, and distinct links with how often, for each text of a run."""
    if pair.cache.chars > CACHE_CHARS:
        pair.cache = Segments()
    cache, n = pair.cache, len(texts)
    cut = [segments(t) if t else [] for t in texts]
    by_text = cache.codes(pair, [x for c in cut for x in c])
    ends = np.cumsum([0] + [len(c) for c in cut]).tolist()
    codes = [by_text[x:y] for x, y in zip(ends[:-1], ends[1:])]
    for i in np.unique(np.repeat(np.arange(n), [len(c) for c in cut])[cache.sizes[by_text, 2] == 0]).tolist():
        codes[i] = cache.codes(pair, [texts[i]])  # as a whole the text may still be given back; it has no tokens otherwise
    flat = np.array([x for c in codes for x in c], dtype=np.int64)
    row = np.repeat(np.arange(n), [len(c) for c in codes])
    n_a, n_b, n_groups = (np.bincount(row, cache.sizes[flat, k], n).astype(np.int64) for k in range(3))
    groups = [";".join(map(cache.groups.__getitem__, c)) for c in codes]

    link, of = cache.links_of(flat), np.repeat(np.arange(n), n_groups)
    order = np.lexsort((link, of))
    link, of = link[order], of[order]
    new = np.ones(len(link), dtype=bool)
    new[1:] = (link[1:] != link[:-1]) | (of[1:] != of[:-1])
    start = np.flatnonzero(new)
    times = np.diff(np.append(start, len(link)))
    offsets = np.searchsorted(of[start], np.arange(n + 1))
    return {"n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_groups), "groups": pa.array(groups, pa.string()),
            "_links": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(link[start])),
            "_times": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(times))}


def _align(path_a: str, path_b: str):
    def run(batches):
        pair = load(path_a, path_b)
        for batch in batches:
            text = batch.column("text")
            for first, _, off in slices(text, RUN_BYTES):
                n = len(off) - 1
                made = align_run(pair, [t or "" for t in text.slice(first, n).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(first, n), *made.values()], ["doc", *made])

    return run


def _known(held):
    """Task: n_best and count_sum over the frequent pairs; the other links go on."""

    def run(batches):
        pair, count, best = held.value
        for batch in batches:
            links, times = batch.column("_links"), batch.column("_times")
            flat, by = links.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(links.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(pair, flat), max(0, len(pair) - 1))
            hit = pair[at] == flat if len(pair) else np.zeros(len(flat), dtype=bool)
            sums = [np.zeros(batch.num_rows, dtype=np.int64) for _ in range(2)]
            np.add.at(sums[0], row[hit], by[hit] * best[at[hit]])
            np.add.at(sums[1], row[hit], by[hit] * count[at[hit]])
            miss = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(pa.array(miss, pa.int32()), pa.array(flat[~hit])),
                 pa.ListArray.from_arrays(pa.array(miss, pa.int32()), pa.array(by[~hit]))], ["_row", "n_best", "count_sum", "_links", "_times"])

    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair (A id * 2^32 + B id), n (links that hold it) and best (1: no A id has more links to this B id)."""
    each = aligned.select(F.explode(F.arrays_zip("_links", "_times")).alias("x")).select(F.col("x._links").alias("pair"), F.col("x._times").alias("n"))
    counts = cut_lineage(each.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts").withColumn("b", F.col("pair").bitwiseAND(F.lit(2**32 - 1)))
    top = counts.groupBy("b").agg(F.max("n").alias("top"))  # one row per id of B
    return counts.join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))


def link_sums(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """_row, n_best and count_sum of every aligned row."""
    spark = aligned.sparkSession
    counts = cut_lineage(pair_counts(aligned), "pairs")
    common = counts.orderBy(F.desc("n"), "pair").limit(frequent).toArrow()  # ``frequent`` rows of 24 bytes
    order = np.argsort(common.column("pair").to_numpy())
    held = spark.sparkContext.broadcast(tuple(common.column(c).to_numpy()[order] for c in ("pair", "n", "best")))
    known = aligned.select("_row", "_links", "_times").mapInArrow(_known(held), "_row long, n_best long, count_sum long, _links array<long>, _times array<long>")
    rare = known.select("_row", F.explode(F.arrays_zip("_links", "_times")).alias("x")).select("_row", F.col("x._links").alias("pair"), F.col("x._times").alias("times"))
    rare = rare.join(counts, "pair").select("_row", (F.col("times") * F.col("best")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    every = known.select("_row", "n_best", "count_sum").unionByName(rare)
    return every.groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, groups=lambda g: g, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` (without text) with n_a, n_b, n_groups, n_links, n_best, count_sum and groups (``a1,a2|b1;a3|b2,b3``).

    ``groups`` is a column function applied to the group texts before they are shuffled (a digest, say).
    """
    ship_package(docs.sparkSession)
    path_a, path_b = path_a or model_path(A_FILE), path_b or model_path(B_FILE)
    rest = [f for f in docs.schema.fields if f.name not in (*MADE, "text")]
    doc = F.struct(F.lit(0).alias("_"), *[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rest)])
    held = docs.select(doc.alias("doc"), "text")
    made = "n_a long, n_b long, n_groups long, n_links long, groups string, _links array<long>, _times array<long>"
    aligned = held.mapInArrow(_align(path_a, path_b), f"doc {held.schema['doc'].dataType.simpleString()}, {made}")
    aligned = cut_lineage(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    sums = link_sums(aligned, frequent)
    counted = aligned.select("_row", "doc", *MADE[:4], groups(F.col("groups")).alias("groups")).join(sums, "_row")
    return counted.select(*[F.col(f"doc.c{i}").alias(f.name) for i, f in enumerate(rest)], *MADE)
