"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words, times the share of
the language among the training documents.

Words are runs of ASCII letters and non-ASCII characters of any length,
lower-cased, with the vocabulary's space mark in front.  A character that no piece
covers counts as the unknown piece.  Words of up to ``RUN`` characters are worked
by length, all of one length in step; longer ones position by position, with a
window of the longest piece that rolls over the word, rescaled as it goes.

Training is expectation maximisation from a rank-based start (piece
probability ~ 1 / (rank + 10), alike in all languages): each round is one pass
over all training documents, in which every task sums expected piece counts
(vocabulary x languages, so bounded) over the distinct words of its batches;
one aggregation adds them.  Scoring works on the distinct words of a batch and
is map-side with the broadcast model.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
ties go to the first language by code point; without any training language
everything is ``und``; repeated rows are scored alike; an empty table gives no
rows; ``held_out``, ``lang_pred`` and ``score`` of the input are replaced.
More than ``MAX_LANGUAGES`` training languages are refused, not cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.llm.text_hash import LETTERS, mix, slices, words
from wareloom.llm.token_counts import MARK, MODEL, load, model_path
from wareloom.session import ship_package

RUN, LONG_BLOCK, LONG_CELLS = 32, 1024, 1 << 13
SCALE = 1e5  # per character, so that products of small probabilities stay in range
FLOOR = 1e-9
MAX_LANGUAGES = 1000
ROUNDS = 1
SMOOTH = 0.5
BASE = np.uint64(0x9E3779B97F4A7C55)
CELLS_AT_ONCE = 1 << 16  # words x languages


class Pieces:
    """The vocabulary: normal pieces of one letter case, found by a hash of their characters."""

    def __init__(self, path: str):
        sp = load(path)
        texts = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.texts = [t for t in texts if t == t.lower()]
        self.n = len(self.texts) + 1  # the last is the unknown piece
        self.longest = max(map(len, self.texts))
        self.start = np.append(1.0 / (np.arange(len(self.texts)) + 10.0), 1e-4)
        self.start /= self.start.sum()
        self.bits = 20
        self.keys, self.ids, self.probes = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32), 0
        for i, t in enumerate(self.texts):
            h = np.zeros(1, np.uint64)
            for c in t:
                h = self.step(h, np.array([ord(c)], np.uint64))
            slot, n = int(self.slot(h)[0]), 1
            while self.ids[slot] >= 0:
                slot, n = (slot + 1) & ((1 << self.bits) - 1), n + 1
            self.keys[slot], self.ids[slot], self.probes = h[0], i, max(self.probes, n)

    @staticmethod
    def step(h: np.ndarray, char: np.ndarray) -> np.ndarray:
        return (h + char + np.uint64(1)) * BASE

    def slot(self, h: np.ndarray) -> np.ndarray:
        return (mix(h) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 where there is none."""
        slot = self.slot(h)
        out = np.full(len(h), -1, np.int32)
        for _ in range(self.probes):
            same = self.keys[slot] == h
            out[same] = self.ids[slot[same]]
            slot = (slot + 1) & ((1 << self.bits) - 1)
        return out


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def _by_length(texts: list[str], languages: int):
    """(word numbers, their characters with the space mark in front) for each length up to RUN."""
    lengths = np.array([len(t) for t in texts])
    at_once = max(1, CELLS_AT_ONCE // max(1, languages))
    for n in np.unique(lengths[lengths <= RUN]):
        at = np.flatnonzero(lengths == n)
        for a in range(0, len(at), at_once):
            part = at[a : a + at_once]
            chars = np.frombuffer("".join(MARK + texts[i] for i in part).encode("utf-32-le"), np.uint32)
            yield part, chars.reshape(len(part), n + 1).astype(np.uint64)


def _edges(vocabulary: Pieces, chars: np.ndarray):
    """Piece numbers of the substrings: edges[i][l - 1] for start i, length l; unknown single characters get the last piece."""
    n = chars.shape[1]
    out = []
    for i in range(n):
        h, row = np.zeros(len(chars), np.uint64), []
        for j in range(i, min(n, i + vocabulary.longest)):
            h = Pieces.step(h, chars[:, j])
            ids = vocabulary.find(h)
            if j == i:
                ids = np.where(ids < 0, vocabulary.n - 1, ids)
            row.append(ids if (ids >= 0).any() else None)
        out.append(row)
    return out


def _forward(edges, p: np.ndarray, rows: int) -> list[np.ndarray]:
    """Scaled forward sums; p has a row for each piece and a last row of zeros."""
    n = len(edges)
    alpha = [np.zeros((rows, p.shape[1])) for _ in range(n + 1)]
    alpha[0][:] = 1.0
    for i in range(n):
        for length, ids in enumerate(edges[i], 1):
            if ids is not None:
                alpha[i + length] += alpha[i] * p[ids] * SCALE**length
    return alpha


def _long(texts: list[str]):
    """(word numbers, characters padded with zeros, lengths with the mark) of words over RUN, those of like length together."""
    order = sorted((i for i, t in enumerate(texts) if len(t) > RUN), key=lambda i: len(texts[i]))
    while order:
        rows = max(1, min(len(order), LONG_CELLS // (len(texts[order[0]]) + 1)))
        part, order = order[:rows], order[rows:]
        sizes = np.array([len(texts[i]) + 1 for i in part])
        chars = np.zeros((len(part), int(sizes.max())), np.uint64)
        for r, i in enumerate(part):
            chars[r, : sizes[r]] = np.frombuffer((MARK + texts[i]).encode("utf-32-le"), np.uint32)
        yield np.array(part), chars, sizes


class _Chain:
    """Forward and backward sums of a batch of long words, block by block.

    Sums are kept times SCALE to the power of the characters they cover, over a factor of
    their own for each word and language (``scale``, its logarithm).
    """

    def __init__(self, vocabulary: Pieces, chars: np.ndarray, sizes: np.ndarray, p: np.ndarray):
        self.v, self.chars, self.sizes, self.p = vocabulary, chars, sizes, p
        self.rows, self.n = chars.shape
        self.w = vocabulary.longest
        self.powers = (SCALE ** np.arange(1, self.w + 1))[:, None, None]
        self.block = max(1, LONG_BLOCK // max(1, self.rows * p.shape[1] // 64))

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Pieces that end at begin + 1 .. end: [end, length - 1, row]; the last row of p (zeros) where there is none."""
        lo = max(0, begin - self.w + 1)
        span = self.chars[:, lo:end]
        out = np.full((end - begin, self.w, self.rows), len(self.p) - 1, np.int32)
        h = np.zeros(span.shape, np.uint64)
        for length in range(1, min(self.w, end) + 1):
            starts = span.shape[1] - length + 1
            if starts <= 0:
                break
            h = Pieces.step(h[:, :starts], span[:, length - 1 :])
            found = self.v.find(h.reshape(-1)).reshape(h.shape)
            if length == 1:
                found = np.where(found < 0, self.v.n - 1, found)
            found = np.where(found < 0, len(self.p) - 1, found)
            first_end = lo + length  # the piece from lo ends here
            skip = max(0, begin + 1 - first_end)
            out[first_end + skip - begin - 1 :, length - 1, :] = found[:, skip:].T
        past = np.arange(begin + 1, end + 1)[:, None] > self.sizes[None, :]
        out[np.broadcast_to(past[:, None, :], out.shape)] = len(self.p) - 1
        return out

    def forward(self, window: np.ndarray, scale: np.ndarray, begin: int, end: int, ids: np.ndarray):
        """Sums at begin + 1 .. end and their scales; ``window`` has the sums at begin, begin - 1, ..."""
        sums, scales = np.zeros((end - begin, *scale.shape)), np.zeros((end - begin, *scale.shape))
        window, scale = window.copy(), scale.copy()
        for t in range(end - begin):
            now = (window * self.p[ids[t]] * self.powers).sum(axis=0)
            window[1:] = window[:-1]
            window[0] = now
            top = window.max(axis=0)
            far = (top > 1e50) | ((top < 1e-50) & (top > 0))
            if far.any():
                by = np.where(far, top, 1.0)
                window /= by
                scale += np.log(by)
            sums[t], scales[t] = window[0], scale
        return sums, scales, window, scale

    def start(self):
        window = np.zeros((self.w, self.rows, self.p.shape[1]))
        window[0] = 1.0
        return window, np.zeros(window.shape[1:])

    def blocks(self):
        return [(a, min(a + self.block, self.n)) for a in range(0, self.n, self.block)]

    def total(self, keep: list | None = None) -> np.ndarray:
        """log of the sum over all segmentations, SCALE taken in; ``keep`` takes the state before each block."""
        window, scale = self.start()
        out = np.zeros(scale.shape)
        for a, b in self.blocks():
            if keep is not None:
                keep.append((window, scale))
            sums, scales, window, scale = self.forward(window, scale, a, b, self.ids(a, b))
            done = np.flatnonzero((self.sizes > a) & (self.sizes <= b))
            at = self.sizes[done] - a - 1
            out[done] = np.log(np.maximum(sums[at, done], 1e-300)) + scales[at, done]
        return out

    def expected(self, counts: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected uses of each piece; blocks are worked from the last, their forward sums taken anew."""
        keep: list = []
        log_total = self.total(keep)
        w, langs = self.w, self.p.shape[1]
        back, scale = np.zeros((w, self.rows, langs)), np.zeros((self.rows, langs))  # sums from position end, end + 1, ...
        for (a, b), (window, before) in zip(reversed(self.blocks()), reversed(keep)):
            hi = min(self.n, b + w)
            ids = self.ids(a, hi)
            sums, scales, _, _ = self.forward(window, before, a, b, ids[: b - a])
            heads = np.concatenate([window[:1], sums])  # at a .. b
            head_scales = np.concatenate([before[None], scales])
            flows, used = np.zeros((b - a, w, self.rows, langs)), np.full((b - a, w, self.rows), len(self.p) - 1, np.int32)
            for i in range(b, a - 1, -1):
                ending = self.sizes == i
                if i == b and i < self.n:
                    continue  # that position belongs to the next block, and is in ``back``
                now = np.zeros((self.rows, langs))
                if i < self.n:
                    reach = min(w, self.n - i)
                    piece = ids[i - a + np.arange(reach), np.arange(reach)]  # from i, by length
                    step = back[:reach] * self.p[piece] * self.powers[:reach]
                    now = step.sum(axis=0)
                    if i < b:
                        with np.errstate(under="ignore"):
                            share = np.exp(np.clip(head_scales[i - a] + scale - log_total, -700, 700))
                        flows[i - a, :reach] = step * (heads[i - a] * share * counts)[None]
                        used[i - a, :reach] = piece
                now[ending], scale[ending] = 1.0, 0.0
                back[1:] = back[:-1]
                back[0] = now
                top = back.max(axis=0)
                far = (top > 1e50) | ((top < 1e-50) & (top > 0))
                if far.any():
                    by = np.where(far, top, 1.0)
                    back /= by
                    scale += np.log(by)
            for lang in range(langs):
                out[:, lang] += np.bincount(used.reshape(-1), flows[..., lang].reshape(-1), len(out))


def score_words(vocabulary: Pieces, texts: list[str], p: np.ndarray) -> np.ndarray:
    """log P(word | language), one row per word."""
    p = np.vstack([p, np.zeros(p.shape[1])])
    out = np.zeros((len(texts), p.shape[1]))
    for at, chars in _by_length(texts, p.shape[1]):
        alpha = _forward(_edges(vocabulary, chars), p, len(at))
        out[at] = np.log(np.maximum(alpha[-1], 1e-300)) - chars.shape[1] * np.log(SCALE)
    for at, chars, sizes in _long(texts):
        out[at] = _Chain(vocabulary, chars, sizes, p).total() - (sizes * np.log(SCALE))[:, None]
    return out


def expected_counts(vocabulary: Pieces, texts: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (rows) by language, over words with counts by language."""
    p = np.vstack([p, np.zeros(p.shape[1])])
    out = np.zeros_like(p)
    for at, chars, sizes in _long(texts):
        _Chain(vocabulary, chars, sizes, p).expected(counts[at], out)
    for at, chars in _by_length(texts, p.shape[1]):
        edges = _edges(vocabulary, chars)
        n = len(edges)
        alpha = _forward(edges, p, len(at))
        beta = [np.zeros_like(alpha[0]) for _ in range(n + 1)]
        beta[n][:] = counts[at] / np.maximum(alpha[n], 1e-300)
        for i in range(n - 1, -1, -1):
            for length, ids in enumerate(edges[i], 1):
                if ids is not None:
                    flow = p[ids] * SCALE**length * beta[i + length]
                    beta[i] += flow
                    flow *= alpha[i]
                    for lang in range(p.shape[1]):
                        out[:, lang] += np.bincount(ids % len(p), flow[:, lang], len(p))
    return out[:-1]


def _unique_words(raw: np.ndarray, off: np.ndarray):
    """(distinct words with a letter, their numbers, number of words, word of each occurrence, text of each occurrence)."""
    s, e, h, first = words(raw, off, LETTERS)
    _, at, which = np.unique(h, return_index=True, return_inverse=True)
    data = raw.tobytes()
    texts, owner = [], []
    for k, i in enumerate(at.tolist()):
        word = data[s[i] : e[i]].decode("utf-8", "replace").lower()
        if any(map(str.isalpha, word)):
            texts.append(word)
            owner.append(k)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return texts, np.array(owner, dtype=np.int64), len(at), which, doc


SLICE = 16 << 20


def _expect(path: str, model):
    def run(batches):
        vocabulary, (langs, p, _) = pieces(path), model.value
        number = {x: i for i, x in enumerate(langs)}
        total = np.zeros((vocabulary.n, len(langs)))
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for row, raw, off in slices(batch.column("text"), SLICE):
                texts, owner, n, which, doc = _unique_words(raw, off)
                if texts:
                    counts = np.bincount(which * len(langs) + lang[row + doc], minlength=n * len(langs)).reshape(n, len(langs))
                    total += expected_counts(vocabulary, texts, counts[owner].astype(float), p)
        at = np.argwhere(total > 0)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(total[at[:, 0], at[:, 1]])], ["piece", "lang", "n"])

    return run


def train(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS):
    """(languages, piece probabilities by language, log shares) from the text and lang of ``docs``."""
    sc = docs.sparkSession.sparkContext
    ship_package(docs.sparkSession)
    path = path or model_path(MODEL)
    vocabulary = pieces(path)
    rows = docs.where("lang is not null and text is not null").select("text", "lang")
    shares = sorted(map(tuple, rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()))
    if len(shares) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs, prior = [x for x, _ in shares], np.log(np.array([float(n) for _, n in shares]) / max(1, sum(n for _, n in shares)))
    p = np.repeat(vocabulary.start[:, None], len(langs), axis=1)
    for _ in range(rounds if langs else 0):
        model = sc.broadcast((langs, p, prior))
        sums = rows.mapInArrow(_expect(path, model), "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros_like(p)
        counts[sums["piece"], sums["lang"]] = sums["n"]
        shared = counts.sum(axis=1, keepdims=True) + SMOOTH * vocabulary.start[:, None]
        shared /= shared.sum()
        p = np.maximum((counts + SMOOTH * vocabulary.n * shared) / (counts.sum(axis=0) + SMOOTH * vocabulary.n), FLOOR)
    return langs, p, prior


def _predict(path: str, model):
    def run(batches):
        vocabulary, (langs, p, prior) = pieces(path), model.value
        for batch in batches:
            pred, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            for row, raw, off in slices(batch.column("text"), SLICE):
                texts, owner, n, which, doc = _unique_words(raw, off)
                if not texts or not langs:
                    continue
                by_word = np.zeros((n, len(langs)))
                np.add.at(by_word, owner, score_words(vocabulary, texts, p))
                lettered = np.zeros(n, dtype=bool)
                lettered[owner] = True
                some = np.bincount(doc, lettered[which], len(off) - 1) > 0
                sums = np.stack([np.bincount(doc, by_word[which, k], len(off) - 1) for k in range(len(langs))], axis=1) + prior
                best = sums.argmax(axis=1)
                share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                for i in np.flatnonzero(some):
                    pred[row + i], score[row + i] = langs[best[i]], share[i]
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            columns |= {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def predict(docs: DataFrame, model, path: str | None = None) -> DataFrame:
    """``docs`` with lang_pred and score (share of the predicted language among all)."""
    ship_package(docs.sparkSession)
    path = path or model_path(MODEL)
    plain = docs.drop("lang_pred", "score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(_predict(path, docs.sparkSession.sparkContext.broadcast(model)), f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Train on the rows whose crc32(doc_id) mod 4 is not 2, predict all."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = train(docs.where(~held), path)
    return predict(docs.drop("held_out").withColumn("held_out", held), model, path)
