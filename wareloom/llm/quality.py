"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are byte-class shares, lengths and word
repetition of the line and of its two neighbours; transitions tie neighbouring
labels.  A document's quality is the mean of its lines' marginals (forward and
backward sums), weighted by line length, mapped to a probability by a logistic
curve fitted on the training documents.

Training: lines take their document's label.  The sample is bounded: at most
``SAMPLE`` labelled documents (smallest hash of doc_id first) and about
``SAMPLE_LINES`` lines; when they have more, the longest documents give a part of their lines
(chains spread evenly over the text), so that no document is left out.  Only
features reach the driver.  For training, documents are cut into chains of at
most ``CHAIN`` lines.  Scoring is map-side over whole texts with the broadcast model.

Defined cases: a null or empty text is one empty line and gets the score that
such a line has; without usable labels every score is 0.5, with one class only
the share of that class; labels without a document, or with a null quality,
are not used; labels of a document that disagree both count, repeated labels and
repeated rows count once; an empty table gives no rows;
``held_out``, ``score`` and ``predicted`` of the input are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.llm.text_hash import NOT_SPACE, slices, words
from wareloom.session import ship_package

SAMPLE, SAMPLE_LINES, CHAIN, BLOCK = 6000, 200_000, 64, 1 << 15
STEPS, RATE, RIDGE = 150, 0.1, 1e-3
THRESHOLD = 0.3


def _classes() -> np.ndarray:
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c\r", ".", ",;:", "!", "?", "|", "\"'()-", "#$%&*+/<=>@[\\]^_`{}~"]
    out = np.full(256, len(groups), dtype=np.int64)  # control characters
    for i, g in enumerate(groups):
        out[list(g.encode())] = i
    out[0x80:] = len(groups) + 1
    return out


CLASS = _classes()
CLASSES = int(CLASS.max()) + 1
WIDTH = CLASSES + 6


def line_features(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, its length in bytes, first line of each text and the end)."""
    breaks = np.flatnonzero(raw == 10)
    starts, ends = np.sort(np.concatenate([off[:-1], breaks + 1])), np.sort(np.concatenate([breaks, off[1:]]))
    first = np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(breaks, off)) + 1)])
    size = ends - starts
    n = len(starts)
    keep = raw != 10
    line = np.repeat(np.arange(n), size)
    shares = np.bincount(line * CLASSES + CLASS[raw[keep]], minlength=n * CLASSES).reshape(n, CLASSES)
    s, e, h, _ = words(raw, off, NOT_SPACE)
    of = np.searchsorted(starts, s, side="right") - 1
    count = np.bincount(of, minlength=n)
    once = np.zeros(len(h), dtype=bool)
    once[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    twice = np.zeros(len(h), dtype=bool)
    twice[2:] = (h[2:] == h[:-2]) & (of[2:] == of[:-2])
    per = lambda total, by: total / np.maximum(by, 1)
    own = np.column_stack([
        shares / np.maximum(size, 1)[:, None], np.log1p(size), np.log1p(count), per(np.bincount(of, e - s, n), count),
        per(np.bincount(of, once, n), count), per(np.bincount(of, twice, n), count), size == 0])
    return own.astype(np.float32), size, first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features, with flags for the first and the last line."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    begin, end = np.zeros(len(own), bool), np.zeros(len(own), bool)
    begin[first[:-1]], end[first[1:] - 1] = True, True
    before[begin], after[end] = 0, 0
    return np.column_stack([own, before, after, begin, end, np.ones(len(own))])


def messages(s: np.ndarray, first: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good from the lines up to each (f), and from those after it (b).

    ``s`` is each line's own log odds and ``stay`` the weights of bad-bad and
    good-good; chains run in step, so the loop is as long as the longest.
    """
    f, b = s.astype(np.float64).copy(), np.zeros(len(s))
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    bad, good = stay

    def through(x):
        return np.logaddexp(good + x, 0) - np.logaddexp(x, bad)

    longest = int(length[0]) if len(length) else 0
    live = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")  # chains with more than t lines
    for t in range(1, longest):
        at = begin[: live[t]] + t
        f[at] += through(f[at - 1])
    for t in range(longest - 1, 0, -1):
        at = begin[: live[t]] + t
        b[at - 1] = through(s[at] + b[at])
    return f, b


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def line_odds(model: dict, own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``with_neighbours(...) @ w`` without the wide matrix: each line's share for itself, its next and its previous line."""
    width, w = own.shape[1], model["w"]
    by_place = w[: 3 * width].reshape(3, width).T
    share = np.empty((len(own), 3))
    for a in range(0, len(own), BLOCK):
        share[a : a + BLOCK] = ((own[a : a + BLOCK] - model["mean"]) / model["spread"]) @ by_place
    out = share[:, 0] + w[3 * width + 2]
    begin, end = np.zeros(len(own), bool), np.zeros(len(own), bool)
    begin[first[:-1]], end[first[1:] - 1] = True, True
    inner, last = np.flatnonzero(~begin), np.flatnonzero(~end)
    out[inner] += share[inner - 1, 1]
    out[last] += share[last + 1, 2]
    return out + begin * w[3 * width] + end * w[3 * width + 1]


def document_quality(model: dict, own: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' good marginals, by text."""
    f, b = messages(line_odds(model, own, first), first, model["stay"])
    weight = size + 1.0
    total = np.add.reduceat(_sigmoid(f + b) * weight, first[:-1])
    return total / np.add.reduceat(weight, first[:-1])


def _curve_input(quality: np.ndarray) -> np.ndarray:
    q = np.clip(quality, 1e-6, 1 - 1e-6)
    return np.column_stack([np.log(q / (1 - q)), np.ones(len(q))])


def fit(own: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict:
    """The model from line features of documents and their labels."""
    mean, spread = own.mean(axis=0), own.std(axis=0) + 1e-3
    cut = np.unique(np.concatenate([first] + [np.arange(a, b, CHAIN) for a, b in zip(first[:-1], first[1:])]))
    x = with_neighbours((own - mean) / spread, first)
    y = np.repeat(label, np.diff(first)).astype(np.float64)
    inner = np.ones(len(x), dtype=bool)
    inner[cut[:-1]] = False
    pair = np.flatnonzero(inner)  # lines with a previous line in their chain
    theta = np.zeros(x.shape[1] + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, stay = theta[:-2], theta[-2:]
        s = x @ w
        f, b = messages(s, cut, stay)
        p = _sigmoid(f + b)
        bb, gg, bg, gb = np.full(len(pair), stay[0]), stay[1] + f[pair - 1] + s[pair] + b[pair], s[pair] + b[pair], f[pair - 1]
        top = np.maximum(np.maximum(bb, gg), np.maximum(bg, gb))
        z = sum(np.exp(k - top) for k in (bb, gg, bg, gb))
        seen = np.array([((1 - y[pair]) * (1 - y[pair - 1])).sum(), (y[pair] * y[pair - 1]).sum()])
        held = np.array([(np.exp(bb - top) / z).sum(), (np.exp(gg - top) / z).sum()])
        grad = np.concatenate([(y - p) @ x, seen - held]) / len(x) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = {"mean": mean, "spread": spread, "w": theta[:-2], "stay": theta[-2:]}
    z, curve = _curve_input(document_quality(model, own, size, first)), np.array([1.0, 0.0])
    for _ in range(25):  # Newton steps of the logistic curve
        p = _sigmoid(z @ curve)
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        curve = curve + np.linalg.solve(hess, z.T @ (label - p) - 1e-2 * (curve - np.array([1.0, 0.0])))
    return model | {"curve": curve}


def parts(n: int, most: int) -> list[tuple[int, int]]:
    """Runs of lines to learn from: all n, or chains of at most CHAIN lines spread evenly, ``most`` lines together."""
    if n <= most:
        return [(0, n)]
    chains = -(-most // CHAIN)
    size = most // chains
    return [(a, a + size) for a in (np.arange(chains) * (n - size) // max(1, chains - 1)).tolist()]


def allowance(lines: list[int], total: int = SAMPLE_LINES) -> int:
    """The most lines a document may give, so that all together give about ``total``; every document gives at least one."""
    left, rest = total, sorted(lines)
    for i, n in enumerate(rest):
        if n * (len(rest) - i) > left:
            return max(1, left // (len(rest) - i))
        left -= n
    return max(rest, default=1)


def _featured(most: int):
    def run(batches):
        for batch in batches:
            quality, digest = batch.column("quality"), batch.column("digest")
            for row, raw, off in slices(batch.column("text")):
                own, size, first = line_features(raw, off)
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    for n, (x, y) in enumerate(parts(b - a, most)):
                        yield pa.RecordBatch.from_arrays([quality.slice(row + i, 1), digest.slice(row + i, 1), pa.array([n], pa.int32()), pa.array([own[a + x : a + y].tobytes()], pa.binary()),
                                                          pa.array([size[a + x : a + y].tobytes()], pa.binary())], ["quality", "digest", "part", "own", "size"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Fit on a bounded sample of ``labels`` (doc_id, quality) with a document.

    Two passes: line counts of the labelled documents choose the sample, then only its
    texts are turned into features, in the tasks that read them.
    """
    ship_package(docs.sparkSession)
    usable = labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    ids = usable.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    digest = F.xxhash64("doc_id", "quality", "text")
    marked = texts.join(F.broadcast(ids), "doc_id").withColumn("digest", digest)  # SAMPLE ids at most
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    counted = marked.select("digest", lines.alias("lines")).groupBy("digest").agg(F.first("lines").alias("lines"))
    chosen = counted.orderBy("digest").limit(SAMPLE).collect()
    if not chosen:
        return {"share": 0.5}
    wanted = docs.sparkSession.createDataFrame([(r["digest"],) for r in chosen], "digest long")
    sample = marked.join(F.broadcast(wanted), "digest", "left_semi").select("digest", "quality", "text")
    features = sample.mapInArrow(_featured(allowance([r["lines"] for r in chosen])), "quality int, digest long, part int, own binary, size binary")
    once = features.groupBy("digest", "part").agg(F.first("quality").alias("quality"), F.first("own").alias("own"), F.first("size").alias("size"))
    rows = sorted(once.collect(), key=lambda r: (r["digest"], r["part"]))
    label = np.array([r.quality for r in rows], dtype=np.float64)
    if len(set(label)) < 2:
        return {"share": float(label[0]) if len(label) else 0.5}
    own = np.concatenate([np.frombuffer(r.own, np.float32).reshape(-1, WIDTH) for r in rows])
    size = np.concatenate([np.frombuffer(r.size, np.int64) for r in rows])
    first = np.concatenate([[0], np.cumsum([len(r.size) // 8 for r in rows])])
    return fit(own, size, first, label)


def _score(held):
    def run(batches):
        model = held.value
        for batch in batches:
            out = np.full(batch.num_rows, model.get("share", 0.5))
            if "curve" in model:
                for row, raw, off in slices(batch.column("text")):
                    quality = document_quality(model, *line_features(raw, off))
                    out[row : row + len(quality)] = _sigmoid(_curve_input(quality) @ model["curve"])
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)} | {"score": pa.array(out)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with score and predicted (1 from THRESHOLD on)."""
    ship_package(docs.sparkSession)
    plain = docs.drop("score", "predicted")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    out = plain.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), f"{schema}, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labels whose crc32(doc_id) mod 5 is not 0, score all of ``docs``."""
    model = train(docs, labels.where(~held_out()))
    return score(docs.drop("held_out").withColumn("held_out", held_out()), model)
