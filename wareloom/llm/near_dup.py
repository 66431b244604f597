"""Near-duplicate documents: SuperMinHash, banding, verification, union-find.

A document's set holds its distinct ``k``-word shingles (words are runs of
bytes other than ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; fewer than k words are one
shingle).  Documents with Jaccard similarity of at least ``percent`` / 100 are
linked; groups are the connected components of all links.

How: equal word sequences are one vertex (smallest doc_id) from the start.
SuperMinHash gives every shingle a permutation of the ``M`` registers; the r-th
register it visits gets the value r + random.  Levels r are worked for all
shingles together and end as soon as every register holds a value of a level
done, which is the early stop.  ``BANDS`` bands of ``ROWS`` registers make the
buckets: at similarity 0.8 a pair shares none with probability 4e-8.

Candidates are not all pairs of a bucket.  First every member is checked
against its bucket's smallest member, and the verified links make components.
Pairs to that member with an estimated similarity of ``LOOSE`` or more also make
loose clusters.  What can still be missing are links between components: inside
a cluster they are looked for in blocks of at most ``2 * BLOCK`` vertices, which
skip chunks of one and the same component and return only pairs that sizes
and sketch let through; across clusters, the buckets give them.  A sketch holds
four bits of each register; pairs more than ``SIGMAS`` standard deviations below the
similarity are let go (2e-8 of the pairs at the limit).  Nothing is capped.
Every candidate is verified on its full shingle sets.

Defined cases: a null, empty or blank text has an empty set and links with
nothing; a null doc_id links with nothing, has component_id null and is kept;
rows that share a doc_id are judged by their own texts; copies group whatever
their number; an empty table gives no rows; ``n_shingles``, ``component_id``
and ``kept`` of the input are replaced.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.llm.components import components, smallest_ids, vertex_ids
from wareloom.llm.text_hash import BASE, NOT_SPACE, mix, ngrams, slices, words
from wareloom.session import cut_lineage, ship_package

M, ROWS, BANDS = 1024, 7, 73
BITS = 512  # of the short sketch, one of each of the first registers
SIGMAS, LOOSE, BLOCK = 5.5, 50, 256
SIGNED = 512  # documents whose registers are held at once (8 kB each)
SHARED = -(1 << 63)  # stands for the chunks that small components share; no component has this number


def shingles(raw: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash) of the distinct shingles of each text, sorted."""
    _, _, h, first = words(raw, off, NOT_SPACE)
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    grams = ngrams(h, k)
    at = np.arange(len(grams))
    inside = at + k <= first[doc[: len(grams)] + 1] if len(grams) else np.zeros(0, bool)
    docs, hashes = [doc[: len(grams)][inside]], [grams[inside]]
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        docs.append(np.array([d]))
        hashes.append(ngrams(h[first[d] : first[d + 1]], int(counts[d])))
    docs, hashes = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    return docs[new], hashes[new]


def _register(e: np.ndarray, level: int) -> np.ndarray:
    """The register that each element visits at a level: a permutation of the levels per element."""
    m = np.uint64(M - 1)
    x = (e + np.uint64(level)) & m
    x = (x * (((e >> np.uint64(10)) << np.uint64(1)) | np.uint64(1)) + (e >> np.uint64(40))) & m
    x ^= x >> np.uint64(5)
    x = (x * (((e >> np.uint64(20)) << np.uint64(1)) | np.uint64(1)) + (e >> np.uint64(50))) & m
    return x ^ (x >> np.uint64(4))


def signatures(docs: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """SuperMinHash registers (n x M) of n sets; an empty set keeps the largest value everywhere."""
    out = np.full((n, M), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat = out.reshape(-1)
    row, e = docs.astype(np.int64) * M, mix(hashes + np.uint64(77))
    live = np.unique(docs)
    for level in range(M):
        value = (np.uint64(level) << np.uint64(48)) | (mix(e + np.uint64((level + 1) * BASE % (1 << 64))) >> np.uint64(16))
        np.minimum.at(flat, row + _register(e, level).astype(np.int64), value)
        still = (out[live] >= np.uint64((level + 1) << 48)).any(axis=1)
        if not still.all():
            live = live[still]
            if not len(live):
                break
            on = np.zeros(n, dtype=bool)
            on[live] = True
            keep = on[row // M]
            row, e = row[keep], e[keep]
    return out


def _bands(sig: np.ndarray) -> np.ndarray:
    used = sig[:, : ROWS * BANDS].reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(5)), used.shape[:2])
    for j in range(ROWS):
        key = mix(key * np.uint64(BASE) + used[:, :, j])
    return key.view(np.int64)


def _bits(sig: np.ndarray) -> np.ndarray:
    """The short sketch, for join conditions."""
    return np.packbits((mix(sig[:, :BITS]) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)


def _nibbles(sig: np.ndarray) -> np.ndarray:
    """The sketch: four bits of every register, two registers to a byte."""
    low = (mix(sig) >> np.uint64(8) & np.uint64(15)).astype(np.uint8)
    return low[:, 0::2] << 4 | low[:, 1::2]


#: number of equal nibbles of two bytes, by their exclusive or
_EQUAL = np.array([(b >> 4 == 0) + (b & 15 == 0) for b in range(256)], dtype=np.uint8)


def least_equal(percent: int, sigmas: float = SIGMAS) -> int:
    """Registers whose nibbles agree at least, if the similarity is reached."""
    p = percent / 100 + (1 - percent / 100) / 16
    return math.floor(M * p - sigmas * math.sqrt(M * p * (1 - p)))


def word_digest(raw: bytes) -> bytes:
    return hashlib.blake2b(b" ".join(raw.lower().split()), digest_size=16).digest()


def _sign(k: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for row, raw, off in slices(batch.column("text"), rows=SIGNED):
                n, data = len(off) - 1, raw.tobytes()
                docs, hashes = shingles(raw, off, k)
                sig = signatures(docs, hashes, n)
                size = np.bincount(docs, minlength=n)
                rows = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * a.shape[1], pa.int32()), pa.array(np.ascontiguousarray(a).reshape(-1)))
                digest = pa.array([word_digest(data[a:b]) for a, b in zip(off[:-1], off[1:])], pa.binary())
                sketch = pa.array([x.tobytes() for x in _nibbles(sig)], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(row, n), batch.column("key").slice(row, n), digest, pa.array(size, pa.int64()), rows(_bands(sig)), rows(_bits(sig)), sketch],
                                                 ["doc_id", "key", "digest", "n_shingles", "bands", "bits", "sketch"])

    return run


def _set(raw: bytes, k: int) -> np.ndarray:
    data = np.frombuffer(raw, dtype=np.uint8)
    return shingles(data, np.array([0, len(data)]), k)[1]


def _verify(k: int, percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            last: tuple = (None, None, None)
            keep = []
            for i in range(batch.num_rows):
                one, two = ((batch.column(f"text_{x}")[i].as_py() or "").encode("utf-8") for x in "ab")
                if word_digest(one) != batch.column("digest_a")[i].as_py() or word_digest(two) != batch.column("digest_b")[i].as_py():
                    keep.append(False)  # another row with the same doc_id
                    continue
                if last[0] != two:
                    last = (two, _set(two, k), None)
                x, y = _set(one, k), last[1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], ["a", "b"])

    return run


def _near(percent: int) -> F.Column:
    """Sizes and short sketches of rows a_ and b_ that allow the similarity."""
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    differ = sum((F.bit_count(F.col("a_bits")[i].bitwiseXOR(F.col("b_bits")[i])) for i in range(BITS // 64)), F.lit(0))
    half = (100 - percent) / 200  # share of differing bits expected at the similarity
    return sizes & (differ <= math.ceil(BITS * half + SIGMAS * math.sqrt(BITS * half * (1 - half))))


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, M // 2)


def _compare(percent: int):
    """Task: which pairs the sizes and sketches let through (near), and which are loosely alike (loose)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            equal = _EQUAL[_sketches(batch.column("a_sketch")) ^ _sketches(batch.column("b_sketch"))].sum(axis=1, dtype=np.int64)
            a, b = batch.column("a_n").to_numpy(), batch.column("b_n").to_numpy()
            near = (equal >= least_equal(percent)) & (np.minimum(a, b) * 100 >= np.maximum(a, b) * percent)
            kept = [batch.column(c) for c in PAIR]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(near), pa.array(equal >= least_equal(LOOSE, 0))], [*PAIR, "near", "loose"])

    return run


def _block(percent: int):
    """Task: the pairs of a block that are of two components and may be near."""
    least = least_equal(percent)

    def run(table: pa.Table) -> pa.Table:
        part, n, group = (table.column(c).to_numpy() for c in ("part", "n", "group"))
        sketch, own = _sketches(table.column("sketch")), table.column("i")[0].as_py() == table.column("j")[0].as_py()
        two = np.flatnonzero(part == (0 if own else 1))
        left, right = [], []
        for r in np.flatnonzero(part == 0):
            may = two[(group[two] != group[r]) & (np.minimum(n[two], n[r]) * 100 >= np.maximum(n[two], n[r]) * percent)]
            if own:
                may = may[may > r]
            near = may[_EQUAL[sketch[may] ^ sketch[r]].sum(axis=1, dtype=np.int64) >= least]
            left.append(np.full(len(near), r))
            right.append(near)
        left, right = np.concatenate([np.zeros(0, int), *left]), np.concatenate([np.zeros(0, int), *right])
        node = table.column("node").to_numpy()
        flip = node[left] < node[right]
        left, right = np.where(flip, right, left), np.where(flip, left, right)
        take = lambda c, at: table.column(c).take(pa.array(at, pa.int64()))
        return pa.table([take(c, at) for c in ("node", "least", "digest") for at in (left, right)], PAIR)

    return run


def _blocks(rows: DataFrame) -> DataFrame:
    """Vertices (cluster, group, node, ...) dealt to pairs i <= j of chunks of about BLOCK.

    A large component has chunks of its own, small ones share chunks, and
    pairs of chunks of the same component are left out."""
    size = rows.groupBy("cluster", "group").agg(F.count(F.lit(1)).alias("_n"))
    totals = size.groupBy("cluster").agg(F.sum(F.when(F.col("_n") < BLOCK, F.col("_n")).otherwise(0)).alias("_small"), F.count(F.lit(1)).alias("_groups")).where("_groups > 1")
    large = size.where(F.col("_n") >= BLOCK).select("cluster", F.col("group").alias("_home"), F.ceil(F.col("_n") / BLOCK).cast("int").alias("_chunks"))
    small = totals.where("_small > 0").select("cluster", F.lit(SHARED).alias("_home"), F.ceil(F.col("_small") / BLOCK).cast("int").alias("_chunks"))
    homes = cut_lineage(large.join(totals.select("cluster"), "cluster", "left_semi").unionByName(small), "homes")
    at = rows.join(size.withColumnRenamed("_n", "_size"), ["cluster", "group"])
    at = at.withColumn("_home", F.when(F.col("_size") >= BLOCK, F.col("group")).otherwise(F.lit(SHARED))).drop("_size")
    at = at.join(homes, ["cluster", "_home"]).withColumn("_chunk", F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int")).drop("_chunks")
    chunks = homes.select("cluster", F.col("_home").alias("_h"), F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_c"))
    dealt = at.join(chunks, "cluster").where((F.col("_home") != F.col("_h")) | (F.col("_home") == SHARED))
    mine, other = F.struct("_home", "_chunk"), F.struct(F.col("_h").alias("_home"), F.col("_c").alias("_chunk"))
    dealt = dealt.withColumns({"i": F.least(mine, other), "j": F.greatest(mine, other)})
    return dealt.withColumn("part", F.when(mine == F.col("i"), 0).otherwise(1)).drop("_home", "_chunk", "_h", "_c")


PAIR = ["a", "b", "id_a", "id_b", "digest_a", "digest_b"]


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The verified of candidate pairs: vertices a > b, each with a doc_id and the digest of its text."""
    ids = pairs.select(F.col("id_a").alias("doc_id")).unionByName(pairs.select(F.col("id_b").alias("doc_id"))).distinct()
    few = cut_lineage(texts.join(ids, "doc_id", "left_semi"), "candidate-texts")
    side = lambda x: few.select(F.col("doc_id").alias(f"id_{x}"), F.col("text").alias(f"text_{x}"))
    whole = pairs.join(side("a"), "id_a").join(side("b"), "id_b").select("a", "b", "digest_a", "digest_b", "text_a", "text_b")
    return cut_lineage(whole.mapInArrow(_verify(k, percent), "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, key: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept for every row of ``docs``.

    With ``key`` (a long column that tells rows of one doc_id apart) also ``key`` and ``group``, a number of the row's own
    component, which rows of other components do not share even where their smallest doc_id is the same; null without shingles.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.col(key).cast("long") if key else F.lit(0).cast("long")).alias("key"))
    sig = cut_lineage(texts.mapInArrow(_sign(k), "doc_id long, key long, digest binary, n_shingles long, bands array<long>, bits array<long>, sketch binary"), "signatures")
    named, repeated = vertex_ids(sig.where("n_shingles > 0 and doc_id is not null"), "doc_id")
    vertices = named.groupBy("digest").agg(F.min("_vertex").alias("node"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"),
                                           F.first("bands").alias("bands"), F.first("bits").alias("bits"), F.first("sketch").alias("sketch"))
    vertices = cut_lineage(vertices, "vertices")
    named_texts = texts.where("doc_id is not null").drop("key")

    members = vertices.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("_last")).where("head < _last").drop("_last")
    held = cut_lineage(members.join(shared, "bucket"), "buckets")
    about = vertices.join(held.select("node").distinct(), "node", "left_semi").select("node", "least", "digest", "n", "bits", "sketch")
    about = cut_lineage(about, "candidates")
    side = lambda x: about.select(F.col("node").alias(x), F.col("least").alias(f"id_{x}"), F.col("digest").alias(f"digest_{x}"), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch"))

    star = held.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    star = star.join(side("a"), "a").join(side("b"), "b").select(*PAIR, "a_n", "b_n", "a_sketch", "b_sketch")
    star = cut_lineage(star.mapInArrow(_compare(percent), "a long, b long, id_a long, id_b long, digest_a binary, digest_b binary, near boolean, loose boolean"), "star")
    links = _links(star.where("near").select(*PAIR), named_texts, k, percent)
    groups = components(links)
    clusters = components(star.where("near or loose").select("a", "b"))

    label = about.join(groups.withColumnRenamed("component", "_g"), "node", "left").join(clusters.withColumnRenamed("component", "_c"), "node", "left")
    label = label.select("node", "least", "digest", "n", "bits", "sketch", F.coalesce("_g", "node").alias("group"), F.coalesce("_c", "node").alias("cluster"))
    label = cut_lineage(label, "labelled")
    schema = "a long, b long, id_a long, id_b long, digest_a binary, digest_b binary"
    within = _blocks(label.drop("bits")).groupBy("cluster", "i", "j").applyInArrow(_block(percent), schema)

    thin = held.select("bucket", "node").join(label.select("node", "group", "cluster"), "node")
    open_ = thin.groupBy("bucket").agg(F.min("cluster").alias("_lo"), F.max("cluster").alias("_hi")).where("_lo < _hi").select("bucket")
    rest = thin.select("bucket", "node").join(open_, "bucket", "left_semi").join(label.drop("sketch"), "node")
    rest = cut_lineage(rest, "open-buckets")
    columns = ("node", "cluster", "group", "least", "n", "bits", "digest")
    one = rest.select("bucket", *[F.col(c).alias(f"a_{c}") for c in columns])
    two = rest.select("bucket", *[F.col(c).alias(f"b_{c}") for c in columns])
    on = (one["bucket"] == two["bucket"]) & (F.col("a_node") > F.col("b_node")) & (F.col("a_cluster") != F.col("b_cluster")) & (F.col("a_group") != F.col("b_group")) & _near(percent)
    across = one.join(two, on).select(*[F.col(c).alias(n) for c, n in zip(("a_node", "b_node", "a_least", "b_least", "a_digest", "b_digest"), PAIR)]).distinct()
    more = cut_lineage(within.unionByName(across).join(star.where("near").select("a", "b"), ["a", "b"], "left_anti"), "cross")
    if not more.isEmpty():
        groups = components(links.unionByName(_links(more.select(*PAIR), named_texts, k, percent)))

    found = smallest_ids(vertices.select("digest", "node", "least"), groups, repeated)
    out = sig.select("doc_id", "key", "digest", "n_shingles").join(found, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    out = out.select("doc_id", "n_shingles", own.alias("component_id"), *(["key", "group"] if key else []))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
