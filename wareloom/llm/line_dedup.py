"""Line dedup: documents probe a sharded minimal perfect hash of repeated lines.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased.  A key of at least ``min_chars`` code points found in two or more
documents (doc_ids) stays only in the smallest doc_id that holds it; there all
its lines stay.

How: tasks reduce each batch to distinct key hashes (128 bits) with smallest
and largest doc_id; one aggregation keeps the hashes with two documents.  Each
shard of those is built, in its own task, into a minimal perfect hash with a
fingerprint, a count and an owner array.  An index of at most ``group_bytes`` is
broadcast and documents probe it map-side, so lines are never joined.  A larger index
stays where it is: documents are written once with row numbers and send a probe of 40 bytes
per line to the shard's task, which holds one shard at a time and streams the probes
past its arrays; only marked positions come back to the documents.  Probes of a shard are
dealt over ``salts`` copies of it, so a very frequent line is not one task's work.

Defined cases: a null or empty text is one empty line; rows with a null doc_id
neither count nor lose lines; rows with one doc_id are one document; a
document that loses every line has an empty text; an empty table gives no
rows; ``n_lines`` and ``n_dropped`` of the input are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.llm.mph import PerfectHash, build
from wareloom.llm.text_hash import mix, spare
from wareloom.session import cut_lineage, ship_package

SPACE = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 1 << 17
GROUP_BYTES = 64 << 20


def line_key(line: bytes, min_chars: int) -> bytes | None:
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _texts(batch: pa.RecordBatch, name: str):
    for x in batch.column(name):
        yield (x.as_py() or "").encode("utf-8")


def _held(min_chars: int):
    """Task: distinct line hashes of the batch with rows, smallest and largest doc_id."""

    def rows(seen: dict) -> pa.RecordBatch:
        pair = np.frombuffer(b"".join(seen), dtype="<i8").reshape(-1, 2)
        got = np.array(list(seen.values()), dtype=np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)) for a in (pair[:, 0], pair[:, 1], got[:, 0], got[:, 1], got[:, 2])], ["h1", "h2", "docs", "lo", "hi"])

    def run(batches):
        for batch in batches:
            seen: dict = {}
            for doc, raw in zip(batch.column("doc_id").to_pylist(), _texts(batch, "text")):
                if doc is None:
                    continue
                for d in {_digest(k) for k in (line_key(x, min_chars) for x in raw.split(b"\n")) if k is not None}:
                    was = seen.get(d)
                    seen[d] = (1, doc, doc) if was is None else (was[0] + 1, min(was[1], doc), max(was[2], doc))
                if len(seen) > 200_000:
                    yield rows(seen)
                    seen = {}
            if seen:
                yield rows(seen)

    return run


def _keys(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return mix(h1.view(np.uint64) ^ mix(h2.view(np.uint64)))


def _shard(table: pa.Table) -> pa.Table:
    """One shard's rows as perfect hash, fingerprint, count and owner arrays."""
    col = lambda n: np.ascontiguousarray(table.column(n).to_numpy())
    h1, h2 = col("h1"), col("h2")
    raw = build(_keys(h1, h2))
    at = PerfectHash(raw).index(_keys(h1, h2))
    prints, counts, owners = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.uint32), np.zeros(len(h1), np.int64)
    prints[at], owners[at] = h2, col("lo")
    counts[at] = np.minimum(col("docs"), 2**32 - 1)
    return pa.table({"shard": pa.array([int(table.column("shard")[0].as_py())], pa.int32()), "n": pa.array([len(h1)], pa.int64()),
                     "hash": pa.array([raw], pa.binary()), "prints": pa.array([prints.tobytes()], pa.binary()),
                     "counts": pa.array([counts.tobytes()], pa.binary()), "owners": pa.array([owners.tobytes()], pa.binary())})


def line_index(docs: DataFrame, min_chars: int = 10) -> tuple[DataFrame, int]:
    """(one row per shard of the index of repeated lines, number of shards)."""
    ship_package(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = ids.mapInArrow(_held(min_chars), "h1 long, h2 long, docs long, lo long, hi long")
    again = held.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi")
    again = cut_lineage(again, "lines")
    shards = -(-again.count() // SHARD_KEYS)
    if not shards:
        return docs.sparkSession.createDataFrame([], "shard int, n long, hash binary, prints binary, counts binary, owners binary"), 0
    rows = again.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    built = rows.groupBy("shard").applyInArrow(_shard, "shard int, n long, hash binary, prints binary, counts binary, owners binary")
    return cut_lineage(built, "line-index"), shards


PROBE = "row long, line int, doc long, h1 long, h2 long"
ARRAYS = ["hash", "prints", "counts", "owners"]


def _arrays(raw) -> tuple:
    """A shard's perfect hash, fingerprints, counts and owners."""
    h, p, c, o = raw
    return PerfectHash(h), np.frombuffer(p, np.int64), np.frombuffer(c, np.uint32), np.frombuffer(o, np.int64)


def _hit(arrays: tuple, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, min_docs: int) -> np.ndarray:
    """Which probes name a line of another document."""
    perfect, prints, counts, owners = arrays
    at = perfect.index(_keys(h1, h2))
    return (at >= 0) & (prints[at] == h2) & (counts[at] >= min_docs) & (owners[at] != doc)


def _probes(min_chars: int):
    """Task: the probes of documents (row, doc_id, text)."""

    def run(batches):
        for batch in batches:
            out: list = []
            for row, doc, raw in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), _texts(batch, "text")):
                if doc is not None:
                    out += [(row, j, doc, *np.frombuffer(_digest(k), "<i8").tolist()) for j, x in enumerate(raw.split(b"\n")) if (k := line_key(x, min_chars)) is not None]
                if len(out) > 100_000:
                    yield _probe_batch(out)
                    out = []
            if out:
                yield _probe_batch(out)

    return run


def _probe_batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["row", "line", "doc", "h1", "h2"])


def _stream(min_docs: int):
    """Task: rows sorted by shard, the shard's arrays before its probes -> marked (row, line)."""

    def run(batches):
        held, arrays = None, None
        for batch in batches:
            shard, index = batch.column("shard").to_numpy(), batch.column("hash").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if shard[a] != held:
                    held, arrays = shard[a], None
                for i in (np.flatnonzero(index[a:b]) + a).tolist():
                    arrays = _arrays([batch.column(c)[i].as_py() for c in ARRAYS])
                at = np.flatnonzero(~index[a:b]) + a
                if arrays is None or not len(at):
                    continue
                h1, h2, doc = (batch.column(c).take(pa.array(at)).to_numpy() for c in ("h1", "h2", "doc"))  # probes have no nulls
                mask = pa.array(at[_hit(arrays, h1, h2, doc, min_docs)])
                yield pa.RecordBatch.from_arrays([batch.column("row").take(mask), batch.column("line").take(mask)], ["row", "line"])

    return run


def _marked_apart(numbered: DataFrame, index: DataFrame, shards: int, min_chars: int, min_docs: int, salts: int) -> DataFrame:
    """(row, marked lines) of the documents ``numbered`` (row, doc_id, text), each shard probed in tasks of its own."""
    probes = numbered.select("row", "doc_id", "text").mapInArrow(_probes(min_chars), PROBE)
    probes = probes.withColumns({"shard": F.pmod("h1", F.lit(shards)).cast("int"), "salt": F.pmod(F.xxhash64("row", "line"), F.lit(salts)).cast("int")})
    arrays = index.select("shard", *ARRAYS).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = probes.unionByName(arrays, allowMissingColumns=True)
    dealt = both.repartition("shard", "salt").sortWithinPartitions("shard", F.col("hash").isNull())
    hits = dealt.mapInArrow(_stream(min_docs), "row long, line int")
    return hits.groupBy("row").agg(F.collect_set("line").alias("marked"))  # lines of one document


def _reduced(batch: pa.RecordBatch, raws: list[bytes], marked: list, drop: str | None = None) -> pa.RecordBatch:
    """``batch`` with texts without their marked lines, n_lines and n_dropped."""
    columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if f.name != drop}
    split = [raw.split(b"\n") for raw in raws]
    kept = [raw if not m else b"\n".join(x for j, x in enumerate(parts) if j not in m) for raw, parts, m in zip(raws, split, marked)]
    columns["text"] = pa.array([k.decode("utf-8") for k in kept], pa.string())
    columns["n_lines"] = pa.array([len(p) for p in split], pa.int64())
    columns["n_dropped"] = pa.array([len(m) for m in marked], pa.int64())
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _probe(shards: int, held, min_chars: int, min_docs: int):
    """Task: drop the lines that the shards in ``held`` (a broadcast) give to another document."""

    def run(batches):
        index = {s: _arrays(raw) for s, *raw in (held.value if held else ())}
        for batch in batches:
            ids, raws = batch.column("doc_id").to_pylist(), list(_texts(batch, "text"))
            marked: list = [set() for _ in raws]
            row, line, owner_of, digests = [], [], [], []
            for i, (doc, raw) in enumerate(zip(ids, raws)):
                if doc is None or not index:
                    continue
                for j, x in enumerate(raw.split(b"\n")):
                    if (key := line_key(x, min_chars)) is not None:
                        row.append(i)
                        line.append(j)
                        owner_of.append(doc)
                        digests.append(_digest(key))
            if digests:
                pair = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                h1, h2 = np.ascontiguousarray(pair[:, 0]), np.ascontiguousarray(pair[:, 1])
                docs, shard = np.array(owner_of, dtype=np.int64), h1 % shards
                for s, arrays in index.items():
                    here = np.flatnonzero(shard == s)
                    for k in here[_hit(arrays, h1[here], h2[here], docs[here], min_docs)]:
                        marked[row[k]].add(line[k])
            yield _reduced(batch, raws, marked)

    return run


def _drop(column: str):
    """Task: drop the lines listed in ``column``."""

    def run(batches):
        for batch in batches:
            marked = [set(x or ()) for x in batch.column(column).to_pylist()]
            yield _reduced(batch, list(_texts(batch, "text")), marked, column)

    return run


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, group_bytes: int = GROUP_BYTES, salts: int = 8) -> DataFrame:
    """``docs`` with text reduced to its kept lines, n_lines (before) and n_dropped.

    ``min_docs`` spares lines that fewer document rows hold."""
    sc = docs.sparkSession.sparkContext
    index, shards = line_index(docs, min_chars)
    state = docs.drop("n_lines", "n_dropped").withColumn("doc_id", F.col("doc_id").cast("long"))
    made = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema.fields) + ", n_lines long, n_dropped long"
    size = index.agg(F.coalesce(F.sum(F.length("hash") + 20 * F.col("n")), F.lit(0))).first()[0] if shards else 0
    if size <= group_bytes:
        rows = [tuple(map(lambda v: bytes(v) if isinstance(v, bytearray) else v, r)) for r in index.select("shard", *ARRAYS).collect()] if shards else []
        held = sc.broadcast(rows) if rows else None
        return state.mapInArrow(_probe(shards, held, min_chars, min_docs), made)
    row, lines = spare("row", state.columns), spare("marked", state.columns)
    numbered = cut_lineage(state.withColumn(row, F.monotonically_increasing_id()), "numbered-texts")
    marked = _marked_apart(numbered.select(F.col(row).alias("row"), "doc_id", "text"), index, shards, min_chars, min_docs, salts)
    marked = cut_lineage(marked, "lines-marked").select(F.col("row").alias(row), F.col("marked").alias(lines))
    return numbered.join(marked, row, "left").drop(row).mapInArrow(_drop(lines), made)
