"""Test service: pages as files below a folder, and their writers."""

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME = "folder_pages:FolderTransport"


class FolderTransport:
    """Pages stored as files below a (shared) folder.

    Offset layout: ``page=<k>/`` holds the records of window k, one JSON per
    line, plus ``_meta.json`` with the row count and page size.
    Cursor layout: a link is a folder holding one JSON object
    ``{"value": [...], "next": <link or null>}``.
    """

    def __init__(self, opts: dict):
        self.root = _local(opts["location"])

    def _lines(self, folder: str) -> list[str]:
        out = []
        if not os.path.isdir(folder):
            return out
        for n in sorted(os.listdir(folder)):
            if n.startswith(("_", ".")):
                continue
            with open(os.path.join(folder, n), encoding="utf-8") as fh:
                out.extend(ln for ln in fh.read().splitlines() if ln.strip())
        return out

    def meta(self) -> dict:
        with open(os.path.join(self.root, "_meta.json"), encoding="utf-8") as fh:
            return json.load(fh)

    def count(self) -> int:
        return int(self.meta()["count"])

    def fetch(self, offset: int, limit: int) -> list:
        size = int(self.meta()["page_size"])
        page, skip = divmod(offset, size)
        if skip + limit != size:
            raise ValueError(f"folder pages hold {size} rows; asked offset={offset} limit={limit}")
        # records are already JSON text: passed through unparsed
        return self._lines(os.path.join(self.root, f"page={page}"))[skip:]

    def follow(self, link: str):
        lines = self._lines(os.path.join(self.root, link))
        if not lines:
            return [], None
        body = json.loads(lines[0])
        return body.get("value", []), body.get("next")


def _local(path: str) -> str:
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return path


def write_offset_pages(df: DataFrame, path: str, order_col: str, page_size: int) -> int:
    """Write ``df`` as offset pages ordered by ``order_col`` (dense 0-based
    positions are computed with a distributed sequence id).  Returns the count."""
    from wareloom.operators.load import with_sequence_id
    from wareloom.sources import paged

    seq = with_sequence_id(df, "__pos", [order_col], start=-1)
    rec = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), paged.JSON_OPTIONS)
    out = seq.select(F.floor(F.col("__pos") / page_size).alias("page"), rec.alias("value"))
    # cluster by page first: one file per page instead of one per (task, page);
    # a page holds at most page_size rows, so no partition can grow hot
    out.repartition("page").write.mode("overwrite").partitionBy("page").text(path)
    n = df.count()
    with open(os.path.join(_local(path), "_meta.json"), "w", encoding="utf-8") as fh:
        json.dump({"count": n, "page_size": page_size}, fh)
    return n


def write_cursor_pages(df: DataFrame, path: str, chain_col: str, order_col: str, page_size: int) -> list[str]:
    """Write one linked chain of pages per value of ``chain_col``; returns the start links.

    Positions come from one distributed sequence over (chain, order) minus
    each chain's first position (a per-chain aggregate), so no task holds a
    whole chain; a page is assembled from at most ``page_size`` rows.
    """
    from wareloom.operators.load import with_sequence_id
    from wareloom.sources import paged

    rec = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), paged.JSON_OPTIONS)
    base = df.select(F.col(chain_col).cast("string").alias("chain"), F.col(order_col).alias("__o"), rec.alias("rec"))
    seq = with_sequence_id(base, "__g", ["chain", "__o"], start=-1)
    bounds = seq.groupBy("chain").agg(F.min("__g").alias("__first"), F.count(F.lit(1)).alias("__n"))
    pos = seq.join(bounds, "chain").withColumn("__pos", F.col("__g") - F.col("__first"))
    pages = (pos.withColumn("page", F.floor(F.col("__pos") / page_size))
             .groupBy("chain", "page", "__n")
             .agg(F.sort_array(F.collect_list(F.struct("__o", "rec"))).alias("rs")))
    has_next = (F.col("page") + 1) * page_size < F.col("__n")
    nxt = F.when(has_next, F.concat(F.lit('"chain='), F.col("chain"), F.lit("/page="),
                                    (F.col("page") + 1).cast("string"), F.lit('"'))).otherwise(F.lit("null"))
    body = F.concat(F.lit('{"value":['), F.array_join(F.transform("rs", lambda s: s["rec"]), ","),
                    F.lit('],"next":'), nxt, F.lit("}"))
    pages.select("chain", "page", body.alias("value")).write.mode("overwrite").partitionBy("chain", "page").text(path)
    chains = [r["chain"] for r in bounds.select("chain").collect()]
    return [f"chain={c}/page=0" for c in sorted(chains)]
