"""Paged record services (REST APIs) as a partitioned Spark source.

``spark.read.format("paged_records")`` plans the pages on the driver and
fetches them inside executors:

* ``paging=offset``: the row count (option ``count`` or the service's own
  count) and ``page_size`` give ``ceil(count / page_size)`` disjoint offset
  windows; consecutive windows are grouped into partitions
  (``pages_per_partition``).  A short page is followed up inside its window; a
  planned row that does not come is an error.  Pages must be ordered by a stable key
  (``order``) or rows move between pages; retries re-fetch a page, so pages
  must be idempotent.
* ``paging=cursor``: a chain of pages linked by ``next`` cannot be split;
  every chain (``starts``: one start link per chain, e.g. per mailbox or per
  loop value) is one partition, and chains run in parallel.
* ``paging=open``: a service without a count is read page by page until an
  empty one, in one partition per loop value.

``loop_values`` (a list) with ``loop_param`` repeats the plan for each value, bound as
a request parameter; ``loop_column`` adds the value to each record.

Rows come out as ``(page bigint, record string)`` with the record as JSON
text; ``read`` parses them with ``from_json`` against a schema.

Transports: ``http`` (GET with limit / offset / order / where query
parameters, or a next link), or a class of the user's own, named ``module:Class``.
Pages that are to be kept, resumed or replayed go to a table:
``wareloom.sources.captures``.
"""

from __future__ import annotations

import json
import math
import time
import urllib.parse
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

OUTPUT_SCHEMA = "page bigint, record string"
DEFAULT_PAGE_SIZE = 1000
DEFAULT_TIMEOUT = 60
DEFAULT_RETRIES = 3
# records keep full microsecond precision through JSON
JSON_OPTIONS = {"ignoreNullFields": "false",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


# ---- transports -------------------------------------------------------------

class HttpTransport:
    """Open-data style paging: ``?$limit=&$offset=&$order=&$where=``; count by
    ``?$select=count(*) as n``.  Parameter names are options."""

    def __init__(self, opts: dict):
        self.url = opts["url"]
        self.timeout = float(opts.get("timeout", DEFAULT_TIMEOUT))
        self.retries = int(opts.get("retries", DEFAULT_RETRIES))
        self.p_limit = opts.get("limit_param", "$limit")
        self.p_offset = opts.get("offset_param", "$offset")
        self.p_order = opts.get("order_param", "$order")
        self.p_where = opts.get("where_param", "$where")
        self.order = opts.get("order")
        self.where = opts.get("where")
        self.records_key = opts.get("records_key")  # a dotted path; None: the body is a list
        self.count_params = json.loads(opts.get("count_params", "null")) or {"$select": "count(*) as n"}
        self.count_key = opts.get("count_key")  # a dotted path; None: the first value of the (first) record
        self.extra = json.loads(opts.get("extra_params", "{}"))
        self.token = {k: opts.get(f"token_{k}") for k in ("url", "form", "key", "param")}
        self.next_key = opts.get("next_key", "next")
        self.headers = json.loads(opts.get("headers", "{}"))

    def _get(self, url: str):
        err = None
        for attempt in range(self.retries + 1):
            try:
                req = urllib.request.Request(url, headers=self.headers)
                with urllib.request.urlopen(req, timeout=self.timeout) as r:
                    return json.loads(r.read().decode("utf-8"))
            except Exception as e:  # noqa: BLE001 - network errors are retried
                err = e
                time.sleep(min(2 ** attempt, 30))
        raise err

    def _get_token(self) -> str:
        """A token from ``token_url``: a form post, the token at ``token_key`` of the answer."""
        form = urllib.parse.urlencode(json.loads(self.token["form"] or "{}")).encode()
        with urllib.request.urlopen(urllib.request.Request(self.token["url"], data=form), timeout=self.timeout) as r:
            return _walk(json.loads(r.read().decode("utf-8")), self.token["key"] or "token")

    def _url(self, params: dict) -> str:
        if self.token["url"] and (self.token["param"] or "token") not in self.extra:
            self.extra[self.token["param"] or "token"] = self._get_token()  # once per task
        q = {k: v for k, v in (params | self.extra).items() if v is not None}
        sep = "&" if "?" in self.url else "?"
        return self.url + sep + urllib.parse.urlencode(q)

    def count(self) -> int:
        body = self._get(self._url(self.count_params | {self.p_where: self.where}))
        if self.count_key:
            return int(_walk(body, self.count_key))
        row = body[0] if isinstance(body, list) else body
        return int(next(iter(row.values())))

    def fetch(self, offset: int, limit: int) -> list:
        body = self._get(self._url({self.p_limit: limit, self.p_offset: offset, self.p_order: self.order,
                                    self.p_where: self.where}))
        return body if self.records_key is None else _walk(body, self.records_key) or []

    def follow(self, link: str):
        body = self._get(link)
        recs = body if isinstance(body, list) else _walk(body, self.records_key or "value") or []
        nxt = None if isinstance(body, list) else _walk(body, self.next_key)
        return recs, nxt


def _walk(body, path: str):
    """The value at a dotted path of nested objects (numbers index lists); None where it ends."""
    for key in path.split("."):
        if isinstance(body, list):
            body = body[int(key)] if key.isdigit() and int(key) < len(body) else None
        else:
            body = body.get(key) if isinstance(body, dict) else None
    return body


TRANSPORTS = {"http": HttpTransport}


def transport(opts: dict):
    """The transport of a request: ``http``, or ``module:Class`` of the user's own with ``count``, ``fetch`` and ``follow``."""
    name = opts.get("transport", "http")
    if ":" in name:
        import importlib

        module, _, cls = name.partition(":")
        return getattr(importlib.import_module(module), cls)(opts)
    return TRANSPORTS[name](opts)


# ---- the data source -----------------------------------------------------------

class OffsetWindows(InputPartition):
    def __init__(self, first_page: int, pages: int, page_size: int, count: int, bound=None):
        super().__init__((first_page, pages, page_size, count, bound))
        self.first_page, self.pages, self.page_size, self.count, self.bound = first_page, pages, page_size, count, bound


class OpenPages(InputPartition):
    def __init__(self, page_size: int, bound=None):
        super().__init__((page_size, bound))
        self.page_size, self.bound = page_size, bound


class CursorChain(InputPartition):
    def __init__(self, chain: int, start: str):
        super().__init__((chain, start))
        self.chain, self.start = chain, start


def _as_text(rec) -> str:
    return rec if isinstance(rec, str) else json.dumps(rec, separators=(",", ":"))


class PagedRecordsReader(DataSourceReader):
    """Raw mode: rows ``(page, record JSON text)``."""

    def __init__(self, options: dict):
        self.opts = dict(options)

    def partitions(self):
        opts = self.opts
        if opts.get("paging", "offset") == "cursor":
            starts = json.loads(opts["starts"])
            return [CursorChain(i, s) for i, s in enumerate(starts)]
        size = int(opts.get("page_size", DEFAULT_PAGE_SIZE))
        out = []
        for bound in json.loads(opts["loop_values"]) if "loop_values" in opts else [None]:
            if opts.get("paging", "offset") == "open":
                out.append(OpenPages(size, bound))
                continue
            count = int(opts["count"]) if "count" in opts else self._transport(bound).count()
            n_pages = math.ceil(count / size) if count > 0 else 0
            if "pages_per_partition" in opts:
                per = max(1, int(opts["pages_per_partition"]))
            else:
                per = max(1, math.ceil(n_pages / max(1, int(opts.get("target_partitions", 64)))))
            out += [OffsetWindows(p, min(per, n_pages - p), size, count, bound) for p in range(0, n_pages, per)]
        return out

    def _options(self, bound) -> dict:
        """The options of a request with its loop value bound."""
        if bound is None:
            return dict(self.opts)
        extra = json.loads(self.opts.get("extra_params", "{}")) | {self.opts["loop_param"]: bound}
        return self.opts | {"extra_params": json.dumps(extra)}

    def _transport(self, bound=None):
        return transport(self._options(bound))

    def _looped(self, partition, recs: list) -> list:
        """Records with their loop value, when a column is asked for."""
        bound, column = getattr(partition, "bound", None), self.opts.get("loop_column")
        if bound is None or not column:
            return recs
        return [(json.loads(r) if isinstance(r, str) else r) | {column: bound} for r in recs]

    def pages(self, partition):
        """(page number, records) of a partition, fetched in the task."""
        t = self._transport(getattr(partition, "bound", None))
        if isinstance(partition, OpenPages):
            got, page = 0, 0
            while recs := t.fetch(got, partition.page_size):
                yield page, self._looped(partition, recs)
                got, page = got + len(recs), page + 1
            return
        if isinstance(partition, CursorChain):
            link, page = partition.start, 0
            seen = set()
            while link:
                if link in seen:
                    raise RuntimeError(f"the chain from {partition.start} comes back to {link}")
                seen.add(link)
                recs, link = t.follow(link)
                yield page, recs
                page += 1
            return
        for p in range(partition.first_page, partition.first_page + partition.pages):
            first, got = p * partition.page_size, 0
            planned = min(partition.page_size, partition.count - first)
            while got < planned:  # a service may answer fewer rows than asked
                recs = t.fetch(first + got, partition.page_size - got)
                if not recs:
                    break
                got += len(recs)
                yield p, self._looped(partition, recs)
            if got < planned and self._count_holds():
                raise RuntimeError(f"rows {first} to {first + planned - 1} were planned, but the service gave {got} of them")

    def _count_holds(self) -> bool:
        """Whether every planned row must come."""
        return True

    def read(self, partition):
        if partition is None:  # no pages planned (an empty service)
            return
        for page, recs in self.pages(partition):
            for r in recs:
                yield (page, _as_text(r))


# ---- typed mode with filter pushdown -------------------------------------------

def _supported(f, columns: set) -> bool:
    """Filters whose result on NULL is the same here as in Spark: plain
    comparisons, never true on NULL, and the NULL tests.  Negations and ``<=>``
    are left to Spark."""
    from pyspark.sql import datasource as ds

    simple = (ds.EqualTo, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual, ds.In, ds.IsNull, ds.IsNotNull,
              ds.StringStartsWith, ds.StringEndsWith, ds.StringContains)
    return isinstance(f, simple) and len(f.attribute) == 1 and f.attribute[0] in columns


def _arrow_mask(table, f):
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql import datasource as ds

    if isinstance(f, ds.Not):
        return pc.invert(_arrow_mask(table, f.child))
    col = table.column(f.attribute[0])
    if isinstance(f, ds.IsNull):
        return pc.is_null(col)
    if isinstance(f, ds.IsNotNull):
        return pc.is_valid(col)
    if isinstance(f, ds.In):
        return pc.is_in(col, value_set=pa.array(list(f.value), type=col.type))
    if isinstance(f, ds.StringStartsWith):
        return pc.starts_with(col, f.value)
    if isinstance(f, ds.StringEndsWith):
        return pc.ends_with(col, f.value)
    if isinstance(f, ds.StringContains):
        return pc.match_substring(col, f.value)
    if isinstance(f, ds.EqualNullSafe) and f.value is None:
        return pc.is_null(col)
    v = pa.scalar(f.value, type=col.type)
    op = {ds.EqualTo: pc.equal, ds.EqualNullSafe: pc.equal, ds.GreaterThan: pc.greater,
          ds.GreaterThanOrEqual: pc.greater_equal, ds.LessThan: pc.less, ds.LessThanOrEqual: pc.less_equal}[type(f)]
    return op(col, v)


def _soql_literal(v) -> str:
    import datetime as dt

    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (dt.datetime, dt.date)):
        return "'" + v.isoformat() + "'"
    return repr(v)


def soql_where(filters) -> str | None:
    """The pushed filters as one SoQL ``$where`` conjunction."""
    from pyspark.sql import datasource as ds

    def one(f):
        if isinstance(f, ds.Not):
            return f"NOT ({one(f.child)})"
        c = f.attribute[0]
        if isinstance(f, ds.IsNull) or (isinstance(f, ds.EqualNullSafe) and f.value is None):
            return f"{c} IS NULL"
        if isinstance(f, ds.IsNotNull):
            return f"{c} IS NOT NULL"
        if isinstance(f, ds.In):
            return f"{c} IN (" + ", ".join(_soql_literal(v) for v in f.value) + ")"
        if isinstance(f, ds.StringStartsWith):
            return f"starts_with({c}, {_soql_literal(f.value)})"
        if isinstance(f, ds.StringEndsWith):
            return f"{c} like {_soql_literal('%' + f.value)}"
        if isinstance(f, ds.StringContains):
            return f"contains({c}, {_soql_literal(f.value)})"
        sym = {ds.EqualTo: "=", ds.EqualNullSafe: "=", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=",
               ds.LessThan: "<", ds.LessThanOrEqual: "<="}[type(f)]
        return f"{c} {sym} {_soql_literal(f.value)}"

    parts = [one(f) for f in filters]
    return " AND ".join(f"({p})" for p in parts) if parts else None


class TypedPagedReader(PagedRecordsReader):
    """Typed mode (a schema was given): records parsed to Arrow batches in the
    task; comparisons on top-level columns are pushed to the service (SoQL
    ``$where`` for http) and applied to each page as it is fetched."""

    def __init__(self, options: dict, schema):
        super().__init__(options)
        self.schema = schema
        self.pushed = []

    def pushFilters(self, filters):
        cols = {f.name for f in self.schema.fields}
        for f in filters:
            if _supported(f, cols):
                self.pushed.append(f)
            else:
                yield f

    def _count_holds(self) -> bool:
        # a count given by the caller knows nothing of the filters pushed later
        return not (self.pushed and "count" in self.opts)

    def _transport(self, bound=None):
        opts = self._options(bound)
        if self.pushed and opts.get("transport", "http") == "http":
            extra = soql_where(self.pushed)
            opts["where"] = f"({opts['where']}) AND {extra}" if opts.get("where") else extra
        return transport(opts)

    def read(self, partition):
        if partition is None:
            return
        import io

        import pyarrow as pa
        import pyarrow.json as pj
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow_schema = to_arrow_schema(self.schema)
        popts = pj.ParseOptions(explicit_schema=arrow_schema, unexpected_field_behavior="ignore")
        for _page, recs in self.pages(partition):
            if not recs:
                continue
            text = "\n".join(_as_text(r) for r in recs).encode("utf-8")
            table = pj.read_json(io.BytesIO(text), parse_options=popts).select(arrow_schema.names)
            for f in self.pushed:  # also after a service-side filter: cheap and exact
                table = table.filter(_arrow_mask(table, f))
            table = table.cast(arrow_schema)
            for batch in table.to_batches():
                yield batch


class PagedRecordsSource(DataSource):
    @classmethod
    def name(cls):
        return "paged_records"

    def schema(self):
        return OUTPUT_SCHEMA

    def reader(self, schema):
        if [f.name for f in schema.fields] == ["page", "record"]:
            return PagedRecordsReader(self.options)
        return TypedPagedReader(self.options, schema)


def register(spark: SparkSession) -> None:
    from wareloom.session import ship_package

    ship_package(spark)
    # Python data sources are offered filters only with this on
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedRecordsSource)


def _reader(spark: SparkSession, options: dict):
    register(spark)
    r = spark.read.format("paged_records")
    options = dict(options)
    options.setdefault("target_partitions", 4 * spark.sparkContext.defaultParallelism)
    for k, v in options.items():
        r = r.option(k, json.dumps(v) if isinstance(v, (list, dict)) else str(v))
    return r


def read(spark: SparkSession, schema: str, **options) -> DataFrame:
    """Read a paged service and parse its records against ``schema`` (JVM ``from_json``)."""
    raw = _reader(spark, options).load()
    return raw.select(F.from_json("record", schema, JSON_OPTIONS).alias("r")).select("r.*")


def read_typed(spark: SparkSession, schema: str, **options) -> DataFrame:
    """Read a paged service as typed columns; filters on the result are pushed
    to the service (see ``TypedPagedReader``)."""
    return _reader(spark, options).schema(schema).load()
