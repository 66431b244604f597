"""Derived fixtures: deterministic expressions over the driver tables.

Every fixture exists twice, as a Spark DataFrame builder and as DuckDB SQL
(``SQL[name]``), so an oracle can rebuild it in a CTE.  All of them read
whole tables; splits such as master / staging partition a table, they do
not sample it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SCHEMAS: dict[tuple[int, str], T.StructType] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table.  Its Parquet schema is inferred once per session and
    path (inference is a small job of its own); later reads pass it along."""
    path = f"{d.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def _dbl(expr: str) -> F.Column:
    return F.expr(f"CAST({expr} AS DOUBLE)")


# ---- F1: master / staging pairs --------------------------------------------

def master_orders(spark, d):
    return table(spark, d, "orders").where("o_orderkey % 10 < 7")


def staging_orders(spark, d):
    o = table(spark, d, "orders").where("o_orderkey % 10 >= 5")
    return o.withColumn("o_totalprice", F.col("o_totalprice") + 100)


def master_lines(spark, d):
    return table(spark, d, "lineitem").where("l_orderkey % 10 < 7")


def staging_lines(spark, d):
    li = table(spark, d, "lineitem").where("l_orderkey % 10 >= 5")
    return li.withColumn("l_extendedprice", F.col("l_extendedprice") + 100)


def _null_key(df):
    return df.withColumn("o_orderkey", F.expr("CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END"))


def master_orders_nk(spark, d):
    return _null_key(master_orders(spark, d))


def staging_orders_nk(spark, d):
    return _null_key(staging_orders(spark, d))


def master_gen(spark, d):
    m = master_orders(spark, d)
    return m.select((F.col("o_orderkey") + 1).alias("row_id"), F.col("o_orderkey").alias("source_id"),
                    "o_custkey", "o_totalprice")


def staging_gen(spark, d):
    s = staging_orders(spark, d)
    return s.select(F.col("o_orderkey").alias("source_id"), "o_custkey", "o_totalprice")


# ---- F2: contract table ------------------------------------------------------

def contract_table(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    lon = _dbl("-80 + (c_custkey % 100) * 0.1")
    lat = _dbl("40 + (c_custkey % 50) * 0.1")
    geo_meta = {"sql_type": "geography"}
    return j.select(
        F.expr("CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE CAST(c_custkey AS INT) END").alias("id"),
        F.concat_ws(", ", "c_name", "n_name").alias("address"),
        F.expr("timestampadd(DAY, c_custkey, TIMESTAMP_NTZ'2020-01-01 00:00:00')").alias("date"),
        (F.col("c_acctbal") > 0).alias("boolean"),
        lon.alias("longitude"), lat.alias("latitude"),
        F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
        .alias("geography", metadata=geo_meta),
    )


# The sample contract (fixed values, as shipped with the validation job).
SAMPLE_CONTRACT = [
    {"COLUMN_NAME": "id", "DATA_TYPE": "int", "NAs": False},
    {"COLUMN_NAME": "address", "DATA_TYPE": "varchar"},
    {"COLUMN_NAME": "date", "DATA_TYPE": "datetime"},
    {"COLUMN_NAME": "boolean", "DATA_TYPE": "bit"},
    {"COLUMN_NAME": "longitude", "DATA_TYPE": "float"},
    {"COLUMN_NAME": "latitude", "DATA_TYPE": "float"},
    {"COLUMN_NAME": "geography", "DATA_TYPE": "geography"},
]


def contract_variants() -> dict[str, list[dict]]:
    exact = SAMPLE_CONTRACT
    changed = [dict(r, DATA_TYPE="int") if r["COLUMN_NAME"] == "latitude" else r for r in exact]
    missing = [r for r in exact if r["COLUMN_NAME"] != "geography"]
    extra = exact + [{"COLUMN_NAME": "zip", "DATA_TYPE": "varchar"}]
    shuffled = list(reversed(exact))
    return {"exact": exact, "type_changed": changed, "column_missing": missing,
            "column_extra": extra, "shuffled": shuffled}


# ---- F3: text-staged columns ---------------------------------------------------

def text_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.expr("CAST(o_orderkey AS STRING)").alias("id_text"),
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END").alias("digits_with_null"),
        F.lit(None).cast("string").alias("all_null"),
        F.expr("CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END").alias("mixed"),
        F.expr("CASE WHEN o_orderkey % 17 = 0 THEN 'bad' WHEN o_orderkey % 19 = 0 THEN '2024-02-30 00:00:00.000' "
               "ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss.SSS') END").alias("order_date"),
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') "
               "ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END").alias("order_day"),
        F.expr("concat('9', lpad(CAST(o_orderkey AS STRING), 19, '0'))").alias("big_digits"),
        F.expr("lpad(CAST(o_orderkey AS STRING), 8, '0')").alias("lead_zero"),
        "o_orderstatus",
        F.expr("CAST(o_custkey % 5 AS STRING)").alias("x:@computed_region"),
    )


# ---- F4: numeric dates -----------------------------------------------------------

def epoch_events(spark, d):
    from wareloom.functions.dates import ts_to_epoch_millis

    e = table(spark, d, "events")
    return e.select("event_id", ts_to_epoch_millis("ts").alias("last_edited_date"),
                    F.lit(None).cast("bigint").alias("close_date"), "value")


def cyyddd_codes(spark, d):
    o = table(spark, d, "orders")
    codes = o.select(F.col("o_orderkey").alias("key"),
                     F.expr("concat('1', date_format(o_orderdate, 'yy'), lpad(CAST(dayofyear(o_orderdate) AS STRING), 3, '0'))")
                     .alias("code"))
    # fixed bad / edge values: day 366 of a non-leap and of a leap year, century 0, junk, NULL
    from wareloom.session import local_rows

    bad = local_rows(spark, [(-1, "123366"), (-2, "124366"), (-3, "099001"), (-4, "x"), (-5, None)],
                     "key bigint, code string")
    return codes.unionByName(bad)


# ---- F5: addresses and places ---------------------------------------------------------

def addr(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    from wareloom.operators.enrich import address

    j = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").alias("id"), "c_name", "n_name")
    # the address expression comes as SQL text, as the geocoding job takes it
    return address(j, "concat_ws(', ', c_name, n_name)").select("id", "FULL_ADDRESS")


def locator(spark, d):
    """Candidates: main (score 90) for ids not divisible by 7, a weaker one for
    ids divisible by 3, a tie (score 90, smaller x) for ids divisible by 5.
    Addresses are written differently (case, spacing) than in ``addr``."""
    a = addr(spark, d).where("id % 7 <> 0")
    spaced = F.lower(F.regexp_replace("FULL_ADDRESS", ", ", ",   "))
    lon = _dbl("-80 + (id % 100) * 0.1")
    lat = _dbl("40 + (id % 50) * 0.1")
    main = a.select(spaced.alias("FULL_ADDRESS"), F.lit(90).alias("score"), lon.alias("longitude"), lat.alias("latitude"))
    weak = a.where("id % 3 = 0").select(spaced.alias("FULL_ADDRESS"), F.lit(80).alias("score"),
                                          (lon + 0.5).alias("longitude"), lat.alias("latitude"))
    tie = a.where("id % 5 = 0").select(spaced.alias("FULL_ADDRESS"), F.lit(90).alias("score"),
                                         (lon - 0.25).alias("longitude"), lat.alias("latitude"))
    return main.unionByName(weak).unionByName(tie)


def addr_g(spark, d):
    """Already geocoded rows (ids not divisible by 4); NULL latitude = failure."""
    a = addr(spark, d).where("id % 4 <> 0")
    lon = _dbl("-80 + (id % 100) * 0.1")
    lat = _dbl("40 + (id % 50) * 0.1")
    ok = F.expr("id % 7 <> 0")
    return a.select("id", "FULL_ADDRESS", F.when(ok, lon).alias("longitude"), F.when(ok, lat).alias("latitude"))


def addr_usps(spark, d):
    """Earlier second-chance attempts: failures with an even id."""
    return addr_g(spark, d).where("latitude IS NULL AND id % 2 = 0").select("id", "FULL_ADDRESS")


def points(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", _dbl("-80 + (c_custkey % 100) * 0.1 + 0.03").alias("longitude"),
                    _dbl("40 + (c_custkey % 50) * 0.1 + 0.03").alias("latitude"))


def counties(spark, d):
    """One square per nation (x -80.., y 40..): sides of 1 for even and 2 for odd nations, so many overlap."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    x0 = _dbl("-80 + n_nationkey % 6")
    y0 = _dbl("40 + n_nationkey div 6")
    w = _dbl("1 + n_nationkey % 2")
    ring = F.array(F.array(x0, y0), F.array(x0 + w, y0), F.array(x0 + w, y0 + w), F.array(x0, y0 + w), F.array(x0, y0))
    return j.select(F.col("n_nationkey").alias("poly_order"), F.col("r_name").alias("STATE"),
                    F.col("n_name").alias("NAME"), F.array(ring).alias("rings"))


# ---- F7: features ------------------------------------------------------------------------

def geometry_text(spark, d):
    """Supplier features with one geometry type per ``s_suppkey % 7`` (6 = NULL)."""
    s = table(spark, d, "supplier")
    x = "CAST(-80 + (s_suppkey % 60) * 0.1 AS DOUBLE)"
    y = "CAST(40 + (s_suppkey % 20) * 0.1 AS DOUBLE)"
    p = lambda dx, dy: f"array({x} + {dx}, {y} + {dy})"
    g = f"""CASE s_suppkey % 7
      WHEN 0 THEN to_json(named_struct('type', 'Point', 'coordinates', array({x}, {y})))
      WHEN 1 THEN to_json(named_struct('type', 'MultiPoint', 'coordinates', array({p(0, 0)}, {p(1, 1)})))
      WHEN 2 THEN to_json(named_struct('type', 'LineString', 'coordinates', array({p(0, 0)}, {p(1, 0)}, {p(1, 1)})))
      WHEN 3 THEN to_json(named_struct('type', 'MultiLineString', 'coordinates',
                  array(array({p(0, 0)}, {p(1, 0)}), array({p(0, 1)}, {p(1, 1)}))))
      WHEN 4 THEN to_json(named_struct('type', 'Polygon', 'coordinates',
                  array(array({p(0, 0)}, {p(1, 0)}, {p(1, 1)}, {p(0, 1)}, {p(0, 0)}))))
      WHEN 5 THEN to_json(named_struct('type', 'MultiPolygon', 'coordinates',
                  array(array(array({p(0, 0)}, {p(1, 0)}, {p(1, 1)}, {p(0, 0)})),
                        array(array({p(2, 0)}, {p(3, 0)}, {p(3, 1)}, {p(2, 0)})))))
    END"""
    return s.select(F.col("s_suppkey").alias("id"),
                    F.expr("s_suppkey * 86400000 + 1700000000000").alias("edit_date"),
                    F.col("s_name").alias("name"), F.expr(g).alias("geometry"))


def point_column(spark, d):
    c = table(spark, d, "customer")
    pt = ("to_json(named_struct('type', 'Point', 'coordinates', array(CAST(-80 + (c_custkey % 100) * 0.1 AS DOUBLE), "
          "CAST(40 + (c_custkey % 50) * 0.1 AS DOUBLE))))")
    return c.select("c_custkey", F.expr(f"CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE {pt} END")
                    .alias("location_latitude_longitude"))


# ---- F8: listing -----------------------------------------------------------------------------

def files(spark, d):
    docs = table(spark, d, "documents")
    pages = table(spark, d, "pages")
    a = docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
                    F.concat_ws("", "source", F.lit("_"), "lang", F.lit(".txt")).alias("name"),
                    F.concat(F.lit("/docs/"), F.col("lang")).alias("path"),
                    F.expr("timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("created"))
    b = pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
                     F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"),
                     F.concat(F.lit("/web/"), (F.col("page_id") % 10).cast("string")).alias("path"),
                     F.expr("timestampadd(HOUR, page_id, TIMESTAMP_NTZ'2024-02-01 00:00:00')").alias("created"))
    return a.unionByName(b)


def resolve_requests(spark, d):
    docs = table(spark, d, "documents")
    pages = table(spark, d, "pages")
    one = pages.select(F.concat(F.lit("rp"), F.col("page_id").cast("string")).alias("req_id"),
                       F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"),
                       F.lit(None).cast("string").alias("path_prefix"))
    several = docs.where("doc_id % 2 = 0").select(
        F.concat(F.lit("rd"), F.col("doc_id").cast("string")).alias("req_id"),
        F.concat_ws("", "source", F.lit("_"), "lang", F.lit(".txt")).alias("name"),
        F.lit("/docs/").alias("path_prefix"))
    none = docs.where("doc_id % 2 = 1").select(
        F.concat(F.lit("rm"), F.col("doc_id").cast("string")).alias("req_id"),
        F.concat(F.lit("missing_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"),
        F.lit(None).cast("string").alias("path_prefix"))
    return one.unionByName(several).unionByName(none)


def latest_requests(spark, d):
    docs = table(spark, d, "documents")
    pages = table(spark, d, "pages")
    by_source = docs.select(F.col("source").alias("req_id"), F.concat(F.col("source"), F.lit("_")).alias("pattern"),
                            F.lit(3).alias("top")).distinct()
    by_page = pages.select(F.concat(F.lit("pg"), F.col("page_id").cast("string")).alias("req_id"),
                           F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("pattern"),
                           F.lit(2).alias("top"))
    return by_source.unionByName(by_page)


def expectations(spark, d):
    docs = table(spark, d, "documents")
    pages = table(spark, d, "pages")
    ready = pages.select(F.concat(F.lit("e"), F.col("page_id").cast("string")).alias("exp_id"),
                         F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".")).alias("file_name"),
                         F.lit("/web/").alias("folder_path"),
                         F.expr("CASE WHEN page_id % 3 = 1 THEN array('.csv') "
                                "WHEN page_id % 3 = 2 THEN CAST(NULL AS ARRAY<STRING>) "
                                "ELSE array('.html', '.htm') END").alias("file_types"))
    pairs = docs.select("source", "lang").distinct().select(
        F.concat_ws("", F.lit("s"), "source", F.lit("_"), "lang").alias("exp_id"),
        F.concat_ws("", "source", F.lit("_"), "lang").alias("file_name"),
        F.concat(F.lit("/docs/"), F.col("lang")).alias("folder_path"),
        F.array(F.lit(".txt")).alias("file_types"))
    return ready.unionByName(pairs)


# ---- part with raw headers -------------------------------------------------------------------

def part_raw(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("PartKey"), F.col("p_name").alias("Part Name"),
                    F.col("p_brand").alias("HTTPBrand"), F.col("p_type").alias("p_Type!"),
                    F.col("p_size").alias("Size@Bin"), F.col("p_retailprice").alias("__RetailPrice__"),
                    F.lit(None).cast("string").alias("Unnamed: 6"))


def csv_customers(spark, d):
    c = table(spark, d, "customer")
    name = F.expr("CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat(c_name, ', Inc') "
                  "WHEN 3 THEN concat(c_name, ' \"The\" one') ELSE c_name END")
    return c.select("c_custkey", name.alias("c_name"), "c_nationkey", "c_acctbal", "c_mktsegment")


# The windows-1252 bytes that differ from ISO-8859-1, and their characters
CP1252_BYTES = "80 82 83 84 85 86 87 88 89 8A 8B 8C 8E 91 92 93 94 95 96 97 98 99 9A 9B 9C 9E 9F"
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def latin1_docs(spark, d):
    """windows-1252 bytes of every document in curly quotes, followed by all 27 mapped bytes."""
    docs = table(spark, d, "documents")
    safe = F.regexp_replace("text", r"[^\x00-\xFF]", "?")
    raw = F.concat(F.unhex(F.lit("93")), F.encode(safe, "ISO-8859-1"), F.unhex(F.lit("94")), F.unhex(F.lit(CP1252_BYTES.replace(" ", ""))))
    return docs.select("doc_id", raw.alias("raw"))


# ---- DuckDB text of the same fixtures --------------------------------------------------------

_LON = "CAST(-80 + (c_custkey % 100) * 0.1 AS DOUBLE)"
_LAT = "CAST(40 + (c_custkey % 50) * 0.1 AS DOUBLE)"
_ILON = "CAST(-80 + (id % 100) * 0.1 AS DOUBLE)"
_ILAT = "CAST(40 + (id % 50) * 0.1 AS DOUBLE)"

SQL = {
    "master_orders": "SELECT * FROM orders WHERE o_orderkey % 10 < 7",
    "staging_orders": ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate, "
                       "o_orderpriority FROM orders WHERE o_orderkey % 10 >= 5"),
    "master_lines": "SELECT * FROM lineitem WHERE l_orderkey % 10 < 7",
    "staging_lines": ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice + 100 AS "
                      "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem "
                      "WHERE l_orderkey % 10 >= 5"),
    "master_orders_nk": ("SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, "
                         "o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 < 7"),
    "staging_orders_nk": ("SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, "
                          "o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate, o_orderpriority FROM orders "
                          "WHERE o_orderkey % 10 >= 5"),
    "master_gen": ("SELECT o_orderkey + 1 AS row_id, o_orderkey AS source_id, o_custkey, o_totalprice FROM orders "
                   "WHERE o_orderkey % 10 < 7"),
    "staging_gen": ("SELECT o_orderkey AS source_id, o_custkey, o_totalprice + 100 AS o_totalprice FROM orders "
                    "WHERE o_orderkey % 10 >= 5"),
    "contract_table": (f"SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS id, "
                       f"c_name || ', ' || n_name AS address, TIMESTAMP '2020-01-01' + to_days(CAST(c_custkey AS INTEGER)) AS date, "
                       f"c_acctbal > 0 AS boolean, {_LON} AS longitude, {_LAT} AS latitude, "
                       f"'POINT (' || CAST({_LON} AS VARCHAR) || ' ' || CAST({_LAT} AS VARCHAR) || ')' AS geography "
                       f"FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    "text_orders": ("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS id_text, "
                    "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS digits_with_null, "
                    "CAST(NULL AS VARCHAR) AS all_null, "
                    "CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS mixed, "
                    "CASE WHEN o_orderkey % 17 = 0 THEN 'bad' WHEN o_orderkey % 19 = 0 THEN '2024-02-30 00:00:00.000' "
                    "ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') END AS order_date, "
                    "CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') "
                    "ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_day, "
                    "'9' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0') AS big_digits, "
                    "lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS lead_zero, o_orderstatus, "
                    "CAST(o_custkey % 5 AS VARCHAR) AS \"x:@computed_region\" FROM orders"),
    "epoch_events": ("SELECT event_id, epoch_us(ts) // 1000 AS last_edited_date, CAST(NULL AS BIGINT) AS close_date, "
                     "value FROM events"),
    "addr": ("SELECT c_custkey AS id, c_name || ', ' || n_name AS FULL_ADDRESS FROM customer "
             "JOIN nation ON c_nationkey = n_nationkey"),
    "addr_g": (f"SELECT id, FULL_ADDRESS, CASE WHEN id % 7 <> 0 THEN {_ILON} END AS longitude, "
               f"CASE WHEN id % 7 <> 0 THEN {_ILAT} END AS latitude FROM addr WHERE id % 4 <> 0"),
    "addr_usps": "SELECT id, FULL_ADDRESS FROM addr_g WHERE latitude IS NULL AND id % 2 = 0",
    "locator": (f"SELECT lower(replace(FULL_ADDRESS, ', ', ',   ')) AS FULL_ADDRESS, 90 AS score, {_ILON} AS longitude, "
                f"{_ILAT} AS latitude FROM addr WHERE id % 7 <> 0 "
                f"UNION ALL SELECT lower(replace(FULL_ADDRESS, ', ', ',   ')), 80, {_ILON} + 0.5, {_ILAT} FROM addr "
                f"WHERE id % 7 <> 0 AND id % 3 = 0 "
                f"UNION ALL SELECT lower(replace(FULL_ADDRESS, ', ', ',   ')), 90, {_ILON} - 0.25, {_ILAT} FROM addr "
                f"WHERE id % 7 <> 0 AND id % 5 = 0"),
    "points": ("SELECT c_custkey, CAST(-80 + (c_custkey % 100) * 0.1 + 0.03 AS DOUBLE) AS longitude, "
               "CAST(40 + (c_custkey % 50) * 0.1 + 0.03 AS DOUBLE) AS latitude FROM customer"),
    "counties": ("SELECT n_nationkey AS poly_order, r_name AS STATE, n_name AS NAME, "
                 "CAST(-80 + n_nationkey % 6 AS DOUBLE) AS xmin, CAST(40 + n_nationkey // 6 AS DOUBLE) AS ymin, "
                 "1 + n_nationkey % 2 AS side FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "files": ("SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, source || '_' || lang || '.txt' AS name, "
              "'/docs/' || lang AS path, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS created FROM documents "
              "UNION ALL SELECT 'p' || CAST(page_id AS VARCHAR), 'page_' || CAST(page_id AS VARCHAR) || '.html', "
              "'/web/' || CAST(page_id % 10 AS VARCHAR), TIMESTAMP '2024-02-01' + to_hours(page_id) FROM pages"),
}
