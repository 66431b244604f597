"""Registered queries: one per operator, each with a DuckDB oracle where SQL can say it.

Every query reads whole driver tables (or fixtures Spark derives from them)
and returns a DataFrame; computed columns carry the same alias as in the
oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom.functions import columns as C
from wareloom.functions import dates as D
from wareloom.functions import geo as G
from wareloom.functions import infer as I
from wareloom.functions import text as TX
from wareloom.functions import types as TY
from wareloom.operators import enrich as E
from wareloom.operators import incremental as INC
from wareloom.operators import listing as L
from wareloom.operators import load as LD
from wareloom.operators import quality as Q
from wareloom.operators import spatial as SP
from wareloom.plans import fixtures as FX
from wareloom.plans.fixtures import SQL as FSQL
from wareloom.sinks import export as X
from wareloom.sources import resource as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def with_(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({FSQL[n]})" for n in names) + "\n"


T = FX.table

# ---- loads (F1) ------------------------------------------------------------------------------

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
LINE_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus, l_shipdate")


@register("replace_by_key", with_("master_orders", "staging_orders") + f"""
SELECT {ORDER_COLS} FROM master_orders m
WHERE NOT EXISTS (SELECT 1 FROM staging_orders s WHERE s.o_orderkey = m.o_orderkey)
UNION ALL SELECT {ORDER_COLS} FROM staging_orders""")
def q_replace_by_key(spark, d):
    return LD.replace(FX.master_orders(spark, d), FX.staging_orders(spark, d), ["o_orderkey"])


@register("replace_by_composite_key", with_("master_lines", "staging_lines") + f"""
SELECT {LINE_COLS} FROM master_lines m
WHERE NOT EXISTS (SELECT 1 FROM staging_lines s WHERE s.l_orderkey = m.l_orderkey AND s.l_linenumber = m.l_linenumber)
UNION ALL SELECT {LINE_COLS} FROM staging_lines""")
def q_replace_by_composite_key(spark, d):
    return LD.replace(FX.master_lines(spark, d), FX.staging_lines(spark, d), ["l_orderkey", "l_linenumber"])


@register("replace_null_keys", with_("master_orders_nk", "staging_orders_nk") + f"""
SELECT {ORDER_COLS} FROM master_orders_nk m
WHERE NOT EXISTS (SELECT 1 FROM staging_orders_nk s WHERE s.o_orderkey = m.o_orderkey)
UNION ALL SELECT {ORDER_COLS} FROM staging_orders_nk""")
def q_replace_null_keys(spark, d):
    return LD.replace(FX.master_orders_nk(spark, d), FX.staging_orders_nk(spark, d), ["o_orderkey"])


@register("replace_report", with_("master_lines", "staging_lines") + """,
c AS (SELECT (SELECT count(*) FROM master_lines) AS master_rows,
             (SELECT count(*) FROM master_lines m WHERE EXISTS (SELECT 1 FROM staging_lines s
                 WHERE s.l_orderkey = m.l_orderkey AND s.l_linenumber = m.l_linenumber)) AS deleted,
             (SELECT count(*) FROM staging_lines) AS inserted)
SELECT master_rows, deleted, inserted, master_rows - deleted + inserted AS result_rows, inserted - deleted AS delta,
  CASE WHEN inserted < deleted
       THEN 'master shrank by ' || CAST(deleted - inserted AS VARCHAR) || ': ' || CAST(deleted AS VARCHAR) || ' removed, ' || CAST(inserted AS VARCHAR) || ' inserted'
       ELSE CAST(inserted AS VARCHAR) || ' inserted, ' || CAST(deleted AS VARCHAR) || ' removed' END AS message
FROM c""")
def q_replace_report(spark, d):
    return LD.replace_report(FX.master_lines(spark, d), FX.staging_lines(spark, d), ["l_orderkey", "l_linenumber"])


@register("append_by_name", with_("master_orders", "staging_orders") + """
SELECT * FROM master_orders
UNION ALL BY NAME
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM staging_orders""")
def q_append_by_name(spark, d):
    return LD.append_by_name(FX.master_orders(spark, d), FX.staging_orders(spark, d).drop("o_orderpriority"))


@register("append_new_keys", with_("master_orders_nk", "staging_orders_nk") + f"""
SELECT {ORDER_COLS} FROM master_orders_nk
UNION ALL
SELECT {ORDER_COLS} FROM staging_orders_nk s WHERE NOT EXISTS (
  SELECT 1 FROM master_orders_nk m WHERE m.o_orderdate IS NOT DISTINCT FROM s.o_orderdate
    AND m.o_orderkey IS NOT DISTINCT FROM s.o_orderkey AND m.o_orderstatus IS NOT DISTINCT FROM s.o_orderstatus)""")
def q_append_new_keys(spark, d):
    return LD.append_new(FX.master_orders_nk(spark, d), FX.staging_orders_nk(spark, d),
                         ["o_orderdate", "o_orderkey", "o_orderstatus"])


@register("overwrite_novel_ids", with_("master_orders_nk", "staging_orders_nk") + f"""
SELECT {ORDER_COLS}, NOT EXISTS (SELECT 1 FROM master_orders_nk m WHERE m.o_orderkey IS NOT DISTINCT FROM s.o_orderkey) AS is_new
FROM staging_orders_nk s""")
def q_overwrite_novel_ids(spark, d):
    """The gated overwrite's new master, each row told apart by the gate's ids."""
    master, staging = FX.master_orders_nk(spark, d), FX.staging_orders_nk(spark, d)
    new = LD.overwrite(master, staging, ["o_orderkey"], require_new=True)
    ids = LD.new_ids(staging, master, ["o_orderkey"]).select(F.col("o_orderkey").alias("_id"), F.lit(True).alias("_new"))
    out = new.join(ids, new["o_orderkey"].eqNullSafe(ids["_id"]), "left")
    return out.withColumn("is_new", F.coalesce("_new", F.lit(False))).drop("_id", "_new")


@register("load_without_generated_id", with_("master_gen", "staging_gen") + """
SELECT row_id, source_id, o_custkey, o_totalprice FROM master_gen
UNION ALL
SELECT (SELECT max(row_id) FROM master_gen) + row_number() OVER (ORDER BY source_id) AS row_id,
       source_id, o_custkey, o_totalprice FROM staging_gen""")
def q_load_without_generated_id(spark, d):
    return LD.append_generated_id(FX.master_gen(spark, d), FX.staging_gen(spark, d), "row_id", ["source_id"])


# ---- contracts (F2) ------------------------------------------------------------------------------

def _contract_values() -> str:
    rows = []
    for variant, recs in FX.contract_variants().items():
        for r in recs:
            nas = "NULL" if r.get("NAs") is None else ("TRUE" if r["NAs"] else "FALSE")
            rows.append(f"('{variant}', '{r['COLUMN_NAME']}', '{r['DATA_TYPE']}', {nas})")
    return "contracts(variant, COLUMN_NAME, DATA_TYPE, NAs) AS (VALUES " + ", ".join(rows) + ")"


_ACTUAL_TYPES = """actual AS (SELECT column_name, CASE WHEN column_name = 'geography' THEN 'geography'
    ELSE CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'varchar'
    WHEN 'TIMESTAMP' THEN 'datetime' WHEN 'BOOLEAN' THEN 'bit' WHEN 'DOUBLE' THEN 'float' ELSE lower(column_type) END END
    AS actual_type FROM (DESCRIBE SELECT * FROM contract_table))"""

_NULLS = """nulls AS (
  SELECT 'id' AS column_name, count(*) FILTER (WHERE id IS NULL) AS null_count FROM contract_table
  UNION ALL SELECT 'address', count(*) FILTER (WHERE address IS NULL) FROM contract_table
  UNION ALL SELECT 'date', count(*) FILTER (WHERE date IS NULL) FROM contract_table
  UNION ALL SELECT 'boolean', count(*) FILTER (WHERE boolean IS NULL) FROM contract_table
  UNION ALL SELECT 'longitude', count(*) FILTER (WHERE longitude IS NULL) FROM contract_table
  UNION ALL SELECT 'latitude', count(*) FILTER (WHERE latitude IS NULL) FROM contract_table
  UNION ALL SELECT 'geography', count(*) FILTER (WHERE geography IS NULL) FROM contract_table)"""


@register("schema_check", with_("contract_table") + ", " + _contract_values() + ",\n" + _ACTUAL_TYPES + ",\n" + _NULLS + """,
variants AS (SELECT DISTINCT variant FROM contracts),
act AS (SELECT v.variant, a.column_name, a.actual_type FROM variants v, actual a),
j AS (SELECT coalesce(c.variant, a.variant) AS variant, coalesce(c.COLUMN_NAME, a.column_name) AS column_name,
             c.DATA_TYPE AS expected_type, a.actual_type, coalesce(c.NAs = FALSE, FALSE) AS required
      FROM contracts c FULL OUTER JOIN act a ON c.variant = a.variant AND c.COLUMN_NAME = a.column_name)
SELECT j.variant, j.column_name, expected_type, actual_type, required, CASE WHEN required THEN n.null_count END AS null_count,
  CASE WHEN actual_type IS NULL THEN 'missing' WHEN expected_type IS NULL THEN 'extra'
       WHEN lower(expected_type) <> lower(actual_type) THEN 'type_mismatch'
       WHEN required AND n.null_count > 0 THEN 'null_violation' ELSE 'ok' END AS status
FROM j LEFT JOIN nulls n ON j.column_name = n.column_name""")
def q_schema_check(spark, d):
    df = FX.contract_table(spark, d)
    contracts = {k: Q.contract_from_records(spark, v) for k, v in FX.contract_variants().items()}
    return Q.schema_reports(df, contracts)


@register("null_report", with_("text_orders") + """
SELECT column_name, null_count FROM (
  SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey, count(*) FILTER (WHERE id_text IS NULL) AS id_text,
    count(*) FILTER (WHERE digits_with_null IS NULL) AS digits_with_null, count(*) FILTER (WHERE all_null IS NULL) AS all_null,
    count(*) FILTER (WHERE mixed IS NULL) AS mixed, count(*) FILTER (WHERE order_date IS NULL) AS order_date,
    count(*) FILTER (WHERE order_day IS NULL) AS order_day, count(*) FILTER (WHERE big_digits IS NULL) AS big_digits,
    count(*) FILTER (WHERE lead_zero IS NULL) AS lead_zero, count(*) FILTER (WHERE o_orderstatus IS NULL) AS o_orderstatus,
    count(*) FILTER (WHERE "x:@computed_region" IS NULL) AS "x:@computed_region"
  FROM text_orders) UNPIVOT (null_count FOR column_name IN (COLUMNS(*)))""")
def q_null_report(spark, d):
    return Q.null_counts(FX.text_orders(spark, d))


@register("quarantine_rows", with_("contract_table") + """
SELECT address, date, CASE WHEN id IS NULL THEN 'id' ELSE '' END AS violations, CASE WHEN id IS NULL THEN 'bad' ELSE 'good' END AS side
FROM contract_table""")
def q_quarantine_rows(spark, d):
    """Both halves of the split."""
    df = FX.contract_table(spark, d)
    good, bad = Q.quarantine(df, Q.contract_from_records(spark, FX.SAMPLE_CONTRACT))
    good = good.select("address", "date", F.lit("").alias("violations"), F.lit("good").alias("side"))
    return good.unionByName(bad.select("address", "date", F.array_join("violations", ",").alias("violations"), F.lit("bad").alias("side")))


@register("contract_generate", with_("contract_table") + ",\n" + _NULLS + """,
types(COLUMN_NAME, DATA_TYPE) AS (VALUES ('id', 'int'), ('address', 'varchar'), ('date', 'datetime'), ('boolean', 'bit'),
  ('longitude', 'float'), ('latitude', 'float'), ('geography', 'geography'))
SELECT types.COLUMN_NAME, DATA_TYPE, CASE WHEN null_count = 0 THEN FALSE END AS NAs FROM types JOIN nulls n ON types.COLUMN_NAME = n.column_name""")
def q_contract_generate(spark, d):
    """Contract whose required columns are those that hold no NULL, written and read back."""
    from wareloom.session import scratch_path

    df = FX.contract_table(spark, d)
    path = scratch_path(spark, "contract")
    Q.write_contract(Q.generate_contract(df, "complete"), path)
    return Q.contract_from_json(spark, path)


# ---- incremental (A3, B19, A8) ---------------------------------------------------------------------

@register("incremental_pull_id", """
SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders
  WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders))""")
def q_incremental_pull_id(spark, d):
    o = T(spark, d, "orders")
    half = o.agg((F.max("o_orderkey") / 2).cast("bigint").alias("h")).first()["h"]
    master = o.where(F.col("o_orderkey") <= F.lit(half))
    return INC.pull(T(spark, d, "orders"), master, "o_orderkey", "max", ">")


@register("incremental_pull_day", """
SELECT * FROM events WHERE ts > CAST(CAST((SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00') AS DATE) AS TIMESTAMP)""")
def q_incremental_pull_day(spark, d):
    e = T(spark, d, "events")
    master = e.where(F.col("ts") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return INC.pull(T(spark, d, "events"), master, "ts", "max", ">", trunc="day")


@register("resource_yearly_counts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1""")
def q_resource_yearly_counts(spark, d):
    sql = ("SELECT year(o_orderdate) AS yr, count(*) AS n FROM orders_resource "
           "WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) GROUP BY year(o_orderdate)")
    return R.resource_sql(spark, {"orders_resource": T(spark, d, "orders")}, sql, {"since": "1996-01-01"})


# ---- type repair (F3, F4) ------------------------------------------------------------------------------

@register("infer_digits", with_("text_orders") + """
SELECT o_orderkey, TRY_CAST(id_text AS BIGINT) AS id_text, TRY_CAST(digits_with_null AS BIGINT) AS digits_with_null,
  CAST(all_null AS BIGINT) AS all_null, mixed,
  try_strptime(order_date, '%Y-%m-%d %H:%M:%S.%g') AS order_date, order_day,
  CAST(TRY_CAST(big_digits AS DECIMAL(38,0)) AS VARCHAR) AS big_digits, TRY_CAST(lead_zero AS BIGINT) AS lead_zero,
  o_orderstatus
FROM text_orders""")
def q_infer_digits(spark, d):
    out = I.convert_types(FX.text_orders(spark, d))
    assert dict(out.dtypes)["big_digits"] == "decimal(38,0)"  # the inferred type; shown as its text below
    # decimals travel to pandas differently in the two engines: compare the digits as text
    return out.withColumn("big_digits", F.col("big_digits").cast("string"))


@register("dates_by_name", with_("text_orders") + """
SELECT o_orderkey, id_text, digits_with_null, all_null, mixed,
  try_strptime(order_date, '%Y-%m-%d %H:%M:%S.%g') AS order_date, order_day, big_digits, lead_zero, o_orderstatus,
  "x:@computed_region"
FROM text_orders""")
def q_dates_by_name(spark, d):
    return I.dates_by_name(FX.text_orders(spark, d))


@register("try_convert_datetime", with_("text_orders") + """
SELECT o_orderkey,
  coalesce(try_strptime(order_date, '%Y-%m-%d %H:%M:%S.%g'), try_strptime(order_date, '%Y-%m-%d %H:%M:%S'),
           try_strptime(order_date, '%Y-%m-%d')) AS order_date,
  coalesce(try_strptime(order_day, '%Y-%m-%d %H:%M:%S.%g'), try_strptime(order_day, '%Y-%m-%d %H:%M:%S'),
           try_strptime(order_day, '%Y-%m-%d')) AS order_day
FROM text_orders""")
def q_try_convert_datetime(spark, d):
    patterns = ("yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    df = FX.text_orders(spark, d).select("o_orderkey", "order_date", "order_day")
    return D.try_convert(df, ["order_date", "order_day"], patterns)


@register("epoch_millis", with_("epoch_events") + """
SELECT event_id, make_timestamp(last_edited_date * 1000) AS last_edited_date, CAST(NULL AS TIMESTAMP) AS close_date, value
FROM epoch_events""")
def q_epoch_millis(spark, d):
    return D.from_epoch_millis(FX.epoch_events(spark, d))


@register("cyyddd_dates", """
SELECT o_orderkey AS key, '1' || strftime(o_orderdate, '%y') || lpad(CAST(dayofyear(o_orderdate) AS VARCHAR), 3, '0') AS code,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders
UNION ALL SELECT * FROM (VALUES (-1, '123366', CAST(NULL AS VARCHAR)), (-2, '124366', '2024-12-31'),
  (-3, '099001', NULL), (-4, 'x', NULL), (-5, NULL, NULL)) AS b(key, code, date)""")
def q_cyyddd_dates(spark, d):
    df = FX.cyyddd_codes(spark, d)
    # the operator returns a DATE; it is compared as ISO text (dates reach pandas
    # as different objects from the two engines)
    return df.withColumn("date", D.from_cyyddd("code").cast("string"))


@register("int_coercion", with_("text_orders") + """
SELECT o_orderkey, TRY_CAST(id_text AS INTEGER) AS id_text, TRY_CAST(mixed AS INTEGER) AS mixed,
  TRY_CAST(big_digits AS INTEGER) AS big_digits, TRY_CAST(lead_zero AS INTEGER) AS lead_zero FROM text_orders""")
def q_int_coercion(spark, d):
    df = FX.text_orders(spark, d).select("o_orderkey", "id_text", "mixed", "big_digits", "lead_zero")
    return TY.to_int(df, ["id_text", "mixed", "big_digits", "lead_zero"])


@register("extract_types", """
SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey,
  CAST(l_suppkey AS DOUBLE) AS l_suppkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def q_extract_types(spark, d):
    return X.extract_types(T(spark, d, "lineitem"))


@register("strip_zone", """
SELECT event_id, ts - to_hours(CAST(user_id % 5 AS INTEGER)) AS ts_utc FROM events""")
def q_strip_zone(spark, d):
    e = T(spark, d, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+0"),
                    (F.col("user_id") % 5).cast("string"), F.lit(":00"))
    zoned = e.select("event_id", F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSXXX")).alias("ts_utc"))
    return TY.strip_zone(zoned, ["ts_utc"])


@register("long_text_columns", """
SELECT 'documents' AS table_name, column_name, max_length, coalesce(max_length > 255, FALSE) AS long_text FROM (
  SELECT max(length(CAST(doc_id AS VARCHAR))) AS doc_id, max(length(text)) AS text, max(length(lang)) AS lang,
         max(length(source)) AS source, max(length(CAST(n_chars AS VARCHAR))) AS n_chars FROM documents)
  UNPIVOT (max_length FOR column_name IN (COLUMNS(*)))
UNION ALL
SELECT 'pages', column_name, max_length, coalesce(max_length > 255, FALSE) FROM (
  SELECT max(length(CAST(page_id AS VARCHAR))) AS page_id, max(length(url)) AS url, max(length(html)) AS html FROM pages)
  UNPIVOT (max_length FOR column_name IN (COLUMNS(*)))""")
def q_long_text_columns(spark, d):
    a = I.long_text_profile(T(spark, d, "documents")).select(F.lit("documents").alias("table_name"), "*")
    b = I.long_text_profile(T(spark, d, "pages")).select(F.lit("pages").alias("table_name"), "*")
    return a.unionByName(b)


@register("cp1252_repair", f"""
SELECT doc_id, '“' || regexp_replace(text, '[^\\x{{00}}-\\x{{FF}}]', '?', 'g') || '”{FX.CP1252_CHARS}' AS text FROM documents""")
def q_cp1252_repair(spark, d):
    return FX.latin1_docs(spark, d).select("doc_id", TX.from_cp1252("raw").alias("text"))


@register("prepare_export", """
SELECT CAST(p_partkey AS DOUBLE) AS part_key, trim(p_brand) AS http_brand, trim(p_type) AS p_type,
  CAST(p_size AS DOUBLE) AS sizebin, p_retailprice AS retail_price, trim(p_name) AS part_name FROM part""")
def q_prepare_export(spark, d):
    from pyspark.sql import types as PT

    df = C.snake_case_columns(C.drop_placeholders(FX.part_raw(spark, d)))
    df = C.across(df, lambda f: isinstance(f.dataType, PT.StringType), lambda c, f: F.trim(c))
    df = C.long_text_last(df, ["part_name"])
    return X.extract_types(df)


@register("flatten_json", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events""")
def q_flatten_json(spark, d):
    e = T(spark, d, "events").select("event_id", "event_type", "props")
    return R.json_records(e, "props", "k bigint")


@register("union_fill", """
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_id % 3 = 0
UNION ALL BY NAME SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_id % 3 = 1
UNION ALL BY NAME SELECT event_id, ts, user_id, event_type, CAST(CAST(floor(value) AS INTEGER) AS DOUBLE) AS value, props
  FROM events WHERE event_id % 3 = 2""")
def q_union_fill(spark, d):
    e = T(spark, d, "events")
    a = e.where("event_id % 3 = 0")
    b = e.where("event_id % 3 = 1").drop("props")
    c = e.where("event_id % 3 = 2").withColumn("value", F.floor("value").cast("int"))
    return C.union_fill([a, b, c])


@register("nth_weekday_window", """
SELECT event_id, ts, (dayofweek(ts) = 2 AND day(ts) BETWEEN 15 AND 21
  AND epoch_us(ts) - epoch_us(date_trunc('day', ts)) BETWEEN 72000000000 AND 82800000000) AS in_window FROM events""")
def q_nth_weekday_window(spark, d):
    e = T(spark, d, "events").select("event_id", "ts")
    return e.withColumn("in_window", D.in_nth_weekday_window("ts", "tuesday", 3, "20:00:00", "23:00:00"))


# ---- geo (F5, F7) -------------------------------------------------------------------------------------------

@register("split_point", """
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(-80 + (c_custkey % 100) * 0.1 AS DOUBLE) END AS longitude,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(40 + (c_custkey % 50) * 0.1 AS DOUBLE) END AS latitude FROM customer""")
def q_split_point(spark, d):
    return G.split_point(FX.point_column(spark, d), "location_latitude_longitude")


_WKT_X = "CAST(CAST(-80 + (s_suppkey % 60) * 0.1 AS DOUBLE) + {dx} AS VARCHAR)"
_WKT_Y = "CAST(CAST(40 + (s_suppkey % 20) * 0.1 AS DOUBLE) + {dy} AS VARCHAR)"


def _wkt_p(dx, dy):
    return f"{_WKT_X.format(dx=dx)} || ' ' || {_WKT_Y.format(dy=dy)}"


_WKT_SQL = f"""CASE s_suppkey % 7
  WHEN 0 THEN 'POINT (' || {_wkt_p(0, 0)} || ')'
  WHEN 1 THEN 'MULTIPOINT ((' || {_wkt_p(0, 0)} || '), (' || {_wkt_p(1, 1)} || '))'
  WHEN 2 THEN 'LINESTRING (' || {_wkt_p(0, 0)} || ', ' || {_wkt_p(1, 0)} || ', ' || {_wkt_p(1, 1)} || ')'
  WHEN 3 THEN 'MULTILINESTRING ((' || {_wkt_p(0, 0)} || ', ' || {_wkt_p(1, 0)} || '), (' || {_wkt_p(0, 1)} || ', ' || {_wkt_p(1, 1)} || '))'
  WHEN 4 THEN 'POLYGON ((' || {_wkt_p(0, 0)} || ', ' || {_wkt_p(1, 0)} || ', ' || {_wkt_p(1, 1)} || ', ' || {_wkt_p(0, 1)} || ', ' || {_wkt_p(0, 0)} || '))'
  WHEN 5 THEN 'MULTIPOLYGON (((' || {_wkt_p(0, 0)} || ', ' || {_wkt_p(1, 0)} || ', ' || {_wkt_p(1, 1)} || ', ' || {_wkt_p(0, 0)} || ')), (('
              || {_wkt_p(2, 0)} || ', ' || {_wkt_p(3, 0)} || ', ' || {_wkt_p(3, 1)} || ', ' || {_wkt_p(2, 0)} || ')))'
END"""


@register("geojson_to_wkt", f"SELECT s_suppkey AS id, {_WKT_SQL} AS geometry_wkt FROM supplier")
def q_geojson_to_wkt(spark, d):
    g = FX.geometry_text(spark, d)
    return G.geometry_to_wkt(g.select("id", "geometry"))


@register("geojson_layer_load", f"""
SELECT s_suppkey AS id, make_timestamp((s_suppkey * 86400000 + 1700000000000) * 1000) AS edit_date, s_name AS name,
  {_WKT_SQL} AS geometry_wkt FROM supplier""")
def q_geojson_layer_load(spark, d):
    from wareloom.sources import geojson as GJ
    from wareloom.session import scratch_path

    path = scratch_path(spark, "geojson-pages")
    GJ.write_feature_pages(FX.geometry_text(spark, d), path, id_col="id", page_size=1000,
                           properties=["id", "edit_date", "name"])
    df = GJ.features(spark, path, "id bigint, edit_date bigint, name string")
    return GJ.standard_fixes(df)


@register("geojson_features_out", """
SELECT json_object('type', 'Feature',
    'geometry', json_object('type', 'Point', 'coordinates', [CAST(-80 + (c_custkey % 100) * 0.1 AS DOUBLE),
                                                           CAST(40 + (c_custkey % 50) * 0.1 AS DOUBLE)]),
    'properties', json_object('c_custkey', c_custkey, 'c_name', c_name,
                              'c_mktsegment', CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END))::VARCHAR AS feature
FROM customer WHERE c_custkey % 9 <> 0""")
def q_geojson_features_out(spark, d):
    c = T(spark, d, "customer")
    pts = G.split_point(FX.point_column(spark, d), "location_latitude_longitude")
    j = pts.join(c, "c_custkey").withColumn(
        "c_mktsegment", F.expr("CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END"))
    return X.geojson_features(j, "longitude", "latitude", ["c_custkey", "c_name", "c_mktsegment"])


@register("locate_points", with_("points", "counties") + """
SELECT p.c_custkey, p.longitude, p.latitude, arg_min(c.STATE, c.poly_order) AS STATE, arg_min(c.NAME, c.poly_order) AS NAME FROM points p
LEFT JOIN counties c ON p.longitude BETWEEN c.xmin AND c.xmin + side AND p.latitude BETWEEN c.ymin AND c.ymin + side
GROUP BY ALL""")
def q_locate_points(spark, d):
    return SP.locate(FX.points(spark, d), FX.counties(spark, d), ["STATE", "NAME"])


@register("lookup_left", """
SELECT c_custkey, c_name, n_name AS NATION FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""")
def q_lookup_left(spark, d):
    c = T(spark, d, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"))
    n = T(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("NATION"))
    return E.lookup(c, n, "c_nationkey").select("c_custkey", "c_name", "NATION")


@register("enrich_pending", with_("addr", "addr_g") + """
SELECT DISTINCT a.id, a.FULL_ADDRESS FROM addr a WHERE NOT EXISTS (SELECT 1 FROM addr_g g WHERE g.id = a.id)""")
def q_enrich_pending(spark, d):
    return E.pending(FX.addr(spark, d), FX.addr_g(spark, d), "id", "FULL_ADDRESS")


@register("enrich_not_attempted", with_("addr", "addr_g", "addr_usps") + """
SELECT f.id, f.FULL_ADDRESS FROM addr_g f
WHERE f.latitude IS NULL AND NOT EXISTS (SELECT 1 FROM addr_usps u WHERE u.id = f.id)""")
def q_enrich_not_attempted(spark, d):
    f = E.failures(FX.addr_g(spark, d)).select("id", "FULL_ADDRESS")
    return E.not_attempted(f, FX.addr_usps(spark, d), "id")


@register("geocode_locator", with_("addr", "locator") + """,
best AS (SELECT * FROM (SELECT upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g'))) AS k, longitude, latitude, score,
    row_number() OVER (PARTITION BY upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g')))
                       ORDER BY score DESC, longitude, latitude) AS rn FROM locator) WHERE rn = 1)
SELECT a.id, a.FULL_ADDRESS, b.longitude, b.latitude, b.score FROM addr a
LEFT JOIN best b ON upper(trim(regexp_replace(a.FULL_ADDRESS, '\\s+', ' ', 'g'))) = b.k""")
def q_geocode_locator(spark, d):
    return E.geocode(FX.addr(spark, d), FX.locator(spark, d)).select("id", "FULL_ADDRESS", "longitude", "latitude", "score")


@register("geocode_misses", with_("addr", "addr_g") + """
SELECT g.id, g.FULL_ADDRESS, c.c_mktsegment, c.c_acctbal FROM addr_g g
LEFT JOIN customer c ON c.c_custkey = g.id WHERE g.latitude IS NULL AND c.c_acctbal > 0""")
def q_geocode_misses(spark, d):
    src = T(spark, d, "customer").withColumnRenamed("c_custkey", "id")
    return E.misses(FX.addr_g(spark, d), src, "id", ["FULL_ADDRESS"], ["c_mktsegment", "c_acctbal"],
                    where="c_acctbal > 0")


# ---- listing (F8) ---------------------------------------------------------------------------------------------

_RESOLVE_REQ = """requests AS (
  SELECT 'rp' || CAST(page_id AS VARCHAR) AS req_id, 'page_' || CAST(page_id AS VARCHAR) || '.html' AS name,
         CAST(NULL AS VARCHAR) AS path_prefix FROM pages
  UNION ALL SELECT 'rd' || CAST(doc_id AS VARCHAR), source || '_' || lang || '.txt', '/docs/' FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT 'rm' || CAST(doc_id AS VARCHAR), 'missing_' || CAST(doc_id AS VARCHAR) || '.txt', NULL
    FROM documents WHERE doc_id % 2 = 1)"""


@register("listing_resolve", with_("files") + ", " + _RESOLVE_REQ + """,
m AS (SELECT r.req_id, count(f.id) AS n, min(f.id) AS any_id FROM requests r LEFT JOIN files f
      ON f.name = r.name AND (r.path_prefix IS NULL OR starts_with(f.path, r.path_prefix)) GROUP BY r.req_id)
SELECT req_id, n AS n_matches, CASE WHEN n = 1 THEN any_id END AS file_id,
  CASE WHEN n = 1 THEN 'ok' WHEN n > 1 THEN 'ambiguous' ELSE 'missing' END AS status FROM m""")
def q_listing_resolve(spark, d):
    return L.resolve(FX.resolve_requests(spark, d), FX.files(spark, d))


@register("listing_latest", with_("files") + """,
requests AS (SELECT DISTINCT source AS req_id, source || '_' AS pattern, 3 AS top FROM documents
  UNION ALL SELECT 'pg' || CAST(page_id AS VARCHAR), 'page_' || CAST(page_id AS VARCHAR), 2 FROM pages),
m AS (SELECT r.req_id, r.top, f.*, row_number() OVER (PARTITION BY r.req_id ORDER BY f.created DESC, f.id) AS rank
      FROM requests r JOIN files f ON contains(f.name, r.pattern))
SELECT req_id, CAST(rank AS INTEGER) AS rank, id, name, path, created FROM m WHERE rank <= top""")
def q_listing_latest(spark, d):
    return L.latest(FX.latest_requests(spark, d), FX.files(spark, d))


@register("arrival_status", with_("files") + """,
exps AS (
  SELECT 'e' || CAST(page_id AS VARCHAR) AS exp_id, 'page_' || CAST(page_id AS VARCHAR) || '.' AS file_name,
    '/web/' AS folder_path,
    CASE WHEN page_id % 3 = 1 THEN ['.csv'] WHEN page_id % 3 = 2 THEN NULL ELSE ['.html', '.htm'] END AS file_types
  FROM pages
  UNION ALL SELECT DISTINCT 's' || source || '_' || lang, source || '_' || lang, '/docs/' || lang, ['.txt'] FROM documents),
m AS (SELECT e.exp_id, count(f.id) AS n, min(f.name) AS any_name FROM exps e LEFT JOIN files f
      ON contains(f.name, e.file_name) AND (e.folder_path IS NULL OR starts_with(f.path, e.folder_path))
      AND (e.file_types IS NULL OR len(e.file_types) = 0 OR len(list_filter(e.file_types, lambda t: ends_with(f.name, t))) > 0)
      GROUP BY e.exp_id)
SELECT exp_id, n AS n_matches, CASE WHEN n = 1 THEN any_name END AS file_name,
  CASE WHEN n = 1 THEN 'ready' WHEN n > 1 THEN 'ambiguous' ELSE 'waiting' END AS status FROM m""")
def q_arrival_status(spark, d):
    return L.arrival_status(FX.expectations(spark, d), FX.files(spark, d))


# ---- files and copies ---------------------------------------------------------------------------------------------

@register("csv_roundtrip", """
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN c_name || ', Inc'
  WHEN 3 THEN c_name || ' "The" one' ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_csv_roundtrip(spark, d):
    from wareloom.session import scratch_path
    from wareloom.sources import files as FS

    df = FX.csv_customers(spark, d)
    path = scratch_path(spark, "csv")
    X.csv(df, path, null_value="NA", sep=",")
    return FS.delimited(spark, path, sep=",", schema=df.schema, null_value="NA")


@register("copy_tables_report", """
SELECT 'orders' AS table_name, count(*) AS rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'customer', count(*) FROM customer""")
def q_copy_tables_report(spark, d):
    from wareloom import jobs
    from wareloom.plans.scratch import scratch_database

    db = scratch_database(spark, "copy")
    tables = {n: T(spark, d, n) for n in ("orders", "lineitem", "customer")}
    return jobs.copy_tables(spark, tables, db, suffix="_copy")


# ---- paged services (F6) ----------------------------------------------------------------------------------------

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _event_pages(spark, d, name, size, **grouped):
    """The events as captured pages: (table, its zones)."""
    from wareloom.plans.scratch import scratch_database
    from wareloom.sources import captures as CP

    table = f"{scratch_database(spark, name)}.pages"
    zones = ["event_id", "event_type", "value"]
    CP.add(CP.pages_of(T(spark, d, "events"), "event_id", size, **grouped), table, EVENT_SCHEMA, zones)
    return table


@register("paged_records", "SELECT * FROM events")
def q_paged_records(spark, d):
    from wareloom.sources import captures as CP

    return CP.read(spark, _event_pages(spark, d, "records", 1000), EVENT_SCHEMA)


@register("paged_cursor", "SELECT * FROM events")
def q_paged_cursor(spark, d):
    """Linked pages, a chain per event type; the capture must hold every link that a page names."""
    from wareloom.sources import captures as CP

    table = _event_pages(spark, d, "cursor", 500, chain_col="event_type")
    if not CP.incomplete(spark, table).isEmpty():
        raise RuntimeError("the capture lacks pages")
    return CP.read(spark, table, EVENT_SCHEMA)


@register("paged_loop_values", """
SELECT event_type AS asked_for, event_id, value FROM events WHERE event_type IN ('click', 'purchase', 'none') AND value <= 50""")
def q_paged_loop_values(spark, d):
    """One capture per loop value, read for three of them (one has no pages) with a filter."""
    from wareloom.sources import captures as CP

    table = _event_pages(spark, d, "loops", 300, loop_col="event_type")
    rows = CP.read(spark, table, EVENT_SCHEMA, [("value", "<=", 50)], ["click", "purchase", "none"], loop_column="asked_for")
    return rows.select("asked_for", "event_id", "value")


# ---- workbooks and streams -------------------------------------------------------------------------------------

@register("workbook_folder", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_workbook_folder(spark, d):
    from wareloom.plans.workbook_fixture import customer_workbooks
    from wareloom.session import cut_lineage
    from wareloom.sources import workbooks as WB

    files = cut_lineage(customer_workbooks(T(spark, d, "customer")), "workbooks")
    return WB.read_files(files, sheet=None, skip=1, column_types={"c_custkey": "bigint", "c_acctbal": "double"})


@register("stream_replace_landing", with_("master_orders", "staging_orders") + f"""
SELECT {ORDER_COLS} FROM master_orders m
WHERE NOT EXISTS (SELECT 1 FROM staging_orders s WHERE s.o_orderkey = m.o_orderkey)
UNION ALL SELECT {ORDER_COLS} FROM staging_orders""")
def q_stream_replace_landing(spark, d):
    from wareloom import catalog
    from wareloom.plans.scratch import scratch_database
    from wareloom.session import scratch_path
    from wareloom.streaming import landing as LS

    root, db = scratch_path(spark, "landing"), scratch_database(spark, "stream")
    master_table = f"{db}.orders"
    catalog.publish(FX.master_orders(spark, d), master_table, "overwrite")
    staging = FX.staging_orders(spark, d)
    # three drops of staging files with disjoint keys land in the folder
    # three drops land one after another; after each, the job runs once
    # (availableNow) and the stream checkpoint makes it pick up only the new files
    for part in range(3):
        staging.where(F.col("o_orderkey") % 3 == part).write.mode("overwrite").parquet(f"{root}/in/drop={part}")
        q = LS.load_landing(spark, f"{root}/in/drop=*", staging.schema, master_table, ["o_orderkey"],
                            checkpoint=f"{root}/checkpoint")
        q.awaitTermination()
    return spark.table(master_table)


@register("paged_filtered_count", """
SELECT event_type, count(*) AS n FROM events WHERE value > 10 AND event_type IN ('click', 'view') GROUP BY event_type""")
def q_paged_filtered_count(spark, d):
    """Both predicates are put to the pages' zones before bodies are parsed, and to the records."""
    from wareloom.sources import captures as CP

    table = _event_pages(spark, d, "filtered", 1000)
    rows = CP.read(spark, table, EVENT_SCHEMA, [("value", ">", 10), ("event_type", "in", ["click", "view"])])
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# ---- more enrichment and contracts (L1, D6, I9, J5, H4) ---------------------------------------------------------

@register("geocode_client", with_("addr", "addr_g") + """
SELECT id, FULL_ADDRESS,
  CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(-80 + (id % 100) * 0.1 AS DOUBLE) END AS longitude,
  CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(40 + (id % 50) * 0.1 AS DOUBLE) END AS latitude
FROM addr_g WHERE latitude IS NULL""")
def q_geocode_client(spark, d):
    from wareloom.plans.clients import make_customer_client

    failed = E.failures(FX.addr_g(spark, d)).select("id", "FULL_ADDRESS")
    attempts = E.with_client(failed.dropDuplicates(["id", "FULL_ADDRESS"]), make_customer_client)
    return E.join_back(failed, attempts, ["id", "FULL_ADDRESS"])


@register("geocode_incremental_load", with_("addr", "addr_g", "locator") + """,
best AS (SELECT * FROM (SELECT upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g'))) AS k, longitude, latitude,
    row_number() OVER (PARTITION BY upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g')))
                       ORDER BY score DESC, longitude, latitude) AS rn FROM locator) WHERE rn = 1)
SELECT id, FULL_ADDRESS, longitude, latitude FROM addr_g
UNION ALL
SELECT a.id, a.FULL_ADDRESS, b.longitude, b.latitude FROM addr a
LEFT JOIN best b ON upper(trim(regexp_replace(a.FULL_ADDRESS, '\\s+', ' ', 'g'))) = b.k
WHERE NOT EXISTS (SELECT 1 FROM addr_g g WHERE g.id = a.id)""")
def q_geocode_incremental_load(spark, d):
    from wareloom import catalog
    from wareloom.plans.scratch import scratch_database

    db = scratch_database(spark, "geo_load")
    geo_table = f"{db}.addr_G"
    catalog.publish(FX.addr_g(spark, d), geo_table, "overwrite")
    loc = FX.locator(spark, d)
    E.run(FX.addr(spark, d), geo_table,
          lambda todo: E.geocode(todo, loc).select("id", "FULL_ADDRESS", "longitude", "latitude"))
    return spark.table(geo_table)


@register("misses_csv", with_("addr", "addr_g") + """
SELECT g.id, g.FULL_ADDRESS, c.c_mktsegment, c.c_acctbal FROM addr_g g
LEFT JOIN customer c ON c.c_custkey = g.id WHERE g.latitude IS NULL AND c.c_acctbal > 0""")
def q_misses_csv(spark, d):
    from wareloom.session import scratch_path
    from wareloom.sources import files as FS

    src = T(spark, d, "customer").withColumnRenamed("c_custkey", "id")
    m = E.misses(FX.addr_g(spark, d), src, "id", ["FULL_ADDRESS"], ["c_mktsegment", "c_acctbal"], where="c_acctbal > 0")
    path = scratch_path(spark, "misses-csv")
    X.csv(m, path, null_value="", sep=",")
    return FS.delimited(spark, path, sep=",", schema=m.schema, null_value="")


_VALIDATE_TABLES = {
    "orders": (["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"], "o_orderkey"),
    "lineitem": (["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"], "l_orderkey"),
    "customer": (["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "c_custkey"),
}


def _validate_many_sql() -> str:
    acts, nulls = [], []
    for t, (cols, _key) in _VALIDATE_TABLES.items():
        acts.append(f"SELECT '{t}' AS table_name, column_name, column_type FROM (DESCRIBE {t})")
        counts = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in cols)
        nulls.append(f"SELECT '{t}' AS table_name, column_name, null_count FROM (SELECT {counts} FROM {t}) "
                     f"UNPIVOT (null_count FOR column_name IN (COLUMNS(*)))")
    keys = ", ".join(f"('{t}', '{k}')" for t, (_c, k) in _VALIDATE_TABLES.items())
    return ("WITH act AS (" + " UNION ALL ".join(acts) + "),\n"
            "typed AS (SELECT table_name, column_name, CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' "
            "WHEN 'VARCHAR' THEN 'varchar' WHEN 'TIMESTAMP' THEN 'datetime' WHEN 'BOOLEAN' THEN 'bit' "
            "WHEN 'DOUBLE' THEN 'float' END AS actual_type FROM act),\n"
            "nulls AS (" + " UNION ALL ".join(nulls) + "),\n"
            f"req(table_name, column_name) AS (VALUES {keys})\n"
            "SELECT t.table_name, t.column_name,\n"
            "  CASE WHEN t.table_name = 'customer' AND t.column_name = 'c_acctbal' THEN 'int' ELSE t.actual_type END AS expected_type,\n"
            "  t.actual_type, r.column_name IS NOT NULL AS required, CASE WHEN r.column_name IS NOT NULL THEN n.null_count END AS null_count,\n"
            "  CASE WHEN t.table_name = 'customer' AND t.column_name = 'c_acctbal' THEN 'type_mismatch'\n"
            "       WHEN r.column_name IS NOT NULL AND n.null_count > 0 THEN 'null_violation' ELSE 'ok' END AS status\n"
            "FROM typed t JOIN nulls n ON t.table_name = n.table_name AND t.column_name = n.column_name\n"
            "LEFT JOIN req r ON t.table_name = r.table_name AND t.column_name = r.column_name")


@register("validate_many", _validate_many_sql())
def q_validate_many(spark, d):
    tables = {}
    for t, (_cols, key) in _VALIDATE_TABLES.items():
        df = T(spark, d, t)
        contract = Q.generate_contract(df, [key])
        if t == "customer":  # one declared type differs from the staged table
            contract = contract.withColumn(
                "DATA_TYPE", F.when(F.col("COLUMN_NAME") == "c_acctbal", "int").otherwise(F.col("DATA_TYPE")))
        tables[t] = (df, contract)
    return Q.validate_all(tables)


# more registered queries live in sibling modules
from wareloom.plans import registry_exports  # noqa: E402,F401
from wareloom.plans import registry_hard  # noqa: E402,F401
from wareloom.plans import registry_loads  # noqa: E402,F401
from wareloom.plans import registry_state  # noqa: E402,F401
