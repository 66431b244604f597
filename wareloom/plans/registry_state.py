"""Registered queries of jobs that keep state: ledger, marks, answers, checked copies; and of hard sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from wareloom.plans import fixtures as FX
from wareloom.plans.registry import ORDER_COLS, SP, D, E, L, T, register, with_
from wareloom.plans.scratch import scratch_database


@register("load_ledger_rerun", with_("master_orders_nk", "staging_orders_nk") + f""",
replaced AS (SELECT {ORDER_COLS} FROM master_orders_nk m WHERE NOT EXISTS (SELECT 1 FROM staging_orders_nk s WHERE s.o_orderkey = m.o_orderkey)
  UNION ALL SELECT {ORDER_COLS} FROM staging_orders_nk)
SELECT * FROM replaced
UNION ALL SELECT {ORDER_COLS} FROM orders WHERE o_orderkey % 50 = 1
UNION ALL SELECT {ORDER_COLS} FROM staging_orders_nk
UNION ALL SELECT {ORDER_COLS} FROM orders WHERE o_orderkey % 50 = 2""")
def q_load_ledger_rerun(spark, d):
    """A replace and an append whose runs stopped after the publish, with another writer before each rerun; some keys are NULL."""
    from wareloom import catalog, jobs
    from wareloom.naming import TableRef
    from wareloom.operators import load

    db = scratch_database(spark, "ledger")
    ref = TableRef("wl", db, "orders")
    master, staging = ref.at(db).qualified, FX.staging_orders_nk(spark, d)
    catalog.ensure_database(spark, "staging")
    catalog.publish(FX.master_orders_nk(spark, d), master)
    runs = [(lambda: jobs.run_replace(spark, ref, ["o_orderkey"], db), "overwrite", lambda: load.replace(spark.table(master), spark.table(ref.qualified), ["o_orderkey"])),
            (lambda: jobs.run_append(spark, ref, db), "append", lambda: spark.table(ref.qualified))]
    for other, (run, mode, new) in enumerate(runs, 1):
        jobs.stage(staging, ref)
        _, marks = jobs._ledger(spark, ref.qualified)
        catalog.publish(new(), master, mode, marks=marks)  # all that the first run came to: staging is still there
        catalog.publish(T(spark, d, "orders").where(F.col("o_orderkey") % 50 == other), master, "append")
        run()
    return spark.table(master)


@register("incremental_pull_ties", """
SELECT event_id, date_trunc('hour', ts) AS hour, CASE WHEN event_id % 3 = 0 AND date_trunc('hour', ts) <= h THEN 1 ELSE 2 END AS batch
FROM (SELECT *, (SELECT max(date_trunc('hour', ts)) FROM events WHERE event_id % 3 = 0 AND ts < TIMESTAMP '2024-01-15 12:30:00') AS h FROM events)
WHERE (event_id % 3 = 0 AND date_trunc('hour', ts) <= h) OR date_trunc('hour', ts) >= h""")
def q_incremental_pull_ties(spark, d):
    """Two pulls by a stored mark whose value many rows share: the second takes the rows at the mark that came later."""
    from wareloom import catalog, jobs
    from wareloom.naming import TableRef
    from wareloom.operators import marks

    db = scratch_database(spark, "marks")
    catalog.ensure_database(spark, "staging")
    ref = TableRef("wl", db, "events")
    hours = T(spark, d, "events").select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    noon = F.lit("2024-01-15 12:30:00").cast("timestamp_ntz")
    early = hours.where((F.col("event_id") % 3 == 0) & (F.col("hour") < F.date_trunc("hour", noon).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")))
    for batch, source in ((1, early), (2, hours)):
        marks.pull(source.withColumn("batch", F.lit(batch)), ref, "hour", "event_id", f"{db}.marks", db)
        jobs.run_append(spark, ref, db)
    return spark.table(ref.at(db).qualified)


@register("stage_columns", """
SELECT c_name, c_custkey FROM customer""")
def q_stage_columns(spark, d):
    """A staged table, read by a list of columns in their order."""
    from wareloom import catalog, jobs
    from wareloom.naming import TableRef

    db = scratch_database(spark, "stage")
    catalog.ensure_database(spark, "staging")
    ref = TableRef("wl", db, "customer")
    jobs.stage(T(spark, d, "customer"), ref)
    jobs.run_overwrite(spark, ref, db)
    return jobs.read_table(spark, ref.at(db), ["c_name", "c_custkey"])


@register("geocode_answer_store", with_("addr") + """
SELECT id, FULL_ADDRESS,
  CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(-80 + (id % 100) * 0.1 AS DOUBLE) END AS longitude,
  CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(40 + (id % 50) * 0.1 AS DOUBLE) END AS latitude,
  (SELECT count(DISTINCT FULL_ADDRESS) FROM addr) AS stored FROM addr""")
def q_geocode_answer_store(spark, d):
    """Half of the addresses are asked for in a first run, the rest by the second, which finds the others answered."""
    from wareloom.plans.clients import make_customer_client

    store, addr = f"{scratch_database(spark, 'answers')}.answers", FX.addr(spark, d)
    E.answers(addr.where("id % 2 = 0"), make_customer_client, store)
    out = E.with_client(addr, make_customer_client, store=store)
    return out.crossJoin(spark.table(store).agg(F.count(F.lit(1)).alias("stored")))  # one row


@register("resolve_hot_name", """
WITH files AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'index.html' AS name, '/web/' || o_orderpriority || '/' || CAST(o_custkey AS VARCHAR) AS path FROM orders),
requests AS (SELECT CAST(c_custkey AS VARCHAR) AS req_id, 'index.html' AS name, CASE c_custkey % 3 WHEN 0 THEN '/web/1-URGENT/' || CAST(c_custkey AS VARCHAR)
  WHEN 1 THEN '/web/5-LOW/' || CAST(c_custkey // 10 AS VARCHAR) ELSE '/web/' END AS path_prefix FROM customer),
m AS (SELECT r.req_id, count(f.id) AS n, min(f.id) AS any_id FROM requests r LEFT JOIN files f ON f.name = r.name AND starts_with(f.path, r.path_prefix) GROUP BY r.req_id)
SELECT req_id, n AS n_matches, CASE WHEN n = 1 THEN any_id END AS file_id, CASE WHEN n = 1 THEN 'ok' WHEN n > 1 THEN 'ambiguous' ELSE 'missing' END AS status FROM m""")
def q_resolve_hot_name(spark, d):
    """One file name in very many folders; requests by folder and by the begin of a folder's name."""
    files = T(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.lit("index.html").alias("name"),
                                         F.concat(F.lit("/web/"), "o_orderpriority", F.lit("/"), F.col("o_custkey").cast("string")).alias("path"))
    k = F.col("c_custkey")
    prefix = (F.when(k % 3 == 0, F.concat(F.lit("/web/1-URGENT/"), k.cast("string")))
              .when(k % 3 == 1, F.concat(F.lit("/web/5-LOW/"), F.floor(k / 10).cast("string"))).otherwise("/web/"))
    requests = T(spark, d, "customer").select(k.cast("string").alias("req_id"), F.lit("index.html").alias("name"), prefix.alias("path_prefix"))
    return L.resolve(requests, files)


@register("workbook_headers", """
SELECT c_custkey AS customer_no, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END AS amt_2,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name, c_acctbal AS amt FROM customer""")
def q_workbook_headers(spark, d):
    """Headers that differ in case and signs between files, and ``amt`` beside ``amt_2``."""
    from wareloom.plans.workbook_fixture import customer_workbooks
    from wareloom.session import cut_lineage
    from wareloom.sources import workbooks as WB

    names = lambda segment: ("Customer No", "amt_2", "Amt") if segment == "BUILDING" else ("CUSTOMER no", "Name", "AMT")
    files = cut_lineage(customer_workbooks(T(spark, d, "customer"), names), "workbooks")
    return WB.read_files(files, skip=1, clean=True, column_types={"customer_no": "bigint", "amt": "double"})


@register("csv_line_breaks", """
SELECT c_custkey, c_name || chr(10) || '"quoted", ' || c_mktsegment || chr(10) AS note, CASE WHEN c_custkey % 3 = 0 THEN chr(10) END AS empty FROM customer""")
def q_csv_line_breaks(spark, d):
    """Line breaks, quotes and separators inside values, written and read back."""
    from wareloom.session import scratch_path
    from wareloom.sinks import export as X
    from wareloom.sources import files as FS

    note = F.concat("c_name", F.lit('\n"quoted", '), "c_mktsegment", F.lit("\n"))
    df = T(spark, d, "customer").select("c_custkey", note.alias("note"), F.when(F.col("c_custkey") % 3 == 0, "\n").alias("empty"))
    path = scratch_path(spark, "csv-breaks")
    X.csv(df, path, null_value="NA", sep=",")
    return FS.delimited(spark, path, sep=",", schema=df.schema, null_value="NA")


@register("dates_all_null", """
SELECT event_id, CAST(NULL AS TIMESTAMP) AS close_date, make_timestamp(epoch_us(ts) // 1000 * 1000) AS "Edit Date", 'x' AS update_note FROM events""")
def q_dates_all_null(spark, d):
    """A text column of NULLs whose name says date becomes a timestamp; one with values stays text."""
    e = T(spark, d, "events")
    return D.from_epoch_millis(e.select("event_id", F.lit(None).cast("string").alias("close_date"), D.ts_to_epoch_millis("ts").alias("Edit Date"), F.lit("x").alias("update_note")))


_SIDES = 720


@register("locate_many_edges", """
SELECT c_custkey, CASE WHEN (x * x + y * y) < 1 AND x IS NOT NULL THEN 'disc' END AS NAME
FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 37 - 18 AS DOUBLE) / 16 + 0.01 END AS x, CAST(c_custkey % 41 - 20 AS DOUBLE) / 18 + 0.01 AS y FROM customer)
WHERE x IS NULL OR abs(x * x + y * y - 1) > 0.001""")
def q_locate_many_edges(spark, d):
    """A disc of many edges, points with repeated and missing coordinates (none within a thousandth of the rim)."""
    k = F.col("c_custkey")
    points = T(spark, d, "customer").select(k, F.when(k % 5 != 0, (k % 37 - 18).cast("double") / 16 + 0.01).alias("x"), ((k % 41 - 20).cast("double") / 18 + 0.01).alias("y"))
    points = points.where("x is null or abs(x * x + y * y - 1) > 0.001")
    turn = lambda i: i.cast("double") * (2 * 3.141592653589793 / _SIDES)
    ring = F.transform(F.sequence(F.lit(0), F.lit(_SIDES)), lambda i: F.array(F.cos(turn(i)), F.sin(turn(i))))
    disc = T(spark, d, "region").where("r_regionkey = 0").select(F.lit(1).alias("poly_order"), F.lit("disc").alias("NAME"), F.array(ring).alias("rings"))
    return SP.locate(points, disc, ["NAME"], "x", "y").select("c_custkey", "NAME")


@register("geocode_approximate", with_("addr", "locator") + """,
asked AS (SELECT id, CASE id % 4 WHEN 1 THEN replace(FULL_ADDRESS, 'Customer', 'Custmer') WHEN 2 THEN replace(FULL_ADDRESS, 'stom', 'sotm') WHEN 3 THEN FULL_ADDRESS || ' xyz'
  ELSE FULL_ADDRESS END AS FULL_ADDRESS FROM addr),
keyed AS (SELECT *, upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g'))) AS k FROM asked),
best AS (SELECT * FROM (SELECT upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g'))) AS near, longitude, latitude, score,
    row_number() OVER (PARTITION BY upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g'))) ORDER BY score DESC, longitude, latitude) AS rn FROM locator) WHERE rn = 1),
close AS (SELECT DISTINCT k, near, levenshtein(k, near) AS edits, longitude, latitude, score FROM keyed JOIN best ON abs(length(k) - length(near)) <= 2 WHERE levenshtein(k, near) <= 2),
first AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY edits, score DESC, longitude, latitude) AS pos FROM close)
SELECT id, FULL_ADDRESS, longitude, latitude, score, edits::INTEGER AS edits FROM keyed LEFT JOIN (SELECT * FROM first WHERE pos = 1) USING (k)""")
def q_geocode_approximate(spark, d):
    """Addresses with a letter missing, two swapped, or a word too many; the last are too far from any."""
    from wareloom.operators import approximate as A

    text = F.col("FULL_ADDRESS")
    asked = (F.when(F.col("id") % 4 == 1, F.replace(text, F.lit("Customer"), F.lit("Custmer"))).when(F.col("id") % 4 == 2, F.replace(text, F.lit("stom"), F.lit("sotm")))
             .when(F.col("id") % 4 == 3, F.concat(text, F.lit(" xyz"))).otherwise(text))
    out = A.geocode(FX.addr(spark, d).withColumn("FULL_ADDRESS", asked), FX.locator(spark, d))
    return out.select("id", "FULL_ADDRESS", "longitude", "latitude", "score", "edits")


_PROFILED = ["id_text", "digits_with_null", "all_null", "mixed", "order_date", "big_digits", "lead_zero"]


def _profile_sql(c: str) -> str:
    dated = "^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"
    return (f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS non_null, count(*) FILTER (WHERE NOT regexp_matches({c}, '^[0-9]+$')) AS non_digit, "
            f"count(*) FILTER (WHERE starts_with({c}, '0') AND length({c}) > 1) AS leading_zero, count(*) FILTER (WHERE regexp_matches({c}, '{dated}')) AS dated, "
            f"max(length({c})) AS max_length FROM text_orders")


@register("profile_batches", with_("text_orders") + " UNION ALL ".join(map(_profile_sql, _PROFILED)))
def q_profile_batches(spark, d):
    """Three batches, one of them sent twice, profiled each by itself; the states add up to the table's."""
    from wareloom.operators import profiles as P

    table = f"{scratch_database(spark, 'profiles')}.states"
    rows = FX.text_orders(spark, d)
    for batch in (0, 1, 2, 1):
        P.record(rows.where(F.col("o_orderkey") % 3 == batch).select(*_PROFILED), table, "orders", str(batch))
    return P.merged(spark, table, "orders")
