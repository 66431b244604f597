"""Registered queries on hard inputs: mixed key types, missing columns, NULL
partitions and addresses, over-wide digits, short patterns, wide tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wareloom.plans import fixtures as FX
from wareloom.plans.registry import LD, ORDER_COLS, C, D, E, I, L, Q, T, register, with_


@register("replace_mixed_key_types", with_("master_orders") + f""",
given AS (SELECT * REPLACE (o_orderkey + CASE WHEN o_orderkey % 3 = 0 THEN 0.5 ELSE 0 END::DOUBLE AS o_orderkey) FROM orders WHERE o_orderkey % 10 >= 5),
staging AS (SELECT * REPLACE (o_orderkey::BIGINT AS o_orderkey) FROM given WHERE o_orderkey = trunc(o_orderkey))
SELECT {ORDER_COLS} FROM master_orders m WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE s.o_orderkey = m.o_orderkey)
UNION ALL SELECT {ORDER_COLS} FROM staging
UNION ALL SELECT NULL, o_custkey, 'refused ' || o_orderkey::VARCHAR, o_totalprice, o_orderdate, o_orderpriority FROM given WHERE o_orderkey <> trunc(o_orderkey)""")
def q_replace_mixed_key_types(spark, d):
    """Staging keys are doubles, a third of them between two master keys: those are listed, the others replace."""
    key = F.col("o_orderkey") + F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 0.5D ELSE 0D END")
    staging = T(spark, d, "orders").where("o_orderkey % 10 >= 5").withColumn("o_orderkey", key)
    master = FX.master_orders(spark, d)
    refused = LD.misfits(master, staging, ["o_orderkey"]).withColumn("o_orderstatus", F.concat(F.lit("refused "), F.col("o_orderkey").cast("string")))
    new = LD.replace(master, LD.fits(master, staging, ["o_orderkey"]), ["o_orderkey"])
    return new.unionByName(refused.withColumn("o_orderkey", F.lit(None).cast("bigint")))


_WIDE_KEY = "o_orderkey + 9007199254740000"


@register("replace_wide_keys", f"""
WITH master AS (SELECT {_WIDE_KEY} AS k, o_totalprice FROM orders),
staging AS (SELECT DISTINCT ({_WIDE_KEY})::DOUBLE AS k, -1.0::DOUBLE AS o_totalprice FROM orders WHERE o_orderkey % 5 = 0)
SELECT k, o_totalprice FROM master m WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE s.k::BIGINT = m.k)
UNION ALL SELECT k::BIGINT, o_totalprice FROM staging""")
def q_replace_wide_keys(spark, d):
    """Whole keys around 2^53 against doubles, which hold only every second of them there: no neighbour is deleted."""
    master = T(spark, d, "orders").select((F.col("o_orderkey") + F.lit(9007199254740000)).alias("k"), "o_totalprice")
    staging = master.where("(k - 9007199254740000) % 5 = 0").select(F.col("k").cast("double").alias("k"), F.lit(-1.0).alias("o_totalprice")).distinct()
    return LD.replace(master, staging, ["k"])


@register("replace_fewer_columns", with_("master_orders", "staging_orders") + f"""
SELECT {ORDER_COLS} FROM master_orders m WHERE NOT EXISTS (SELECT 1 FROM staging_orders s WHERE s.o_orderkey = m.o_orderkey)
UNION ALL SELECT o_orderkey, NULL, NULL, o_totalprice, NULL, NULL FROM staging_orders""")
def q_replace_fewer_columns(spark, d):
    staging = FX.staging_orders(spark, d).select("o_totalprice", "o_orderkey")
    return LD.replace(FX.master_orders(spark, d), staging, ["o_orderkey"])


@register("replace_null_partition", """
WITH parted AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders),
one AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, status FROM parted WHERE o_orderkey % 4 = 0 AND status IS NULL),
two AS (SELECT o_orderkey, o_totalprice + 2 AS o_totalprice, status FROM parted WHERE o_orderkey % 4 = 1 AND status = 'F')
SELECT * FROM parted p WHERE NOT EXISTS (SELECT 1 FROM two t WHERE t.o_orderkey = p.o_orderkey AND t.status = p.status)
UNION ALL SELECT * FROM one UNION ALL SELECT * FROM two""")
def q_replace_null_partition(spark, d):
    """Two partition-wise replaces, of the NULL partition (its keys match nothing, so its rows are added) and of ``F``."""
    from wareloom import jobs
    from wareloom.naming import TableRef
    from wareloom.plans.scratch import scratch_database

    target = scratch_database(spark, "null_partition")
    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    ref = TableRef("wl", target, "orders")
    parted = T(spark, d, "orders").select("o_orderkey", "o_totalprice", F.expr("CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END").alias("status"))
    runs = [parted, parted.where("o_orderkey % 4 = 0 AND status IS NULL").withColumn("o_totalprice", F.col("o_totalprice") + 1),
            parted.where("o_orderkey % 4 = 1 AND status = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 2)]
    for staging in runs:
        jobs.stage(staging, ref)
        jobs.run_replace_partitions(spark, ref, ["o_orderkey", "status"], ["status"], target_layer=target)
    return spark.table(ref.at(target).qualified)


@register("digits_too_wide", """
SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 40, '7') AS account, lpad(o_orderkey::VARCHAR, 18, '7')::BIGINT AS code FROM orders""")
def q_digits_too_wide(spark, d):
    o = T(spark, d, "orders")
    text = lambda n: F.lpad(F.col("o_orderkey").cast("string"), n, "7")
    return I.convert_types(o.select("o_orderkey", text(40).alias("account"), text(18).alias("code")))


@register("listing_short_patterns", with_("files") + """,
requests(req_id, pattern, top) AS (VALUES (1, '7', 4), (2, 'e_', 4), (3, '', 4), (4, NULL, 4), (5, 'src1', 4), (6, 'page_1', 4), (7, '_fr.t', 4), (8, 'nowhere', 4)),
m AS (SELECT r.req_id, r.top, f.*, row_number() OVER (PARTITION BY r.req_id ORDER BY f.created DESC, f.id) AS rank
      FROM requests r JOIN files f ON r.pattern <> '' AND contains(f.name, r.pattern))
SELECT req_id, CAST(rank AS INTEGER) AS rank, id, name, path, created FROM m WHERE rank <= top""")
def q_listing_short_patterns(spark, d):
    from wareloom.session import local_rows

    patterns = ["7", "e_", "", None, "src1", "page_1", "_fr.t", "nowhere"]
    requests = local_rows(spark, [(i, p, 4) for i, p in enumerate(patterns, 1)], "req_id int, pattern string, top int")
    return L.latest(requests, FX.files(spark, d))


_WIDE = 230


@register("null_report_wide", "SELECT column_name, null_count FROM (SELECT " + ", ".join(
    f"count(*) FILTER (WHERE o_orderkey % {i + 2} = 0) AS c{i}" for i in range(_WIDE)) + " FROM orders) UNPIVOT (null_count FOR column_name IN (COLUMNS(*)))")
def q_null_report_wide(spark, d):
    o = T(spark, d, "orders")
    return Q.null_counts(o.select(*[F.expr(f"CASE WHEN o_orderkey % {i + 2} <> 0 THEN o_orderkey END").alias(f"c{i}") for i in range(_WIDE)]))


@register("geocode_null_addresses", with_("addr", "locator") + """,
holes AS (SELECT id, CASE WHEN id % 5 <> 1 THEN FULL_ADDRESS END AS FULL_ADDRESS FROM addr),
best AS (SELECT * FROM (SELECT upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g'))) AS k, longitude, latitude, score,
    row_number() OVER (PARTITION BY upper(trim(regexp_replace(FULL_ADDRESS, '\\s+', ' ', 'g'))) ORDER BY score DESC, longitude, latitude) AS rn FROM locator) WHERE rn = 1)
SELECT h.id, h.FULL_ADDRESS, b.longitude, b.latitude, b.score FROM holes h
LEFT JOIN best b ON upper(trim(regexp_replace(h.FULL_ADDRESS, '\\s+', ' ', 'g'))) = b.k""")
def q_geocode_null_addresses(spark, d):
    """A fifth of the addresses and some of the locator's are NULL."""
    some = FX.addr(spark, d).withColumn("FULL_ADDRESS", F.expr("CASE WHEN id % 5 <> 1 THEN FULL_ADDRESS END"))
    locator = FX.locator(spark, d)
    holes = locator.withColumn("FULL_ADDRESS", F.lit(None).cast("string"))
    return E.geocode(some, locator.unionByName(holes)).select("id", "FULL_ADDRESS", "longitude", "latitude", "score")


@register("date_text_forms", """
SELECT user_id, ts AS with_zone, date_trunc('minute', ts) AS to_minute, ts AS six_digits, date_trunc('second', ts) AS with_offset FROM events""")
def q_date_text_forms(spark, d):
    """Texts with ``Z``, minutes only, six digits and an offset, read back."""
    e = T(spark, d, "events")
    form = lambda p: F.date_format("ts", p)
    texts = e.select("user_id", form("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("with_zone"), form("yyyy-MM-dd HH:mm").alias("to_minute"),
                     form("yyyy-MM-dd HH:mm:ss.SSSSSS").alias("six_digits"), form("yyyy-MM-dd'T'HH:mm:ss'+05:30'").alias("with_offset"))
    return D.try_convert(texts, ["with_zone", "to_minute", "six_digits", "with_offset"])


@register("union_fill_decimals", """
SELECT o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS amount FROM orders
UNION ALL SELECT c_custkey, CAST(CAST(CAST(c_acctbal AS DECIMAL(10,1)) AS DECIMAL(12,2)) AS VARCHAR) FROM customer
UNION ALL SELECT n_nationkey, CAST(CAST(n_nationkey AS DECIMAL(12,2)) AS VARCHAR) FROM nation""")
def q_union_fill_decimals(spark, d):
    """Decimals of two scales and an int meet as one decimal (shown as text)."""
    a = T(spark, d, "orders").select(F.col("o_orderkey").cast("bigint").alias("k"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount"))
    b = T(spark, d, "customer").select(F.col("c_custkey").cast("bigint").alias("k"), F.col("c_acctbal").cast("decimal(10,1)").alias("amount"))
    c = T(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_nationkey").cast("int").alias("amount"))
    out = C.union_fill([a, b, c])
    assert dict(out.dtypes)["amount"] == "decimal(12,2)"
    return out.withColumn("amount", F.col("amount").cast("string"))
