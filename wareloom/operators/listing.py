"""File-listing operators: resolve one file per request, latest files per
request, and arrival status.

Listings can be large (millions of files) and requests are many, so every
operator is a join, never a loop:

* exact-name matches pre-aggregate the listing by (name, path) before the
  join, so a name shared by a third of all files collapses map-side;
* "name contains" matches use an n-gram equi-join over the distinct names: a
  name is exploded into its grams of the lengths that the patterns need (6 for
  patterns of 6 characters on, else 3, else the pattern's own 2 or 1); a
  request joins on the rarest gram of its pattern, so its candidates are only
  the names that hold it, and the exact ``contains`` test runs on them.  Gram
  counts are taken for the requests' grams only, and the files' columns
  join the matching names last;
* top-n per request is two-phase (salted, then exact), so a request that
  matches a third of the listing is ranked by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAMS = (6, 3, 2, 1)
TOPN_SALT_BUCKETS = 32


def _cut(text: Column, k: int) -> Column:
    """The substrings of length ``k`` (none of a shorter text)."""
    n = F.length(text)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(k)))
    return F.filter(cut, lambda g: F.length(g) == k)


def _gram_length(pattern: Column) -> Column:
    """The longest gram length that a pattern has."""
    n = F.length(pattern)
    return F.coalesce(*[F.when(n >= k, k) for k in GRAMS])


def contains_matches(files: DataFrame, requests: DataFrame, name_col: str = "name", pattern_col: str = "pattern",
                     req_cols: list[str] | None = None) -> DataFrame:
    """(file columns..., request columns...) for every file whose name contains the pattern.

    Requests with an empty or NULL pattern match nothing.
    """
    req_cols = req_cols or requests.columns
    pat = F.col(pattern_col)
    rq = requests.where(pat.isNotNull() & (F.length(pat) > 0)).select(*[F.col(c) for c in req_cols])
    patterns = rq.select(pat.alias("__pattern")).distinct()
    used = [r[0] for r in patterns.select(_gram_length(F.col("__pattern"))).distinct().collect()]  # of four lengths
    if not used:
        return files.crossJoin(rq.limit(0)).limit(0)
    wanted = F.coalesce(*[F.when(_gram_length(F.col("__pattern")) == k, F.array_distinct(_cut(F.col("__pattern"), k))) for k in used])
    wanted = patterns.withColumn("__g", F.explode(wanted))
    names = files.select(F.col(name_col).alias("__name")).where(F.col(name_col).isNotNull()).distinct()
    grams = names.withColumn("__g", F.explode(F.array_distinct(F.flatten(F.array(*[_cut(F.col("__name"), k) for k in used])))))
    counts = (grams.join(wanted.select("__g").distinct(), "__g", "left_semi").groupBy("__g").agg(F.count(F.lit(1)).alias("__n")))
    rarest = (wanted.join(counts, "__g", "left").groupBy("__pattern")
              .agg(F.min_by("__g", F.struct(F.coalesce("__n", F.lit(0)), "__g")).alias("__g")))
    hits = grams.join(rarest, "__g").where(F.col("__name").contains(F.col("__pattern"))).select("__name", "__pattern")
    wide = rq.join(hits, pat == F.col("__pattern")).drop("__pattern")
    return files.join(wide, F.col(name_col) == F.col("__name")).drop("__name")


def top_n_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column], n: int | str,
                    salt_buckets: int = TOPN_SALT_BUCKETS) -> DataFrame:
    """Rows ranked 1..n per group (``n`` may be a column name), two-phase.

    Phase 1 ranks inside (group, salt) slices and keeps n rows per slice, so
    a huge group is ranked by ``salt_buckets`` tasks; phase 2 ranks the at
    most n x salt_buckets survivors per group.  Returns a ``rank`` column.
    """
    limit = F.col(n) if isinstance(n, str) else F.lit(n)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
    w1 = Window.partitionBy(*group_cols, "__salt").orderBy(*order_cols)
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    step1 = (df.withColumn("__salt", salt).withColumn("__r1", F.row_number().over(w1))
             .where(F.col("__r1") <= limit).drop("__r1", "__salt"))
    return step1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= limit)


def resolve(requests: DataFrame, files: DataFrame) -> DataFrame:
    """Pick exactly one file per request by exact name (and optional path prefix).

    requests: (req_id, name, path_prefix[, file_id]); files: (id, name, path, ...).
    A request that names a ``file_id`` (the way to settle an ambiguous name)
    is resolved by that id alone.
    Returns req_id, n_matches, file_id (when exactly one), status ok/ambiguous/missing.
    """
    if "file_id" in requests.columns:
        by_id = requests.where(F.col("file_id").isNotNull()).select("req_id", "file_id")
        found = by_id.join(files.select(F.col("id").alias("file_id")), "file_id", "left_semi")
        ids = (by_id.join(found.select("req_id", F.lit(1).cast("bigint").alias("n_matches")), "req_id", "left")
               .select("req_id", F.coalesce("n_matches", F.lit(0).cast("bigint")).alias("n_matches"), "file_id"))
        ids = ids.select("req_id", "n_matches", F.when(F.col("n_matches") == 1, F.col("file_id")).alias("file_id"),
                         F.when(F.col("n_matches") == 1, "ok").otherwise("missing").alias("status"))
        named = requests.where(F.col("file_id").isNull()).drop("file_id")
        return resolve(named, files).unionByName(ids)
    r = requests.select("req_id", F.col("name").alias("r_name"), "path_prefix")
    # a prefix is the folder up to its last "/" and the begin of the next part; files are counted under every
    # folder of their path, so a request meets one row (by folder) or the parts below one folder, however often its name occurs
    prefix = F.col("path_prefix")
    folder = F.regexp_extract(prefix, "(?s)^(.*/)?", 0)
    r = r.withColumns({"folder": folder, "begin": F.substr(prefix, F.length(folder) + 1)})
    wanted = r.select(F.col("r_name").alias("name"), "folder").distinct()
    parts = F.split("path", "/")
    below = files.select("name", "id", F.posexplode(parts).alias("i", "part"), parts.alias("parts"))
    below = below.select("name", "id", "part", F.concat_ws("/", F.slice("parts", 1, F.col("i")), F.when(F.col("i") > 0, "")).alias("folder"))
    below = below.join(wanted, ["name", "folder"], "left_semi")
    count = (F.count(F.lit(1)).alias("n"), F.min("id").alias("min_id"))
    by_part = below.groupBy("name", "folder", "part").agg(*count)
    by_folder = by_part.groupBy("name", "folder").agg(F.sum("n").alias("n"), F.min("min_id").alias("min_id"))
    by_name = files.groupBy("name").agg(*count)
    one = r.where(prefix.isNull()).join(by_name, F.col("r_name") == by_name["name"], "left").select("req_id", "n", "min_id")
    two = r.where(F.col("begin") == "").withColumnRenamed("folder", "r_folder")
    two = two.join(by_folder, (F.col("r_name") == by_folder["name"]) & (F.col("r_folder") == by_folder["folder"]), "left").select("req_id", "n", "min_id")
    # the parts are cut to the lengths of the begins, so that a begin meets its count by equality, however many parts a folder has
    begins = r.where(F.col("begin") != "").withColumnRenamed("folder", "r_folder")
    lengths = F.broadcast(begins.agg(F.collect_set(F.length("begin")).alias("lengths")))  # one row: few, however many requests
    cut = by_part.crossJoin(lengths).select("name", "folder", "part", "n", "min_id", F.explode(F.filter("lengths", lambda k: k <= F.length("part"))).alias("k"))
    by_begin = cut.groupBy("name", "folder", F.substring("part", 1, F.col("k")).alias("b_begin")).agg(F.sum("n").alias("n"), F.min("min_id").alias("min_id"))
    three = begins.join(by_begin, (F.col("r_name") == by_begin["name"]) & (F.col("r_folder") == by_begin["folder"]) & (F.col("begin") == F.col("b_begin")), "left")
    three = three.select("req_id", "n", "min_id")
    cand = one.unionByName(two).unionByName(three).withColumn("n", F.coalesce("n", F.lit(0)))
    per = cand.groupBy("req_id").agg(F.sum("n").cast("bigint").alias("n_matches"),
                                     F.min(F.when(F.col("n") > 0, F.col("min_id"))).alias("any_id"))
    status = (F.when(F.col("n_matches") == 1, "ok").when(F.col("n_matches") > 1, "ambiguous").otherwise("missing"))
    return per.select("req_id", "n_matches",
                      F.when(F.col("n_matches") == 1, F.col("any_id")).alias("file_id"),
                      status.alias("status"))


def latest(requests: DataFrame, files: DataFrame, n: int | None = None) -> DataFrame:
    """Latest files whose name contains the request pattern, newest first.

    requests: (req_id, pattern, top); files: (id, name, path, created).
    ``n`` overrides the per-request ``top``.  Returns req_id, rank, id, name, path, created.
    """
    m = contains_matches(files, requests.select("req_id", "pattern", "top"), "name", "pattern",
                         ["req_id", "pattern", "top"])
    ranked = top_n_per_group(m, ["req_id"], [F.col("created").desc(), F.col("id").asc()],
                             n if n is not None else "top")
    return ranked.select("req_id", F.col("rank").cast("int").alias("rank"), "id", "name", "path", "created")


def arrival_status(expectations: DataFrame, files: DataFrame) -> DataFrame:
    """Arrival check per expectation (exp_id, file_name, folder_path, file_types).

    A file matches when its path starts with ``folder_path`` (NULL = any),
    its name contains ``file_name`` and ends with one of ``file_types``
    (NULL / empty list = any suffix).  Exactly one match is ``ready`` (with
    that file's name), none ``waiting``, more ``ambiguous``.
    """
    m = contains_matches(files, expectations.select("exp_id", "file_name", "folder_path", "file_types"),
                         "name", "file_name", ["exp_id", "file_name", "folder_path", "file_types"])
    ok_path = F.col("folder_path").isNull() | F.col("path").startswith(F.col("folder_path"))
    types = F.col("file_types")
    # the file name enters the lambda as an argument (zip_with) rather than as an
    # outer reference: a filter whose lambda refers to an outer column can be
    # pushed below the join to the side that lacks that column
    names = F.array_repeat(F.col("name"), F.size(types))
    ends = F.zip_with(types, names, lambda t, n: n.endswith(t))
    ok_type = types.isNull() | (F.size(types) == 0) | F.array_contains(ends, True)
    per = (m.where(ok_path & ok_type).groupBy("exp_id")
           .agg(F.count(F.lit(1)).alias("n_matches"), F.min("name").alias("any_name")))
    out = expectations.select("exp_id").join(per, "exp_id", "left")
    n = F.coalesce(F.col("n_matches"), F.lit(0)).cast("bigint")
    return out.select("exp_id", n.alias("n_matches"),
                      F.when(n == 1, F.col("any_name")).alias("file_name"),
                      F.when(n == 1, "ready").when(n > 1, "ambiguous").otherwise("waiting").alias("status"))
