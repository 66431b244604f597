"""Keyed loads from a staging table into a master table.

Pure functions ``(master, staging) -> DataFrame`` describe the new master;
``wareloom.catalog.publish`` makes it visible.  Plans at scale:

* The staging key set is taken ``distinct`` first: partial aggregation
  collapses a hot key map-side, so the build side of the anti join never
  holds one key a third of the table times.
* Master rows with a NULL key can never match (plain equality, as the
  warehouse DELETE ... JOIN does).  They are spread over shuffle partitions
  by a hash salt instead of all landing in the NULL-key partition.
* Keys of different types are compared exactly: a staging key is never
  narrowed or rounded into a master key it does not equal, and one that the
  master's type cannot hold is refused (``misfits`` lists such rows).
* No broadcast hint: AQE switches the anti join to a broadcast hash join
  from the *measured* size of the distinct key set when it is small, and
  splits skewed master partitions otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "__wl_salt"


def _check_keys(keys: list[str] | tuple[str, ...] | str) -> list[str]:
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        raise ValueError("at least one key column is required")
    return keys


def _all_not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def _hashable(df: DataFrame) -> list[str]:
    """Columns that ``xxhash64`` takes (no maps inside)."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


def spread(df: DataFrame) -> Column:
    """A hash of the row, for rows that need no partner: never 0."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(df)])
    return F.when(h == 0, F.lit(1).cast("bigint")).otherwise(h)


def _null_salt(df: DataFrame, keys: list[str], by_position: bool = False) -> Column:
    """0 for rows that can match; a spreading number for NULL-key rows.

    The number is a hash of the whole row, or (``by_position``, when only the
    key columns are read) the row's position in its input split, which is
    stable for a file scan."""
    away = F.monotonically_increasing_id() + 1 if by_position else spread(df)
    return F.when(_all_not_null(keys), F.lit(0).cast("bigint")).otherwise(away)


def common_key_types(left: DataFrame, right: DataFrame, keys: list[str]) -> dict[str, str | None]:
    """For each key whose types differ, the type both are compared in.

    Whole numbers against floating ones meet as whole numbers (a double cannot tell large
    ones apart); other types by Catalyst's own widening (date and timestamp: timestamp); text
    against another type is read as that type.  What the type cannot hold exactly is
    NULL, so it matches nothing.  Decimals against floating numbers are refused: neither holds the other."""
    from pyspark.sql import types as T

    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    floating = (T.FloatType, T.DoubleType)
    out = {}
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if a == b:
            continue
        texts = [isinstance(t, T.StringType) for t in (a, b)]
        if any(texts):
            out[k] = None if all(texts) else (b if texts[0] else a).simpleString()
            continue
        kinds = [next((n for n, t in (("whole", whole), ("floating", floating), ("decimal", T.DecimalType)) if isinstance(x, t)), "other") for x in (a, b)]
        if sorted(kinds) == ["floating", "whole"]:
            out[k] = "bigint"
            continue
        if sorted(kinds) == ["decimal", "floating"]:
            raise ValueError(f"key {k}: {a.simpleString()} and {b.simpleString()} cannot be compared exactly; cast one of them")
        both = F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("k")
        out[k] = left.sparkSession.range(0).select(both).schema["k"].dataType.simpleString()
    return {k: t for k, t in out.items() if t}


def _exactly(c: Column, source, target: str) -> Column:
    """``c`` in another type, NULL where that type does not hold it exactly."""
    from pyspark.sql import types as T

    if isinstance(source, (T.FloatType, T.DoubleType)) and target in ("tinyint", "smallint", "int", "bigint"):
        fits = (c == F.floor(c).cast("double")) & (c >= -(2.0**63)) & (c < 2.0**63)
        return F.when(fits, c.try_cast("bigint")).try_cast(target)
    return c.try_cast(target)


def _comparable(df: DataFrame, types: dict[str, str | None]) -> dict[str, Column]:
    """Key columns in the types they are compared in."""
    return {k: _exactly(F.col(f"`{k}`"), df.schema[k].dataType, t) for k, t in types.items()}


def _misfit(master: DataFrame, staging: DataFrame, keys: list[str]) -> Column:
    """Whether a staging row has a key that the master's type would change (or lose)."""
    tests = []
    for k in keys:
        if k not in staging.columns or master.schema[k].dataType == staging.schema[k].dataType:
            continue
        c = F.col(f"`{k}`")
        there = _exactly(c, staging.schema[k].dataType, master.schema[k].dataType.simpleString())
        back = there.try_cast(staging.schema[k].dataType)
        is_text = staging.schema[k].dataType.simpleString() == "string"  # a number may be written in many ways
        tests.append(c.isNotNull() & (there.isNull() if is_text else ~back.eqNullSafe(c)))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def misfits(master: DataFrame, staging: DataFrame, keys) -> DataFrame:
    """Staging rows whose key the master's type cannot hold; loading them would make other keys of them."""
    return staging.where(_misfit(master, staging, _check_keys(keys)))


def fits(master: DataFrame, staging: DataFrame, keys) -> DataFrame:
    """Staging rows whose key the master's type holds."""
    return staging.where(~_misfit(master, staging, _check_keys(keys)))


_KEY = "__wl_key"


def _match_key(keys: list[str], salt: Column, string_keys: set | None = None,
               collation: str | None = None) -> Column:
    """The join key ``struct(keys..., salt)``.  A struct is kept whole by the
    optimizer, so the salt reaches the shuffle's hash partitioning (a plain
    ``salt = 0`` key on the key-set side is folded into a join condition and
    would leave every NULL-key row in one partition).

    With ``collation`` (e.g. ``UTF8_LCASE_RTRIM``: case-insensitive, trailing
    spaces ignored, as a warehouse's default collation compares), string keys
    are compared under that collation."""
    parts = []
    for k in keys:
        c = F.col(f"`{k}`")
        if collation and string_keys and k in string_keys:
            c = F.collate(c, collation)
        parts.append(c.alias(k))
    return F.struct(*parts, salt.alias(_SALT))


def _string_keys(df: DataFrame, keys: list[str]) -> set:
    from pyspark.sql import types as T

    return {f.name for f in df.schema.fields if f.name in keys and isinstance(f.dataType, T.StringType)}


def _key_side(staging: DataFrame, keys: list[str], key_type=None, collation: str | None = None) -> DataFrame:
    """Distinct non-NULL staging keys as match keys.

    The distinct is taken on the plain key columns and the join then shuffles
    the (small) distinct set once more by the match key.  That extra exchange
    is kept on purpose: with both join inputs coming straight from shuffle
    stages, AQE can split a master partition that one hot key makes huge
    (``SortMergeJoin(skew=true)``); with the aggregate directly under the join
    it could not.  When the key set is small AQE broadcasts it instead.
    """
    skeys = _string_keys(staging, keys)
    # under a collation the distinct groups "A" and "a " as one key
    cols = [F.collate(F.col(f"`{k}`"), collation).alias(k) if collation and k in skeys else F.col(f"`{k}`")
            for k in keys]
    ks = staging.select(*cols).where(_all_not_null(keys)).distinct()
    k = _match_key(keys, F.lit(0).cast("bigint"))
    if key_type is not None:  # the master side's exact type, so no cast in the join keys
        k = k.cast(key_type)
    return ks.select(k.alias(_KEY))


def anti_by_key(left: DataFrame, right: DataFrame, keys, collation: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key (plain equality: NULL never matches) is not
    among the keys of ``right``; NULL-key rows are salted, hot keys split by AQE."""
    keys = _check_keys(keys)
    types = common_key_types(left, right, keys)
    if types:
        named = {k: f"__wl_as_{i}" for i, k in enumerate(keys)}
        wide = left.withColumns({n: _comparable(left, types).get(k, F.col(f"`{k}`")) for k, n in named.items()})
        thin = right.select(*[_comparable(right, types).get(k, F.col(f"`{k}`")).alias(n) for k, n in named.items()])
        return anti_by_key(wide, thin, list(named.values()), collation).drop(*named.values())
    m = left.withColumn(_KEY, _match_key(keys, _null_salt(left, keys), _string_keys(left, keys), collation))
    return m.join(_key_side(right, keys, m.schema[_KEY].dataType, collation), _KEY, "left_anti").drop(_KEY)


def delete_by_key(master: DataFrame, staging: DataFrame, keys, collation: str | None = None) -> DataFrame:
    """Master rows whose key does not occur in staging (NULL keys never match)."""
    return anti_by_key(master, staging, keys, collation)


def replace(master: DataFrame, staging: DataFrame, keys, collation: str | None = None) -> DataFrame:
    """Replace by key: delete master rows matched by staging keys, then insert
    every staging row (duplicates kept).  Columns are matched by name and take
    the master's types; master columns that staging lacks become NULL.  A key that
    the master's type would change fails the job."""
    return delete_by_key(master, staging, keys, collation).unionByName(align_by_name(master, refuse_misfits(master, staging, keys)))


def refuse_misfits(master: DataFrame, staging: DataFrame, keys) -> DataFrame:
    """``staging``, whose reading fails at a key that the master's type would change."""
    keys = _check_keys(keys)
    if all(k not in staging.columns or master.schema[k].dataType == staging.schema[k].dataType for k in keys):
        return staging
    shown = F.concat_ws(", ", *[F.col(f"`{k}`").cast("string") for k in keys])
    message = F.concat(F.lit("the master's types cannot hold the staging key "), shown)
    return staging.where(F.when(_misfit(master, staging, keys), F.raise_error(message).cast("boolean")).otherwise(True))


def _same_columns(master: DataFrame, staging: DataFrame) -> None:
    extra = [c for c in staging.columns if c not in master.columns]
    if extra:
        raise ValueError(f"staging has columns the master lacks: {extra}")


def align_by_name(master: DataFrame, staging: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Staging rows shaped like master (INSERT ... BY NAME): staging columns
    absent from master are an error, master columns absent from staging
    become NULL, types follow master."""
    exclude = list(exclude or [])
    staging = staging.drop(*exclude)
    _same_columns(master, staging)
    mtypes = {f.name: f.dataType for f in master.schema.fields}
    return staging.select(*[
        (F.col(f"`{c}`").cast(mtypes[c]) if c in staging.columns else F.lit(None).cast(mtypes[c])).alias(c)
        for c in master.columns])


def append_by_name(master: DataFrame, staging: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """The new master of an append: master plus the aligned staging rows."""
    return master.unionByName(align_by_name(master, staging, exclude))


def _null_safe_cond(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys])


def unseen(staging: DataFrame, master: DataFrame, keys) -> DataFrame:
    """Staging rows whose (NULL-safe) key is not in master."""
    keys = _check_keys(keys)
    mk = master.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    return staging.join(mk, _null_safe_cond(staging, mk, keys), "left_anti")


def append_new(master: DataFrame, staging: DataFrame, keys) -> DataFrame:
    """Append only staging rows with unseen NULL-safe keys."""
    return master.unionByName(unseen(staging, master, keys).select(*[F.col(f"`{c}`") for c in master.columns]))


def new_ids(staging: DataFrame, master: DataFrame, id_cols) -> DataFrame:
    """Novelty gate input: distinct staging ids absent from master (NULL = NULL)."""
    id_cols = _check_keys(id_cols)
    sk = staging.select(*[F.col(f"`{k}`") for k in id_cols]).distinct()
    return unseen(sk, master, id_cols)


class GateError(RuntimeError):
    pass


def require_new_ids(staging: DataFrame, master: DataFrame | None, id_cols) -> None:
    """Stop when staging brings no id the master does not have (one short job)."""
    if master is None:
        return
    if new_ids(staging, master, id_cols).isEmpty():
        raise GateError(f"no new ids in staging for {id_cols}")


def overwrite(master: DataFrame | None, staging: DataFrame, id_cols=None, require_new: bool = False) -> DataFrame:
    """Overwrite: the new master is staging; optionally gated by new ids."""
    if require_new:
        require_new_ids(staging, master, id_cols)
    return staging


@dataclass(frozen=True)
class Report:
    deleted: int
    inserted: int

    @property
    def delta(self) -> int:
        return self.inserted - self.deleted

    @property
    def message(self) -> str:
        return report_message(self.deleted, self.inserted)


def report_message(deleted: int, inserted: int) -> str:
    """One line for the job log: how a replace changed the master's size."""
    if inserted < deleted:
        return f"master shrank by {deleted - inserted}: {deleted} removed, {inserted} inserted"
    return f"{inserted} inserted, {deleted} removed"


def replace_report(master: DataFrame, staging: DataFrame, keys) -> DataFrame:
    """One-row load report of a replace-by-key, computed in one job:
    master_rows, deleted, inserted, result_rows, delta, message."""
    keys = _check_keys(keys)
    types = common_key_types(master, staging, keys)
    as_key = lambda df: df.select(*[_comparable(df, types).get(k, F.col(f"`{k}`")).alias(k) for k in keys])
    mk = as_key(master)
    mkeys = mk.select(_match_key(keys, _null_salt(mk, keys, by_position=True)).alias(_KEY))
    ks = _key_side(as_key(staging), keys, mkeys.schema[_KEY].dataType).withColumn("__hit", F.lit(True))
    m = (mkeys.join(ks, _KEY, "left")
         .select(F.lit("m").alias("side"), F.coalesce(F.col("__hit"), F.lit(False)).alias("hit")))
    s = staging.select(F.lit("s").alias("side"), F.lit(False).alias("hit"))
    agg = m.unionByName(s).agg(
        F.count_if(F.col("side") == "m").alias("master_rows"),
        F.count_if((F.col("side") == "m") & F.col("hit")).alias("deleted"),
        F.count_if(F.col("side") == "s").alias("inserted"))
    removed, added = F.col("deleted").cast("string"), F.col("inserted").cast("string")
    shrank = (F.col("deleted") - F.col("inserted")).cast("string")
    message = (F.when(F.col("inserted") < F.col("deleted"),
                      F.concat(F.lit("master shrank by "), shrank, F.lit(": "), removed, F.lit(" removed, "), added, F.lit(" inserted")))
               .otherwise(F.concat(added, F.lit(" inserted, "), removed, F.lit(" removed"))))
    return agg.select(
        "master_rows", "deleted", "inserted",
        (F.col("master_rows") - F.col("deleted") + F.col("inserted")).alias("result_rows"),
        (F.col("inserted") - F.col("deleted")).alias("delta"), message.alias("message"))


# ---- generated ids ---------------------------------------------------------

def with_sequence_id(df: DataFrame, id_col: str, order_cols: list[str], start: int | Column = 0,
                     checkpoint: bool = True) -> DataFrame:
    """Consecutive ids ``start+1, start+2, ...`` in ``order_cols`` order, distributed.

    A global sort (range partitions, with a row hash as tie breaker so a hot
    sort key still spreads) is tagged with ``monotonically_increasing_id``;
    per-partition row counts (one row per partition, a proven small bound)
    give each partition its offset.  The tagged sort is written as a table in
    the shared checkpoint folder so both uses see the same rows after executor loss.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__tie")
    tagged = (df.withColumn("__tie", tie)
              .orderBy(*[F.col(f"`{c}`") for c in order_cols], "__tie")
              .withColumn("__mono", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("__pid", F.shiftright(F.col("__mono"), 33))
    if checkpoint:
        # a written Parquet table in the shared checkpoint folder: the
        # per-partition counts and the final join read the same rows, also
        # after an executor is lost (the ids live in columns, not in the layout)
        from wareloom.session import cut_lineage
        tagged = cut_lineage(tagged, "sequence")
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql.window import Window
    offsets = counts.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    local = F.col("__mono") - F.shiftleft(F.col("__pid"), 33)
    base = start if isinstance(start, Column) else F.lit(start)
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(id_col, (base + F.col("__off") + local + 1).cast("bigint"))
            .drop("__tie", "__mono", "__pid", "__off"))


def append_generated_id(master: DataFrame, staging: DataFrame, id_col: str, order_cols: list[str]) -> DataFrame:
    """Append staging without its id column; new ids continue after max(master id)."""
    start = master.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("m")).first()["m"]
    staged = with_sequence_id(staging.drop(id_col), id_col, order_cols, start=int(start))
    return master.unionByName(align_by_name(master, staged))


def replace_generated_id(master: DataFrame, staging: DataFrame, keys, id_col: str, order_cols: list[str]) -> DataFrame:
    """Replace by key, leaving the generated id column out of the insert."""
    kept = delete_by_key(master, staging, keys)
    start = master.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("m")).first()["m"]
    staged = with_sequence_id(refuse_misfits(master, staging, keys).drop(id_col), id_col, order_cols, start=int(start))
    return kept.unionByName(align_by_name(master, staged))
