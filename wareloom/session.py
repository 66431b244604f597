"""Session construction and shared scratch locations.

Intermediate tables (lineage cuts, fixture files, publish swaps) always go
below the cluster's shared checkpoint folder.  The folder is read from the
running session; a local folder is only created when the session runs in
local mode and nothing was configured (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python data sources (paged APIs) receive filters they can push.
    "spark.sql.python.filterPushdown.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "wareloom", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # local runs (tools, tests) keep managed tables out of the working directory
        conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="wareloom-warehouse-")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1024 * 1024


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * MB) -> dict:
    """Settings for a cluster run sized from the input volume.

    Shuffles start with enough partitions for ``partition_bytes`` each (and
    at least three waves of tasks); AQE coalesces small ones and splits
    skewed ones at runtime; scan splits match the shuffle target; static
    broadcasts stay small while AQE broadcasts from measured sizes.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(32 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.session.timeZone": "UTC",
    }


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a private folder
    (and has it registered as its checkpoint dir); a cluster session must
    name a shared folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="wareloom-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    base = root.rstrip("/")
    return f"{base}/wareloom-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, name: str):
    """Write ``df`` as a Parquet table below the shared checkpoint folder and
    read it back: later jobs (and task retries after executor loss) start
    from the written files instead of recomputing the plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``wareloom`` importable in Python workers (Python data sources,
    ``mapInPandas``).  The package is zipped in memory, written below the
    shared checkpoint folder with the session's own file system API (so any
    scheme works) and added with ``addPyFile``, once per application.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, names in os.walk(pkg_dir):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.join("wareloom", os.path.relpath(full, pkg_dir)))
    target = f"{checkpoint_root(spark).rstrip('/')}/wareloom-pkg-{uuid.uuid4().hex[:8]}/wareloom.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder made by ``scratch_path`` once nothing reads it any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that must open files directly."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def local_rows(spark: SparkSession, rows: list[tuple], schema: str):
    """A small DataFrame of literal rows planned in the JVM (no Python RDD,
    no Python worker): ``inline(array(struct(...)))`` over a one-row range.
    Meant for metadata-sized inputs (contracts, schemas, catalog listings)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType, _parse_datatype_string

    st = _parse_datatype_string(schema)
    if not isinstance(st, StructType):
        raise ValueError("schema must be a struct")
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    # one SQL text (one call into the JVM) instead of a call per literal
    cols = ", ".join(f"c{i}" for i in range(len(st.fields)))
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(st.fields))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({cols})")


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}L" if abs(v) > 2**31 - 1 else str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"
