"""Session helpers: builder defaults, the shared checkpoint folder, checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a side may hold and still be shipped to every task: rows, and bytes as estimated from its values.
BROADCAST_ROW_LIMIT = 200_000
BROADCAST_BYTE_LIMIT = 64 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tremorlake") -> SparkSession:
    """A session configured the way every operator here expects: UTC, AQE on, no UI."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TREMOR_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, as ``--py-files`` would.

    Python functions that run there import it.  Where it is installed on all
    machines, ``spark.tremorlake.installed=true`` leaves this out.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tremorlake_shipped", False) or sc.getConf().get("spark.tremorlake.installed", "false") == "true":
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):
        path = os.path.join(tempfile.mkdtemp(prefix="tremorlake-"), "tremorlake.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(here):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.join("tremorlake", os.path.relpath(full, here)))
        sc.addPyFile(path)
    sc._tremorlake_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins.  A fresh temporary folder is
    taken only on a local master (tests, a laptop); elsewhere executors would not
    share it, so an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = os.path.join(tempfile.gettempdir(), f"tremorlake-ckpt-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder inside the shared checkpoint location (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def estimated_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a frame: one aggregate with a partial one in every task.

    Bytes are counted from the values: the length of texts and binaries and the
    fixed width of the rest, plus 16 for each row.
    """
    width = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        else:
            width = width + 16
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return row["n"], row["b"] or 0


def proven_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, max_bytes: int = BROADCAST_BYTE_LIMIT) -> bool:
    rows, size = estimated_size(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, max_bytes: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """Broadcast ``df`` only after its rows and bytes are counted and within bounds.

    Beyond them the frame is returned as it is and the planner keeps a shuffle join.
    """
    return F.broadcast(df) if proven_small(df, max_rows, max_bytes) else df
