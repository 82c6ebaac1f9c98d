"""What the operators share: table access and the identity of a row.

A row of ``documents`` is known by its doc_id and a hash of its text.  Rows
equal in both get equal results and count as one document in corpus counts.
Operators keep only the columns they name, so extra columns cannot clash.
"""

from __future__ import annotations

from functools import wraps
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.session import ensure_checkpoint_dir, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """The session with its shared checkpoint folder and with this package on the executors."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def whole_text(col: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, row_hash, text, more): the row's identity beside its whole text."""
    text = whole_text()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("row_hash"), text.alias("text"),
                       *[F.col(c) for c in more])


def splittable(facts: DataFrame) -> DataFrame:
    """One-row-per-key facts, cut off from the aggregate that made them.

    Joined straight after the aggregate, they would keep its partitioning, and
    Spark can't split a hot key on the other side of such a join.  Read from the
    checkpoint, both sides are dealt anew and skewed partitions are split.
    """
    ready(facts.sparkSession)
    return facts.checkpoint()


def shielding(fn):
    """For functions of documents that return all their columns: columns whose names
    start with __, as helper columns' do, have other names while the function works."""
    @wraps(fn)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        taken, names = {c.lower() for c in docs.columns}, {}
        for c in docs.columns:
            if c.startswith("__"):
                names[c] = next(n for i in count() if (n := f"kept_{i}") not in taken)
                taken.add(names[c])
        made = fn(docs.withColumnsRenamed(names) if names else docs, *args, **kwargs)
        return made.withColumnsRenamed({new: c for c, new in names.items()}) if names else made
    return run


def join_rows(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``facts`` for the same row (null where there are none)."""
    facts = facts.withColumnsRenamed({"doc_id": "__doc", "row_hash": "__hash"})
    at = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("row_hash") == F.col("__hash"))
    return rows.join(facts, at, "left").drop("__doc", "__hash")
