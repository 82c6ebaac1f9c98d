"""Tables kept in place, in one folder per date or bucket, and safe after a stop.

A batch writes the folders that it touches anew.  It never writes into the table
itself: new folders go to ``_redo`` beside it, a small file then names them and
marks them complete, and only then each takes its place (the old folder is
deleted, the new one renamed).  A run that finds a complete ``_redo`` finishes it
first; an incomplete one is dropped.  So a stop at any point, also between the
deletion and the renaming of a folder, loses no row, doubles none and gives no
number twice.  Several tables may change in one such commit.

Folder names that start with _ are no part of the table: readers read the table
by its path alone.  One writer at a time; a folder's renaming must be atomic, as
it is on HDFS and local disks.

``_state`` holds what a batch needs to know without a scan of the table: numbers
(the last serial id) and a key index, (key, date, version) in folders by a hash
of the key, of which a batch reads its own keys' folders alone.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import _fs

REDO, STATE = "_redo", "_state"
#: Folders of a new key index: about one for each 10^5 to 10^6 keys that the table will hold.
BUCKETS = 16
_NULL = "__HIVE_DEFAULT_PARTITION__"


class Part(NamedTuple):
    """The new rows of a table's touched folders."""

    name: str
    rows: DataFrame
    target: str
    by: str
    touched: list  # values of ``by`` whose folders the rows replace
    order: list = []
    bloom: list[str] = []


def after(step: str) -> None:
    """Called after every step of a commit; tests stop a run here."""


# --- files ---------------------------------------------------------------------------------

def _make(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"{path} can't be deleted")


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, target)
    if not fs.rename(_fs(spark, source)[1], p):
        raise OSError(f"{source} can't be renamed to {target}")


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    fs, p = _fs(spark, path + ".tmp")  # its folder is made with it
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    _delete(spark, path)
    _rename(spark, path + ".tmp", path)


def _read_json(spark: SparkSession, path: str) -> dict | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of a table's folders."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if "=" in n and not n.startswith("_"))


def folder(by: str, value) -> str:
    return f"{by}={_NULL if value is None else value.isoformat() if isinstance(value, dt.date) else value}"


# --- commits ---------------------------------------------------------------------------------

def finish(spark: SparkSession, home: str) -> bool:
    """Finish a commit that stopped after it was complete, drop one that stopped before; True if there was one to finish."""
    redo = f"{home}/{REDO}"
    plan = _read_json(spark, f"{redo}/complete.json")
    if plan is None:
        _delete(spark, redo)
        return False
    for staged, target, names in plan["moves"]:
        waiting = set(folders(spark, f"{redo}/{staged}"))  # the others have their place already
        _make(spark, target)
        for name in names:
            if name in waiting:
                _delete(spark, f"{target}/{name}")
                after("deleted")
                _rename(spark, f"{redo}/{staged}/{name}", f"{target}/{name}")
                after("moved")
    for target in plan["drops"]:
        _delete(spark, target)
        after("dropped")
    if plan["state"] is not None:
        _write_json(spark, f"{home}/{STATE}/numbers.json", plan["state"])
    after("numbers")
    _delete(spark, redo)
    return True


def commit(spark: SparkSession, home: str, parts: list[Part], state: dict | None = None) -> None:
    """Replace the touched folders of the parts' tables, all or none of them; ``state`` becomes the new numbers."""
    finish(spark, home)
    redo = f"{home}/{REDO}"
    moves, drops = [], []
    for part in parts:
        staged = f"{redo}/{part.name}"
        rows = part.rows.repartitionByRange(part.by, *part.order[:1]).sortWithinPartitions(part.by, *part.order)
        writer = rows.write.partitionBy(part.by)
        for c in part.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(staged)
        after("staged")
        made = folders(spark, staged)
        moves.append((part.name, part.target, made))
        drops += [f"{part.target}/{name}" for name in sorted({folder(part.by, v) for v in part.touched} - set(made))]
    _write_json(spark, f"{redo}/complete.json", {"moves": moves, "drops": drops, "state": state})
    after("complete")
    finish(spark, home)


def numbers(spark: SparkSession, home: str) -> dict | None:
    return _read_json(spark, f"{home}/{STATE}/numbers.json")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table's rows; ``schema`` names the folder column too.  Without folders there are none."""
    if not folders(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def within(by: str, values: Iterable) -> Column:
    """The condition that a row lies in one of these folders."""
    values = list(values)
    known = F.col(by).isin([v for v in values if v is not None])
    return known | F.col(by).isNull() if None in values else known


def distinct_values(df: DataFrame, by: str) -> list:
    """The folders that rows fall into: as many as a batch has days, or the index has buckets."""
    return sorted((r[0] for r in df.select(by).distinct().collect()), key=lambda v: (v is not None, v))


# --- the key index -----------------------------------------------------------------------------

def bucketed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def index_path(home: str) -> str:
    return f"{home}/{STATE}/keys"


def index_rows(spark: SparkSession, home: str, schema: T.StructType, keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """All index rows of the folders that ``keys`` fall into."""
    wanted = distinct_values(bucketed(keys.select(key), key, buckets), "bucket")
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return read(spark, index_path(home), whole).filter(within("bucket", wanted))


def index_parts(spark: SparkSession, home: str, schema: T.StructType, entries: DataFrame, key: str, buckets: int) -> list[Part]:
    """``entries`` in place of the index rows of their keys, for ``commit``; nothing without entries."""
    made = bucketed(entries.select(*schema.names), key, buckets)
    touched = distinct_values(made, "bucket")
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    old = read(spark, index_path(home), whole).filter(within("bucket", touched)).join(entries.select(key), key, "left_anti")
    rows = old.select(*made.columns).unionByName(made)
    return [Part("keys", rows, index_path(home), "bucket", touched, [F.col(key)])] if touched else []
