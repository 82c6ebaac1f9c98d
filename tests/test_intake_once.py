"""A feed batch is parsed, checked, counted and folded in one pass; landings are compressed and bounded."""

import os

import pytest
from pyspark.sql import functions as F

from tremorlake.operators.constraints import ConstraintError
from tremorlake.plans import jobs
from tremorlake.sources import sinks as SINK
from tremorlake.sources import tables as T
from tremorlake.sources.feed import ARRIVAL, UNFIT, read_feed

SF001 = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def counted(spark, batch):
    """The batch and an accumulator of the rows that are computed for its readers."""
    seen = spark.sparkContext.accumulator(0)

    def run(frames):
        for frame in frames:
            seen.add(frame.num_rows)
            yield frame

    return batch.mapInArrow(run, batch.schema), seen


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed"))
    docs = SINK.feed_documents(T.derived_raw(spark, SF001, T.AS_OF))
    SINK.write_feed_documents(docs, path)
    return path


@pytest.mark.parametrize("job", [lambda s, b, p: jobs.ingest_batch(s, b, p, 1, stamp=T.AS_OF), lambda s, b, p: jobs.ingest_in_place(s, b, p, stamp=T.AS_OF)])
def test_batch_is_read_once(spark, landed, tmp_path, job):
    rows = read_feed(spark, landed, multi_line=False, tracked=True).drop(ARRIVAL).checkpoint()
    batch, seen = counted(spark, rows)
    done = job(spark, batch, f"{tmp_path}/raw")
    assert done["events"] == rows.count() == seen.value


@pytest.mark.parametrize("job", [lambda s, b, p: jobs.ingest_batch(s, b, p, 1, stamp=T.AS_OF), lambda s, b, p: jobs.ingest_in_place(s, b, p, stamp=T.AS_OF)])
def test_broken_batch_leaves_no_table(spark, landed, tmp_path, job):
    rows = read_feed(spark, landed, multi_line=False, tracked=True).withColumn(UNFIT, F.array(F.lit("mag"))).withColumn("alert", F.repeat(F.lit("r"), 99))
    with pytest.raises(ConstraintError, match=r"fits_decimal\(6,2\)\(mag\)"):
        job(spark, rows, f"{tmp_path}/raw")
    assert not os.path.exists(f"{tmp_path}/raw/v00000001") and not [n for n in os.listdir(tmp_path) if "event_date" in n]


def test_properties_are_parsed_once(spark, landed):
    for strict in (True, False):
        rows = read_feed(spark, landed, strict=strict, multi_line=False, tracked=True)
        assert plan(rows).count("from_json") == 1


def test_first_load_joins_nothing(spark, landed, tmp_path):
    from tremorlake.operators import upsert as U
    from tremorlake.schema import RAW_SCHEMA

    rows = read_feed(spark, landed, multi_line=False).withColumn("ingested_at", T.ts_literal(T.AS_OF))
    empty = spark.createDataFrame([], RAW_SCHEMA)
    fresh = U.raw_upsert(empty, rows, stamp=T.ts_literal(T.AS_OF), folded=True, fresh=True)
    joined = U.raw_upsert(empty, rows, stamp=T.ts_literal(T.AS_OF), folded=True)
    assert "Join" not in plan(fresh) and fresh.columns == joined.columns
    assert sorted(map(str, fresh.collect())) == sorted(map(str, joined.collect()))


def test_landed_files_are_compressed_and_bounded(spark, tmp_path):
    docs = spark.range(60).select(F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}")).alias("value"), F.col("id").alias("_doc"))
    assert SINK.land_in_batches(docs, f"{tmp_path}/a", 3, 60_000) == 1
    assert SINK.land_in_batches(docs, f"{tmp_path}/b", 3, 60_000, per_file=5_000) == 4
    for folder, n in (("a", 3), ("b", 12)):
        names = [f for f in os.listdir(f"{tmp_path}/{folder}") if f.startswith("part-")]
        assert len(names) == n and all(f.endswith(".gz") for f in names)
        assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/{folder}").collect()) == sorted(r[0] for r in docs.select("value").collect())
