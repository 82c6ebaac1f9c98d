"""Tables in place: stops at every step, untouched files, the key index, the tsunami table."""

import datetime as dt
import glob
import os
import random
import shutil
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from test_intake import MS, feature, land
from tremorlake.operators import upsert as U
from tremorlake.plans import jobs
from tremorlake.schema import CURATE_INPUT_COLUMNS, RAW_SCHEMA, TSUNAMI_COLUMNS
from tremorlake.sources import place as PLACE
from tremorlake.sources import tables as T
from tremorlake.streaming.intake import stream_feed

DAY = dt.datetime(2024, 1, 1)


def raw_rows(spark, rows):
    """(usgs_id, day, version in hours, tsunami, mag) -> raw rows."""
    base = dict.fromkeys(RAW_SCHEMA.names)
    out = []
    for key, day, version, tsunami, mag in rows:
        made = base | {"id": key, "usgs_id": key, "time": None if day is None else DAY + dt.timedelta(days=day), "updated": DAY + dt.timedelta(hours=version),
                       "tsunami": tsunami, "mag": Decimal(mag), "longitude": Decimal("1.5"), "latitude": Decimal("2.5")}
        out.append(tuple(made[c] for c in RAW_SCHEMA.names))
    return spark.createDataFrame(out, RAW_SCHEMA)


def rows_of(spark, path, columns=None):
    if not PLACE.folders(spark, path):
        return []
    df = spark.read.parquet(path)
    return sorted((tuple(r) for r in df.select(*(columns or sorted(df.columns))).collect()), key=repr)


FIRST = [  # key, day, version, tsunami, mag
    ("a", 0, 1, 1, 1), ("b", 0, 1, 0, 2), ("c", 1, 1, 1, 3), ("d", 2, 1, 0, 4), ("e", None, 1, 1, 5)]
# a moves to another date and leaves its own; b changes; c goes and its date becomes empty; f is new; d is older than what is there
SECOND = [("a", 3, 5, 0, 9), ("b", 0, 5, 1, 8), ("c", 3, 5, 1, 7), ("d", 2, 0, 1, 6), ("f", None, 5, 1, 5)]


class Stop(Exception):
    pass


def stop_at(monkeypatch, n):
    left = [n]

    def after(step):
        left[0] -= 1
        if left[0] == 0:
            raise Stop(step)
    monkeypatch.setattr(PLACE, "after", after)


def test_a_stop_after_any_step_loses_doubles_and_renumbers_nothing(spark, monkeypatch):
    first, second = raw_rows(spark, FIRST).checkpoint(), raw_rows(spark, SECOND).checkpoint()

    def loaded():
        root = tempfile.mkdtemp(prefix="place-")
        jobs.curate_in_place(spark, first, f"{root}/final", stamp=T.AS_OF, tsunami_dir=f"{root}/tsunami", buckets=2)
        return root

    whole = loaded()
    jobs.curate_in_place(spark, second, f"{whole}/final", stamp=T.AS_OF, tsunami_dir=f"{whole}/tsunami")
    want = rows_of(spark, f"{whole}/final"), rows_of(spark, f"{whole}/tsunami")
    ids = {r[0]: r[1] for r in spark.read.parquet(f"{whole}/final").select("usgs_id", "id").collect()}
    assert len(want[0]) == 6 and len(set(ids.values())) == 6 and ids["f"] == 6
    base, steps = loaded(), []
    monkeypatch.setattr(PLACE, "after", steps.append)
    jobs.curate_in_place(spark, second, f"{base}/final", stamp=T.AS_OF, tsunami_dir=f"{base}/tsunami")
    assert {"staged", "complete", "deleted", "moved", "dropped", "numbers"} == set(steps)
    monkeypatch.setattr(PLACE, "after", lambda step: None)
    base = loaded()
    # the last table staged; complete; between a deletion and its renaming, early and late; some moved; numbers written
    late = len(steps) - 1 - steps[::-1].index("deleted")
    for n in (i + 1 for i in (2, steps.index("complete"), steps.index("deleted"), late, steps.index("dropped"), steps.index("numbers"))):
        root = tempfile.mkdtemp(prefix="place-")
        shutil.copytree(base, root, dirs_exist_ok=True)
        stop_at(monkeypatch, n)
        with pytest.raises(Stop):
            jobs.curate_in_place(spark, second, f"{root}/final", stamp=T.AS_OF, tsunami_dir=f"{root}/tsunami")
        monkeypatch.setattr(PLACE, "after", lambda step: None)
        jobs.curate_in_place(spark, second, f"{root}/final", stamp=T.AS_OF, tsunami_dir=f"{root}/tsunami")
        assert (rows_of(spark, f"{root}/final"), rows_of(spark, f"{root}/tsunami")) == want, steps[n - 1]
        assert not os.path.exists(f"{root}/final/_redo")


def test_a_stop_between_ingest_and_curate_is_caught_up(spark, monkeypatch):
    for n in (9, 16):
        root = tempfile.mkdtemp(prefix="place-")
        raw, final, tsu = (f"{root}/{t}" for t in ("raw", "final", "tsunami"))

        def both(rows):
            jobs.ingest_in_place(spark, raw_rows(spark, rows), raw, stamp=T.AS_OF, buckets=2)
            return jobs.curate_pending(spark, raw, final, tsu, stamp=T.AS_OF, buckets=2)

        both(FIRST)
        stop_at(monkeypatch, n)
        try:
            both(SECOND)
        except Stop:
            pass
        monkeypatch.setattr(PLACE, "after", lambda step: None)
        both([("z", 1, 1, 0, 1)])  # not the batch that was stopped: what it had loaded is curated, what it had not is loaded with a replay
        both(SECOND)
        got = {r["usgs_id"]: r for r in spark.read.parquet(final).collect()}
        assert set(got) == {"a", "b", "c", "d", "e", "f", "z"} and len({r["id"] for r in got.values()}) == 7
        assert got["a"]["mag"] == 9 and got["d"]["mag"] == 4 and got["c"]["event_date"] == dt.date(2024, 1, 4)
        assert PLACE.folders(spark, f"{raw}/_state/pending") == []
        assert rows_of(spark, tsu, TSUNAMI_COLUMNS) == sorted(map(tuple, U.refresh_tsunami(spark.read.parquet(final)).collect()), key=repr)


def stamps(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/*/event_date=*/*.parquet")}


def test_a_batch_of_one_event_touches_its_own_files_alone(spark):
    root = tempfile.mkdtemp(prefix="place-")
    raw, final, tsu = (f"{root}/{t}" for t in ("raw", "final", "tsunami"))
    jobs.ingest_in_place(spark, raw_rows(spark, [(f"k{i}", i % 20, 1, i % 2, 1) for i in range(400)]), raw, stamp=T.AS_OF)
    assert jobs.curate_pending(spark, raw, final, tsu, stamp=T.AS_OF)["mode"] == "full"
    before = stamps(root)
    index = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/*/_state/keys/*/*.parquet")}
    ing = jobs.ingest_in_place(spark, raw_rows(spark, [("k7", 7, 9, 1, 5)]), raw, stamp=T.AS_OF)
    cur = jobs.curate_pending(spark, raw, final, tsu, stamp=T.AS_OF)
    assert ing["events"] == 1 and ing["dates"] == cur["dates"] == [dt.date(2024, 1, 8)]
    assert (cur["mode"], cur["read"], cur["transformed"], cur["loaded"]) == ("incremental", 1, 1, 1)
    changed = {f for f, t in before.items() if stamps(root).get(f) != t}
    assert len(changed) == 3 and all("event_date=2024-01-08" in f for f in changed)
    now = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/*/_state/keys/*/*.parquet")}
    assert sum(now.get(f) != t for f, t in index.items()) == 1  # the raw index keeps its date, the curated one has a new version
    assert [r["mag"] for r in spark.read.parquet(tsu).filter("usgs_id = 'k7'").collect()] == [5]
    # nothing waits: nothing is read or written
    still = stamps(root)
    assert jobs.curate_pending(spark, raw, final, tsu, stamp=T.AS_OF)["read"] == 0 and stamps(root) == still


def test_index_reads_only_the_folders_of_the_keys(spark):
    root = tempfile.mkdtemp(prefix="place-")
    jobs.curate_in_place(spark, raw_rows(spark, [(f"k{i}", i % 5, 1, 0, 1) for i in range(300)]), root, stamp=T.AS_OF, buckets=64)
    keys = spark.createDataFrame([("k5",), ("nobody",)], "usgs_id string")
    rows = PLACE.index_rows(spark, root, jobs._FINAL_KEYS, keys, "usgs_id", 64)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    found = rows.collect()
    assert "k5" in {r["usgs_id"] for r in found} and len(found) < 40


def test_random_batches_equal_a_full_refresh(spark):
    rng = random.Random(2)
    root = tempfile.mkdtemp(prefix="place-")
    raw, final, tsu = (f"{root}/{t}" for t in ("raw", "final", "tsunami"))
    newest, ids = {}, {}
    for _ in range(2):
        batch = {k: (k, rng.choice([None, 0, 1, 2, 3]), rng.randrange(50), rng.choice([0, 1, None]), rng.randrange(9)) for k in rng.sample([f"k{i}" for i in range(25)], 9)}
        jobs.ingest_in_place(spark, raw_rows(spark, batch.values()), raw, stamp=T.AS_OF, buckets=4)
        jobs.curate_pending(spark, raw, final, tsu, stamp=T.AS_OF, buckets=4)
        for k, r in batch.items():
            if k not in newest or r[2] > newest[k][2]:
                newest[k] = r
        got = {r["usgs_id"]: r for r in spark.read.parquet(final).collect()}
        assert {k: (r["mag"], r["tsunami"], r["time"]) for k, r in got.items()} == {
            k: (r[4], r[3] or 0, None if r[1] is None else DAY + dt.timedelta(days=r[1])) for k, r in newest.items()}
        assert spark.read.parquet(final).count() == len(newest) == spark.read.parquet(raw).count()
        for k, r in got.items():
            assert ids.setdefault(k, r["id"]) == r["id"]
        assert len(set(ids.values())) == len(ids)
        assert rows_of(spark, tsu, TSUNAMI_COLUMNS) == sorted(map(tuple, U.refresh_tsunami(spark.read.parquet(final)).collect()), key=repr)
    everything = spark.read.parquet(raw).select(*CURATE_INPUT_COLUMNS)
    assert jobs.curate_pending(spark, raw, final, tsu, full=True, stamp=T.AS_OF)["read"] == everything.count()


def test_a_table_without_index_is_adopted(spark):
    root = tempfile.mkdtemp(prefix="place-")
    jobs.curate_in_place(spark, raw_rows(spark, FIRST), root, stamp=T.AS_OF)
    bare = tempfile.mkdtemp(prefix="bare-")
    spark.read.parquet(root).write.mode("overwrite").partitionBy("event_date").parquet(bare)
    for home in (root, bare):
        jobs.curate_in_place(spark, raw_rows(spark, SECOND), home, stamp=T.AS_OF)
    assert rows_of(spark, root) == rows_of(spark, bare)


def test_stream_in_place_and_a_restart(spark):
    src, root = tempfile.mkdtemp(prefix="landed-"), tempfile.mkdtemp(prefix="tables-")

    def run():
        stream_feed(spark, src, root, stamp=T.AS_OF, in_place=True).awaitTermination()
        return {r["usgs_id"]: r for r in spark.read.parquet(f"{root}/final").collect()}

    land(src, "z_old.json", [feature("a", 1.0, MS + 1), feature("t", 1.0, MS, tsunami=1)], 1_700_000_000)
    land(src, "a_new.json", [feature("a", 2.0, MS + 2)], 1_700_000_100)
    first = run()
    assert first["a"]["mag"] == Decimal("2.00") and len(first) == 2
    land(src, "later.json", [feature("b", 3.0, MS), feature("a", 2.5, MS + 3)], 1_700_000_200)
    second = run()
    assert len(second) == 3 and second["a"]["mag"] == Decimal("2.50") and second["a"]["id"] == first["a"]["id"]
    assert [r["usgs_id"] for r in spark.read.parquet(f"{root}/tsunami").collect()] == ["t"]


def test_a_folder_that_cannot_move_is_an_error(spark):
    with pytest.raises(Exception, match="does not exist|renamed"):
        PLACE._rename(spark, f"{tempfile.mkdtemp()}/nothing", f"{tempfile.mkdtemp()}/x")
