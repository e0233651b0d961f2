import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from adcube.config import EngineConfig
from adcube.plans.incremental import run_report, run_staging
from adcube.plans.reports import report
from adcube.plans.staging import staging_campaign
from adcube.sinks.table import max_date, merge_by_key, publish, read_table, upsert_by_key, write_table
from adcube.sources import testdata

SF = "/root/testdata/sf0.001"


def test_merge_strict_null_keys(spark):
    target = spark.createDataFrame([("k1", 1), ("k2", 2), (None, 9)], "unique_key string, v long")
    batch = spark.createDataFrame([("k2", 20), ("k3", 30), (None, 9)], "unique_key string, v long")
    got = sorted(merge_by_key(target, batch, ["unique_key"]).collect(), key=lambda r: (r[0] or "", r[1]))
    assert [tuple(r) for r in got] == [(None, 9), (None, 9), ("k1", 1), ("k2", 20), ("k3", 30)]


def test_schema_policies(spark):
    target = spark.createDataFrame([("k1", 1, 5), ("k2", 2, 6)], "unique_key string, v long, h long")
    batch = spark.createDataFrame([("k2", 20, 7)], "unique_key string, v long, g long")
    app = {r.unique_key: r.asDict() for r in merge_by_key(target, batch, ["unique_key"], "append").collect()}
    assert app["k1"]["g"] is None and app["k2"]["h"] is None and app["k2"]["g"] == 7
    syn = merge_by_key(target, batch, ["unique_key"], "sync")
    assert syn.columns == ["unique_key", "v", "g"]


def test_upsert_writes_only_touched_partitions(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = spark.createDataFrame([(d1, "a", 1), (d2, "b", 2)], "date date, unique_key string, v long")
    assert upsert_by_key(spark, first, path, ["unique_key"]) == "created"
    batch = spark.createDataFrame([(d2, "b", 20), (d2, "c", 30)], "date date, unique_key string, v long")
    assert upsert_by_key(spark, batch, path, ["unique_key"]) == "upserted"
    got = sorted((r.unique_key, r.v) for r in read_table(spark, path).collect())
    assert got == [("a", 1), ("b", 20), ("c", 30)]


def test_incremental_staging_matches_full_refresh(spark, tmpdir_path):
    cfg = EngineConfig()
    path = f"{tmpdir_path}/stg"
    first = testdata.ad_sources(spark, SF, max_date="2000-06-30")
    full = testdata.ad_sources(spark, SF)
    assert run_staging(spark, "campaign", first, cfg, path, ()) == "created"  # missing target: full build
    assert run_staging(spark, "campaign", full, cfg, path, ()) == "rewritten"
    got = read_table(spark, path)
    expected = staging_campaign(full, cfg)
    # last_updated is per batch by design; everything else equals a full refresh
    cols = [c for c in expected.columns if c != "last_updated"]
    keyed = lambda df: sorted(tuple(r) for r in df.select(*cols).collect())
    assert keyed(got) == keyed(expected)


def test_empty_staging_target(spark, tmpdir_path):
    path = f"{tmpdir_path}/empty"
    src = testdata.ad_sources(spark, SF)
    staging_campaign(src, EngineConfig()).limit(0).write.parquet(path)
    assert run_staging(spark, "campaign", src, EngineConfig(strict=True), path, ()) == "skipped"  # strict: NULL cut
    assert run_staging(spark, "campaign", src, EngineConfig(), path, ()) == "rewritten"


def test_report_run_appends_and_replaces(spark, tmpdir_path):
    cfg = EngineConfig(strict=False)
    path = f"{tmpdir_path}/rep"
    first = testdata.ad_sources(spark, SF, max_date="2000-06-30")
    second = testdata.ad_sources(spark, SF, max_date="2000-07-31")
    assert run_report(spark, "campaign", first, cfg, path, partition_by=("date_granularity",)) == "created"
    assert run_report(spark, "campaign", second, cfg, path, partition_by=("date_granularity",)) == "upserted"
    from adcube.queries import rounded
    got = rounded(read_table(spark, path))
    full = rounded(report("campaign", second, cfg))
    # exact mode, no source row removed, dimensions unchanged: incremental == full refresh
    rows = lambda df: sorted(tuple(r) for r in df.select(*sorted(full.columns)).collect())
    assert rows(got) == rows(full)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _days(spark, rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), k, v) for d, k, v in rows], "date date, ad_id long, v long")


def test_null_safe_upsert_replaces_rows_without_entity(spark, tmpdir_path):
    path, keys = f"{tmpdir_path}/t", ["date", "ad_id"]
    batch = _days(spark, [(1, None, 1), (1, 7, 2), (2, None, 3)])
    for _ in range(3):
        upsert_by_key(spark, batch, path, keys, null_safe=True)
    assert _rows(read_table(spark, path).select("date", "ad_id", "v")) == _rows(batch)


@pytest.mark.parametrize("stop_after", [0, 1])
def test_interrupted_upsert_is_finished_by_the_next_run(spark, tmpdir_path, monkeypatch, stop_after):
    from adcube.sinks import table
    path = f"{tmpdir_path}/t"
    first = _days(spark, [(1, 1, 1), (2, 1, 2), (2, 2, 3), (3, 9, 9), (1, None, 5)])
    upsert_by_key(spark, first, path, ["date", "ad_id"], null_safe=True)
    batch = _days(spark, [(1, 1, 10), (2, 1, 20)])
    expected = [(dt.date(2024, 1, d), k, v) for d, k, v in [(1, 1, 10), (2, 1, 20), (2, 2, 3), (3, 9, 9), (1, None, 5)]]
    moves = []
    move = table._Store.move

    def stop(self, source, target):
        if "__upsert" in source:
            if len(moves) == stop_after:
                raise RuntimeError("executor gone")
            moves.append(target)
        move(self, source, target)

    monkeypatch.setattr(table._Store, "move", stop)
    with pytest.raises(RuntimeError):
        upsert_by_key(spark, batch, path, ["date", "ad_id"], null_safe=True)
    monkeypatch.setattr(table._Store, "move", move)
    # Kept rows (2, 2), (3, 9) and the one without an id are in no later batch.
    upsert_by_key(spark, batch, path, ["date", "ad_id"], null_safe=True)
    assert _rows(read_table(spark, path).select("date", "ad_id", "v")) == sorted(expected, key=str)
    assert not [n for n in os.listdir(tmpdir_path) if n != "t"]


def test_unfinished_write_beside_the_table_is_dropped(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    first = _days(spark, [(1, 1, 1)])
    write_table(first, path, ("date",))
    _days(spark, [(1, 1, 99)]).write.partitionBy("date").parquet(f"{path}__upsert")
    os.remove(f"{path}__upsert/_SUCCESS")
    assert _rows(read_table(spark, path).select("date", "ad_id", "v")) == _rows(first)
    assert os.path.exists(f"{path}__upsert")  # reading may happen beside a running write
    upsert_by_key(spark, first, path, ["date", "ad_id"])
    assert _rows(read_table(spark, path).select("date", "ad_id", "v")) == _rows(first)
    assert not os.path.exists(f"{path}__upsert")


def test_touched_partitions_get_few_files(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    rows = _days(spark, [(d, k, k) for d in (1, 2, 3) for k in range(400)]).repartition(32)
    write_table(rows, path, ("date",))
    upsert_by_key(spark, rows.where("date > '2024-01-01'").repartition(32), path, ["date", "ad_id"])
    for d in (1, 2, 3):
        files = [f for f in os.listdir(f"{path}/date=2024-01-0{d}") if f.endswith(".parquet")]
        assert len(files) <= 2


def test_partition_type_and_newest_day_without_opening_files(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    rows = spark.createDataFrame([(5, "a", 1), (40, "b", 2)], "day long, k string, v long")
    write_table(rows, path, ("day",))
    assert upsert_by_key(spark, rows, path, ["day", "k"], "sync", ("day",)) == "upserted"  # not "rewritten"
    assert dict(read_table(spark, path).dtypes)["day"] == "bigint"
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                with open(f"{folder}/{n}", "wb"):
                    pass  # a file that cannot be opened
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".crc"):
                os.remove(f"{folder}/{n}")
    assert max_date(spark, path, "day") == 40


def test_unreadable_table_is_not_taken_for_absent(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        upsert_by_key(spark, _days(spark, [(1, 1, 1)]), path, ["date", "ad_id"])
    assert os.path.exists(f"{path}/part-0.parquet")


def test_published_table_has_all_columns(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    write_table(_days(spark, [(1, 1, 1), (2, 1, 2)]), path, ("date",))
    more = _days(spark, [(2, 1, 20)]).withColumn("g", F.lit("new"))
    upsert_by_key(spark, more, path, ["date", "ad_id"])
    publish(spark, path, "adcube_test_db.days")
    found = _rows(spark.table("adcube_test_db.days").select("date", "v", "g"))
    assert found == [(dt.date(2024, 1, 1), 1, None), (dt.date(2024, 1, 2), 20, "new")]
    spark.sql("DROP DATABASE adcube_test_db CASCADE")


def wide(spark, days):
    rows = [(g, dt.date(2024, 1, d), i, f"{g} {d} {i}") for g in ("day", "week", None) for d in range(1, days + 1) for i in (1, 2, None)]
    return spark.createDataFrame(rows, "g string, date date, id long, v string"), rows


def files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def hints(spark, monkeypatch):
    kind, seen = type(spark.range(0)), []
    plain = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *a: (seen.append((name, *a)), plain(self, name, *a))[1])
    return seen


def test_many_rows_of_few_partitions_are_not_shuffled(spark, tmpdir_path, monkeypatch):
    from adcube.sinks import table
    monkeypatch.setattr(table, "LITTLE_BYTES", 0, raising=False)
    path, seen = f"{tmpdir_path}/t", hints(spark, monkeypatch)
    df, rows = wide(spark, 4)
    write_table(df, path, ("g",))
    batch = spark.createDataFrame([("day", dt.date(2024, 1, 1), 1, "new"), (None, dt.date(2024, 1, 2), None, "new")], df.schema)
    assert upsert_by_key(spark, batch, path, ["g", "date", "id"], null_safe=True, partition_by=("g",)) == "upserted"
    assert not seen
    new = {("day", dt.date(2024, 1, 1), 1): "new", (None, dt.date(2024, 1, 2), None): "new"}
    found = read_table(spark, path).select("g", "date", "id", "v").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((*r[:3], new.get(r[:3], r[3]))) for r in rows)
    assert files(path) and all("zstd" in f for f in files(path))
    assert sorted(os.listdir(tmpdir_path)) == ["t"]


@pytest.mark.parametrize("null_safe", [True, False])
def test_merges_shuffle_keys_only(spark, tmpdir_path, null_safe):
    from adcube.session import intermediates
    from adcube.sinks.table import merge_touched
    df, rows = wide(spark, 9)
    write_table(df, f"{tmpdir_path}/t", ("g",))
    write_table(df.where("date > '2024-01-03' and id = 1"), f"{tmpdir_path}/b", ())
    target, batch = read_table(spark, f"{tmpdir_path}/t"), read_table(spark, f"{tmpdir_path}/b")
    with intermediates(spark):
        merged, _ = merge_touched(target, batch, ["date", "id"], "append", null_safe, ("g",), None)
        assert "Exchange hashpartitioning" not in merged._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, merged.select("g", "date", "id", "v").collect())) == sorted(map(str, df.collect()))


def test_many_partitions_are_dealt_in_slices(spark, tmpdir_path, monkeypatch):
    from adcube.sinks import table
    path, seen = f"{tmpdir_path}/t", hints(spark, monkeypatch)
    monkeypatch.setattr(table, "LITTLE_BYTES", 0, raising=False)
    df, rows = wide(spark, 9)
    write_table(df, path, ("g", "date"))
    assert [h[0] for h in seen] == ["rebalance"] * 4
    batch = spark.createDataFrame([(g, dt.date(2024, 1, d), 1, "new") for g in ("day", None) for d in range(1, 10)], df.schema)
    assert upsert_by_key(spark, batch, path, ["g", "date", "id"], null_safe=True, partition_by=("g", "date")) == "upserted"
    found = read_table(spark, path).select("g", "date", "id", "v").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((*r[:3], "new" if r[0] != "week" and r[2] == 1 else r[3])) for r in rows)
    assert sorted(os.listdir(tmpdir_path)) == ["t"]


def test_rows_left_of_a_stopped_write_are_deleted(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    df, rows = wide(spark, 2)
    for side in ("__replace__rows", "__upsert__rows"):
        df.write.parquet(f"{path}{side}")
    write_table(df, path, ("g",))
    assert sorted(os.listdir(tmpdir_path)) == ["t"] and read_table(spark, path).count() == len(rows)
