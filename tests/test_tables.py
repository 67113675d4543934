"""Sources, sinks and upserts."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairwait import operators as op
from fairwait import sinks, sources
from fairwait.schemas import RAW_REQUESTS


def test_request_records(spark, tmp_path):
    path = tmp_path / "batch.json"
    records = [
        {"unique_key": "1", "latitude": "40.7", "longitude": -73.9, "created_date": "2024-01-01T10:00:00.000"},
        {"unique_key": "2", "latitude": "not a number", "location": {"type": "Point"}, "borough": "QUEENS"},
    ]
    path.write_text("\n".join(json.dumps(r) for r in records))
    df = sources.read_request_records(spark, str(path), datetime(2024, 1, 2, 3, 4))
    assert df.columns == RAW_REQUESTS.names and [f.dataType for f in df.schema] == [f.dataType for f in RAW_REQUESTS]
    one, two = df.orderBy("unique_key").collect()
    assert (one["latitude"], one["longitude"], one["created_date"]) == (40.7, -73.9, "2024-01-01T10:00:00.000")
    assert (two["latitude"], two["borough"], two["tract_geoid"]) == (None, "QUEENS", None)
    assert one["ingestion_timestamp"] == datetime(2024, 1, 2, 3, 4)


def test_malformed_record_fails(spark, tmp_path):
    path = tmp_path / "batch.json"
    path.write_text('{"unique_key": "1"}\n{"unique_key": ')
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_request_records(spark, str(path)).collect()


def test_month_keeps_the_last_second(spark, rows):
    data = [(1, datetime(2024, 12, 31, 23, 59, 59, 500_000)), (2, datetime(2025, 1, 1)), (3, datetime(2024, 12, 1))]
    df = spark.createDataFrame(data, "id int, ts timestamp_ntz")
    assert rows(sources.scan_month(df, "ts", 2024, 12), "id") == [(1,), (3,)]


def test_scan_since_reaches_the_reader(spark, tmp_path):
    spark.range(10).select("id", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz").alias("ts")).write.parquet(str(tmp_path / "t"))
    df = sources.scan_since(spark.read.parquet(str(tmp_path / "t")), "ts", datetime(2024, 1, 5))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 10


def test_month_spine(spark):
    got = [r["month"] for r in sources.month_spine(spark, "2023-11-15", "2024-02-01").collect()]
    assert got == [datetime(2023, 11, 1), datetime(2023, 12, 1), datetime(2024, 1, 1), datetime(2024, 2, 1)]


def test_crosswalk(spark, rows):
    df = spark.createDataFrame([("1", "A"), ("1", "A"), (None, "B"), ("2", None)], "geoid string, ntaname string")
    assert rows(sources.read_crosswalk(df)) == [("1", "A")]


def test_partition_overwrite_is_idempotent(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, p string")
    assert sinks.write_partition(df, path, "p") == 3
    assert sinks.write_partition(df.filter("p = 'b'"), path, "p") == 2
    assert rows(spark.read.parquet(path), "id", "p") == [(1, "a"), (2, "b"), (3, "b")]


def test_ensure_append_and_new_columns(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    schema = T.StructType([T.StructField("A", T.StringType()), T.StructField("b", T.DoubleType())])
    assert sinks.ensure_table(spark, path, schema)
    assert spark.read.parquet(path).columns == ["A", "b"]
    more = spark.createDataFrame([(7, "x", "extra")], "B int, a string, c string")
    with pytest.raises(ValueError, match="c"):
        sinks.append_raw(more, path)
    loaded = sinks.append_raw(more, path, extra="drop")
    assert loaded == 1 and not sinks.ensure_table(spark, path, schema)
    assert rows(spark.read.parquet(path)) == [("x", 7.0)]
    sinks.append_raw(more, path, extra="widen")
    assert rows(sinks.read_or_none(spark, path, True), "a", "b", "c") == [("x", 7.0, "extra"), ("x", 7.0, None)]


def test_snapshots_switch_as_a_whole(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, path)
    for n in (3, 2, 1):
        sinks.replace_table(spark.range(n).withColumn("n", F.lit(n)), path)
    assert sinks.read_snapshot(spark, path).count() == 1
    reader = spark.read.parquet(f"{path}/v=1")
    assert reader.count() == 3  # older versions stay until they are expired
    assert sinks.expire_versions(spark, path) == [1]
    # A version without its completion mark is not seen.
    spark.range(9).withColumn("n", F.lit(9)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/v=4")
    assert sinks.read_snapshot(spark, path).count() == 1


V = "k string, updated string, v string, month string"


def versions(spark, data):
    return spark.createDataFrame(data, V)


def test_upsert_replaces_and_inserts(spark, rows):
    target = versions(spark, [("1", "b", "old", "m"), ("2", "b", "keep", "m")])
    updates = versions(spark, [("1", "a", "new", "m"), ("3", "a", "add", "m")]).withColumn("extra", F.lit("e"))
    merged = op.upsert_latest(target, updates, ["k"])
    assert rows(merged, "k", "v", "extra") == [("1", "new", "e"), ("2", "keep", None), ("3", "add", "e")]
    assert rows(op.upsert_latest(merged, updates, ["k"]), "k", "v", "extra") == rows(merged, "k", "v", "extra")


def test_upsert_by_order(spark, rows):
    target = versions(spark, [("1", "b", "newer", "m"), ("2", "b", "same age", "m")])
    updates = versions(spark, [("1", "a", "late", "m"), ("2", "b", "wins", "m")])
    assert rows(op.upsert_latest(target, updates, ["k"], ["updated"]), "k", "v") == [("1", "newer"), ("2", "wins")]


def test_upsert_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")

    def upsert(data, batch, **more):
        return sinks.upsert_table(versions(spark, data), path, ["k"], ["updated"], "month", batch, **more)

    def now():
        return rows(sinks.read_or_none(spark, path).select("k", "v", F.col("month").cast("string")))

    assert upsert([("1", "a", "x", "2024-01"), ("2", "a", "y", "2024-02"), ("9", "a", "n", None)], 1)
    # One key moves to another month and empties its old one; a new version and an older one.
    assert upsert([("1", "b", "moved", "2024-03"), ("9", "b", "null month", None), ("9", "0", "older", None)], 2)
    expected = [("1", "moved", "2024-03"), ("2", "y", "2024-02"), ("9", "null month", None)]
    assert now() == expected
    # The second version holds the partitions it replaced, and no others.
    assert {p.name for p in (tmp_path / "t" / "table_version=2").glob("month=*")} == {"month=2024-03", "month=__HIVE_DEFAULT_PARTITION__"}
    # The same batch again is skipped, the same rows in a new batch change nothing.
    assert not upsert([("1", "z", "ignored", "2024-03")], 2)
    assert upsert([("1", "b", "moved", "2024-03")], 3, stable_partition=True)
    assert now() == expected


UPSERT = (["k"], ["updated"], "month")


@pytest.mark.parametrize("broken", ["_folders", "write_text", "_path"])
def test_a_batch_that_fails_leaves_the_table_as_it_was(spark, tmp_path, rows, monkeypatch, broken):
    from fairwait.sinks import tables

    path = str(tmp_path / "t")
    tables.upsert_table(versions(spark, [("1", "a", "x", "m"), ("4", "a", "x", "m4")]), path, *UPSERT, 1)
    second, plain = versions(spark, [("1", "b", "moved", "m2")]), getattr(tables, broken)

    def failing(session, name, *args):
        # After the write of the version: at the listing of its folders, at the commit or at its last step.
        if "table_version=2" in name or name.endswith(".part"):
            raise RuntimeError("driver lost")
        return plain(session, name, *args)

    with monkeypatch.context() as m:
        m.setattr(tables, broken, failing)
        with pytest.raises(RuntimeError):
            tables.upsert_table(second, path, *UPSERT, 2)
    assert rows(sinks.read_or_none(spark, path), "k", "v") == [("1", "x"), ("4", "x")] and not tables.committed(spark, path, 2)
    # Another batch comes first, then the same again, which counts once.
    assert tables.upsert_table(versions(spark, [("3", "a", "z", "m")]), path, *UPSERT, 3) == ["m"]
    assert tables.upsert_table(second, path, *UPSERT, 2) == ["m", "m2"]
    assert tables.upsert_table(second, path, *UPSERT, 2) is None
    assert rows(sinks.read_or_none(spark, path), "k", "v") == [("1", "moved"), ("3", "z"), ("4", "x")]
    assert tables.batches(spark, path) == ["1", "3", "2"]


def test_rows_of_a_merge_move_once(spark, tmp_path, monkeypatch):
    from fairwait.sinks import tables

    path, plans, plain = str(tmp_path / "t"), [], tables.replace_partitions

    def seen(df, *args, **more):
        plans.append((df._jdf.queryExecution().executedPlan().toString(), more))
        return plain(df, *args, **more)

    monkeypatch.setattr(tables, "replace_partitions", seen)
    tables.upsert_table(versions(spark, [("1", "a", "x", "m"), ("4", "a", "x", "m4")]), path, *UPSERT, 1)
    assert not (tmp_path / "t" / "_updates").exists()
    tables.upsert_table(versions(spark, [("1", "b", "y", "m")]), path, *UPSERT, 2)
    for plan, more in plans:
        assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1 and more["placed"]


def test_stored_updates_are_read_where_they_are(spark, tmp_path, rows, monkeypatch):
    """Not landed again, and dealt out by sizes of partitions: no look at whole rows before they move. The table is the same as without."""
    import random

    from fairwait.sinks import tables

    rng, plain, plans = random.Random(5), tables.replace_partitions, {}
    monkeypatch.setattr(tables, "FEW_ROWS", 20)  # so that several tasks take part

    def seen(df, path, *args, **more):
        plans.setdefault(path, []).append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, path, *args, **more)

    monkeypatch.setattr(tables, "replace_partitions", seen)
    paths = {kept: str(tmp_path / f"kept-{kept}") for kept in (False, True)}
    for batch, months in enumerate([["m1", "m2", "m3", None], ["m2", "m4"], ["m1", "m2", "m3", "m4", None]]):
        # Keys move from month to month, some have none, and equal update times are settled by the value.
        data = [(rng.choice([None, *map(str, range(60))]), rng.choice([None, "a", "b", f"c{batch}"]), f"v{n}", rng.choice(months)) for n in range(200)]
        versions(spark, data).write.parquet(f"{tmp_path}/u{batch}")
        updates, found = spark.read.parquet(f"{tmp_path}/u{batch}"), {}
        for kept, path in paths.items():
            found[kept] = sorted(tables.upsert_table(updates, path, *UPSERT, batch, ["v"], high_water="updated", stored=kept))
        now = [rows(sinks.read_or_none(spark, path), "k", "updated", "v", "month") for path in paths.values()]
        assert now[0] == now[1] and len(now[1]) == len({r[0] for r in now[1]})
        assert found[False] == found[True] and sinks.high_water_mark(spark, paths[True]) == sinks.high_water_mark(spark, paths[False]) == f"c{batch}"
    assert not (tmp_path / "kept-True" / "_updates").exists()
    for plan in plans[paths[True]]:
        moves = [x for x in plan.splitlines() if "Exchange" in x and "BroadcastExchange" not in x]
        assert len(moves) == 1 and "shufflepartitionidpassthrough" in moves[0] and "rangepartitioning" not in plan


def test_sizes_of_partitions_deal_rows_evenly(spark, monkeypatch):
    from fairwait.sinks import tables

    monkeypatch.setattr(tables, "FEW_ROWS", 250)
    df = spark.range(4000).select("id", F.when(F.col("id") < 3000, "big").when(F.col("id") % 2 == 0, F.concat(F.lit("s"), F.col("id") % 10)).alias("part"))
    sizes, newest = tables.partition_sizes(df, "part", "id")
    assert sizes["big"] == 3000 and sizes["__HIVE_DEFAULT_PARTITION__"] == 500 and len(sizes) == 7 and newest == "3999"
    dealt = tables._dealt(df.unionByName(df), F.col("part"), ["id"], {p: 2 * n for p, n in sizes.items()})
    per = dealt.withColumn("task", F.spark_partition_id()).groupBy("_place").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("task").alias("where")).collect()
    assert dealt.rdd.getNumPartitions() == len(per) == 4 and all(r["where"] == 1 and 1700 < r["n"] < 2300 for r in per)
    # A key's rows of one partition come to one task, also where the sizes say nothing of it.
    for given in (sizes, {"big": 10}):
        spread = tables._dealt(df.unionByName(df), F.col("part"), ["id"], given).groupBy("id").agg(F.countDistinct("_place").alias("n"))
        assert spread.filter("n > 1").count() == 0 and spread.count() == 4000


def test_only_partitions_without_updates_are_searched_for_moved_keys(spark):
    from fairwait.sinks.tables import _concerned

    assert _concerned(None, {"m1": 1}, None, ["m1", "m2"], ["k"], "month") == ["m1", "m2"]  # none: nothing is read
    table = versions(spark, [("1", "a", "x", "m1"), ("2", "a", "x", "m2"), ("3", "a", "x", None), ("4", "a", "x", "m4")])
    fresh = versions(spark, [("1", "b", "x", "m1"), ("2", "b", "x", "m1"), ("3", "b", "x", "m1"), (None, "b", "x", "m1")])
    held = {"m1": 1, "m2": 1, "__HIVE_DEFAULT_PARTITION__": 1, "m4": 1}
    assert sorted(_concerned(table, held, fresh, ["m1"], ["k"], "month")) == ["__HIVE_DEFAULT_PARTITION__", "m1", "m2"]


@pytest.mark.parametrize("text", [
    "2024-01-05T23:30:00-05:00", "2024-01-05T23:30:00+0900", "2024-01-05 23:30:00.123Z", "2024-01-05T23:30:00+09", "2024-01-05T23:30:00-05:00\n",
    "2024-01-05T23:30:00-05:00\r\n", "2024-01-05", "2024-01-05T23:30:00.000", "5 Z", "-05:00", "Z", "", None,
])
def test_zones_at_the_end_are_found(spark, text):
    from fairwait.operators.upsert import instant

    df = spark.createDataFrame([(text,)], "u string")
    c = F.col("u")
    there = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.try_cast("timestamp").cast("timestamp_ntz"))
    whole = F.when(c.rlike(r"[0-9][T ].*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"), there).otherwise(c.try_cast("timestamp_ntz"))
    one, other = df.select(instant(df, "u"), whole).first()
    assert one == other


def test_versions_of_a_key_in_several_partitions(spark, tmp_path, rows):
    """What is told by ranges of partition and key alone is told by key then, in the first batch and in a merge; ties too."""
    path = str(tmp_path / "t")
    first = [("1", "a", "x", "m1"), ("1", "b", "y", "m2"), ("1", "a", "z", "m3"), ("2", "a", "x", "m1"), (None, "a", "n", "m1"), (None, "b", "o", None)]
    tied = versions(spark, [*first, ("3", None, "p", "m1"), ("3", None, "q", "m2")]).withColumn("at", F.length("k"))
    sinks.upsert_table(tied, path, *UPSERT, 1, ["at", "v"], aside=["at"], high_water="updated")
    now = lambda: rows(sinks.read_or_none(spark, path), "k", "updated", "v", "month")
    assert now() == rows(versions(spark, [first[1], first[3], first[5], ("3", None, "q", "m2")]), "k", "updated", "v", "month")
    more = versions(spark, [("2", "b", "x2", "m2"), ("2", "b", "x3", "m9"), ("1", "a", "late", "m8"), ("3", None, "new", "m1")]).withColumn("at", F.lit(1))
    assert sinks.upsert_table(more, path, *UPSERT, 2, ["at", "v"], aside=["at"], high_water="updated") == ["m1", "m2", "m9"]
    assert now() == rows(versions(spark, [first[1], ("2", "b", "x3", "m9"), first[5], ("3", None, "new", "m1")]), "k", "updated", "v", "month")
    assert sinks.high_water_mark(spark, path) == "b" and "at" not in sinks.read_or_none(spark, path).columns


def test_readers_keep_their_version_until_it_expires(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for n in range(5):
        sinks.upsert_table(versions(spark, [("1", str(n), f"x{n}", "m"), (f"k{n}", "a", "y", f"m{n}")]), path, *UPSERT, n, keep=2)
        if n == 3:
            reader = sinks.read_or_none(spark, path)
    assert rows(reader.filter("k = '1'"), "v") == [("x3",)]
    assert rows(sinks.read_or_none(spark, path), "k", "v") == [("1", "x4"), *[(f"k{n}", "y") for n in range(5)]]
    left = sorted(str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").glob("table_version=*/month=m"))
    assert left == [f"table_version={n}/month=m" for n in (3, 4, 5)]
    assert len(list((tmp_path / "t").glob("table_version=*/month=m0"))) == 1  # never replaced, so still where it was written


def test_only_the_folders_of_the_state_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        sinks.upsert_table(versions(spark, [("1", str(n), "x", "m"), (str(n + 5), "a", "y", f"m{n}")]), path, *UPSERT, n, keep=9)
    df = sinks.read_or_none(spark, path)
    scan = next(x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [" in scan and "table_version" in scan.split("PartitionFilters")[1] and "DataFilters: []" in scan
    assert df.filter("month = 'm'").select(F.input_file_name().alias("f")).distinct().count() == 1  # one folder is opened


def test_whole_tables_and_partitions_are_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.replace_partitions(versions(spark, [("1", "a", "x", "m1"), ("2", "a", "x", "m2"), ("3", "a", "x", None)]), path, "month", "a")
    assert sinks.replace_partitions(versions(spark, [("4", "a", "x", "m2")]), path, "month", "b", ["m1", "m2"]) == ["m1", "m2"]
    assert rows(sinks.read_or_none(spark, path), "k") == [("3",), ("4",)]
    assert sinks.replace_partitions(versions(spark, []), path, "month", "c") == ["__HIVE_DEFAULT_PARTITION__", "m2"]
    assert sinks.read_or_none(spark, path).count() == 0 and sinks.read_or_none(spark, path).columns == ["k", "updated", "v", "month"]
    sinks.replace_partitions(spark.sql("SELECT 1 AS n, timestamp_ntz'2024-01-01 10:20:00' AS at UNION ALL SELECT 2, timestamp_ntz'2024-01-02'"), str(tmp_path / "u"), "at", "a")
    got = sinks.read_or_none(spark, str(tmp_path / "u"))
    assert dict(got.dtypes)["at"] == "timestamp_ntz" and got.filter("at < '2024-01-02'").collect()[0]["n"] == 1
    with pytest.raises(ValueError, match="table_version"):
        sinks.replace_partitions(spark.range(1).withColumn("table_version", F.lit(1)), path, "id", "d")


def test_high_water_mark_and_schema_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, updated in enumerate(["b", "c", "a"]):
        more = versions(spark, [(str(batch), updated, "x", "m")])
        sinks.upsert_table(more.withColumn("extra", F.lit(1)) if batch == 1 else more, path, *UPSERT, batch, high_water="updated")
    assert sinks.high_water_mark(spark, path) == "c"
    assert sinks.read_or_none(spark, path).columns == ["k", "updated", "v", "extra", "month"]
    assert sinks.read_or_none(spark, path).filter("extra IS NULL").count() == 2


def test_incremental_model_rewrites_only_its_partitions(spark, tmp_path, rows):
    for data in ([("1", "a", "x", "m1"), ("2", "a", "y", "m2")], [("1", "b", "new", "m1")]):
        df = sinks.materialise(versions(spark, data), "t", "incremental", str(tmp_path), ["k"], ["updated"], part_col="month")
    assert rows(df, "k", "v") == [("1", "new"), ("2", "y")]
    assert [p.name for p in (tmp_path / "t" / "table_version=2").glob("month=*")] == ["month=m1"]


def test_watermark(spark):
    now = datetime(2024, 5, 3, 12)
    empty = spark.createDataFrame([], "u string")
    assert op.get_watermark(None, "u", 48, now) == datetime(2024, 5, 1, 12)
    assert op.get_watermark(empty, "u", 48, now) == datetime(2024, 5, 1, 12)
    iso = spark.createDataFrame([("2024-01-05T10:00:00Z",), ("2024-01-04T00:00:00.000",), (None,)], "u string")
    assert op.get_watermark(iso, "u") == datetime(2024, 1, 3, 10)
    zoned = spark.createDataFrame([("2024-01-05T23:30:00-05:00",), ("2024-01-06T01:00:00",), ("2024-01-06T03:00:00+09:00",)], "u string")
    assert op.get_watermark(zoned, "u") == datetime(2024, 1, 4, 4, 30)


def test_incremental_filter(spark, rows):
    data = [(1, datetime(2024, 1, 10)), (2, datetime(2024, 1, 8)), (3, datetime(2024, 1, 7, 23)), (4, None)]
    src = spark.createDataFrame(data, "id int, updated_at timestamp_ntz")
    target = src.filter("id = 1")
    assert rows(op.incremental_filter(src, target), "id") == [(1,), (2,)]
    assert rows(op.incremental_filter(src, target, include_null=True), "id") == [(1,), (2,), (4,)]
    assert op.incremental_filter(src, src.filter("false")).count() == 4  # empty target: full build
    assert op.incremental_filter(src, None).count() == 4


def test_stream_survives_a_restart(spark, tmp_path, rows):
    from fairwait.streaming import stream_upsert

    landing, path, log = (str(tmp_path / n) for n in ("landing", "table", "log"))

    def run():
        stream = spark.readStream.schema(V).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_upsert(stream, path, ["k"], ["updated"], "month", log).awaitTermination()
        return rows(sinks.read_or_none(spark, path), "k", "v")

    versions(spark, [("1", "a", "x", "m1"), ("2", "a", "y", "m1")]).coalesce(1).write.parquet(landing)
    assert run() == [("1", "x"), ("2", "y")]
    assert run() == [("1", "x"), ("2", "y")]  # nothing new
    versions(spark, [("1", "b", "x2", "m1"), ("3", "a", "z", "m2")]).coalesce(1).write.mode("append").parquet(landing)
    versions(spark, [("1", "0", "stale", "m1")]).coalesce(1).write.mode("append").parquet(landing)
    assert run() == [("1", "x2"), ("2", "y"), ("3", "z")]


def test_streams_with_logs_of_their_own_share_a_table(spark, tmp_path, rows):
    from fairwait.streaming import stream_upsert

    path = str(tmp_path / "table")
    for n, data in enumerate([[("1", "a", "x", "m")], [("2", "a", "y", "m")], [("1", "b", "x2", "m")]]):
        landing = str(tmp_path / f"landing{n}")
        versions(spark, data).write.parquet(landing)
        stream = spark.readStream.schema(V).parquet(landing)
        stream_upsert(stream, path, *UPSERT, str(tmp_path / f"log{n}")).awaitTermination()
    assert rows(sinks.read_or_none(spark, path), "k", "v") == [("1", "x2"), ("2", "y")]


def test_checks_of_changed_partitions_equal_full_ones(spark, tmp_path):
    import random

    from fairwait.operators import quality as qc
    from fairwait.plans.check_state import run_checkpoint_changed
    from fairwait.plans.suites import run_checkpoint
    from fairwait.sinks.tables import partitions, read_or_none, replace_partitions

    rng = random.Random(3)
    suite = {"t": [
        qc.check_not_null("v"), qc.check_unique("k"), qc.check_unique("k2"), qc.check_unique_combination(["k", "v"]), qc.check_unique_combination(["k", "m"]),
        qc.check_accepted_range("v", 0, 5, "warn"), qc.check_row_count(3), qc.check_columns_present(["k", "zz"]), qc.check_column_type("v", "bigint"),
    ]}
    schema = "k bigint, k2 string, v bigint, m date"
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    months = [None, *[datetime(2024, n, 1).date() for n in (1, 2, 3, 4)]]

    def rows(which):
        return [(rng.choice([None, *range(40)]), f"u{rng.random()}" if rng.random() < 0.97 else "twice", rng.choice([None, 1, 4, 9]), m) for m in which for _ in range(6)]

    def same(at):
        order = ["check_name", "column_name"]
        full = run_checkpoint(read_or_none(spark, path), "t", None, at, suite).orderBy(order).collect()
        return run_checkpoint_changed(spark, path, "m", state, "t", None, at, suite).orderBy(order).collect() == full

    at = datetime(2024, 1, 1)
    replace_partitions(spark.createDataFrame(rows(months), schema), path, "m", "0")
    assert same(at)
    for n in range(1, 5):
        # One month anew (with keys of others), one without rows from now on in the third round, nothing in the last but one.
        if n != 3:
            replace_partitions(spark.createDataFrame(rows([rng.choice(months)]), schema), path, "m", str(n), ["2024-02-01"] if n == 2 else [])
        assert same(at), n
    # Only the changed partition is opened for counts: the others' files can be unreadable to a suite without keys across partitions.
    flat = {"t": [qc.check_not_null("v"), qc.check_unique_combination(["k", "m"])]}
    run_checkpoint_changed(spark, path, "m", state, "t", None, at, flat).collect()
    replace_partitions(spark.createDataFrame(rows(months[4:]), schema), path, "m", "9")
    expected = run_checkpoint(read_or_none(spark, path), "t", None, at, flat).collect()
    version = partitions(spark, path)[0]
    for folder in tmp_path.glob("t/*=*"):
        if not folder.name.endswith(f"={version}"):
            for file in folder.rglob("*.parquet"):
                file.write_bytes(b"broken")
    got = run_checkpoint_changed(spark, path, "m", state, "t", None, at, flat).collect()
    assert sorted(got) == sorted(expected)


def test_derived_columns_are_not_moved(spark, tmp_path, rows, monkeypatch):
    """They are worked out where the rows arrive, and rows of a key that changed its partition get them too."""
    from fairwait.sinks import tables

    derived = {"month": F.substring("day", 1, 7), "hours": F.length("v") * 2}
    write, moved = tables.replace_partitions, []
    monkeypatch.setattr(tables, "replace_partitions", lambda df, *args, **more: moved.append(df) or write(df, *args, **more))

    def merge(data, batch):
        df = spark.createDataFrame(data, "k string, updated string, day string, v string").withColumns(derived)
        tables.upsert_table(df, path, ["k"], ["updated"], "month", batch, ["v"], derived=derived)
        return tables.read_or_none(spark, path)

    path = str(tmp_path / "t")
    merge([("1", "a", "2024-01-05", "x"), ("1", "b", "2024-01-06", "xy"), ("2", "a", "2024-01-07", "x"), ("3", "a", None, "x")], 1)
    got = merge([("2", "b", "2024-02-01", "xyz"), ("3", "b", None, "xy"), ("4", "a", "2024-02-02", None)], 2)
    assert got.columns == ["k", "updated", "day", "v", "hours", "month"]
    assert rows(got, "k", "updated", "month", "hours") == sorted(
        [("1", "b", "2024-01", 4), ("2", "b", "2024-02", 6), ("3", "b", None, 4), ("4", "a", "2024-02", None)], key=repr
    )
    for df in moved:
        plan = df._jdf.queryExecution()
        below = plan.optimizedPlan().toString().split("RepartitionByExpression")[1].split("\n", 1)
        assert "hours#" not in below[1].split("Relation")[0].split("LogicalRDD")[0]
        assert plan.executedPlan().toString().count("Exchange") == 1
    assert list(tmp_path.glob("t/table_version=2/month=2024-02/*.zstd.parquet"))
