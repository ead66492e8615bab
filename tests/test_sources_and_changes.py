import gzip
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from velocast.plans.ingest import SCHEMA1, SCHEMA2, transform_trips
from velocast.sources import catalog as A
from velocast.sources import files as AF
from velocast.streaming import changes as J

HEADER1 = ",".join(f'"{c}"' for c in SCHEMA1.fieldNames())
ROWS1 = [
    '"634","1/1/2015 1:30","1/1/2015 1:41","72","W 52 St, 11 Ave","40.76","-73.99","505","6 Ave & W 33 St",'
    '"40.74","-73.98","16247","Customer",\\N,"0"',
    '"1200","12/1/2014 02:04:53","12/1/2014 02:24:53",NULL,"Broadway","40.7","-73.9","\\N","x","40.7",'
    '"-73.9","2","Subscriber","1980","1"',
    '"9","junk time","2014-08-10 15:21:22","3","A","1","2","4","B","3","4","5","Subscriber","1990","2"',
]
HEADER2 = ",".join(SCHEMA2.fieldNames())
ROWS2 = ['ABC123,classic_bike,2021-03-01 08:00:01.345,2021-03-01 08:20:00,"Main St, North",5000.01,'
         'X,6000.02,40.1,-73.1,40.2,-73.2,member']


from conftest import SF001  # noqa: E402


def _tmp():
    return tempfile.mkdtemp(prefix="velocast-test-")


def test_read_csv_gzip_with_both_null_tokens(spark):
    d = _tmp()
    p = os.path.join(d, "201501-citibike-tripdata.csv.gz")
    with gzip.open(p, "wt") as fh:
        fh.write("\n".join([HEADER1, *ROWS1]) + "\n")
    df = AF.read_trips_csv(spark, p, SCHEMA1)
    rows = df.orderBy("TRIPDURATION").collect()
    assert len(rows) == 3
    by = {r["TRIPDURATION"]: r for r in rows}
    assert by["634"]["START_STATION_NAME"] == "W 52 St, 11 Ave"
    assert by["634"]["BIRTH_YEAR"] is None            # \N token
    assert by["1200"]["START_STATION_ID"] is None     # NULL token
    assert by["1200"]["END_STATION_ID"] is None       # quoted \N token


def test_transform_trips_unions_by_name_and_parses(spark):
    d = _tmp()
    p1, p2 = os.path.join(d, "a.csv"), os.path.join(d, "b.csv")
    open(p1, "w").write("\n".join([HEADER1, *ROWS1]) + "\n")
    open(p2, "w").write("\n".join([HEADER2, *ROWS2]) + "\n")
    t = transform_trips(AF.read_trips_csv(spark, p1, SCHEMA1), AF.read_trips_csv(spark, p2, SCHEMA2))
    rows = {r["USERTYPE"] + str(r["START_STATION_ID"]): r for r in t.collect()}
    assert len(t.columns) == 11
    assert rows["Customer72"]["STARTTIME"].isoformat() == "2015-01-01T01:30:00"
    assert rows["Subscriber3"]["STARTTIME"] is None                         # unparsable
    assert rows["Subscriber3"]["STOPTIME"].isoformat() == "2014-08-10T15:21:22"
    m = rows["member5000.01"]
    assert m["START_STATION_NAME"] == "Main St, North" and m["START_STATION_LATITUDE"] == "40.1"
    assert m["STARTTIME"].isoformat() == "2021-03-01T08:00:01.345000"


def test_unpack_zip_first_member(spark):
    d = _tmp()
    for name in ("201306-citibike-tripdata.zip", "201701-citibike-tripdata.csv.zip"):
        with zipfile.ZipFile(os.path.join(d, name), "w") as zf:
            zf.writestr(name.replace(".zip", "").replace(".csv", "") + ".csv",
                        "\n".join([HEADER1, *ROWS1]) + "\n")
            zf.writestr("__MACOSX/ignored.csv", "garbage")
    df = AF.unpack_zip_csv(spark, d, SCHEMA1)
    assert df.count() == 6
    assert df.filter(F.col("BIRTH_YEAR").isNull()).count() == 2
    listing = AF.list_files(spark, d, "*.zip")
    assert sorted(r["NAME"] for r in listing.collect()) == ["201306-citibike-tripdata.zip",
                                                          "201701-citibike-tripdata.csv.zip"]


def test_empty_table_and_append_skip(spark):
    d = _tmp()
    name = "t_empty_" + os.path.basename(d).replace("-", "_")
    AF.empty_table(spark, name, SCHEMA2, os.path.join(d, "tbl"))
    assert spark.table(name).count() == 0 and spark.table(name).columns == SCHEMA2.fieldNames()
    assert AF.append_files_to_raw(spark, [], SCHEMA2, name) == 0


SCHEMA = "K long, V string, ACTION string, ISUPDATE boolean, SEQ long"


def _target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "K long, V string")


def test_merge_golden(spark):
    ch = spark.createDataFrame([
        (1, "a", "DELETE", True, 1), (1, "a2", "INSERT", True, 1),     # update pair, same seq: INSERT wins
        (2, "b", "DELETE", False, 5),                                   # delete
        (3, "c9", "INSERT", False, 1),                                  # matched insert w/o update: ignored
        (4, "d", "INSERT", False, 1), (4, "d2", "INSERT", False, 2),    # duplicate changes: last seq wins
        (5, "e", "DELETE", False, 1),                                   # delete of a missing key: no-op
        (None, "n2", "INSERT", True, 1),                                # null key matches null-safely
    ], SCHEMA)
    out = {r["K"]: r["V"] for r in J.merge_changes(_target(spark), ch, ["K"]).collect()}
    assert out == {1: "a2", 3: "c", 4: "d2", None: "n2"}


def test_a_file_added_from_outside_is_seen(spark, tmp_path):
    import pandas as pd
    from velocast.operators import relational as R
    def put(name, **cols):
        pd.DataFrame(cols).to_parquet(tmp_path / name)
    read = lambda p, s: spark.read.schema(s).parquet(str(tmp_path / p))
    (tmp_path / "w").mkdir(), (tmp_path / "c").mkdir()
    days = spark.createDataFrame([("a",), ("b",)], "DATE string")
    put("w/1.parquet", DATE=["a"], PRECIP=["1"], TEMP=["1"])
    put("c/1.parquet", K=[1], V=["x"], ACTION=["DELETE"], ISUPDATE=[False], SEQ=[1])
    weather = lambda: R.join_inner_weather(days, read("w", "DATE string, PRECIP string, TEMP string")).count()
    merged = lambda: J.merge_changes(_target(spark), read("c", SCHEMA), ["K"]).count()
    assert (weather(), merged()) == (1, 3)
    put("w/2.parquet", DATE=["b"], PRECIP=["1"], TEMP=["1"])
    put("c/2.parquet", K=[9], V=["y"], ACTION=["INSERT"], ISUPDATE=[False], SEQ=[2])
    assert (weather(), merged()) == (2, 4)


def test_equal_states_have_no_changes_with_repeated_and_null_keys(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (None, "n"), (None, "m")], "K long, V string")
    assert J.snapshot_diff(t, t, ["K"]).count() == 0
    more = t.unionByName(spark.createDataFrame([(1, "b")], "K long, V string"))
    assert {r["ACTION"] for r in J.snapshot_diff(t, more, ["K"]).collect()} <= {"INSERT", "DELETE"}
    assert J.snapshot_diff(t, more, ["K"]).count() >= 1


def test_merge_empty_batch_is_identity(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sorted(J.merge_changes(_target(spark), empty, ["K"]).collect(), key=str) == \
        sorted(_target(spark).collect(), key=str)


def test_snapshot_diff_and_roundtrip(spark):
    before = _target(spark)
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (None, "n")], "K long, V string")
    diff = J.snapshot_diff(before, after, ["K"])
    got = sorted((r["K"], r["V"], r["ACTION"], r["ISUPDATE"]) for r in diff.collect())
    assert got == sorted([(2, "b", "DELETE", True), (2, "B", "INSERT", True),
                          (3, "c", "DELETE", False), (4, "d", "INSERT", False)])
    first = J.snapshot_diff(None, before, ["K"])
    assert first.filter(F.col("ACTION") == "INSERT").count() == 4
    # applying the diff to the old state gives the new state
    merged = J.merge_changes(before, diff.withColumn("SEQ", F.when(F.col("ACTION") == "INSERT", 2).otherwise(1)
                                                     .cast("long")), ["K"])
    assert sorted(merged.collect(), key=str) == sorted(after.collect(), key=str)


def _target_table(spark, buckets=8):
    name = "merged_" + os.path.basename(_tmp()).replace("-", "_")
    return J.init_target(_target(spark), name, ["K"], buckets=buckets, path=f"{_tmp()}/target")


def _state(spark, table):
    return {r["K"]: r["V"] for r in J.current_state(spark, table).collect()}


def test_stream_merge_and_replay_idempotent(spark):
    base, target = _tmp(), _target_table(spark)
    changes_dir = f"{base}/changes"
    ch = spark.createDataFrame([(2, "b", "DELETE", False, 1), (7, "g", "INSERT", False, 1),
                                (1, "a", "DELETE", True, 1), (1, "z", "INSERT", True, 2)], SCHEMA)
    ch.repartition(2, "K").write.parquet(changes_dir)
    q = J.stream_merge(spark, changes_dir, ch.schema, target, f"{base}/_cp", max_files_per_trigger=1)
    q.awaitTermination()
    spark.catalog.refreshTable(target)
    final = {1: "z", 3: "c", 7: "g", None: "n"}
    assert _state(spark, target) == final
    sink = J.merge_sink(target)
    sink(ch.filter("false"), 5)                  # empty batch: nothing happens
    sink(ch, 6)                                  # a replayed batch changes nothing
    assert _state(spark, target) == final and J.current_state(spark, target).count() == 4


def test_a_batch_rewrites_only_the_partitions_of_its_keys(spark):
    target = _target_table(spark)
    files = lambda: {r[0] for r in spark.table(target).select(F.input_file_name()).distinct().collect()}
    before = files()
    ch = spark.createDataFrame([(3, "c", "DELETE", True, 1), (3, "cc", "INSERT", True, 2)], SCHEMA)
    touched = J.apply_changes(ch, target)
    assert touched == [r["B"] for r in ch.select(J.bucket_of(["K"], 8).alias("B")).distinct().collect()]
    kept = {f for f in before if f"{J.BUCKET}={touched[0]}/" not in f}
    assert kept and kept <= files() and _state(spark, target)[3] == "cc"


def test_a_partition_without_rows_goes(spark):
    target = _target_table(spark)
    everything = _target(spark).select("K", "V", F.lit("DELETE").alias("ACTION"), F.lit(False).alias("ISUPDATE"), F.lit(1).cast("long").alias("SEQ"))
    J.apply_changes(everything, target)
    assert _state(spark, target) == {}
    J.apply_changes(spark.createDataFrame([(9, "i", "INSERT", False, 1)], SCHEMA), target)
    assert _state(spark, target) == {9: "i"}


def test_diff_of_multisets(spark):
    t = lambda rows: spark.createDataFrame(rows, "K long, V string")
    before, after = t([(1, "a"), (1, "a"), (2, None), (None, "n"), (None, "n")]), t([(1, "a"), (2, "x"), (None, "n"), (None, "m"), (5, None), (5, None)])
    got = sorted(((r["K"], r["V"], r["ACTION"], r["ISUPDATE"]) for r in J.snapshot_diff(before, after, ["K"]).collect()), key=str)
    assert got == sorted([(1, "a", "DELETE", False), (2, None, "DELETE", True), (2, "x", "INSERT", True), (None, "n", "DELETE", True),
                          (None, "m", "INSERT", True), (5, None, "INSERT", False), (5, None, "INSERT", False)], key=str)


def test_catalog_helpers(spark):
    d = _tmp()
    name = "t_cat_" + os.path.basename(d).replace("-", "_")
    df = spark.range(5).withColumn("X", F.col("id") * 2)
    A.write_overwrite(df, name, os.path.join(d, "t"))
    A.tag_lineage(spark, name, {"model_id": "m1"})
    tags = {r["key"]: r["value"] for r in A.read_tags(spark, name).collect()}
    assert tags["model_id"] == "m1"
    assert A.ensure_table(spark, name, lambda: None).count() == 5
    assert [r["NAME"] for r in A.table_schema(df).collect()] == ["id", "X"]
    assert len(A.fetch_bounded(df, 2)) == 2


def test_stage_several_files_per_month_keeps_every_row(spark):
    d = _tmp()
    rows = [(f"{i}", f"2015-0{1 + i % 2}-01 00:00:00", "201501" if i % 2 == 0 else "201701") for i in range(40)]
    df = spark.createDataFrame(rows, "ride_id string, STARTTIME string, _MONTH string")
    # AQE would merge these tiny salted partitions back into one file per month
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = AF.stage_monthly_files(df, "_MONTH", d + "/csv", rows_per_file=5)
        zips = AF.stage_monthly_zips(df, "_MONTH", d + "/zip", rows_per_file=5).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(paths) > 2 and all(p.rsplit("/", 1)[-1][:6] in ("201501", "201701") for p in paths)
    back = spark.read.option("header", True).csv(d + "/csv/*.csv.gz")
    assert back.count() == 40
    names = [r["PATH"].rsplit("/", 1)[-1] for r in zips]
    assert len(names) == len(set(names)) and all(n.endswith(".zip") for n in names)
    assert any(n.startswith("201701") and n.endswith(".csv.zip") for n in names)
    from pyspark.sql import types as T
    st = T.StructType([T.StructField("ride_id", T.StringType()), T.StructField("STARTTIME", T.StringType())])
    assert AF.unpack_zip_csv(spark, d + "/zip", st).count() == 40


def test_snapshot_of_immutable_table_is_zero_copy_and_keeps_its_state(spark):
    d = _tmp()
    src, snap = "t_src_" + os.path.basename(d).replace("-", "_"), "t_snap_" + os.path.basename(d).replace("-", "_")
    A.write_immutable(spark.range(4), src, d + "/src")
    A.snapshot_table(spark, src, snap)
    assert A.table_location(spark, snap) == A.table_location(spark, src)     # no copy
    A.write_immutable(spark.range(10, 12), src, d + "/src")                  # the source moves on
    assert sorted(r["id"] for r in spark.table(snap).collect()) == [0, 1, 2, 3]
    assert sorted(r["id"] for r in spark.table(src).collect()) == [10, 11]
    # a table written in place is copied instead
    A.write_overwrite(spark.range(3), src + "_plain", d + "/plain")
    A.snapshot_table(spark, src + "_plain", snap + "_plain", d + "/plain_snap")
    assert A.table_location(spark, snap + "_plain") != A.table_location(spark, src + "_plain")
    assert spark.table(snap + "_plain").count() == 3


def test_incremental_loads_equal_full_rebuild(spark):
    from velocast.book.flows import _landed
    from velocast.config import RunConfig
    from velocast.plans import ingest as K
    _, landed = _landed(spark, SF001)
    db = "t_inc_" + os.path.basename(_tmp()).replace("-", "_")
    cfg = RunConfig(database=db)
    A.reset_database(spark, db, {cfg.raw("schema1"): K.SCHEMA1, cfg.raw("schema2"): K.SCHEMA2}, _tmp() + "/db")
    K.incremental_elt(spark, cfg, landed.filter(F.col("NAME") < F.lit("2022")))
    A.snapshot_table(spark, f"{db}.TRIPS", f"{db}.TRIPS_first")
    first = spark.table(f"{db}.TRIPS").count()
    K.incremental_elt(spark, cfg, landed.filter(F.col("NAME") >= F.lit("2022")))
    assert K.loads_of(spark, f"{db}.TRIPS")[1] == 2                        # the second load appended
    full = K.transform_trips(spark.table(f"{db}.{cfg.raw('schema1')}"), spark.table(f"{db}.{cfg.raw('schema2')}"))
    assert sorted(spark.table(f"{db}.TRIPS").collect(), key=str) == sorted(full.collect(), key=str)
    assert spark.table(f"{db}.TRIPS_first").count() == first < full.count()   # the snapshot kept its state
    # a load retried before it was published rewrites its own partition only
    storage, last = K.loads_of(spark, f"{db}.TRIPS")
    extra = K.transform_trips(spark.table(f"{db}.{cfg.raw('schema1')}").limit(3),
                              spark.createDataFrame([], K.SCHEMA2))
    K._insert_load(spark, extra, storage, last + 1)
    K._insert_load(spark, extra, storage, last + 1)
    assert spark.table(storage).where(F.col(K.LOAD) == last + 1).count() == 3
    assert spark.table(f"{db}.TRIPS").count() == full.count()             # unpublished: not visible
    # the per-load daily counts equal D1 over the rows, for TRIPS and for its snapshot
    from velocast.operators.relational import daily_counts
    for name in ("TRIPS", "TRIPS_first"):
        got = K.daily_of(spark, f"{db}.{name}").collect()
        assert sorted(got, key=str) == sorted(daily_counts(spark.table(f"{db}.{name}")).collect(), key=str)
