"""Files load once, changed files are reported, records that don't fit are kept apart."""

import gzip
import os
import tempfile
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velocast.sources import files as AF
from velocast.sources import ledger as L

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("ID", "NAME", "N")])
HEAD = "ID,NAME,N\n"


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="velocast-ledger-")


def put(folder, name, text):
    path = os.path.join(folder, name)
    with (gzip.open(path, "wt") if name.endswith(".gz") else open(path, "w")) as f:
        f.write(HEAD + text)
    return path


def load(spark, folder, table, **kw):
    out = L.load_files(spark, L.listing(spark, folder, "*.{csv,csv.gz,zip}"), SCHEMA, table, **kw)
    return {r.NAME: (r.STATUS, r.N_ROWS, r.N_REJECTED) for r in out.collect()}


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).na.fill("-").collect())


def name():
    return "led_" + uuid.uuid4().hex[:8]


def test_files_load_once(spark, folder):
    t = name()
    put(folder, "a.csv.gz", "1,x,NULL\n2,\\N,5\n")
    assert load(spark, folder, t) == {"a.csv.gz": ("NEW", 2, 0)}
    put(folder, "b c%.csv", "3,z,1\n")
    put(folder, "empty.csv", "")
    assert load(spark, folder, t) == {"a.csv.gz": ("LOADED", None, None), "b c%.csv": ("NEW", 1, 0), "empty.csv": ("NEW", 0, 0)}
    assert {s for s, _, _ in load(spark, folder, t).values()} == {"LOADED"}
    assert rows(spark, t) == [("1", "x", "-"), ("2", "-", "5"), ("3", "z", "1")]
    assert spark.table(L.ledger_of(t)).count() == 3


def test_changed_files(spark, folder):
    t = name()
    put(folder, "a.csv", "1,x,1\n2,y,2\n")
    put(folder, "b.csv", "3,z,3\n")
    load(spark, folder, t)
    put(folder, "a.csv", "1,new,1\n")
    assert load(spark, folder, t)["a.csv"] == ("CHANGED", None, None) and len(rows(spark, t)) == 3
    assert load(spark, folder, t, on_change="reload")["a.csv"] == ("CHANGED", 1, 0)
    assert rows(spark, t) == [("1", "new", "1"), ("3", "z", "3")]
    assert load(spark, folder, t)["a.csv"][0] == "LOADED"
    with pytest.raises(ValueError):
        load(spark, folder, t, on_change="ignore")


def test_a_load_cut_off_before_its_commit(spark, folder, monkeypatch):
    """Rows without a ledger row are not seen, and the retry writes the same partitions again."""
    t = name()
    put(folder, "a.csv", "1,x,1\n2,y,2\n")
    put(folder, "b.csv", "3,z,3\nbroken\n")
    real = L._log
    monkeypatch.setattr(L, "_log", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load(spark, folder, t)
    monkeypatch.setattr(L, "_log", real)
    spark.catalog.refreshTable(L.store_of(t))
    assert spark.table(L.store_of(t)).count() == 4 and rows(spark, t) == []
    assert load(spark, folder, t) == {"a.csv": ("NEW", 2, 0), "b.csv": ("NEW", 1, 1)}
    assert rows(spark, t) == [("1", "x", "1"), ("2", "y", "2"), ("3", "z", "3")] and spark.table(L.store_of(t)).count() == 4


def test_rows_of_a_plain_table_are_taken_over(spark, folder):
    t = name()
    spark.createDataFrame([("0", "old", "0")], SCHEMA).write.saveAsTable(t)
    put(folder, "a.csv", "1,x,1\n")
    load(spark, folder, t)
    assert rows(spark, t) == [("0", "old", "0"), ("1", "x", "1")]


def test_rows_and_rejects_add_up(spark, folder):
    text = ('1,"a, ""b""\nsecond line",2\n' "2,short\n" "3,too,many,fields\n" "4,fine,NULL\n" '5,"quoted",\\N\n')
    put(folder, "a.csv.gz", text)
    put(folder, "b.csv", "6,x,1\n" '7,"never closed,1\n8,lost,2\n')
    got = L.read_checked(spark, [folder], SCHEMA).cache()
    good = sorted(tuple(r)[:3] for r in got.where("REJECTED IS NULL").collect())
    assert good == [("1", 'a, "b"\nsecond line', "2"), ("4", "fine", None), ("5", "quoted", None), ("6", "x", "1")]
    bad = {(r.RECORD[0], r.REASON) for r in L.rejects(got, 3).collect()}
    assert bad == {("2", "too few fields"), ("3", "too many fields"), ("7", "unterminated quote")}
    assert got.where("REJECTED IS NOT NULL").selectExpr("coalesce(ID, NAME, N) AS x").where("x IS NOT NULL").count() == 0
    t = name()
    load(spark, folder, t)
    assert spark.table(L.rejects_of(t)).count() == 3 and len(rows(spark, t)) == 4


def test_archives(spark, folder):
    t = name()
    with zipfile.ZipFile(os.path.join(folder, "m.zip"), "w") as z:
        z.writestr("one.csv", HEAD + "1,x,NULL\n2,few\n")
        z.writestr("two.csv", HEAD + "3,z,3\n")
    put(folder, "a.csv", "4,q,4\n")
    assert load(spark, folder, t) == {"m.zip": ("NEW", 2, 1), "a.csv": ("NEW", 1, 0)}
    assert rows(spark, t) == [("1", "x", "-"), ("3", "z", "3"), ("4", "q", "4")]


def test_no_files(spark, folder):
    put(folder, "a.csv", "1,x,1\n")
    t = name()
    assert L.load_files(spark, L.listing(spark, folder).limit(0), SCHEMA, t).count() == 0 and spark.table(t).count() == 0
    assert AF.read_trips_csv(spark, folder, SCHEMA).count() == 1


def test_a_repeated_or_retried_run_adds_no_row(spark, monkeypatch):
    """K2 twice over the same files, with a crash between raw and TRIPS, and a later month."""
    from pyspark.sql import functions as F

    from velocast.config import RunConfig
    from velocast.plans import ingest as K
    from velocast.sources import catalog as A

    folder = tempfile.mkdtemp(prefix="velocast-k2-")
    cfg = RunConfig(database="k2_" + uuid.uuid4().hex[:8])
    A.reset_database(spark, cfg.database, {cfg.raw("schema1"): K.SCHEMA1, cfg.raw("schema2"): K.SCHEMA2}, folder + "/db")

    def month(name, ids):
        with gzip.open(os.path.join(folder, name), "wt") as f:
            f.write(",".join(K.SCHEMA2_COLUMNS) + "\n")
            f.writelines(",".join([i, "bike", "2022-01-05 08:00:00", "2022-01-05 09:00:00", *["s"] * 8, "u"]) + "\n" for i in ids)

    def run():
        K.incremental_elt(spark, cfg, AF.list_files(spark, folder, "*.csv.gz"))
        return spark.table(f"{cfg.database}.{cfg.trips}").count()

    month("202201-citibike-tripdata.csv.gz", "abc")
    assert run() == 3 and run() == 3
    month("202202-citibike-tripdata.csv.gz", "de")
    real = K.append_trips
    monkeypatch.setattr(K, "append_trips", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr(K, "append_trips", real)
    assert run() == 5 and run() == 5
    assert spark.table(f"{cfg.database}.{cfg.raw('schema2')}").agg(F.count_distinct("ride_id")).first()[0] == 5
    month("202202-citibike-tripdata.csv.gz", "defgh")
    with pytest.warns(UserWarning, match="changed"):
        assert run() == 5


def test_odd_records_are_landed_by_many_tasks(spark, folder):
    """Each partition of the orders lands as a file with a header of its own; every order is one record."""
    from velocast.book import flows
    n = 700
    orders = spark.range(n).select(F.col("id").alias("o_orderkey"), F.lit("F").alias("o_orderstatus"))
    orders.repartition(4).write.parquet(f"{folder}/orders.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:  # a partition for each file
        spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
        spark.conf.set("spark.sql.files.openCostInBytes", 1 << 20)
        assert spark.read.format("binaryFile").load(flows._odd_records(spark, folder)).where("length > 0").count() == 4
        got = sorted((int(r.ride_id), r.USERTYPE, r.END_STATION_NAME, r.REASON) for r in flows.rejected_records(spark, folder).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    why = {0: "too few fields", 1: "too many fields"}
    assert got == [(i, None if i % 7 < 2 else "F", f'a "b",\n{i}' if i % 7 == 2 else None, why.get(i % 7)) for i in range(n)]
    orders.limit(0).write.parquet(f"{folder}/none/orders.parquet")
    assert flows.rejected_records(spark, f"{folder}/none").count() == 0
