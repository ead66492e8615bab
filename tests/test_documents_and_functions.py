"""Archives by member, the polymorphic table function, documents of an open schema."""

import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velocast.operators import documents as D
from velocast.operators import polymorphic as PM
from velocast.sources import files as AF

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("ID", "NAME")])


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="velocast-zip-")


def archive(folder, name, members):
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for m, text in members.items():
            z.writestr(m, text)
    return path


def test_a_member_is_a_task(spark, folder):
    archive(folder, "a.zip", {f"m{i}.csv": "ID,NAME\n" + "".join(f"{i}-{j},x\n" for j in range(40)) for i in range(12)} | {"__MACOSX/m0.csv": "junk", "d/": ""})
    archive(folder, "b.zip", {"one.csv": 'ID,NAME\nq,"a, b"\n\nr,NULL\n'})
    m = AF.archive_members(spark, folder).orderBy("PATH", "N").collect()
    assert len(m) == 13 and m[0].OFFSET == 0 and all(b.OFFSET > a.OFFSET for a, b in zip(m[:11], m[1:12]))
    lines = AF.archive_lines(spark, folder)
    assert lines.select(F.spark_partition_id().alias("p")).distinct().count() >= 6
    rows = AF.unpack_zip_csv(spark, folder, SCHEMA)
    assert rows.count() == 482 and {tuple(r) for r in rows.where("ID > 'a'").collect()} == {("q", "a, b"), ("r", None)}
    assert AF.unpack_zip_csv(spark, folder, SCHEMA, first_only=True).count() == 42


def test_damaged_archives_are_refused(spark, folder):
    path = archive(folder, "a.zip", {"m.csv": "ID,NAME\n" + "".join(f"{i},{i * i}\n" for i in range(500))})
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-30])
    with pytest.raises(Exception, match="a.zip"):
        AF.unpack_zip_csv(spark, folder, SCHEMA).count()
    open(path, "wb").write(data[:200] + b"\0\0\0\0" + data[204:])
    with pytest.raises(Exception, match="member m.csv"):
        AF.unpack_zip_csv(spark, folder, SCHEMA).collect()
    archive(folder, "a.zip", {"m.csv": b"ID,NAME\n1,ok\n2,caf\xe9\n"})
    with pytest.raises(Exception, match="after line"):
        AF.unpack_zip_csv(spark, folder, SCHEMA).collect()


def test_one_function_over_two_schemas(spark):
    a = spark.createDataFrame([("x", 2, 5, 1.5), ("x", 1, 9, None), ("x", 3, 4, 0.5), (None, 1, None, None)], "K string, T int, A long, B double")
    out = {r.K: r for r in PM.series_profile(a, "K", "T").collect()}
    assert PM.series_profile(a, "K", "T").columns == ["K", "N", "FIRST_T", "LAST_T", "FIRST_A", "LAST_A", "STEP_A", "FIRST_B", "LAST_B", "STEP_B"]
    assert tuple(out["x"]) == ("x", 3, 1, 3, 9, 4, 4, 1.5, 0.5, 1.0) and tuple(out[None])[1:] == (1, 1, 1, None, None, None, None, None, None)
    b = spark.createDataFrame([(1, "2020-01-02", "t"), (1, "2020-01-01", "u")], "k int, `a day` string, note string")
    assert [tuple(r) for r in PM.series_profile(b, "k", "a day").collect()] == [(1, 2, "2020-01-01", "2020-01-02")]
    assert PM.series_profile(a.limit(0), "K", "T").count() == 0
    with pytest.raises(Exception, match="no column"):
        PM.series_profile(a, "K", "missing").collect()


def test_documents_with_unknown_fields(spark):
    path = tempfile.mkdtemp(prefix="velocast-variant-") + "/t"
    docs = [("s", '[[{"DATE": "2020-01-01", "COUNT": 2, "PRED": 1.5, "new": {"x": [1]}}, {"DATE": "2020-01-02", "COUNT": "no number"}], []]'),
            ("t", "[[], [{\"PRED\": null}]]"), ("u", "{}"), ("v", None)]
    (spark.createDataFrame(docs, "STATION_ID string, J string").select("STATION_ID", F.parse_json("J").alias("PRED_DATA")).write.parquet(path))
    pred = spark.read.parquet(path)
    assert dict(pred.dtypes)["PRED_DATA"] == "variant"
    rows = {(r.STATION_ID, str(r.DATE)): r for r in D.flatten_variant(pred, 0, (1, 7)).collect()}
    assert set(rows) == {("s", "2020-01-01"), ("s", "2020-01-02")}
    assert rows["s", "2020-01-01"].COUNT == 2 and float(rows["s", "2020-01-01"].PRED) == 1.5 and rows["s", "2020-01-02"].COUNT is None
    assert D.flatten_variant(pred, 1, (1, 7)).count() == 1
    parts = D.explode_documents(pred, "PRED_DATA", "$[0]")
    assert {(r.FIELD, r.KIND, r.N_DOCS) for r in D.fields_of(parts).where("STATION_ID = 's'").collect()} >= {
        ("new", "OBJECT<x: ARRAY<BIGINT>>", 1), ("DATE", "STRING", 2), ("COUNT", "BIGINT", 1), ("COUNT", "STRING", 1)}
    assert "new" in D.schema_of_documents(parts).collect()[0].SCHEMA
