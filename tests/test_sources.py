import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tableworks.operators import clean, quality
from tableworks.sources import files, tables

# crafted input: a string id, a missing id and id 0 must not survive
USERS = [
    '{"id": 1, "email": "a@x.io", "creation_date": "01-31-2021 10:00:00", "firstname": "ANNA"}',
    '{"id": 4, "email": "b@x.io", "creation_date": "02-01-2021 10:00:00", "firstname": "ben"}',
    '{"id": 0, "email": "c@x.io", "creation_date": "02-02-2021 10:00:00", "firstname": "cat"}',
    '{"id": 3, "email": "d@x.io", "creation_date": "02-03-2021 10:00:00", "firstname": "dan"}',
    '{"id": 2, "email": "e@x.io", "creation_date": "not a date", "firstname": "eve"}',
    '{"email": "f@x.io", "creation_date": "02-05-2021 10:00:00", "firstname": "fay"}',
    '{"id": "invalid ID", "email": "g@x.io", "creation_date": "02-06-2021 10:00:00", "firstname": "gus"}',
]
SCHEMA = "id int, email string, creation_date string, firstname string"


@pytest.fixture
def users_path(spark, tmp_path):
    path = str(tmp_path / "users")
    spark.createDataFrame([(u,) for u in USERS], "value string").coalesce(1).write.text(path)
    return path


def test_rescue_then_clean(spark, users_path):
    raw = files.read_with_rescue(spark, users_path, "json", SCHEMA)
    assert raw.count() == 7
    bad = [r[files.RESCUED] for r in raw.filter(f"{files.RESCUED} IS NOT NULL").collect()]
    assert bad == ['{"id":"invalid ID"}']
    kept = quality.expect(raw, [quality.Rule("valid", "id > 0", "drop")])
    out = clean.clean_entities(kept, {"id": "copy id", "email": "sha1 email", "name": "title firstname",
                                      "created": "timestamp creation_date MM-dd-yyyy HH:mm:ss"})
    got = {r.id: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3, 4] and got[1].name == "Anna" and got[2].created is None
    assert all("@" not in r.email for r in got.values())


def test_rescue_keeps_broken_lines(spark):
    lines = spark.createDataFrame([("{broken",), ('{"a": 1, "b": {"c": 2}}',)], "value string")
    got = files.rescue_json(lines, T.StructType.fromDDL("a int")).collect()
    assert [(r.a, r[files.RESCUED]) for r in got] == [(None, '{"_raw":"{broken"}'), (1, '{"b":"{\\"c\\":2}"}')]


def test_rescue_nested_fields(spark):
    schema = T.StructType.fromDDL("a struct<x int, y int, s struct<p int>>, l array<int>, m map<string,int>")
    cases = [
        ('{"a": {"x": "bad", "y": 2, "z": 9}}', {"a.x": "bad", "a.z": "9"}, 2),
        ('{"a": {"y": 3, "s": {"p": "no", "q.r": 1}}}', {"a.s.p": "no", "a.s.`q.r`": "1"}, 3),
        ('{"a": 5}', {"a": "5"}, None),
        ('{"a": {"y": 4}, "l": [1, "two"]}', {"l": '[1,"two"]'}, 4),
        ('{"a": {"y": 5}, "m": {"k": "v"}}', {"m": '{"k":"v"}'}, 5),
        ('{"a": {"x": 1, "y": 6, "s": {"p": 2}}, "l": [1, null], "m": {"k": 1}}', None, 6),
        ('{"a": null}', None, None),
    ]
    got = files.rescue_json(spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, value string"), schema).orderBy("i").collect()
    assert [json.loads(r[files.RESCUED]) if r[files.RESCUED] else None for r in got] == [c[1] for c in cases]
    assert [r.a.y if r.a else None for r in got] == [c[2] for c in cases]


def test_evolution_of_structs():
    old = T.StructType.fromDDL("a struct<x int>, b int")
    new = T.StructType.fromDDL("a struct<x string, y string>, c int")
    wider, grew = files.evolve_schema(old, new)
    assert grew and wider == T.StructType.fromDDL("a struct<x int, y string>, b int, c int")
    assert files.evolve_schema(wider, new) == (wider, False)
    assert files.unknown_fields(new, old) == T.StructType.fromDDL("a struct<y string>, c int")


def test_csv_rescue_drops_incomplete(spark, tmp_path):
    path = tmp_path / "spend"
    path.mkdir()
    (path / "s.csv").write_text("id,age,annual_income\n1,30,10.5\n2,,20\n,40,30\nabc,50,40\n5,60,\n6,70,60\n")
    raw = files.read_with_rescue(spark, str(path), "csv", "id int, age int, annual_income double")
    gold = clean.drop_incomplete(raw.drop(files.RESCUED), ["id", "age", "annual_income"])
    assert raw.count() == 6 and rows(gold) == [(1, 30, 10.5), (6, 70, 60.0)]


def test_schema_hints_and_store(spark, users_path, tmp_path):
    store = str(tmp_path / "schema")
    first = files.infer_schema(spark, users_path, "json", "id bigint, added double", store)
    assert first["id"].dataType == T.LongType() and first["added"].dataType == T.DoubleType()
    assert files.infer_schema(spark, users_path, "json", None, store) == first
    assert files.load_schema(spark, str(tmp_path / "none")) is None


def test_evolution_modes():
    old, new = T.StructType.fromDDL("a int"), T.StructType.fromDDL("a int, b string")
    assert files.evolve_schema(old, new)[0].names == ["a", "b"]
    assert files.evolve_schema(old, new, "rescue") == (old, False)
    with pytest.raises(files.SchemaChanged):
        files.evolve_schema(old, new, "failOnNewColumns")


def test_evolving_load_restarts_once_per_change(spark, tmp_path):
    src, store, ckpt, out = (str(tmp_path / n) for n in ("src", "store", "ckpt", "out"))

    def add(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(src)

    def load(mode="addNewColumns"):
        files.ingest_evolving(spark, src, store, ckpt, out, "a int", mode)

    add('{"a": 1}')
    assert files.run_until_stable(load) == 1
    add('{"a": 2, "b": "x"}', '{"a": 3, "c": 1.5}')
    assert files.run_until_stable(load) == 2
    add('{"a": 4, "d": 1}')
    load("rescue")
    got = tables.read_table(spark, out, merge_schema=True)
    assert rows(got, "a", "b", "c") == [(1, None, None), (2, "x", None), (3, None, 1.5), (4, None, None)]
    assert [r[files.RESCUED] for r in got.filter("a = 4").collect()] == ['{"d":"1"}']


def test_evolving_load_adds_fields_of_structs(spark, tmp_path):
    src, store, ckpt, out = (str(tmp_path / n) for n in ("src", "store", "ckpt", "out"))
    spark.createDataFrame([('{"a": {"x": 1}}',)], "value string").write.text(src)
    files.run_until_stable(lambda: files.ingest_evolving(spark, src, store, ckpt, out, "a struct<x int>"))
    spark.createDataFrame([('{"a": {"x": 2, "y": 0.5}}',)], "value string").write.mode("append").text(src)
    assert files.run_until_stable(lambda: files.ingest_evolving(spark, src, store, ckpt, out, "a struct<x int>")) == 2
    assert rows(tables.read_table(spark, out, merge_schema=True), "a.x", "a.y") == [(1, None), (2, 0.5)]


def test_copy_into_loads_each_file_once(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "table")
    spark.range(3).coalesce(1).write.json(src)
    assert files.copy_into(spark, src, "json", table, "id bigint", glob="*.json") == 1
    assert files.copy_into(spark, src, "json", table, "id bigint", glob="*.json") == 0
    spark.range(3, 5).coalesce(1).write.mode("append").json(src)
    assert files.copy_into(spark, src, "json", table, "id bigint", glob="*.json") == 1
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [0, 1, 2, 3, 4]


def test_binary_files(spark, tmp_path):
    for label in ("cat", "dog"):
        (tmp_path / "img" / label).mkdir(parents=True)
        (tmp_path / "img" / label / "1.jpg").write_bytes(b"x" * 5)
    got = files.ingest_binary(spark, str(tmp_path / "img"), "*.jpg", "/([^/]+)/[^/]+$", content=False)
    assert rows(got, "file_name", "label", "length") == [("1.jpg", "cat", 5), ("1.jpg", "dog", 5)]


def test_fan_out_raises():
    with pytest.raises(ZeroDivisionError):
        files.fan_out(["a", "b"], lambda n: 1 / 0)


# ---- logs of row versions --------------------------------------------------

def test_log_table_replays_and_keeps_the_newest(spark, tmp_path):
    path = str(tmp_path / "log")
    a = spark.range(20).select("id", F.lit("a").alias("v"), F.lit(5).alias("at"))
    b = spark.range(10, 30).select("id", F.lit("b").alias("v"), F.when(F.col("id") == 10, 1).otherwise(5).alias("at"))
    tables.append_batch(a, 0, path)
    tables.append_batch(b, 1, path)
    tables.append_batch(b, 1, path)  # the same batch again
    assert spark.read.parquet(path).count() == 40
    want = [(i, "a" if i <= 10 else "b") for i in range(30)]
    got = tables.latest_rows(spark, path, ["id"], ["at"])
    assert sorted((r.id, r.v) for r in got.collect()) == want
    # without an order the later write counts
    assert tables.latest_rows(spark, path, ["id"]).filter("id = 10").first().v == "b"


def test_log_table_takes_new_columns_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_batch(spark.createDataFrame([(1, "x"), (None, "y")], "id long, v string"), 0, path)
    tables.append_batch(spark.createDataFrame([(None, "z", 3)], "id long, v string, w int"), 11, path)
    tables.append_batch(spark.createDataFrame([], "id long, v string, w int"), 12, path)
    got = {r.id: (r.v, r.w) for r in tables.latest_rows(spark, path, ["id"]).collect()}
    assert got == {1: ("x", None), None: ("z", 3)}
    with pytest.raises(ValueError):
        tables.append_batch(spark.range(1).withColumn(tables.BATCH, F.lit(1)), 13, path)


def test_write_table_guards_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(3), path, "overwrite")
    with pytest.raises(ValueError):
        tables.write_table(spark.range(3).withColumn("x", F.lit(1)), path)
    tables.write_table(spark.range(3).withColumn("x", F.lit(1)), path, merge_schema=True)
    assert tables.read_table(spark, path, merge_schema=True).filter("x IS NULL").count() == 3
