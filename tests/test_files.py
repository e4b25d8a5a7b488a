import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import layout as L
from millrace.operators import merge as M
from millrace.session import work_dir
from millrace.sources import files as S
from millrace.sources import ingest as I
from millrace.sources import rescue as R
from millrace.sources import sinks as K


def put(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_permissive_csv_keeps_null_readings(spark):
    path = work_dir(spark, "t")
    put(spark, path, ["sensor,reading,at", "s1,1.5,2024-01-01", "s2,,2024-01-01", "s3,abc,2024-01-01", "s4,2.0"])
    good, bad = S.read_csv_permissive(spark, path, "sensor STRING, reading DOUBLE, at DATE", header="sensor,reading,at")
    assert rows(good, "sensor", "reading") == [("s1", 1.5), ("s2", None)]
    assert rows(bad) == [("s3,abc,2024-01-01",), ("s4,2.0",)]


def test_rescue(spark):
    lines = ['{"a": 1, "b": "x"}', '{"a": "no", "b": "y", "c": {"d": 1}}', '{"a": 2.5}', "broken {", '{"a": null}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = [tuple(r) for r in R.rescue_json(df, "a INT, b STRING").collect()]
    assert out[0] == (1, "x", None)
    assert out[1][:2] == (None, "y") and '"a":"no"' in out[1][2] and '"c"' in out[1][2]
    assert out[2] == (None, None, '{"a":"2.5"}')
    assert out[3] == (None, None, "broken {")
    assert out[4] == (None, None, None)


def test_ingest_each_file_once_and_evolution(spark):
    root = work_dir(spark, "t")
    put(spark, f"{root}/in", ['{"id": 1}'])
    args = (f"{root}/checkpoint", f"{root}/table")
    schema = I.ingest_files(spark, f"{root}/in", "json", "id BIGINT", *args, evolution="add")
    put(spark, f"{root}/in", ['{"id": 2, "priority": "high"}'])
    with pytest.raises(I.SchemaChanged):
        I.ingest_files(spark, f"{root}/in", "json", schema, *args, evolution="fail")
    schema = I.ingest_files(spark, f"{root}/in", "json", schema, *args, evolution="add")
    I.ingest_files(spark, f"{root}/in", "json", schema, *args, evolution="add")
    out = S.read_parquet(spark, f"{root}/table", evolved=True)
    assert rows(out, "id", "priority") == [(1, None), (2, "high")]


def test_load_once_counts(spark):
    root = work_dir(spark, "t")
    put(spark, f"{root}/in", ['{"id": 1}', '{"id": 2}'])
    args = (spark, f"{root}/in", "json", f"{root}/table", f"{root}/manifest", "id BIGINT")
    assert I.load_once(*args) == 1
    assert I.load_once(*args) == 0
    assert rows(I.read_loaded(spark, f"{root}/table")) == [(1,), (2,)]


def test_load_once_after_a_crash_with_a_new_file(spark, monkeypatch):
    root = work_dir(spark, "t")
    put(spark, f"{root}/in", ['{"id": 1}'])
    args = (spark, f"{root}/in", "json", f"{root}/table", f"{root}/manifest", "id BIGINT")
    note = I._note

    def crash(session, manifest, entries):
        if entries[0][0] is None:
            raise OSError("lost")
        note(session, manifest, entries)

    monkeypatch.setattr(I, "_note", crash)
    with pytest.raises(OSError):
        I.load_once(*args)
    monkeypatch.setattr(I, "_note", note)
    put(spark, f"{root}/in", ['{"id": 2}'])
    assert I.load_once(*args) == 2
    assert I.load_once(*args) == 0
    assert rows(I.read_loaded(spark, f"{root}/table")) == [(1,), (2,)]


def test_require_sources(spark):
    path = work_dir(spark, "t")
    put(spark, path, ["x"])
    S.require_sources(spark, {path: "text"})
    with pytest.raises(S.MissingSource):
        S.require_sources(spark, {path + "-none": "text"}, ["no_such_table"])


def test_enforced_append(spark):
    path = work_dir(spark, "t")
    df = spark.createDataFrame([(1, 2.0)], "id int, amount double")
    K.write(df, path)
    with pytest.raises(K.SchemaMismatch):
        K.append_enforced(df.withColumn("extra", F.lit(1)), path)
    with pytest.raises(K.SchemaMismatch):
        K.append_enforced(df.withColumn("amount", F.lit("x")), path)
    assert K.read(spark, path).count() == 1
    K.append_enforced(K.conform(df.withColumn("extra", F.lit(1)), df.schema), path)
    assert K.read(spark, path).columns == ["id", "amount"] and K.read(spark, path).count() == 2


def test_merge_into_touches_only_its_partitions(spark):
    path = work_dir(spark, "t")
    base = spark.createDataFrame([(1, "x", 1), (2, "x", 1), (3, "y", 1)], "id int, part string, v int")
    K.write(base, path, partition_by=["part"])
    before = sorted(os.listdir(f"{path}/part=y"))
    K.merge_into(path, spark.createDataFrame([(2, "x", 9), (4, "z", 9)], base.schema), ["part", "id"], ["part"], keyed=True)
    assert rows(K.read(spark, path), "id", "part", "v") == [(1, "x", 1), (2, "x", 9), (3, "y", 1), (4, "z", 9)]
    assert sorted(os.listdir(f"{path}/part=y")) == before


def test_merge_into_removes_an_emptied_partition(spark):
    path = work_dir(spark, "t")
    base = spark.createDataFrame([(1, "a b", 1), (2, "x:y", 1), (3, "x:y", 1), (4, None, 1)], "id int, part string, v int")
    K.write(base, path, partition_by=["part"])
    gone = spark.createDataFrame([(1, "a b", 0, True), (2, "x:y", 0, True), (5, None, 5, False)], "id int, part string, v int, gone boolean")
    clauses = [M.delete("s.gone"), M.update(), M.insert()]
    K.merge_into(path, gone, ["part", "id"], ["part"], clauses)
    want = [(3, "x:y", 1), (4, None, 1), (5, None, 5)]
    back = K.read(spark, path).select("id", "part", "v").orderBy("id").collect()
    assert [tuple(r) for r in back] == want
    assert not any(f.startswith("part=a") for f in os.listdir(path))
    K.merge_into(path, gone.limit(0), ["part", "id"], ["part"], clauses)
    assert K.read(spark, path).count() == 3


def test_merge_into_many_partitions(spark):
    path = work_dir(spark, "t")
    base = spark.range(400).selectExpr("id", "id as part", "0 as v")
    base.coalesce(4).write.partitionBy("part").parquet(path)
    K.merge_into(path, base.selectExpr("id", "part", "7 as v"), ["part", "id"], ["part"], keyed=True)
    back = K.read(spark, path)
    assert (back.count(), back.where("v = 7").count()) == (400, 400)


def test_zorder_on_text(spark):
    df = spark.range(3000).selectExpr("if(id % 50 = 0, null, concat('Customer#', lpad(id * 37 % 3000, 6, '0'))) as name", "id % 60 as g")
    assert rows(L.zorder(df.where("name is not null"), ["name", "g"], 6)) == rows(df.where("name is not null"))
    out = work_dir(spark, "t")
    L.zorder(df, ["g", "name"], 8).write.parquet(out)
    back = spark.read.parquet(out)
    assert back.columns == df.columns and back.count() == 3000
    spans = back.where("name is not null").groupBy(F.col("_metadata.file_path")).agg(F.min("name").alias("lo"), F.max("name").alias("hi"))
    whole = spans.where("substring(hi, 10)::int - substring(lo, 10)::int < 2000").count()
    assert whole > 4
    assert L.zorder(df.where("name is null"), ["name"], 2).count() == 60


def test_layouts_keep_rows_and_split_a_heavy_value(spark):
    df = spark.range(4000).selectExpr("if(id % 3 = 0, 7, id % 100) as k", "id % 50 as g", "id")
    out = work_dir(spark, "t")
    L.write_clustered(df, out, ["k"], parts=8)
    back = spark.read.parquet(out)
    assert back.count() == 4000
    assert back.where("k = 7").select("_metadata.file_path").distinct().count() > 1
    assert rows(L.zorder(df, ["k", "g"], parts=6)) == rows(df)
    small = work_dir(spark, "t")
    df.repartition(12).write.parquet(small)
    assert L.compact(spark, small, work_dir(spark, "t")) == (12, 1)
    cost = {r.layout: r for r in L.scan_cost(spark, {"raw": small, "clustered": out}, {"k": 55}).collect()}
    assert cost["clustered"].files_touched < cost["raw"].files_touched == 12
    assert cost["clustered"].rows_found == cost["raw"].rows_found == df.where("k = 55").count()


def test_named_tables_and_statistics(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    K.write(df, "millrace_stats")
    K.overwrite(df.where("id = 1"), "millrace_stats")
    assert K.read(spark, "millrace_stats").count() == 1
    L.analyze(spark, "millrace_stats", ["id"])
    stats = spark.sql("DESCRIBE EXTENDED millrace_stats").where("col_name = 'Statistics'").first()
    assert "1 rows" in stats["data_type"]
    spark.sql("DROP TABLE millrace_stats")


def test_csv_by_header(spark):
    from millrace.sources.headers import ingest_by_header

    root = work_dir(spark, "headers")

    def put(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{root}/in")

    put("id,amount", "1,10.5", "id,amount", "id,amount", "x,y")
    run = lambda: ingest_by_header(spark, f"{root}/in", "id INT, amount DOUBLE", f"{root}/c", f"{root}/out")
    run()
    put("id,region,amount", '2,"EU,1",20.5')
    put("amount, id", "30.5,3")
    put("id")
    run()
    run()
    out = spark.read.option("mergeSchema", True).parquet(f"{root}/out")
    # lines that repeat the header are data after its first copy
    assert rows(out, "id", "amount", "region") == [(1, 10.5, None), (2, 20.5, "EU,1"), (3, 30.5, None), (None, None, None), (None, None, None), (None, None, None)]


def test_header_is_left_out_once_per_file(spark):
    path = work_dir(spark, "csv")
    for lines in (["k|v", "a|1", "k|v"], ["k|v", "b|2"]):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    good, bad = S.read_csv_permissive(spark, path, "k STRING, v STRING", header="k|v", sep="|")
    assert rows(good) == [("a", "1"), ("b", "2"), ("k", "v")] and bad.isEmpty()
