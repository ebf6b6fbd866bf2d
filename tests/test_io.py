"""Sources and sinks on scratch folders and an embedded (in-process) Derby
database — nothing listens on a port."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import MOVIES_JSON
from vireo.sources import files
from vireo.sources.tables import table

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_text_roundtrip(spark, tmp_path):
    c = table(spark, SF_SMALL, "customer").select("c_custkey", "c_name")
    files.write_text(c, str(tmp_path / "t"), ["c_custkey", "c_name"], sep="\t")
    back = files.read_text(spark, str(tmp_path / "t"), partitions=3)
    assert back.count() == c.count() and back.rdd.getNumPartitions() == 3
    assert back.where(F.col("value").contains("\t")).count() == c.count()


def test_csv_infer_and_enforced_schema(spark, tmp_path):
    c = table(spark, SF_SMALL, "customer").select(
        "c_custkey", "c_acctbal",
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("n/a"))
        .otherwise(F.col("c_nationkey").cast("string")).alias("nation"))
    c.coalesce(1).write.option("header", True).csv(str(tmp_path / "c"))
    inferred = files.read_csv_infer(spark, str(tmp_path / "c"))
    assert dict(inferred.dtypes)["nation"] == "string"        # dirty column infers as text
    typed = files.read_csv_schema(spark, str(tmp_path / "c"), "c_custkey long, c_acctbal double, nation int")
    autos = c.where("nation = 'n/a'").count()
    assert typed.where("nation is null").count() == autos > 0
    assert typed.count() == c.count()


def test_json_infer_and_schema(spark, tmp_path):
    p = tmp_path / "m.json"
    p.write_text("\n".join(MOVIES_JSON))
    inf = files.read_json(spark, str(p))
    assert set(inf.columns) == {"title", "country", "year", "cast", "genres", "ratings"}
    sch = files.read_json(spark, str(p), "title string, genres array<string>, ratings map<string,double>")
    assert sch.select(F.explode("ratings")).count() == 4
    ddl = files.json_column_schema(spark.createDataFrame([(j,) for j in MOVIES_JSON], "v string"), "v")
    assert "genres" in ddl


def test_sequence_file_roundtrip(spark, tmp_path):
    df = spark.range(0, 50).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).cast("int").alias("v"))
    files.save_kv_file(df, "k", "v", str(tmp_path / "kv"))
    back = files.load_kv_file(spark, str(tmp_path / "kv"), schema="k int, v int")
    assert back.schema == df.schema or back.dtypes == df.dtypes
    assert sorted(tuple(r) for r in back.collect()) == [(i, 2 * i) for i in range(50)]


def test_jdbc_read_partitioned_pushdown_append(spark, tmp_path):
    url = f"jdbc:derby:memory:vireo{os.getpid()};create=true"
    people = table(spark, SF_SMALL, "customer").select(
        F.col("c_name").alias("FNAME"), (F.col("c_custkey") % 60).cast("int").alias("AGE"))
    files.jdbc_append(people, url, "PEOPLE", DERBY)
    files.jdbc_append(people.limit(5), url, "PEOPLE", DERBY)
    whole = files.jdbc_read(spark, url, "PEOPLE", DERBY)
    assert whole.count() == people.count() + 5
    parts = files.jdbc_read_partitioned(spark, url, "PEOPLE", "AGE", 0, 60, 2, DERBY)
    assert parts.rdd.getNumPartitions() == 2 and parts.count() == whole.count()
    q = whole.where((F.col("AGE") > 30) & F.col("FNAME").startswith("Customer#00000001")).select("FNAME")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(AGE,30)" in plan and "StringStartsWith(FNAME" in plan
    assert q.count() == people.where((F.col("AGE") > 30) & F.col("FNAME").startswith("Customer#00000001")).count()


def test_s3a_settings_from_env(monkeypatch):
    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "AK")
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "SK")
    conf = files.s3a_settings(endpoint="http://objects.invalid")
    assert conf["fs.s3a.access.key"] == "AK" and conf["fs.s3a.endpoint"] == "http://objects.invalid"
    monkeypatch.delenv("AWS_ACCESS_KEY_ID")
    assert "fs.s3a.access.key" not in files.s3a_settings()


def test_catalog_managed_and_external(spark, tmp_path):
    c = table(spark, SF_SMALL, "nation")
    files.save_table(c, "vireo_nation_managed")
    assert files.read_table(spark, "vireo_nation_managed").count() == 25
    spark.sql("INSERT INTO vireo_nation_managed VALUES (99, 'ATLANTIS', 0)")
    assert files.read_table(spark, "vireo_nation_managed").count() == 26
    ext = str(tmp_path / "ext")
    files.save_table(c, "vireo_nation_external", path=ext)
    spark.sql("DROP TABLE vireo_nation_external")
    assert spark.read.parquet(ext).count() == 25          # external drop keeps files
    files.create_external_table(spark, "vireo_nation_ext2", "n_nationkey int, n_name string, n_regionkey int", ext)
    assert files.read_table(spark, "vireo_nation_ext2").count() == 25
    spark.sql("DROP TABLE vireo_nation_managed")
    spark.sql("DROP TABLE vireo_nation_ext2")


def test_temp_view_fail_if_exists(spark):
    df = table(spark, SF_SMALL, "region")
    df.createOrReplaceTempView("vireo_region_v")
    with pytest.raises(Exception):
        df.createTempView("vireo_region_v")


def test_empty_sequence_file_reads_as_an_empty_frame(spark, tmp_path):
    files.save_kv_file(spark.createDataFrame([], "k string, v string"), "k", "v", str(tmp_path / "none"))
    assert files.load_kv_file(spark, str(tmp_path / "none"), "k", "v").collect() == []


def test_json_schema_has_the_fields_of_all_values(spark):
    docs = spark.createDataFrame([('{"a":1}',), ('{"a":2,"b":"x"}',), (None,), ('{"c":{"d":[1.5]}}',)], "j string")
    ddl = files.json_column_schema(docs, "j")
    row = docs.select(F.from_json("j", ddl).alias("r")).select("r.a", "r.b", "r.c.d").collect()
    assert [tuple(r) for r in row] == [(1, None, None), (2, "x", None), (None, None, None), (None, None, [1.5])]


def test_object_store_settings_leave_the_default_providers(monkeypatch):
    monkeypatch.delenv("AWS_ACCESS_KEY_ID", raising=False)
    assert "fs.s3a.aws.credentials.provider" not in files.s3a_settings()


def test_a_rewritten_table_is_read_with_its_new_schema(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(3).withColumn("x", F.lit("a")).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert table(spark, str(tmp_path), "t").columns == ["id", "x"]
