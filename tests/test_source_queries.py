"""The file, catalog and strict-parse queries beyond their oracles: what they leave behind, and the cases that raise."""

import pytest
from conftest import SF_SMALL
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vireo.functions.logs import parse_access_log_strict
from vireo.plans import catalogue
from vireo.sources import files


def test_gzip_lines_are_one_file_a_partition(spark, tmp_path):
    df = spark.range(100, numPartitions=3).select(F.concat(F.lit("line "), "id").alias("line"))
    files.write_text(df, str(tmp_path / "t"), ["line"], compression="gzip")
    assert len(list((tmp_path / "t").glob("*.txt.gz"))) == 3
    back = files.read_text(spark, str(tmp_path / "t"), partitions=7)
    assert back.rdd.getNumPartitions() == 7 and back.distinct().count() == 100


def test_json_schema_of_a_column_with_line_breaks(spark):
    df = spark.createDataFrame([('{"a": 1,\n "b": "x"}',), ('{"c": [1.5]}',), (None,), ('{"a": 2}',)], "j string")
    assert files.json_column_schema(df, "j") == "a BIGINT,b STRING,c ARRAY<DOUBLE>"


def test_catalog_query_leaves_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    catalogue.queries()["catalog_tables"](spark, SF_SMALL).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_log_report_releases_the_parse(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    report = catalogue.queries()["log_report"](spark, SF_SMALL)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert report.select("report").distinct().count() == 11


def test_strict_parse_raises(spark):
    with pytest.raises(PySparkException, match="cannot parse log line"):
        parse_access_log_strict(spark.createDataFrame([("junk line 1",)], "value string")).collect()
