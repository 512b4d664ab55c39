from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import bag
from ledgerline.functions import times
from ledgerline.operators.conform import conform
from ledgerline.plans import staging
from ledgerline.schemas import STAGED_FILING
from ledgerline.sources import daily_files

N = None
FILES = {
    "good": '[{"cik":"1","extra":1},{"formurl":"f","companyname":"c","cik":"2"}]',
    "blank_ends": ' \n[\n {"cik":\n "3"}\n]\n',
    "empty_list": "[]",
    "truncated": '[{"cik":"4"},{"cik":',
    "empty_file": "",
    "mixed": '[{"cik":"5"}, 7]',
    "null_element": '[null,{"cik":"6"}]',
    "object": '{"cik":"7"}',
    "scalar": "8",
    "nested": '[[{"cik":"9"}]]',
    "more_after": '[{"cik":"10"}][{"cik":"11"}]',
}
BAD = {
    "truncated": "malformed", "mixed": "not_an_array_of_objects",
    "null_element": "not_an_array_of_objects", "object": "not_an_array_of_objects",
    "scalar": "not_an_array_of_objects", "nested": "not_an_array_of_objects",
    "more_after": "not_an_array_of_objects",
}


def land(root, ymd, files):
    os.makedirs(f"{root}/{ymd}", exist_ok=True)
    for name, body in files.items():
        with open(f"{root}/{ymd}/{name}.json", "w") as out:
            out.write(body)


def test_whole_files_only(spark, tmp_path):
    land(tmp_path, "20190222", FILES)
    parsed = daily_files.parse_files(daily_files.read_files(spark, str(tmp_path), "20190222"))
    assert bag(daily_files.records(parsed)) == [
        ("20190222", "1", N, N, N, N, N), ("20190222", "2", N, N, N, "c", "f"), ("20190222", "3", N, N, N, N, N)]
    bad = daily_files.quarantine(parsed).collect()
    names = {os.path.basename(row["source_file"]).removesuffix(".json"): row["reason"] for row in bad}
    # A file of no bytes is not listed by the scan; it has no record either way.
    assert names == BAD
    assert {row["body"] for row in bad} >= {FILES["truncated"], FILES["mixed"]}


def test_strict_fails_on_shape_only(spark, tmp_path):
    land(tmp_path, "20190222", {"a": FILES["good"], "b": FILES["truncated"]})
    land(tmp_path, "20190223", {"a": FILES["good"], "b": FILES["mixed"]})
    days = [daily_files.require_arrays(daily_files.parse_files(daily_files.read_files(spark, str(tmp_path), day)))
            for day in ("20190222", "20190223")]
    assert daily_files.quarantine(days[0]).count() == 1
    with pytest.raises(PySparkException):
        daily_files.quarantine(days[1]).collect()


def test_one_day_or_all(spark, tmp_path):
    land(tmp_path, "20190222", {"a": '[{"cik":"1"}]'})
    land(tmp_path, "20190223", {"a": '[{"cik":"2"}]'})
    land(tmp_path, "notes", {"a": '[{"cik":"3"}]'})
    one = daily_files.parse_files(daily_files.read_files(spark, str(tmp_path), "20190223"))
    every = daily_files.parse_files(daily_files.read_files(spark, str(tmp_path)))
    assert bag(daily_files.records(one).select("ymd", "cik")) == [("20190223", "2")]
    assert bag(daily_files.records(every).select("ymd", "cik")) == [("20190222", "1"), ("20190223", "2")]


def test_stage_day_is_repeatable(spark, tmp_path, folder):
    land(tmp_path, "20190222", FILES)
    target, bad, day = folder("staged"), folder("bad"), dt.date(2019, 2, 22)
    said = staging.stage_day(spark, str(tmp_path), target, day, bad)
    assert said == {"records": 3, "set_aside": len(BAD)}
    first = bag(staging.read_staged(spark, target))
    assert staging.stage_day(spark, str(tmp_path), target, day, bad) == said
    assert bag(staging.read_staged(spark, target)) == first
    assert {row[-3:] for row in first} == {(2019, 2, 20190222)}
    assert os.path.isdir(f"{target}/y=2019/m=2/d=20190222")
    reasons = spark.read.parquet(bad).select("reason", "d").groupBy("reason", "d").count()
    assert bag(reasons) == [("malformed", 20190222, 1), ("not_an_array_of_objects", 20190222, len(BAD) - 1)]


def test_stage_day_that_becomes_empty(spark, tmp_path, folder):
    target, day = folder("staged"), dt.date(2019, 2, 22)
    land(tmp_path / "one", "20190222", {"a": '[{"cik":"1"}]'})
    staging.stage_day(spark, str(tmp_path / "one"), target, day)
    land(tmp_path / "two", "20190222", {"a": FILES["truncated"]})
    assert staging.stage_day(spark, str(tmp_path / "two"), target, day) == {"records": 0, "set_aside": 1}
    assert staging.read_staged(spark, target).count() == 0


def test_stage_day_without_files(spark, tmp_path, folder):
    target = folder("staged")
    assert staging.stage_day(spark, str(tmp_path), target) == {"records": 0, "set_aside": 0}
    assert staging.read_staged(spark, target).count() == 0


def test_write_days_replaces_only_its_days(spark, folder):
    target = folder("staged")

    def rows(*pairs):
        records = spark.createDataFrame(list(pairs), "ymd string, cik string")
        return staging.staged_rows(records)

    staging.write_days(rows(("20190222", "1"), ("20190223", "2")), target)
    staging.write_days(rows(("20190223", "3")), target)
    staged = staging.read_staged(spark, target)
    assert bag(staged.select("cik", "y", "m", "d")) == [("1", 2019, 2, 20190222), ("3", 2019, 2, 20190223)]
    plan = staged.filter("d = 20190222")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_partition_path(spark):
    day = spark.range(1).select(times.as_of_day(F.lit(dt.date(2019, 3, 1))).alias("day"))
    got = day.select(times.partition_path(F.col("day")), times.input_prefix("raw/", F.col("day"))).first()
    assert tuple(got) == ("y=2019/m=2/d=20190228", "raw/20190228/")


def test_conform(spark):
    schema = T.StructType([
        T.StructField("i", T.IntegerType()), T.StructField("f", T.DoubleType()), T.StructField("gone", T.StringType())])
    df = spark.createDataFrame([(1, 2**31 - 1, 3)], "extra int, i long, f long")
    once = conform(df, schema)
    assert once.schema == schema and bag(once) == [(2**31 - 1, 3.0, None)]
    assert bag(conform(once, schema)) == bag(once)
    assert conform(df, schema, {"i": "n"}).columns == ["n", "f", "gone"]
    with pytest.raises(PySparkException):
        conform(spark.createDataFrame([(2**31,)], "i long"), schema).collect()


def test_staged_schema_order():
    assert STAGED_FILING.names == ["cik", "date", "formtype", "inter_url", "companyname", "formurl"]
