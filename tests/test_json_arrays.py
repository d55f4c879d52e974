"""Files of one JSON array each, read by byte ranges of any size, against Spark's own multi-line reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tablesync.plans import fixtures as fx
from tablesync.session import scratch_path
from tablesync.sinks.files import write_json_multiline
from tablesync.sources.files import read_json
from tablesync.sources.json_arrays import read_json_array

from conftest import SF_SMALL

SCHEMA = "id long, s string, a array<string>, o struct<x: string, y: array<struct<z: string>>>"


def element(rnd, n):
    text = lambda: "".join(rnd.choice(['a', ',', '"', "\\", "{", "}", "[", "]", "é", "\n", " ", ":", "\\\\", "😀"]) for _ in range(rnd.randint(0, 12)))
    return {"id": n, "s": text(), "a": [text() for _ in range(rnd.randint(0, 3))], "o": {"x": text(), "y": [{"z": text()} for _ in range(rnd.randint(0, 2))]}}


@pytest.fixture
def ranges(spark):
    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield of
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [17, 100, 1000, 1 << 27])
def test_arrays_by_ranges(spark, ranges, size):
    rnd = random.Random(size)
    root = scratch_path(spark, "t_arrays")
    texts = [
        json.dumps([element(rnd, n) for n in range(15)]),
        json.dumps([element(rnd, n) for n in range(15, 25)], indent=3, ensure_ascii=False),
        " \n[ ]\n", json.dumps([element(rnd, 25)]) + "\n", json.dumps(element(rnd, 26)), json.dumps(element(rnd, 27), indent=1), "[\n" + ",\n".join(json.dumps(element(rnd, n)) for n in range(28, 33)) + "\n]",
        json.dumps([{"id": 40, "s": ",,,,\\,," * 30}, {"id": 41}]),
    ]
    for n, x in enumerate(texts):
        spark.createDataFrame([(x,)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{root}/f{n}")
    paths = [f"{root}/f{n}" for n in range(len(texts))]
    want = sorted(map(str, read_json(spark, paths, SCHEMA, multiline=True).collect()))
    ranges(size)
    got = read_json_array(spark, paths, SCHEMA)
    assert sorted(map(str, got.collect())) == want and len(want) == 35


def test_one_array_is_read_by_several_tasks(spark, ranges):
    path = scratch_path(spark, "t_one_array")
    orders = fx.table(spark, SF_SMALL, "orders")
    write_json_multiline(orders.coalesce(1), path)
    assert read_json(spark, path, orders.schema, multiline=True).rdd.getNumPartitions() == 1
    ranges(32 << 10)
    split = read_json_array(spark, path, orders.schema)
    assert split.select(F.spark_partition_id().alias("p")).distinct().count() > 3
    assert split.exceptAll(orders).count() == 0 and split.count() == orders.count()


def test_bad_elements_and_missing_files(spark):
    path = scratch_path(spark, "t_bad_array")
    spark.createDataFrame([('[{"id": 1}, {"id": "x"}, 5, {"id": 2}]',)], "value string").write.text(path)
    assert sorted(r["id"] or 0 for r in read_json_array(spark, path, SCHEMA).collect()) == [0, 0, 1, 2]
