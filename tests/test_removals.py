from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from forktide.sources import removals


@pytest.fixture(params=["sign", "keys"])
def table(request, spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    rows = spark.range(10).select(
        F.col("id").alias("k"), F.lit(0).alias("w"), (F.col("id") % 2).alias("pool")
    )
    if request.param == "sign":
        rows = rows.withColumn("sign", F.lit(1))
    rows.write.format("parquet").saveAsTable(name)
    return removals.Removable(name, ("k",), "w")


def keys(spark, table):
    return sorted(r["k"] for r in removals.read_rows(spark, table).collect())


def test_remove_and_write_again(spark, table, request):
    report = removals.remove_rows(spark, [table], "pool = :p", {"p": 1})
    assert [r["removed"] for r in report] == [5]
    assert report[0]["kind"] == request.node.callspec.params["table"]
    assert keys(spark, table) == [0, 2, 4, 6, 8]
    assert removals.remove_rows(spark, [table], "pool = 1")[0]["removed"] == 0
    back = spark.table(table.table).filter("k = 3").limit(1).withColumn("w", F.lit(7))
    if "sign" in back.columns:
        back = back.withColumn("sign", F.lit(1))
    back.select(*spark.table(table.table).columns).write.mode("append").insertInto(table.table)
    assert keys(spark, table) == [0, 2, 3, 4, 6, 8]


def test_remove_by_query_and_by_id(spark, table):
    n = removals.remove_by_query(spark, table, f"SELECT * FROM {table.table} WHERE k >= :low", {"low": 7})
    assert n == 3
    assert removals.remove_ids(spark, table, spark.createDataFrame([(1,), (1,), (99,)], "k bigint")) == 1
    assert keys(spark, table) == [0, 2, 3, 4, 5, 6]
