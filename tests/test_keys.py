from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.plans import formatted
from tidemark.operators.keys import (
    assign_surrogates,
    dense_number,
    drop_null_keys,
    latest_per_key,
    lay_out,
    rejected_keys,
    require_unique,
)


def test_null_keys_are_dropped_and_counted(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, n int")
    assert [r.k for r in drop_null_keys(df, ["k", "n"]).collect()] == ["a"]
    assert rejected_keys(df, ["k", "n"]).first().rejected == 2


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w")], "k string, n int, v string")
    newest = [F.col("n").desc()]
    assert sorted(r.v for r in latest_per_key(df, ["k"], newest, ties="keep").collect()) == ["w", "y", "z"]
    assert sorted(r.v for r in latest_per_key(df, ["k"], [*newest, F.col("v")]).collect()) == ["w", "y"]
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], newest, ties="drop")


def test_hot_key_is_ranked_before_the_shuffle(spark):
    newest = latest_per_key(spark.range(100).withColumn("k", F.col("id") % 2), ["k"], [F.col("id").desc()])
    plan = formatted(newest)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan
    assert sorted(r.id for r in newest.collect()) == [98, 99]


def test_second_row_of_a_key_fails(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "k string, n int")
    assert require_unique(df, ["k", "n"]).count() == 3
    with pytest.raises(Exception, match="more than one row for key"):
        require_unique(df, ["k"]).collect()


@pytest.fixture(params=["true", "false"], ids=["coalesced", "all-partitions"])
def coalescing(spark, request):
    """Small data end up in one partition unless coalescing is off; both ways must number alike."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield request.param == "true"
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("rows", [0, 1, 7, 1500])
def test_numbering_equals_global_row_number(spark, coalescing, rows):
    random.seed(rows)
    keys = random.sample(range(10_000_000), rows)
    df = spark.createDataFrame([(f"k{k}", k % 3) for k in keys], "nk string, part int").repartition(7)
    used = spark.createDataFrame([(41,), (5,)], "sk long")
    numbered = assign_surrogates(df, ["sk"], ["part", "nk"], existing=used).select("sk", "nk")
    expected = df.select((F.row_number().over(Window.orderBy("part", "nk")) + 41).cast("long").alias("sk"), "nk")
    assert sorted(numbered.collect()) == sorted(expected.collect())


def test_skipped_rows_leave_no_gap(spark, coalescing):
    df = spark.range(500).select(F.format_string("k%03d", "id").alias("nk"), (F.col("id") % 3 == 0).alias("old"))
    laid_out = lay_out(df, ["nk"], skip=F.col("old"))
    partitions = laid_out.select(F.shiftrightunsigned("_slot", 33)).distinct().count()
    assert (partitions == 1) if coalescing else (partitions > 4)
    got = dense_number(laid_out, "n").orderBy("nk").collect()
    assert [r.n for r in got if not r.old] == list(range(1, 334))
    assert {r.n for r in got if r.old} == {None}


def test_several_surrogates_continue_separately(spark):
    df = spark.createDataFrame([("b",), ("a",)], "nk string")
    used = spark.createDataFrame([(10, 100)], "s1 long, s2 long")
    assert sorted(assign_surrogates(df, ["s1", "s2"], ["nk"], used).collect()) == [("a", 11, 101), ("b", 12, 102)]


def test_rows_are_not_drawn_into_one_task(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("nk"), F.lit("payload").alias("v"))
    plan = formatted(assign_surrogates(df, ["sk"], ["nk"]))
    single = [block for block in plan.split("\n\n") if "SinglePartition" in block]
    assert all("payload" not in block and "nk#" not in block for block in single)
