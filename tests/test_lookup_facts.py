from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.plans import formatted
from tidemark.entities import DIM_BUSINESSES, DIM_USERS
from tidemark.load import LoadContext
from tidemark.operators.lookup import lookup_effective
from tidemark.plans.facts import checkin_dates, fact_checkins, fact_reviews, fact_tips, rejected_dates

VERSION = "effective_from date, effective_to date"
LOAD = LoadContext(3, date(2020, 2, 1))
OPEN_END = date(9999, 12, 31)


@pytest.fixture
def businesses(spark):
    return spark.createDataFrame(
        [
            (1, "b1", date(2020, 1, 1), date(2020, 1, 31)),
            (2, "b1", date(2020, 2, 1), OPEN_END),
            (3, "b2", date(2020, 1, 1), OPEN_END),
            (4, "b3", date(2020, 3, 1), OPEN_END),
        ],
        f"business_id long, business_nk string, {VERSION}",
    )


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [(7, "u1", date(2020, 1, 1), OPEN_END)], f"user_id long, user_nk string, {VERSION}"
    )


@pytest.mark.parametrize(
    "day,expected",
    [
        (date(2019, 12, 31), [-1, -1, -1, -1]),
        (date(2020, 1, 1), [1, 3, -1, -1]),  # on the first day of a version
        (date(2020, 1, 15), [1, 3, -1, -1]),  # inside
        (date(2020, 1, 31), [1, 3, -1, -1]),  # on its last day
        (date(2020, 2, 1), [2, 3, -1, -1]),
        (date(2021, 1, 1), [2, 3, 4, -1]),
    ],
)
def test_lookup_by_validity(spark, businesses, day, expected):
    rows = spark.createDataFrame([("b1", 1), ("b2", 2), ("b3", 3), (None, 4)], "key string, n int")
    found = lookup_effective(rows, businesses, DIM_BUSINESSES, {"key": "business_nk"}, day)
    assert found.columns == ["n", "business_id"]
    assert [r.business_id for r in found.orderBy("n").collect()] == expected


def test_hot_key_is_split_by_adaptive_execution(spark, tmp_path, businesses):
    path = str(tmp_path / "rows")
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("b1")).otherwise(F.concat(F.lit("b"), F.col("id"))).alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    rows.repartition(8).write.parquet(path)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
    }
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        found = lookup_effective(
            spark.read.parquet(path), businesses, DIM_BUSINESSES, {"key": "business_nk"}, LOAD.load_date
        )
        assert found.groupBy("business_id").count().filter("business_id = 2").first()["count"] == 266_666
        hashed = found.select(F.xxhash64("payload", "business_id").alias("hash"))
        assert len(hashed.collect()) == 400_000
        final = formatted(hashed).split("Initial Plan")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for name in conf:
            spark.conf.unset(name)


def test_checkin_text(spark):
    checkin = spark.createDataFrame(
        [
            ("b1", "2020-01-01 10:00:00, 2020-01-02 11:00:00, 2020-01-01 23:59:59"),
            ("b2", "2020-01-05 00:00:00"),
            ("b3", ""),
            ("b4", None),
            ("b5", "2020-01-01 10:00:00, soon"),
        ],
        "business_id string, date string",
    )
    days = checkin_dates(checkin)
    assert sorted((r[0], str(r[1])) for r in days.collect()) == [
        ("b1", "2020-01-01"), ("b1", "2020-01-01"), ("b1", "2020-01-02"), ("b2", "2020-01-05"),
        ("b3", "None"), ("b5", "2020-01-01"), ("b5", "None"),
    ]
    assert rejected_dates(days, "checkin_date").first().rejected == 2


def test_fact_checkins(spark, businesses):
    checkin = spark.createDataFrame(
        [("b1", "2020-01-01, 2020-01-01"), ("b1", "2020-01-01"), ("x", "2020-01-01"), ("y", "2020-01-01, bad")],
        "business_id string, date string",
    )
    fact = fact_checkins(checkin, businesses, LOAD)
    assert fact.columns == ["business_id", "checkin_date", "cnt_appearance", "ctl_loading", "ctl_loading_date"]
    assert sorted(tuple(r)[:3] for r in fact.filter("checkin_date is not null").collect()) == [
        (-1, date(2020, 1, 1), 2), (2, date(2020, 1, 1), 3),
    ]
    assert [tuple(r)[:3] for r in fact.filter("checkin_date is null").collect()] == [(-1, None, 1)]


REVIEW = (
    "review_id string, user_id string, business_id string, stars double, useful long, funny long, cool long, "
    "text string, date string"
)


def test_fact_reviews_looks_up_each_dimension_by_itself(spark, businesses, users):
    review = spark.createDataFrame(
        [
            ("r1", "u1", "b1", 4.0, 1, 2, 3, "t", "2019-05-06 07:08:09"),
            ("r2", "u1", "nobody", None, None, 0, 0, None, "bad"),
            ("r3", "nobody", "b2", 1.5, 1, 1, 1, "", "2019-05-06"),
        ],
        REVIEW,
    )
    fact = fact_reviews(review, businesses, users, LOAD)
    assert sorted(tuple(r) for r in fact.select("review_nk", "business_id", "user_id").collect()) == [
        ("r1", 2, 7), ("r2", -1, 7), ("r3", 3, -1),
    ]
    first = fact.filter("review_nk = 'r1'").first()
    assert (first.review_date, first.review_stars, first.review_useful_cnt) == (date(2019, 5, 6), 4.0, 1)
    assert (first.ctl_loading, first.ctl_loading_date) == (3, date(2020, 2, 1))


def test_fact_tips(spark, businesses, users):
    tip = spark.createDataFrame(
        [
            ("u1", "b1", "t", "2019-05-06", 2), ("u1", "b1", "t", "2019-05-06 10:00:00", None),
            ("u1", "x", "t", "2019-05-06", 1), ("u1", "y", "t", "2019-05-06", 1),
            ("u1", "b2", "t", "2019-05-06", None),
        ],
        "user_id string, business_id string, text string, date string, compliment_count long",
    )
    fact = fact_tips(tip, businesses, users, LOAD)
    assert sorted(tuple(r)[:5] for r in fact.collect()) == [
        (-1, 7, date(2019, 5, 6), 2, 2), (2, 7, date(2019, 5, 6), 2, 2), (3, 7, date(2019, 5, 6), 1, None),
    ]


def test_lookup_scans_two_columns_of_valid_versions(spark, tmp_path, businesses):
    path = str(tmp_path / "dim")
    businesses.withColumn("is_current", F.lit(True)).withColumn("business_name", F.lit("n")).write.partitionBy(
        "effective_to"
    ).parquet(path)
    rows = spark.range(1).select(F.lit("b1").alias("key"))
    plan = formatted(
        lookup_effective(rows, spark.read.parquet(path), DIM_BUSINESSES, {"key": "business_nk"}, LOAD.load_date)
    )
    assert "ReadSchema: struct<business_id:bigint,business_nk:string,effective_from:date>" in plan
    assert "PartitionFilters: [isnotnull(effective_to" in plan
    assert DIM_USERS.surrogates == ("user_id",)
