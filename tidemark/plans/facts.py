"""The three snapshot facts of a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.entities import DIM_BUSINESSES, DIM_USERS
from tidemark.functions.dates import explode_dates, text_to_date
from tidemark.load import LoadContext, stamp
from tidemark.operators.lookup import lookup_effective

# Declared schemas of the published facts.
FACT_SCHEMAS = {
    "fact_checkins": "business_id BIGINT, checkin_date DATE, cnt_appearance BIGINT",
    "fact_reviews": """business_id BIGINT, user_id BIGINT, review_nk STRING, review_date DATE,
        review_text_desc STRING, review_stars DOUBLE, review_useful_cnt BIGINT, review_funny_cnt BIGINT,
        review_cool_cnt BIGINT""",
    "fact_tips": """business_id BIGINT, user_id BIGINT, tips_date DATE, tips_cnt BIGINT,
        tips_sum_of_compliments BIGINT""",
}

BUSINESS_KEY, USER_KEY = {"_business": "business_nk"}, {"_user": "user_nk"}


def _with_business(rows: DataFrame, dim_businesses: DataFrame, load: LoadContext) -> DataFrame:
    return lookup_effective(rows, dim_businesses, DIM_BUSINESSES, BUSINESS_KEY, load.load_date)


def _with_user(rows: DataFrame, dim_users: DataFrame, load: LoadContext) -> DataFrame:
    return lookup_effective(rows, dim_users, DIM_USERS, USER_KEY, load.load_date)


def checkin_dates(checkin: DataFrame) -> DataFrame:
    """One row per check-in out of the comma-separated lists; a malformed item has a NULL date."""
    items = checkin.select("business_id", explode_dates(F.col("date")).alias("item"))
    return items.select("business_id", text_to_date(F.col("item")).alias("checkin_date"))


def fact_checkins(checkin: DataFrame, dim_businesses: DataFrame, load: LoadContext) -> DataFrame:
    """Check-ins per business and day.

    Counted per natural key before the lookup, so that a busy (or missing) key meets the join with one row
    per day, and added up again after it, since all unknown businesses become one member.
    """
    days = checkin_dates(checkin).withColumnRenamed("business_id", "_business")
    per_key = days.groupBy("_business", "checkin_date").agg(F.count("*").alias("_checkins"))
    known = _with_business(per_key, dim_businesses, load)
    counted = known.groupBy("business_id", "checkin_date").agg(F.sum("_checkins").alias("cnt_appearance"))
    return stamp(counted, load)


def fact_reviews(
    review: DataFrame, dim_businesses: DataFrame, dim_users: DataFrame, load: LoadContext
) -> DataFrame:
    """Every review with its business and user."""
    rows = review.select(
        F.col("business_id").alias("_business"),
        F.col("user_id").alias("_user"),
        F.col("review_id").alias("review_nk"),
        text_to_date(F.col("date")).alias("review_date"),
        F.col("text").alias("review_text_desc"),
        F.col("stars").alias("review_stars"),
        F.col("useful").alias("review_useful_cnt"),
        F.col("funny").alias("review_funny_cnt"),
        F.col("cool").alias("review_cool_cnt"),
    )
    known = _with_user(_with_business(rows, dim_businesses, load), dim_users, load)
    columns = [c for c in rows.columns if c not in ("_business", "_user")]
    return stamp(known.select("business_id", "user_id", *columns), load)


def fact_tips(tip: DataFrame, dim_businesses: DataFrame, dim_users: DataFrame, load: LoadContext) -> DataFrame:
    """Tips and their compliments per business, user and day."""
    rows = tip.select(
        F.col("business_id").alias("_business"),
        F.col("user_id").alias("_user"),
        text_to_date(F.col("date")).alias("tips_date"),
        "compliment_count",
    )
    known = _with_user(_with_business(rows, dim_businesses, load), dim_users, load)
    counted = known.groupBy("business_id", "user_id", "tips_date").agg(
        F.count("*").alias("tips_cnt"), F.sum("compliment_count").alias("tips_sum_of_compliments")
    )
    return stamp(counted, load)


def rejected_dates(rows: DataFrame, day: str) -> DataFrame:
    """Number of rows whose date was missing or malformed."""
    return rows.agg(F.count_if(F.col(day).isNull()).alias("rejected"))
