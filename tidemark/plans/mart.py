"""The weekly business mart and its three sets of measures."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.averages import average_or_null
from tidemark.operators.loads import latest_load
from tidemark.operators.scd2 import current_rows
from tidemark.operators.weeks import END, START, date_extent, dense_weekly, weekly_sums

KEY = "business_id"
_DAY = "_day"


@dataclass(frozen=True)
class Measures:
    """What one fact contributes per row: its date column and the values to sum.

    A sparse fact shows NULL in weeks without any of its rows; ``rows_as`` names the sum that counts them.
    """

    day: str
    sums: Mapping[str, str]
    rows_as: str | None = None

    def row_values(self) -> dict[str, Column]:
        values = {name: F.coalesce(F.expr(value), F.lit(0)) for name, value in self.sums.items()}
        return values | ({} if self.rows_as is None else {self.rows_as: F.lit(1)})

    @property
    def names(self) -> list[str]:
        return [*self.sums, *([] if self.rows_as is None else [self.rows_as])]


REVIEWS = Measures(
    "review_date",
    {
        "review_useful_cnt": "review_useful_cnt",
        "review_funny_cnt": "review_funny_cnt",
        "review_cool_cnt": "review_cool_cnt",
        "stars_sum": "review_stars",
        "stars_cnt": "CAST(review_stars IS NOT NULL AS BIGINT)",
    },
)
CHECKINS = Measures("checkin_date", {"checkin_appearance_cnt": "cnt_appearance"}, rows_as="checkin_rows")
TIPS = Measures(
    "tips_date", {"tips_cnt": "tips_cnt", "compliments_cnt": "tips_sum_of_compliments"}, rows_as="tip_rows"
)

REVIEW_VOTES = ["review_useful_cnt", "review_funny_cnt", "review_cool_cnt"]


def fact_extent(reviews: DataFrame, checkins: DataFrame, tips: DataFrame) -> DataFrame:
    """Date extent over the newest load of each fact."""
    facts = [(reviews, REVIEWS), (checkins, CHECKINS), (tips, TIPS)]
    return date_extent(*[(latest_load(fact), measures.day) for fact, measures in facts])


def _dense(
    members: DataFrame, facts: list[tuple[DataFrame, Measures]], extent: DataFrame
) -> DataFrame:
    """All measures of the given facts in one aggregation: facts side by side, absent values NULL."""
    names = [name for _, measures in facts for name in measures.names]
    rows = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [
            latest_load(fact).select(
                KEY, F.col(m.day).alias(_DAY), *[value.alias(name) for name, value in m.row_values().items()]
            )
            for fact, m in facts
        ],
    )
    activity = weekly_sums(rows, KEY, _DAY, {name: F.col(name) for name in names})
    return dense_weekly(members, KEY, activity, extent, names)


def _votes() -> list[Column]:
    return [F.col(f"{span}_{vote}") for vote in REVIEW_VOTES for span in ("weekly", "aggregated")]


def _averages() -> list[Column]:
    return [
        average_or_null(F.col(f"{span}_stars_sum"), F.col(f"{span}_stars_cnt")).alias(f"{span}_review_stars_avg")
        for span in ("weekly", "aggregated")
    ]


def _sparse(measures: Measures, fill_idle_weeks: bool) -> list[Column]:
    """Weekly and running columns of a sparse fact, NULL in idle weeks unless these are to be filled."""
    shown = F.lit(True) if fill_idle_weeks else F.col(f"weekly_{measures.rows_as}") > 0
    return [
        F.when(shown, F.col(f"{span}_{name}")).alias(f"{span}_{name}")
        for name in measures.sums
        for span in ("weekly", "aggregated")
    ]


def _business_ids(dim_businesses: DataFrame) -> DataFrame:
    return current_rows(dim_businesses).select(KEY)


def review_measures(dim_businesses: DataFrame, reviews: DataFrame, extent: DataFrame) -> DataFrame:
    """Weekly and running review measures of every current business; dense."""
    dense = _dense(_business_ids(dim_businesses), [(reviews, REVIEWS)], extent)
    return dense.select(KEY, START, END, *_votes(), *_averages())


def checkin_measures(
    dim_businesses: DataFrame, checkins: DataFrame, extent: DataFrame, fill_idle_weeks: bool = False
) -> DataFrame:
    """Weekly and running check-ins of every current business."""
    dense = _dense(_business_ids(dim_businesses), [(checkins, CHECKINS)], extent)
    return dense.select(KEY, START, END, *_sparse(CHECKINS, fill_idle_weeks))


def tip_measures(
    dim_businesses: DataFrame, tips: DataFrame, extent: DataFrame, fill_idle_weeks: bool = False
) -> DataFrame:
    """Weekly and running tips and compliments of every current business."""
    dense = _dense(_business_ids(dim_businesses), [(tips, TIPS)], extent)
    return dense.select(KEY, START, END, *_sparse(TIPS, fill_idle_weeks))


def weekly_business(
    dim_businesses: DataFrame,
    reviews: DataFrame,
    checkins: DataFrame,
    tips: DataFrame,
    fill_idle_weeks: bool = False,
) -> DataFrame:
    """The mart: every current business in every week, with all measures and the business's attributes.

    The calendar runs over the newest load of each fact. Facts of closed versions and of the unknown member
    have no current business and drop out. In weeks without check-ins (or tips) those columns are NULL, the
    running ones too; ``fill_idle_weeks`` shows 0 and the carried totals instead.
    """
    members = current_rows(dim_businesses).select(
        KEY,
        "business_name",
        "business_address",
        "business_city",
        "business_postal_code",
        F.col("business_stars").alias("final_amount_business_stars"),
        F.col("business_review_count").alias("final_amount_business_review_count"),
    )
    extent = fact_extent(reviews, checkins, tips)
    dense = _dense(members, [(reviews, REVIEWS), (checkins, CHECKINS), (tips, TIPS)], extent)
    attributes = [c for c in members.columns if c not in (KEY, "business_name")]
    return dense.select(
        KEY,
        "business_name",
        END,
        *attributes,
        *_votes(),
        *_averages(),
        *_sparse(CHECKINS, fill_idle_weeks),
        *_sparse(TIPS, fill_idle_weeks),
    )
