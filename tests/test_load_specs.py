from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from tidemark.entities import DIM_BUSINESSES, DIM_USERS, entity_spec, entity_specs
from tidemark.load import LoadContext, stamp
from tidemark.specs import DimSpec, Field


def test_load_context_is_typed():
    assert LoadContext.parse("2", "2001-12-08") == LoadContext(2, date(2001, 12, 8))
    for bad in [("1", date(2001, 1, 1)), (True, date(2001, 1, 1)), (1, "2001-01-01"), (1, datetime(2001, 1, 1))]:
        with pytest.raises(TypeError):
            LoadContext(*bad)


def test_stamp(spark):
    stamped = stamp(spark.range(1), LoadContext(7, date(2020, 1, 1)))
    assert stamped.dtypes == [("id", "bigint"), ("ctl_loading", "int"), ("ctl_loading_date", "date")]
    assert stamped.collect() == [(0, 7, date(2020, 1, 1))]


def test_dimension_specs():
    assert len(DIM_BUSINESSES.attributes) == 10 and len(DIM_USERS.attributes) == 19
    assert DIM_BUSINESSES.columns[:2] == ["business_id", "business_nk"]
    assert DIM_BUSINESSES.columns[-4:] == ["ctl_loading", "effective_from", "effective_to", "is_current"]
    assert DIM_USERS.schema["user_yelping_since"].dataType == T.DateType()


def test_dimension_needs_keys_and_distinct_names():
    key, text = Field("nk", T.StringType(), "id"), T.StringType()
    with pytest.raises(ValueError):
        DimSpec("d", "e", (), (key,), ())
    with pytest.raises(ValueError):
        DimSpec("d", "e", ("sk",), (), ())
    with pytest.raises(ValueError):
        DimSpec("d", "e", ("sk",), (key,), (Field("nk", text, "x"),))


def test_conform_renames_casts_and_prunes(spark):
    spec = DimSpec(
        "d", "e", ("sk",), (Field("nk", T.StringType(), "id"),),
        (Field("n", T.IntegerType(), "count"), Field("since", T.DateType(), "day")),
    )
    raw = spark.createDataFrame(
        [("a", 3, "2020-01-02 10:00:00", "x"), ("b", None, "soon", "y")], "id string, count long, day string, more string"
    )
    conformed = spec.conform(raw)
    assert conformed.dtypes == [("nk", "string"), ("n", "int"), ("since", "date")]
    assert sorted(conformed.collect()) == [("a", 3, date(2020, 1, 2)), ("b", None, None)]


def test_entities():
    assert [s.name for s in entity_specs("raw_")] == ["raw_business", "raw_checkin", "raw_review", "raw_tip", "raw_user"]
    assert entity_spec("tip").options["allowSingleQuotes"] == "true"
    assert entity_spec("tip", declared=False).schema is None
