from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.changes import attrs_differ

CASES = [
    # type, left, right, differs null-safe, differs with sentinels
    ("string", None, None, False, False),
    ("string", None, "", True, False),
    ("string", "a", "", True, True),
    ("int", None, 0, True, False),
    ("bigint", None, 0, True, False),
    ("bigint", None, 5, True, True),
    ("double", None, 1.0, True, False),
    ("double", None, 0.0, True, True),
    ("float", None, 1.0, True, False),
    ("double", float("nan"), float("nan"), False, False),
    ("boolean", None, False, True, False),
    ("boolean", None, True, True, True),
    ("date", None, date(2020, 1, 1), True, True),
    ("date", date(2020, 1, 1), None, True, True),
    ("date", None, date(9999, 12, 31), True, False),
]


@pytest.mark.parametrize("dtype,left,right,null_safe,sentinels", CASES)
def test_attrs_differ(spark, dtype, left, right, null_safe, sentinels):
    df = spark.createDataFrame([(left, right)], f"l {dtype}, r {dtype}")
    pair = [(F.col("l"), F.col("r"), df.schema["l"].dataType)]
    row = df.select(attrs_differ(pair).alias("a"), attrs_differ(pair, null_sentinels=True).alias("b")).first()
    assert (row.a, row.b) == (null_safe, sentinels)


def test_no_attributes_never_differ(spark):
    assert spark.range(1).select(attrs_differ([]).alias("d")).first().d is False


def test_type_without_sentinel_is_refused(spark):
    pair = [(F.lit(1), F.lit(2), T.TimestampType())]
    with pytest.raises(TypeError):
        attrs_differ(pair, null_sentinels=True)
