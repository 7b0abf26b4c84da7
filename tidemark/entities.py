"""The five raw entities of the business-review data set and the two dimensions built on them."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.specs import CORRUPT_RECORD, EXTRA_FIELDS, DimSpec, EntitySpec, Field

STRING, INT, LONG, DOUBLE, DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()

# File name prefix and JSON fields of the public data set.
FILE_PREFIX = "yelp_academic_dataset_"
COMPLIMENTS = ["hot", "more", "profile", "cute", "list", "note", "plain", "cool", "funny", "writer", "photos"]
TEXT_MAP = T.MapType(STRING, STRING)
RAW_FIELDS: dict[str, dict[str, T.DataType]] = {
    "business": {
        "business_id": STRING, "name": STRING, "address": STRING, "city": STRING, "state": STRING,
        "postal_code": STRING, "latitude": DOUBLE, "longitude": DOUBLE, "stars": DOUBLE,
        "review_count": LONG, "is_open": LONG, "attributes": TEXT_MAP, "categories": STRING, "hours": TEXT_MAP,
    },
    "checkin": {"business_id": STRING, "date": STRING},
    "review": {
        "review_id": STRING, "user_id": STRING, "business_id": STRING, "stars": DOUBLE, "useful": LONG,
        "funny": LONG, "cool": LONG, "text": STRING, "date": STRING,
    },
    "tip": {"user_id": STRING, "business_id": STRING, "text": STRING, "date": STRING, "compliment_count": LONG},
    "user": {
        "user_id": STRING, "name": STRING, "review_count": LONG, "yelping_since": STRING, "useful": LONG,
        "funny": LONG, "cool": LONG, "elite": STRING, "friends": STRING, "fans": LONG, "average_stars": DOUBLE,
        **{f"compliment_{c}": LONG for c in COMPLIMENTS},
    },
}


def raw_schema(entity: str) -> T.StructType:
    """Declared landing schema; a line that does not fit it is kept whole in the corrupt-record column, and fields that
    it does not declare are kept as text by name."""
    fields = [T.StructField(name, dtype) for name, dtype in RAW_FIELDS[entity].items()]
    return T.StructType([*fields, T.StructField(CORRUPT_RECORD, STRING), T.StructField(EXTRA_FIELDS, TEXT_MAP)])


def entity_spec(entity: str, prefix: str = FILE_PREFIX, declared: bool = True) -> EntitySpec:
    return EntitySpec(
        name=prefix + entity,
        options={"allowSingleQuotes": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD},
        schema=raw_schema(entity) if declared else None,
    )


def entity_specs(prefix: str = FILE_PREFIX, declared: bool = True) -> list[EntitySpec]:
    return [entity_spec(entity, prefix, declared) for entity in RAW_FIELDS]

# What is counted of each entity at its load: rows without these fields, and dates in this field that are none.
KEY_FIELDS = {
    "business": ["business_id"], "checkin": ["business_id"], "review": ["review_id", "business_id", "user_id"],
    "tip": ["business_id", "user_id"], "user": ["user_id"],
}
DATE_FIELDS = {"checkin": "date", "review": "date", "tip": "date", "user": "yelping_since"}

# The target column names of both dimensions.
DIM_BUSINESSES = DimSpec(
    table="dim_businesses",
    entity="business",
    surrogates=("business_id",),
    keys=(Field("business_nk", STRING, "business_id"),),
    attributes=tuple(
        Field(f"business_{source}", dtype, source)
        for source, dtype in [
            ("name", STRING), ("address", STRING), ("city", STRING), ("state", STRING), ("postal_code", STRING),
            ("latitude", DOUBLE), ("longitude", DOUBLE), ("stars", DOUBLE), ("is_open", INT), ("review_count", LONG),
        ]
    ),
)

DIM_USERS = DimSpec(
    table="dim_users",
    entity="user",
    surrogates=("user_id",),
    keys=(Field("user_nk", STRING, "user_id"),),
    attributes=(
        Field("user_name", STRING, "name"),
        Field("user_review_count", INT, "review_count"),
        Field("user_yelping_since", DATE, "yelping_since"),
        *[Field(f"user_{vote}_votes", INT, vote) for vote in ("useful", "funny", "cool")],
        Field("user_number_of_fans", INT, "fans"),
        Field("user_average_stars", DOUBLE, "average_stars"),
        *[Field(f"user_received_compliment_{c}", INT, f"compliment_{c}") for c in COMPLIMENTS],
    ),
)
