"""Declarative descriptions of raw entities and of dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.load import LOAD_ID

EFFECTIVE_FROM = "effective_from"
EFFECTIVE_TO = "effective_to"
IS_CURRENT = "is_current"

# In a stored dimension: a digest of a version's attributes, by which a load tells changed members.
DIGEST = "_attributes_digest"

# Fixed value: the open end of a version's validity.
OPEN_END = date(9999, 12, 31)

# A line that does not fit, whole; and what a line holds beside the declared fields (NULL if it is no JSON object).
CORRUPT_RECORD = "_corrupt_record"
EXTRA_FIELDS = "_extra_fields"


@dataclass(frozen=True)
class EntitySpec:
    """A raw entity in the landing area: ``<root>/<name>.<fmt>``.

    With ``schema=None`` Spark infers the schema, at the price of one more pass over the files.
    """

    name: str
    fmt: str = "json"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None


@dataclass(frozen=True)
class Field:
    """One dimension column: its target name, its declared type and the source column it comes from."""

    name: str
    dtype: T.DataType
    source: str

    def conformed(self) -> Column:
        # Dates arrive as text of mixed quality; a bad one becomes NULL, any other bad value fails the load.
        cast = F.col(self.source).try_cast if isinstance(self.dtype, T.DateType) else F.col(self.source).cast
        return cast(self.dtype).alias(self.name)


@dataclass(frozen=True)
class DimSpec:
    """A slowly changing dimension (type 2) over one source entity.

    With ``digests`` its table stores a digest of each version's attributes, by which a load tells changed members without
    reading or shuffling the attributes of the others. That costs a hash of every current row and spares network, so it
    """

    table: str
    entity: str
    surrogates: tuple[str, ...]
    keys: tuple[Field, ...]
    attributes: tuple[Field, ...]
    digests: bool = False

    def __post_init__(self) -> None:
        if not self.surrogates or not self.keys:
            raise ValueError(f"{self.table}: a dimension needs a surrogate and a natural key")
        names = self.columns
        if len(set(names)) != len(names):
            raise ValueError(f"{self.table}: duplicate column names in {names}")

    @property
    def key_names(self) -> list[str]:
        return [f.name for f in self.keys]

    @property
    def attribute_names(self) -> list[str]:
        return [f.name for f in self.attributes]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(s, T.LongType()) for s in self.surrogates]
            + [T.StructField(f.name, f.dtype) for f in self.keys + self.attributes]
            + [
                T.StructField(LOAD_ID, T.IntegerType()),
                T.StructField(EFFECTIVE_FROM, T.DateType()),
                T.StructField(EFFECTIVE_TO, T.DateType()),
                T.StructField(IS_CURRENT, T.BooleanType()),
            ]
        )

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def stored_schema(self) -> T.StructType:
        """The schema with the digest that lies in the table besides."""
        return self.schema.add(DIGEST, T.BinaryType())

    def digest(self) -> Column:
        """SHA-256 of all attributes. Equal for rows whose attributes are equal, NULL to NULL only; 0.0 is -0.0."""

        def text(f: Field) -> Column:
            value = F.col(f.name) + F.lit(0.0) if isinstance(f.dtype, (T.FloatType, T.DoubleType)) else F.col(f.name)
            shown = value.cast("string")
            return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))

        return F.unhex(F.sha2(F.concat(F.lit(""), *[text(f) for f in self.attributes]), 256))

    def conform(self, source: DataFrame) -> DataFrame:
        """Rename and cast the mapped source columns once; unmapped ones are pruned from the scan."""
        return source.select(*[f.conformed() for f in self.keys + self.attributes])
