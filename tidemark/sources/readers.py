"""Scans of the landing area and of the lake's own tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import versions
from tidemark.load import LOAD_ID
from tidemark.specs import CORRUPT_RECORD, EXTRA_FIELDS, EntitySpec

EntityReader = Callable[[SparkSession, EntitySpec, str], DataFrame]


def read_entity(spark: SparkSession, spec: EntitySpec, root: str) -> DataFrame:
    """Scan ``<root>/<name>.<fmt>`` (a file or a folder of files) with the entity's own options.

    JSON lines with a declared schema keep all they hold: see :func:`parse_lines`.
    """
    path = f"{root}/{spec.name}.{spec.fmt}"
    if spec.fmt == "json" and spec.schema is not None:
        return parse_lines(spark.read.text(path), spec)
    reader = spark.read.format(spec.fmt).options(**spec.options)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    return reader.load(path)


#: Between the values of a plain line; raw, no JSON text may hold it.
_MARK = "\x01"
_CHARS = '[^"\\\\' + "".join(f"\\x{code:02x}" for code in range(0x20)) + "]*+"  # one by one: a bit set, told in one look
_STRING = rf'"{_CHARS}(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{{4}}){_CHARS})*+"'
_WHOLE = r"(?:0|-?[1-9]\d{0,17}+)"
_NUMBER = r"(?:-?(?:0|[1-9]\d{0,14}+)\.\d{1,30}+(?:[eE][+-]?\d{1,2}+)?+|0|-?[1-9]\d{0,14}+)"
#: Either the last member or a comma; that none follows the comma is seen by the bracket behind it.
_NEXT, _END = r"(?:, ?+|(?=\}))", r"(?<![, ])\}"
#: How values are written whose text means the same cut out of the line or parsed with it.
_PLAIN = {
    "string": _STRING,
    "bigint": _WHOLE,
    "double": _NUMBER,
    "map<string,string>": rf"\{{(?:{_STRING}: ?+(?:{_STRING}|null){_NEXT})*+{_END}",
}


def plain_line(fields: Sequence[T.StructField]) -> str:
    """A pattern of JSON lines with none but the given fields, in their order, each at most once and written as its
    type; a group for each. It never goes back, so a line costs one look."""

    def member(f: T.StructField) -> str:
        value = _PLAIN.get(f.dataType.simpleString())
        if value is None:
            return "()?+"
        return rf'(?:"{re.escape(f.name)}": ?+(?:({value})|null){_NEXT})?+'

    return rf"\A\{{{''.join(map(member, fields))}{_END}\z"


def parse_lines(lines: DataFrame, spec: EntitySpec) -> DataFrame:
    """The declared columns of JSON lines (column ``value``), each line taken apart once, into texts by field.

    A field whose text does not fit its type is NULL and its line is kept; a line that is no JSON object has nothing
    but its text. Fields beyond the schema stay in the map of extra fields.

    Lines as :func:`plain_line` says, whose texts all fit, are cut by that pattern, which costs far less than a parser;
    any other line is parsed.
    """
    declared = [f for f in spec.schema if f.name not in (CORRUPT_RECORD, EXTRA_FIELDS)]
    options = {k: v for k, v in spec.options.items() if k != "columnNameOfCorruptRecord"}
    groups = "".join(f"{_MARK}${n}" for n in range(1, len(declared) + 1))
    cut = F.regexp_replace("value", F.lit(plain_line(declared)), F.lit(groups))
    looked_at = lines.filter(F.trim("value") != "").select("value", cut.alias("cut"))
    plain = F.col("cut") != F.col("value")
    parsed = looked_at.select(
        "value",
        F.when(plain, F.split("cut", _MARK, -1)).alias("texts"),
        F.when(~plain, F.from_json("value", "map<string,string>", options)).alias("fields"),
    )
    plain = F.col("texts").isNotNull()

    def typed(text: Column, field: T.StructField) -> Column:
        if isinstance(field.dataType, T.StringType):
            return text
        if isinstance(field.dataType, (T.MapType, T.StructType, T.ArrayType)):
            return F.from_json(text, field.dataType, options)
        return text.try_cast(field.dataType)

    def cut_out(place: int, field: T.StructField) -> Column:
        text = F.col("texts")[place]
        if isinstance(field.dataType, T.StringType):
            bare = F.substring(text, F.lit(2), F.length(text) - 2)
            escaped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")[0]
            text_of = F.when(F.contains(text, F.lit("\\")), escaped).otherwise(bare)
            return F.when(text != "", text_of)
        return F.when(text != "", typed(text, field))

    by_name = {f.name: F.col("fields")[f.name] for f in declared}
    misfit = [by_name[f.name].isNotNull() & typed(by_name[f.name], f).isNull() for f in declared]
    broken = reduce(or_, misfit, F.col("fields").isNull())
    names = [f.name for f in declared]
    kept = {
        f.name: F.when(plain, cut_out(place, f)).otherwise(typed(by_name[f.name], f))
        for place, f in enumerate(declared, 1)
    }
    kept[CORRUPT_RECORD] = F.when(~plain & broken, F.col("value"))
    beyond = F.map_filter("fields", lambda name, _: ~name.isin(names))
    kept[EXTRA_FIELDS] = F.when(plain, F.create_map().cast("map<string,string>")).otherwise(beyond)
    return parsed.select(*[kept[name].alias(name) for name in spec.schema.names])


def is_record() -> Column:
    """Whether a bronze row came from a JSON object, with or without fields that do not fit."""
    return F.col(CORRUPT_RECORD).isNull() | F.col(EXTRA_FIELDS).isNotNull()


def corrupt_rows(df: DataFrame) -> DataFrame:
    """Rows whose line did not fit the declared schema."""
    return df.filter(F.col(CORRUPT_RECORD).isNotNull())


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None
) -> DataFrame:
    """Scan a lake table, of a published one the newest version. With a schema, partition columns keep their declared
    type (a flag stays boolean)."""
    version = versions.live(spark, path)
    if version is not None:
        return versions.read(spark, path, version, fmt, schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows that the optimizer knows to be empty, so that joins with it vanish."""
    nothing = spark.range(1).filter(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """As :func:`read_table`, but a table that does not exist yet is empty. Any other failure is raised."""
    try:
        return read_table(spark, path, fmt, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def since_load(df: DataFrame, after: int, upto: int | None = None) -> DataFrame:
    """Rows of the loads after ``after`` (and not beyond ``upto``); prunes partitions of a bronze table."""
    chosen = F.col(LOAD_ID) > after
    return df.filter(chosen if upto is None else chosen & (F.col(LOAD_ID) <= upto))
