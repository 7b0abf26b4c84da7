"""Load identity: every row of every layer says which load wrote it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_ID = "ctl_loading"
LOAD_DATE = "ctl_loading_date"

# The columns that stamp() adds.
LOAD_COLUMNS = f"{LOAD_ID} INT, {LOAD_DATE} DATE"


@dataclass(frozen=True)
class LoadContext:
    """One run over the lake. Typed, so that a date or an id never travels as text."""

    load_id: int
    load_date: date

    def __post_init__(self) -> None:
        if isinstance(self.load_id, bool) or not isinstance(self.load_id, int):
            raise TypeError(f"load_id must be an int, got {self.load_id!r}")
        if type(self.load_date) is not date:
            raise TypeError(f"load_date must be a date, got {self.load_date!r}")

    @classmethod
    def parse(cls, load_id: str, load_date: str) -> LoadContext:
        """Build a context from command-line text, e.g. ``parse("2", "2001-12-08")``."""
        return cls(int(load_id), date.fromisoformat(load_date))


def stamp(df: DataFrame, load: LoadContext) -> DataFrame:
    """Add the load id and load date as literal columns."""
    return df.withColumns(
        {
            LOAD_ID: F.lit(load.load_id).cast(T.IntegerType()),
            LOAD_DATE: F.lit(load.load_date),
        }
    )
