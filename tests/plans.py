"""Plans as text."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def formatted(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
