"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def empty_to_null(text: Column | str) -> Column:
    return F.nullif(as_col(text), F.lit(""))


def slugify(text: Column | str) -> Column:
    """Lower-case identifier: runs of spaces and dashes become `_`, other signs go, `_` before a
    leading digit."""
    plain = F.regexp_replace(F.lower(as_col(text)), "[ -]+", "_")
    plain = F.regexp_replace(plain, "[^a-z0-9_]+", "")
    return F.regexp_replace(plain, "^([0-9])", "_$1")


def slugify_text(text: str) -> str:
    """`slugify` for a plain string, used to name columns."""
    plain = re.sub(r"[^a-z0-9_]+", "", re.sub(r"[ -]+", "_", (text or "").lower()))
    return "_" + plain if plain[:1].isdigit() else plain
