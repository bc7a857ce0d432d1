"""Hashed row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SURROGATE_KEY_NULL
from ._cols import as_col


def _hashed(fields, delimiter: str, null_text: str) -> Column:
    texts = [F.coalesce(as_col(f).cast("string"), F.lit(null_text)) for f in fields]
    return F.md5(F.concat_ws(delimiter, *texts).cast("binary"))


def surrogate_key(fields: list[Column | str], nulls_as_empty: bool = False) -> Column:
    """Hex md5 of the fields as text, joined with `-`; NULL keeps apart from the empty string
    unless `nulls_as_empty`."""
    return _hashed(fields, "-", "" if nulls_as_empty else SURROGATE_KEY_NULL)


def row_fingerprint(fields: list[Column | str], delimiter: str = "-") -> Column:
    """Hex md5 of the natural key of a loaded row, NULL as empty text.

    `delimiter=""` joins the fields directly; ('1', '23') and ('12', '3') then collide.
    """
    return _hashed(fields, delimiter, "")
