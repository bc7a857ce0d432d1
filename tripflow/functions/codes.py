"""Code mappings and forgiving casts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import VENDOR_NAMES
from ._cols import as_col


def safe_cast(value: Column | str, data_type: str) -> Column:
    """Cast that gives NULL where the value does not fit the type."""
    return as_col(value).try_cast(data_type)


def map_values(value: Column | str, mapping: dict) -> Column:
    """CASE over a dictionary; values not listed give NULL."""
    value = as_col(value)
    first, *rest = mapping.items()
    return reduce(lambda c, kv: c.when(value == kv[0], kv[1]), rest,
                  F.when(value == first[0], first[1]))


def vendor_name(vendor_id: Column | str) -> Column:
    return map_values(vendor_id, VENDOR_NAMES)


def encode_base_id(base: Column | str) -> Column:
    """Dispatch-base code: one letter, then a number of any length. Multiples of 7 become
    `s/<hex>`, other multiples of 3 `a/<hex>`, the rest `e/<hex>`; NULL when what follows the letter
    is no number of 64 bits."""
    number = F.substr(as_col(base), F.lit(2)).try_cast("bigint")
    tag = F.when(number % 7 == 0, "s/").when(number % 3 == 0, "a/").otherwise("e/")
    return F.concat(tag, F.hex(number))
