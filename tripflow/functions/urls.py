"""URL parts by plain text rules, so that URLs without a scheme work too."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def _without(url: Column, *prefixes: str) -> Column:
    return reduce(lambda u, p: F.replace(u, F.lit(p), F.lit("")), prefixes, url)


def _before(text: Column, mark: str) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(1))


def url_host(url: Column | str) -> Column:
    bare = _without(as_col(url), "android-app://", "http://", "https://")
    return _before(_before(bare, "/"), "?")


def url_path(url: Column | str) -> Column:
    """Text after the first slash up to `?`. Without a slash: empty when there is a query, else the
    whole text."""
    bare = _without(as_col(url), "http://", "https://")
    slash, query = F.locate("/", bare), F.locate("?", bare)
    after_slash = _before(F.substring(bare, slash + 1, F.length(bare)), "?")
    return (F.when(slash > 0, after_slash)
            .when(query > 0, F.lit(""))
            .otherwise(bare))


def url_parameter(url: Column | str, name: str) -> Column:
    """Text between `name=` and the next `&`; NULL when empty or absent."""
    value = F.split_part(as_col(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(_before(value, "&"), F.lit(""))
