"""Host and path of a url."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blocklog.llm.text import ascii_lower

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    return ascii_lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _URL, 1))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://` or for null."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _URL, 2)
