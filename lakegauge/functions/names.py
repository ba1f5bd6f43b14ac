"""Dataset names and archive addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name pattern `<source>[_po]_<year>` and the address rewrite.
_NAME = r"^(.+?)(_po)?_([0-9]{4})$"
_RAW_ADDRESS = r"^https://github\.com/([^/]+)/([^/]+)/raw/(.+)$"
_RAW_HOST = "https://raw.githubusercontent.com/$1/$2/$3"


def _part(name: Column, group: int) -> Column:
    # Empty, not null, where the name does not match or lacks the part.
    return F.regexp_extract(name, _NAME, group)


def name_source(name: Column) -> Column:
    """Source part of a dataset name; the whole name where it does not end in a year."""
    return F.coalesce(F.nullif(_part(name, 1), F.lit("")), name)


def name_season(name: Column) -> Column:
    """Starting year as BIGINT, null where the name does not end in one."""
    return _part(name, 3).try_cast("bigint")


def name_playoffs(name: Column) -> Column:
    """Whether the name carries the playoff marker."""
    return _part(name, 2) != ""


def direct_address(url: Column) -> Column:
    """Repository ``/raw/`` addresses rewritten to the host serving the bytes; others unchanged."""
    return F.regexp_replace(url, _RAW_ADDRESS, _RAW_HOST)
