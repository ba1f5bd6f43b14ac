"""Column functions that turn the feeds' text fields into canonical values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_game_id(game_id: Column) -> Column:
    """The ten-character game id; the feeds drop its leading zeros. Longer ids are left alone."""
    return F.when(F.length(game_id) < 10, F.lpad(game_id, 10, "0")).otherwise(game_id)


def clock_seconds(clock: Column) -> Column:
    """Seconds left in the period from a ``MM:SS`` clock, fractions kept; null for other text."""
    minutes = F.split_part(clock, F.lit(":"), F.lit(1)).try_cast("double")
    seconds = F.split_part(clock, F.lit(":"), F.lit(2)).try_cast("double")
    return F.when(clock.rlike(r"^[0-9]+:[0-9]{1,2}(\.[0-9]+)?$"), minutes * 60 + seconds)


def game_date(text: Column) -> Column:
    """Date from ``YYYYMMDD`` or ISO text; null for other text."""
    compact = F.when(text.rlike(r"^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd"))
    return F.coalesce(compact, F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd")))


def score_part(score: Column, part: int) -> Column:
    """Points from a ``home - visitor`` score: part 1 is home, part 2 the visitor."""
    return F.when(
        score.rlike(r"^\s*[0-9]+\s*-\s*[0-9]+\s*$"),
        F.trim(F.split_part(score, F.lit("-"), F.lit(part))).try_cast("bigint"),
    )


def score_margin(margin: Column) -> Column:
    """Signed margin as BIGINT, a tie being 0."""
    return F.when(margin == "TIE", F.lit(0).cast("bigint")).otherwise(margin.try_cast("bigint"))
