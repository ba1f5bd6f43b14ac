"""Declared schemas of the published sources. Types are declared, never inferred from data.

Three types are in use. Identifiers, clocks, dates and composite scores are STRING even when they
look numeric (a jersey ``00`` must not become ``0``), every integer is BIGINT, and a rate is DOUBLE
even where each observed value parses as an integer.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# Column names, order and types of the published feeds.
_DECLARED = {
    "nbastats": """
        GAME_ID STRING, EVENTNUM BIGINT, EVENTMSGTYPE BIGINT, EVENTMSGACTIONTYPE BIGINT,
        PERIOD BIGINT, WCTIMESTRING STRING, PCTIMESTRING STRING, HOMEDESCRIPTION STRING,
        NEUTRALDESCRIPTION STRING, VISITORDESCRIPTION STRING, SCORE STRING, SCOREMARGIN STRING,
        PERSON1TYPE BIGINT, PLAYER1_ID BIGINT, PLAYER1_NAME STRING, PLAYER1_TEAM_ID BIGINT,
        PLAYER1_TEAM_CITY STRING, PLAYER1_TEAM_NICKNAME STRING, PLAYER1_TEAM_ABBREVIATION STRING,
        PERSON2TYPE BIGINT, PLAYER2_ID BIGINT, PLAYER2_NAME STRING, PLAYER2_TEAM_ID BIGINT,
        PLAYER2_TEAM_CITY STRING, PLAYER2_TEAM_NICKNAME STRING, PLAYER2_TEAM_ABBREVIATION STRING,
        PERSON3TYPE BIGINT, PLAYER3_ID BIGINT, PLAYER3_NAME STRING, PLAYER3_TEAM_ID BIGINT,
        PLAYER3_TEAM_CITY STRING, PLAYER3_TEAM_NICKNAME STRING, PLAYER3_TEAM_ABBREVIATION STRING,
        VIDEO_AVAILABLE_FLAG BIGINT
    """,
    "datanba": """
        evt BIGINT, wallclk STRING, cl STRING, de STRING, locX BIGINT, locY BIGINT, opt1 BIGINT,
        opt2 BIGINT, opt3 BIGINT, opt4 BIGINT, mtype BIGINT, etype BIGINT, opid BIGINT, tid BIGINT,
        pid BIGINT, hs BIGINT, vs BIGINT, epid BIGINT, oftid BIGINT, ord BIGINT, pts BIGINT,
        PERIOD BIGINT, GAME_ID STRING
    """,
    "shotdetail": """
        GRID_TYPE STRING, GAME_ID STRING, GAME_EVENT_ID BIGINT, PLAYER_ID BIGINT,
        PLAYER_NAME STRING, TEAM_ID BIGINT, TEAM_NAME STRING, PERIOD BIGINT,
        MINUTES_REMAINING BIGINT, SECONDS_REMAINING BIGINT, EVENT_TYPE STRING, ACTION_TYPE STRING,
        SHOT_TYPE STRING, SHOT_ZONE_BASIC STRING, SHOT_ZONE_AREA STRING, SHOT_ZONE_RANGE STRING,
        SHOT_DISTANCE BIGINT, LOC_X BIGINT, LOC_Y BIGINT, SHOT_ATTEMPTED_FLAG BIGINT,
        SHOT_MADE_FLAG BIGINT, GAME_DATE STRING, HTM STRING, VTM STRING
    """,
    "matchups": """
        game_id STRING, away_team_id BIGINT, home_team_id BIGINT, team_id BIGINT, team_name STRING,
        team_city STRING, team_tricode STRING, team_slug STRING, person_id BIGINT,
        first_name STRING, family_name STRING, name_i STRING, player_slug STRING, position STRING,
        comment STRING, jersey_num STRING, matchups_person_id BIGINT, matchups_first_name STRING,
        matchups_family_name STRING, matchups_name_i STRING, matchups_player_slug STRING,
        matchups_jersey_num STRING, matchup_minutes STRING, matchup_minutes_sort DOUBLE,
        partial_possessions DOUBLE, percentage_defender_total_time DOUBLE,
        percentage_offensive_total_time DOUBLE, percentage_total_time_both_on DOUBLE,
        switches_on BIGINT, player_points BIGINT, team_points BIGINT, matchup_assists BIGINT,
        matchup_potential_assists BIGINT, matchup_turnovers BIGINT, matchup_blocks BIGINT,
        matchup_field_goals_made BIGINT, matchup_field_goals_attempted BIGINT,
        matchup_field_goals_percentage DOUBLE, matchup_three_pointers_made BIGINT,
        matchup_three_pointers_attempted BIGINT, matchup_three_pointers_percentage DOUBLE,
        help_blocks BIGINT, help_field_goals_made BIGINT, help_field_goals_attempted BIGINT,
        help_field_goals_percentage DOUBLE, matchup_free_throws_made BIGINT,
        matchup_free_throws_attempted BIGINT, shooting_fouls BIGINT
    """,
}

_TYPES = {"STRING": StringType(), "BIGINT": LongType(), "DOUBLE": DoubleType()}


def declare(text: str) -> StructType:
    """Nullable columns from ``name TYPE, ...``, without needing a session."""
    pairs = (item.split() for item in text.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, StructType] = {source: declare(text) for source, text in _DECLARED.items()}


def schema_for(source: str) -> StructType:
    """Declared schema of ``source``; an undeclared source is refused, not guessed."""
    if source not in SCHEMAS:
        raise KeyError(f"{source!r} has no declared schema; declared: {', '.join(sorted(SCHEMAS))}")
    return SCHEMAS[source]
