"""Names, slugs and keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the data contract: tokens that stand for "no value" in text columns.
NULL_TOKENS = ["", "nan", "None", "null", "NULL"]

# Session name -> abbreviation.
SESSION_ABBREVIATIONS = {
    "Practice 1": "P1",
    "Practice 2": "P2",
    "Practice 3": "P3",
    "Qualifying": "Q",
    "Sprint Qualifying": "SQ",
    "Sprint Shootout": "SS",
    "Sprint": "S",
    "Race": "R",
}

# Session type -> abbreviation used for predictions; anything else is Q.
PREDICTION_SESSIONS = {"sprint_qualifying": "SQ", "sprint_shootout": "SS", "sprint": "S"}

# A capital with small letters starts a new part, so does a capital after a small letter or digit.
_WORD_START = "(.)([A-Z][a-z]+)"
_CAPITAL_AFTER = "([a-z0-9])([A-Z])"


def snake_name(name: str) -> str:
    return re.sub(_CAPITAL_AFTER, r"\1_\2", re.sub(_WORD_START, r"\1_\2", name)).lower()


def snake_case(name: Column) -> Column:
    parts = F.regexp_replace(F.regexp_replace(name, _WORD_START, "$1_$2"), _CAPITAL_AFTER, "$1_$2")
    return F.lower(parts)


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def event_slug(event_name: Column) -> Column:
    """Path-safe name of an event without the words "Grand Prix"."""
    short = F.trim(F.replace(F.coalesce(event_name, F.lit("")), F.lit("Grand Prix"), F.lit("")))
    # The accented name has to be replaced before other characters become underscores.
    plain = F.replace(short, F.lit("São Paulo"), F.lit("sao_paulo"))
    plain = F.replace(plain, F.lit("Mexico City"), F.lit("mexico_city"))
    squeezed = F.regexp_replace(F.lower(plain), "[^a-z0-9]+", "_")
    return F.btrim(squeezed, F.lit("_"))


def event_key(event_year: Column, event_name: Column) -> Column:
    return F.concat_ws("_", event_year.cast("string"), F.replace(F.trim(event_name), F.lit(" "), F.lit("_")))


def event_key_year(key: Column) -> Column:
    return F.substring_index(key, "_", 1).try_cast("int")


def event_key_name(key: Column) -> Column:
    return F.replace(F.regexp_extract(key, "^[^_]*_(.*)$", 1), F.lit("_"), F.lit(" "))


def session_type(session_name: Column) -> Column:
    """Kind of session; the special cases come first, so the order of the rules matters."""
    name = F.lower(session_name)
    return (
        F.when(session_name.isNull(), None)
        .when(name.contains("shootout"), "sprint_shootout")
        .when(name.contains("sprint qualifying"), "sprint_qualifying")
        .when(name.contains("practice"), "practice")
        .when(name.contains("race") | (name == "r"), "race")
        .when(name.contains("qualifying") | name.startswith("q"), "qualifying")
        .when(name.contains("sprint") | (name == "s"), "sprint")
        .otherwise("unknown")
    )


def session_abbreviation(session_name: Column) -> Column:
    known = F.create_map(*[F.lit(v) for pair in SESSION_ABBREVIATIONS.items() for v in pair])
    return F.coalesce(F.try_element_at(known, session_name), F.upper(F.substring(session_name, 1, 1)))


def prediction_session(kind: Column) -> Column:
    chosen = F.lit(None).cast("string")
    for name, abbreviation in PREDICTION_SESSIONS.items():
        chosen = F.when(kind == name, abbreviation).otherwise(chosen)
    return F.coalesce(chosen, F.lit("Q"))


def null_if_token(value: Column) -> Column:
    return F.when(~value.isin(NULL_TOKENS), value)


def clear_tokens(df: DataFrame) -> DataFrame:
    return df.select(
        *[null_if_token(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes]
    )
