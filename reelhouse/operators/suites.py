"""The data-quality suites of the seven raw files, as plain rules."""

from __future__ import annotations

import json


def _exist(*columns: str) -> list[dict]:
    return [{"type": "column_exists", "column": c} for c in columns]


def _not_null(*columns: str) -> list[dict]:
    return [{"type": "not_null", "column": c} for c in columns]


def _rule(kind: str, column: str, **settings) -> dict:
    return {"type": kind, "column": column, **settings}


# 80 expectations in their suite's order. Three notes on them: some fail on sound data
# (a title has many principals, people share names) and are kept as they are; `isOriginalTitle` lists
# the marker as it stands in the files; the not-null rules look at the raw text, where the marker is a
# value, unless a run asks otherwise.
TITLE_KEY, NAME_KEY, MARK = r"tt\d*", r"nm\d*", r"\\N"
SUITES = {
    "name.basics": [
        _rule("unique", "primaryName"),
        *_exist("nconst", "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"),
        *_not_null("nconst", "primaryName", "primaryProfession"),
        _rule("between", "birthYear", min=0, max=2021),
        _rule("between", "deathYear", min=0, max=2021),
        _rule("matches", "nconst", regex=NAME_KEY),
    ],
    "title.akas": [
        *_exist("titleId", "ordering", "title", "region", "types", "attributes", "isOriginalTitle"),
        _rule("length_between", "region", min=2, max=4),
        _rule("matches", "titleId", regex=TITLE_KEY),
        _rule("distinct_set", "isOriginalTitle", members=["0", "1", "\\N"]),
    ],
    "title.basics": [
        *_exist("tconst", "titleType", "primaryTitle", "originalTitle", "isAdult"),
        *_exist("startYear", "endYear", "runtimeMinutes", "genres"),
        _rule("matches", "tconst", regex=TITLE_KEY),
        _rule("unique", "tconst"),
        *_not_null("tconst", "primaryTitle", "originalTitle", "isAdult"),
        *_not_null("startYear", "endYear", "runtimeMinutes", "genres"),
        _rule("distinct_set", "isAdult", members=["0", "1"]),
        _rule("between", "runtimeMinutes", min=1),
    ],
    "title.crew": [
        *_exist("tconst"),
        _rule("unique", "tconst"),
        *_not_null("tconst", "directors"),
        _rule("matches", "tconst", regex=TITLE_KEY),
        _rule("matches_any", "directors", regexes=[NAME_KEY, MARK]),
        _rule("matches_any", "writers", regexes=[NAME_KEY, MARK]),
    ],
    "title.episode": [
        *_exist("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
        _rule("matches", "tconst", regex=TITLE_KEY),
        _rule("matches", "parentTconst", regex=TITLE_KEY),
        _rule("unique", "tconst"),
        {"type": "unique_together", "columns": ["tconst", "parentTconst"]},
    ],
    "title.principals": [
        *_exist("tconst", "ordering", "nconst", "category", "job", "characters"),
        _rule("matches", "tconst", regex=TITLE_KEY),
        _rule("matches", "nconst", regex=NAME_KEY),
        _rule("unique", "tconst"),
        _rule("unique", "nconst"),
        *_not_null("tconst", "nconst", "category"),
    ],
    "title.ratings": [
        *_exist("tconst", "averageRating", "numVotes"),
        _rule("matches", "tconst", regex=TITLE_KEY),
        *_not_null("tconst"),
        _rule("between", "averageRating", min=0, max=10),
        _rule("between", "numVotes", min=0),
        _rule("unique", "tconst"),
    ],
}

# Expectation names found in stored JSON suites, and the rule each one is here.
JSON_NAMES = {
    "expect_column_to_exist": "column_exists",
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_unique": "unique",
    "expect_compound_columns_to_be_unique": "unique_together",
    "expect_column_values_to_match_regex": "matches",
    "expect_column_values_to_match_regex_list": "matches_any",
    "expect_column_values_to_be_between": "between",
    "expect_column_value_lengths_to_be_between": "length_between",
    "expect_column_distinct_values_to_equal_set": "distinct_set",
}
JSON_SETTINGS = {
    "column_list": "columns",
    "regex_list": "regexes",
    "min_value": "min",
    "max_value": "max",
    "value_set": "members",
}


def suite_from_json(text: str) -> list[dict]:
    """Rules of a stored JSON suite."""
    rules = []
    for stored in json.loads(text)["expectations"]:
        settings = {JSON_SETTINGS.get(k, k): v for k, v in stored["kwargs"].items() if v is not None}
        rules.append({"type": JSON_NAMES[stored["expectation_type"]], **settings})
    return rules
