"""Layouts of the raw files and of the warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The missing-value marker and the column names of the seven raw files.
SENTINEL = "\\N"
RAW_COLUMNS = {
    "title.basics": (
        "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes genres"
    ),
    "title.ratings": "tconst averageRating numVotes",
    "title.episode": "tconst parentTconst seasonNumber episodeNumber",
    "title.principals": "tconst ordering nconst category job characters",
    "title.crew": "tconst directors writers",
    "title.akas": "titleId ordering title region language types attributes isOriginalTitle",
    "name.basics": "nconst primaryName birthYear deathYear primaryProfession knownForTitles",
}
# The categories that make a principal a cast member; every other one is crew.
CAST_CATEGORIES = ("self", "actor", "actress")


def raw_schema(name: str) -> T.StructType:
    """All-string schema of one raw file."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[name].split()])


@dataclass(frozen=True)
class Table:
    """A warehouse table; NOT NULL, VARCHAR(n) and SMALLINT are read off the schema."""

    columns: T.StructType
    unique: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return self.columns.fieldNames()


def _col(name: str, kind: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, kind, nullable=not required)


_ID, _SHORT, _INT, _BOOL = T.LongType(), T.ShortType(), T.IntegerType(), T.BooleanType()
_RATING, _text = T.DecimalType(10, 1), T.VarcharType

_PERSON = T.StructType([
    _col("id", _ID, True),
    _col("name", _text(200), True),
    _col("age", _SHORT),
    _col("is_alive", _BOOL),
    _col("nconst", _text(15), True),
])

# What columns of the raw text are cast to.
RAW_TYPES = {
    "title.basics": {"startYear": "smallint", "endYear": "smallint", "runtimeMinutes": "smallint"},
    "title.ratings": {"averageRating": "decimal(10,1)", "numVotes": "int"},
    "title.episode": {"seasonNumber": "smallint", "episodeNumber": "smallint"},
    "name.basics": {"birthYear": "int", "deathYear": "int"},
}

# Names, types, text lengths, keys and references of the seven tables.
TABLES = {
    "download_date": Table(
        T.StructType([
            _col("id", _ID, True),
            _col("year", _SHORT, True),
            _col("month", _SHORT, True),
            _col("day", _SHORT, True),
        ]),
        unique=("id",),
    ),
    "titles": Table(
        T.StructType([
            _col("id", _ID, True),
            _col("download_date_id", _ID),
            _col("tconst", _text(20), True),
            _col("type", _text(40)),
            _col("primary_title", _text(800), True),
            _col("original_title", _text(800)),
            _col("is_adult", _BOOL),
            _col("start_year", _SHORT),
            _col("end_year", _SHORT),
            _col("runtime_minutes", _SHORT),
            _col("av_rating", _RATING),
            _col("num_votes", _INT),
            _col("genre_1", _text(25)),
            _col("genre_2", _text(25)),
            _col("genre_3", _text(25)),
        ]),
        unique=("id", "tconst"),
        references={"download_date_id": "download_date"},
    ),
    "episodes": Table(
        T.StructType([
            _col("id", _ID, True),
            _col("title_id", _ID),
            _col("season", _SHORT),
            _col("total_episodes", _SHORT),
        ]),
        unique=("id",),
        references={"title_id": "titles"},
    ),
    "casts": Table(_PERSON, unique=("id",)),
    "crew": Table(_PERSON, unique=("id",)),
    "titles_casts": Table(
        T.StructType([_col("title_id", _ID), _col("cast_id", _ID), _col("character", _text(300))]),
        references={"title_id": "titles", "cast_id": "casts"},
    ),
    "titles_crew": Table(
        T.StructType([_col("title_id", _ID), _col("crew_id", _ID), _col("role", _text(50))]),
        references={"title_id": "titles", "crew_id": "crew"},
    ),
}
