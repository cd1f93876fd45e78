import datetime
import gzip
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from reelhouse.schemas import RAW_COLUMNS  # noqa: E402
from reelhouse.session import local_session  # noqa: E402
from reelhouse.sources.files import read_raw  # noqa: E402

DROP = datetime.date(2021, 6, 26)

# Rows of a tiny catalogue; N is the missing-value marker.
N = "\\N"
FILM = {
    "title.basics": [
        ["tt01", "movie", "One", "Un", "0", "1990", N, "100", "Drama,War,Crime"],
        ["tt02", "movie", '"Two', "Deux", "1", "1991", N, N, "Drama,War"],
        ["tt03", "short", "Three", "Trois", "0", N, N, "10", "Drama"],
        ["tt04", "movie", "Four", "Quatre", "2", "1993", "1994", "7", N],
        ["tt05", "series", "Five", "Cinq", "0", "99999", "x", "1", "Comedy"],
        ["tt06", "movie", "Unrated", "Sans", "0", "1995", N, "5", "Comedy"],
        ["tt07", "series", "Seven", "Sept", "", "1996", N, "5", "Comedy"],
    ],
    "title.ratings": [
        ["tt01", "8.4", "100"],
        ["tt02", "8.5", "100"],
        ["tt03", "8.5", "100"],
        ["tt04", "1.0", "90"],
        ["tt05", "7.0", N],
        ["tt07", "7.0", "5"],
    ],
    "title.episode": [
        ["te1", "tt05", "1", "1"],
        ["te2", "tt05", "1", "7"],
        ["te3", "tt05", "2", "3"],
        ["te4", "tt05", N, N],
        ["te5", "tt05", N, N],
        ["te6", "tt05", "3", N],
        ["te7", "tt05", N, "4"],
        ["te8", "tt07", N, N],
        ["te9", "tt06", "1", "9"],
    ],
    "title.principals": [
        ["tt01", "1", "nm1", "actor", N, '["Hero"]'],
        ["tt01", "2", "nm2", "actress", N, '["Queen","Maid"]'],
        ["tt01", "3", "nm3", "director", N, N],
        ["tt02", "1", "nm1", "self", N, N],
        ["tt02", "2", "nm4", "writer", "novel", N],
        ["tt02", "3", "nm1", "producer", N, N],
        ["tt03", "1", "nm5", "actor", N, '["King, the [old]"]'],
        ["tt03", "2", "nm3", "director", N, N],
        ["tt06", "1", "nm6", "actor", N, '["Ghost"]'],
        ["tt04", "1", "nm3", "director", N, N],
        ["tt05", "1", "nm9", "actor", N, '["Nobody"]'],
        ["tt05", "2", "nm2", N, N, N],
        ["tt07", "1", "nm2", "actress", N, ""],
    ],
    "name.basics": [
        ["nm1", "Ann", "1950", "2000", "actor", N],
        ["nm2", "Bob", "1960", N, "actor", N],
        ["nm3", "Cid", "1500", N, "director", N],
        ["nm4", "Dee", N, "1999", "writer", N],
        ["nm5", "Ann", N, N, "actor", N],
        ["nm6", "Eve", "1970", N, "actor", N],
        ["nm7", "Unseen", "1980", N, "actor", N],
    ],
}


def write_tsv(path: Path, name: str, rows, header=None, zipped=False) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [header or RAW_COLUMNS[name].split(), *rows]
    text = "".join("\t".join(line) + "\n" for line in lines)
    (gzip.open(path, "wt") if zipped else open(path, "w")).write(text)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("tables"))}
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def drop(tmp_path_factory) -> str:
    """A root folder with one dated drop, some files gzipped."""
    root = tmp_path_factory.mktemp("drops")
    for i, (name, rows) in enumerate(FILM.items()):
        zipped = i % 2 == 1
        suffix = ".tsv.gz" if zipped else ".tsv"
        write_tsv(root / "2021-06" / "26" / f"{name}{suffix}", name, rows, zipped=zipped)
    return str(root)


@pytest.fixture(scope="session")
def film(spark, drop):
    """Decoded raw tables of the tiny catalogue by name."""
    return {name: read_raw(spark, drop, name, DROP) for name in FILM}


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns or ["*"]).collect()), key=repr)
