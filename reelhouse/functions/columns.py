"""Column expressions shared by the builders. All of them are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.schemas import SENTINEL


def decode(c: Column) -> Column:
    """The missing-value marker as NULL."""
    return F.nullif(c, F.lit(SENTINEL))


def decode_all(df: DataFrame) -> DataFrame:
    """Every column of a raw table with the marker as NULL (same as reading with `nullValue`)."""
    return df.select(*[decode(F.col(c)).alias(c) for c in df.columns])


def to_type(c: Column, kind: str) -> Column:
    """Text to a type; what does not parse is NULL, under any ANSI setting."""
    return c.try_cast(kind)


def adult_flag(c: Column) -> Column:
    """`0` is false, anything else, also a missing value, is true."""
    return F.when(c == "0", False).otherwise(True)


def list_item(c: Column, position: int) -> Column:
    """Item of a comma list, NULL past its end."""
    return F.get(F.split(c, ","), position)


def age(birth: Column, death: Column, as_of_year: int) -> Column:
    """Years lived, or years up to `as_of_year` while no death is known."""
    born = to_type(birth, "int")
    return F.when(birth.isNotNull() & death.isNotNull(), to_type(death, "int") - born).when(
        birth.isNotNull(), F.lit(as_of_year) - born
    )


def is_alive(birth: Column, death: Column) -> Column:
    """False with both years, true with a birth only, NULL without a birth."""
    return F.when(birth.isNotNull(), death.isNull())


def listed_characters(c: Column, parse: str = "split") -> Column:
    """The character list as an array, the marker still in place; NULL stays NULL.

    `split` drops brackets and quotes and cuts at every comma, so a name with a comma falls apart;
    `json` reads the list as it was meant.
    """
    if parse == "json":
        return F.from_json(c, "array<string>")
    if parse == "split":
        return F.split(F.translate(c, '[]"', ""), ",")
    raise ValueError(f"parse must be 'split' or 'json', not {parse!r}")


def characters(c: Column, parse: str = "split") -> Column:
    """The same with the marker as NULL."""
    return F.transform(listed_characters(c, parse), decode)
