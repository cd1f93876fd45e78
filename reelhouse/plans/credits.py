"""People, and the cast and crew they make up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.columns import age, decode, is_alive, listed_characters
from reelhouse.operators.constraints import repeated_keys
from reelhouse.operators.joins import HOT_ROWS, bucket, heavy_buckets, hot_keys, skew_join
from reelhouse.operators.latest import latest_rows
from reelhouse.schemas import CAST_CATEGORIES


def people(names: DataFrame, as_of_year: int) -> DataFrame:
    """nconst, name, age, is_alive."""
    birth, death = F.col("birthYear"), F.col("deathYear")
    return names.select(
        "nconst",
        F.col("primaryName").alias("name"),
        age(birth, death, as_of_year).alias("age"),
        is_alive(birth, death).alias("is_alive"),
    )


def _on_screen():
    return F.col("category").isin(*CAST_CATEGORIES)


def cast_credits(principals: DataFrame) -> DataFrame:
    """tconst, nconst and the unparsed character list of everyone on screen."""
    return principals.filter(_on_screen()).select("tconst", "nconst", "characters")


def crew_credits(principals: DataFrame) -> DataFrame:
    """tconst, nconst, role of everyone else; a missing category is neither cast nor crew."""
    off_screen = principals.filter(~_on_screen())
    return off_screen.select("tconst", "nconst", F.col("category").alias("role"))


def credit_counts(principals: DataFrame, key: str) -> DataFrame:
    """`key`, cast_rows, crew_rows: the credits of every person or title.

    One pass that tells who is cast and crew, and which keys are heavy, for both at once.
    """
    return _counted(principals, key, F.col(key))


def bucket_counts(principals: DataFrame, key: str) -> DataFrame:
    """_bucket, cast_rows, crew_rows: the same by hash value of the key, a table of bounded size."""
    return _counted(principals, key, bucket(key).alias("_bucket"))


def heavy_credit_counts(
    principals: DataFrame, key: str, buckets: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """`credit_counts` of the keys that can be heavy by `bucket_counts`; without such keys no credits are read."""
    listed = F.broadcast(heavy_buckets(buckets, ["cast_rows", "crew_rows"], hot_rows))
    some = principals.withColumn("_bucket", bucket(key)).join(listed, "_bucket", "left_semi")
    return credit_counts(some, key)


def _counted(principals: DataFrame, key: str, by: Column) -> DataFrame:
    return (
        principals.filter(F.col(key).isNotNull() & F.col("category").isNotNull())
        .groupBy(by)
        .agg(
            F.count_if(_on_screen()).alias("cast_rows"),
            F.count_if(~_on_screen()).alias("crew_rows"),
        )
    )


def explode_characters(credits: DataFrame, parse: str = "split") -> DataFrame:
    """One row per character; a credit without characters keeps one row with NULL."""
    kept = [c for c in credits.columns if c != "characters"]
    listed = credits.select(*kept, F.explode_outer(listed_characters(F.col("characters"), parse)).alias("character"))
    return listed.withColumn("character", decode(F.col("character")))


def person_dim(credits: DataFrame, persons: DataFrame) -> DataFrame:
    """The people who hold at least one credit, one row each.

    The credits are cut to distinct keys before the join, so a person with very many credits moves a
    few rows only. Only people whose key repeats, found by a count, have to be compared row by row.
    """
    credited = credits.select("nconst").distinct()
    found = persons.join(credited, "nconst", "left_semi")
    several = repeated_keys(persons, "nconst").select("nconst")
    once = found.join(several, "nconst", "left_anti")
    return once.unionByName(latest_rows(found.join(several, "nconst", "left_semi"), ["nconst"]))


def link(
    credits: DataFrame,
    person_ids: DataFrame,
    title_ids: DataFrame,
    person_col: str,
    hot_persons: DataFrame | None = None,
    hot_titles: DataFrame | None = None,
) -> DataFrame:
    """Credits with both keys replaced: title_id, `person_col` and the credit's other columns.

    `person_ids` holds id and nconst, `title_ids` id and tconst. Credits of a title without an id drop
    out. Either key may be very frequent, so both look-ups split their heavy keys; without a list of
    these they are counted here. Both look-ups have one row per key.
    """
    title_map = title_ids.select("tconst", F.col("id").alias("title_id"))
    person_map = person_ids.select("nconst", F.col("id").alias(person_col))
    rest = [c for c in credits.columns if c not in ("tconst", "nconst")]
    hot_titles = hot_keys(credits, "tconst") if hot_titles is None else hot_titles
    hot_persons = hot_keys(credits, "nconst") if hot_persons is None else hot_persons
    linked = skew_join(credits, title_map, "tconst", hot_titles, single=True)
    linked = skew_join(linked, person_map, "nconst", hot_persons, single=True)
    return linked.select("title_id", person_col, *rest)


def titles_casts(
    credits: DataFrame,
    cast_ids: DataFrame,
    title_ids: DataFrame,
    parse: str = "split",
    **hot: DataFrame,
) -> DataFrame:
    """title_id, cast_id, character. Lists are spread out last, so the joins move one row per credit."""
    return explode_characters(link(credits, cast_ids, title_ids, "cast_id", **hot), parse)


def titles_crew(
    credits: DataFrame, crew_ids: DataFrame, title_ids: DataFrame, **hot: DataFrame
) -> DataFrame:
    """title_id, crew_id, role."""
    return link(credits, crew_ids, title_ids, "crew_id", **hot)
