"""Dashboard reports over the warehouse tables. `limit=None` returns every row, where a report allows it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MOST_PLAUSIBLE_AGE = 150  # Fixed value: ages outside 0 < age < 150 are left out of the chart.


def _cut(df: DataFrame, order: Sequence[Column | str], limit: int | None) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def _by_rating() -> list[Column]:
    return [F.desc_nulls_last("num_votes"), F.desc_nulls_last("av_rating"), F.asc("tconst")]


def age_distribution(casts: DataFrame, crew: DataFrame) -> DataFrame:
    """age, n over cast and crew; who is in both counts twice."""
    ages = casts.select("age").unionByName(crew.select("age"))
    plausible = (F.col("age") > 0) & (F.col("age") < MOST_PLAUSIBLE_AGE)
    return ages.filter(plausible).groupBy("age").agg(F.count("age").alias("n"))


def genre_counts(titles: DataFrame) -> DataFrame:
    """genre, n, rarest first. The three columns are spread out in one pass over the titles."""
    genre = F.explode(F.array("genre_1", "genre_2", "genre_3")).alias("genre")
    counted = titles.select(genre).filter(F.col("genre").isNotNull()).groupBy("genre")
    return counted.agg(F.count("genre").alias("n")).orderBy("n", "genre")


def adult_split(titles: DataFrame) -> DataFrame:
    """is_adult, n; a group without the flag counts 0."""
    return titles.groupBy("is_adult").agg(F.count("is_adult").alias("n"))


def adult_pair(titles: DataFrame) -> DataFrame:
    """adult, non_adult in one row."""
    flag = F.col("is_adult")
    return titles.agg(F.count_if(flag).alias("adult"), F.count_if(~flag).alias("non_adult"))


def top_rated(titles: DataFrame, limit: int | None = 50) -> DataFrame:
    """primary_title, num_votes, av_rating by votes, then rating."""
    return _cut(titles, _by_rating(), limit).select("primary_title", "num_votes", "av_rating")


def top_episode_counts(
    titles: DataFrame, episodes: DataFrame, limit: int | None = 50
) -> DataFrame:
    """primary_title, total_episodes of the longest seasons."""
    named = episodes.join(
        titles.select(F.col("id").alias("title_id"), "tconst", "primary_title"), "title_id"
    )
    order = [F.desc_nulls_last("total_episodes"), F.asc("tconst"), F.asc_nulls_first("season")]
    return _cut(named, order, limit).select("primary_title", "total_episodes")


def top_names(
    persons: DataFrame,
    bridge: DataFrame,
    person_col: str,
    limit: int | None = 100,
    by: str = "name",
) -> DataFrame:
    """Most frequent names of cast or crew.

    `by="name"` counts bridge rows and lets people of one name run together: name, n.
    `by="person"` counts distinct titles of each person: nconst, name, n.
    Rows are counted per person before the join, so it moves one row per person and task.
    """
    names = persons.select(F.col("id").alias(person_col), "nconst", "name")
    if by == "name":
        per_person = bridge.groupBy(person_col).agg(F.count(F.lit(1)).alias("rows"))
        named = per_person.join(names, person_col).withColumn(
            "rows", F.when(F.col("name").isNotNull(), F.col("rows")).otherwise(0)
        )
        counted = named.groupBy("name").agg(F.sum("rows").alias("n"))
        return _cut(counted, [F.desc("n"), F.asc_nulls_last("name")], limit)
    if by == "person":
        pairs = bridge.select("title_id", person_col).distinct()
        per_person = pairs.groupBy(person_col).agg(F.count(F.lit(1)).alias("n"))
        named = per_person.join(names, person_col).select("nconst", "name", "n")
        return _cut(named, [F.desc("n"), F.asc("nconst")], limit)
    raise ValueError(f"by must be 'name' or 'person', not {by!r}")


def _first_pairs(members: DataFrame, facts: Sequence[str], limit: int) -> DataFrame:
    """The first `limit` pairs of each title: `facts`, cast_id, character, crew_id, role.

    `members` are bridge rows (`facts`, side, id, part). Sorted by cast and then by crew, a pair's place
    follows from those of its members: all crew rows come with the earlier cast rows, and equal cast
    rows take turns with each crew row.
    """
    first = W.partitionBy("title_id", "side").orderBy("id", F.asc_nulls_last("part"))
    equal = W.partitionBy("title_id", "side", "id", "part")
    member = F.struct("id", "part", "place", "start", "same")
    paired = (
        members.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= limit)
        .withColumns({"start": F.min("place").over(equal), "same": F.count(F.lit(1)).over(equal)})
        .groupBy(*facts)  # at most `limit` members of each side per group
        .agg(
            F.collect_list(F.when(F.col("side") == "cast", member)).alias("casts"),
            F.collect_list(F.when(F.col("side") == "crew", member)).alias("crews"),
        )
        .select(*facts, F.explode("casts").alias("cast"), "crews")
        .withColumn(
            "before",
            (F.col("cast.start") - 1).cast("long") * F.size("crews") + F.col("cast.place") - F.col("cast.start"),
        )
        .filter(F.col("before") < limit)
        .select(*facts, "cast", "before", F.explode("crews").alias("crew"))
        .filter(F.col("before") + F.col("cast.same") * (F.col("crew.place") - 1) < limit)
    )
    return paired.select(
        *facts,
        F.col("cast.id").alias("cast_id"),
        F.col("cast.part").alias("character"),
        F.col("crew.id").alias("crew_id"),
        F.col("crew.part").alias("role"),
    )


def people_of_top_titles(
    titles: DataFrame,
    casts: DataFrame,
    crew: DataFrame,
    titles_casts: DataFrame,
    titles_crew: DataFrame,
    limit: int = 10,
) -> DataFrame:
    """The first `limit` pairs of cast and crew member over titles by votes, then rating.

    Pairs of one title are ordered by (cast_id, character, crew_id, role). Every title with both sides
    gives at least one pair, so `limit` titles suffice; and the first `limit` pairs of a title use only
    its first `limit` rows of either side. The cut is therefore made on the bridge rows, and of what they
    pair up to, only the first `limit` pairs of a title are formed, yet the rows are those of cutting the
    full product. Bridge rows are taken to name existing people, as their foreign keys say.
    """
    if limit is None:
        raise ValueError("people_of_top_titles needs a limit: all pairs of cast and crew are not listed")
    sides = titles_casts.select(
        "title_id", F.lit("cast").alias("side"), F.col("cast_id").alias("id"), F.col("character").alias("part")
    ).unionByName(
        titles_crew.select(
            "title_id", F.lit("crew").alias("side"), F.col("crew_id").alias("id"), F.col("role").alias("part")
        )
    ).filter(F.col("title_id").isNotNull() & F.col("id").isNotNull())

    staffed = (
        sides.groupBy("title_id")
        .agg(F.max(F.col("side") == "cast").alias("cast"), F.max(F.col("side") == "crew").alias("crew"))
        .filter(F.col("cast") & F.col("crew"))
        .select("title_id")
    )
    facts = ["title_id", "tconst", "primary_title", "num_votes", "av_rating"]
    top = _cut(
        titles.withColumnRenamed("id", "title_id").join(staffed, "title_id", "left_semi"),
        _by_rating(),
        limit,
    ).select(*facts)

    pairs = _first_pairs(sides.join(top, "title_id"), facts, limit)
    order = [
        *_by_rating(),
        F.asc("cast_id"),
        F.asc_nulls_last("character"),
        F.asc("crew_id"),
        F.asc_nulls_last("role"),
    ]
    best = _cut(pairs, order, limit)
    for who, persons in (("cast", casts), ("crew", crew)):
        person = persons.select(
            F.col("id").alias(f"{who}_id"),
            F.col("name").alias(f"{who}_name"),
            F.col("age").alias(f"{who}_age"),
        )
        best = person.join(best, f"{who}_id")
    return _cut(best, order, limit).select(
        "crew_name", "crew_age", "cast_name", "cast_age", "primary_title"
    )
