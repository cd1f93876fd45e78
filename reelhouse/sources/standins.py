"""The seven raw files, derived from the order tables when no catalogue files are at hand.

Each view is one SELECT that Spark SQL and other engines read alike, so that a result can be checked
elsewhere. `chr(92)` is the backslash of the missing-value marker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# raw file -> (table it comes from, SELECT over {src})
VIEWS = {
    "title.basics": ("orders", """
        SELECT 'tt' || lpad(cast(o_orderkey AS STRING), 7, '0') AS tconst,
               o_orderpriority AS titleType,
               'Title ' || cast(o_orderkey AS STRING) AS primaryTitle,
               'Original ' || cast(o_orderkey AS STRING) AS originalTitle,
               CASE WHEN o_orderstatus = 'P' THEN '1' ELSE '0' END AS isAdult,
               cast(year(o_orderdate) AS STRING) AS startYear,
               CASE WHEN o_orderstatus = 'F' THEN cast(year(o_orderdate) + 1 AS STRING)
                    ELSE concat(chr(92), 'N') END AS endYear,
               CASE WHEN o_orderkey % 10 = 0 THEN concat(chr(92), 'N')
                    WHEN o_orderkey % 97 = 0 THEN '51420'
                    ELSE cast(1 + o_orderkey % 180 AS STRING) END AS runtimeMinutes,
               CASE o_orderkey % 4
                    WHEN 0 THEN concat(chr(92), 'N')
                    WHEN 1 THEN substr(o_orderpriority, 3)
                    WHEN 2 THEN 'Drama,' || substr(o_orderpriority, 3)
                    ELSE 'Comedy,Drama,' || substr(o_orderpriority, 3) END AS genres
        FROM {src}"""),
    "title.ratings": ("orders", """
        SELECT 'tt' || lpad(cast(o_orderkey AS STRING), 7, '0') AS tconst,
               cast(cast(1 + (o_orderkey % 91) / 10.0 AS DECIMAL(10,1)) AS STRING) AS averageRating,
               cast(cast(floor(o_totalprice) AS BIGINT) AS STRING) AS numVotes
        FROM {src} WHERE o_totalprice >= 100000"""),
    "title.episode": ("lineitem", """
        SELECT 'tt' || lpad(cast(10000000 + l_orderkey * 10 + l_linenumber AS STRING), 9, '0') AS tconst,
               'tt' || lpad(cast(l_orderkey AS STRING), 7, '0') AS parentTconst,
               CASE WHEN l_orderkey % 6 = 0 THEN concat(chr(92), 'N')
                    ELSE cast(1 + l_linenumber % 3 AS STRING) END AS seasonNumber,
               CASE WHEN l_orderkey % 6 = 0 OR l_linenumber = 7 THEN concat(chr(92), 'N')
                    ELSE cast(cast(l_quantity AS INT) AS STRING) END AS episodeNumber
        FROM {src}"""),
    "title.principals": ("lineitem", """
        SELECT 'tt' || lpad(cast(l_orderkey AS STRING), 7, '0') AS tconst,
               cast(l_linenumber AS STRING) AS ordering,
               'nm' || lpad(cast(l_partkey AS STRING), 7, '0') AS nconst,
               CASE l_returnflag || l_linestatus
                    WHEN 'AF' THEN 'actor' WHEN 'AO' THEN 'actress' WHEN 'RF' THEN 'self'
                    WHEN 'RO' THEN 'director' WHEN 'NF' THEN 'writer' ELSE 'producer' END AS category,
               concat(chr(92), 'N') AS job,
               CASE WHEN l_returnflag = 'A' AND l_linenumber % 2 = 0
                    THEN '["Lead ' || cast(l_suppkey AS STRING)
                         || '","Guest, ' || cast(l_linenumber AS STRING) || '"]'
                    WHEN l_returnflag = 'A' THEN '["Lead ' || cast(l_suppkey AS STRING) || '"]'
                    ELSE concat(chr(92), 'N') END AS characters
        FROM {src}"""),
    "title.crew": ("orders", """
        SELECT 'tt' || lpad(cast(o_orderkey AS STRING), 7, '0') AS tconst,
               CASE WHEN o_orderkey % 9 = 0 THEN concat(chr(92), 'N')
                    ELSE 'nm' || lpad(cast(o_custkey AS STRING), 7, '0') END AS directors,
               CASE WHEN o_orderkey % 2 = 0 THEN concat(chr(92), 'N')
                    ELSE 'nm' || lpad(cast(o_custkey AS STRING), 7, '0')
                         || ',nm' || lpad(cast(o_custkey + 1 AS STRING), 7, '0') END AS writers
        FROM {src}"""),
    "title.akas": ("part", """
        SELECT 'tt' || lpad(cast(p_partkey AS STRING), 7, '0') AS titleId,
               '1' AS ordering,
               p_name AS title,
               CASE WHEN p_partkey % 11 = 0 THEN 'LONGX' ELSE substr(upper(p_type), 1, 2) END AS region,
               concat(chr(92), 'N') AS language,
               'display' AS types,
               concat(chr(92), 'N') AS attributes,
               CASE p_partkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '1'
                    ELSE concat(chr(92), 'N') END AS isOriginalTitle
        FROM {src}"""),
    "name.basics": ("part", """
        SELECT 'nm' || lpad(cast(p_partkey AS STRING), 7, '0') AS nconst,
               p_name AS primaryName,
               CASE WHEN p_partkey % 7 = 0 THEN concat(chr(92), 'N')
                    WHEN p_partkey % 50 = 1 THEN '1500'
                    ELSE cast(1900 + p_partkey % 100 AS STRING) END AS birthYear,
               CASE WHEN p_partkey % 3 = 0 THEN cast(2000 + p_size % 20 AS STRING)
                    ELSE concat(chr(92), 'N') END AS deathYear,
               p_type AS primaryProfession,
               concat(chr(92), 'N') AS knownForTitles
        FROM {src}"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw file as strings, the missing-value marker still in place."""
    source, select = VIEWS[name]
    return spark.sql(select, src=table(spark, sf_dir, source))
