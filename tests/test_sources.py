import datetime

import pytest

from reelhouse.functions.columns import decode_all
from reelhouse.sources import files, jdbc
from tests.conftest import DROP, FILM, rows, write_tsv


def test_snapshot_path():
    day = datetime.date(2021, 6, 5)
    assert files.snapshot_stamp(day) == "2021-06/05"
    assert files.snapshot_path("s3a://films/", day, "title.basics") == (
        "s3a://films/2021-06/05/title.basics.tsv"
    )


def test_read_decodes_marker_quotes_and_gzip(spark, drop, film):
    titles = {r.tconst: r for r in film["title.basics"].collect()}
    assert titles["tt02"].primaryTitle == '"Two'  # an unbalanced quote swallows nothing
    assert titles["tt02"].startYear == "1991"
    assert titles["tt02"].runtimeMinutes is None
    assert titles["tt07"].isAdult is None  # an empty field is missing too
    assert film["title.ratings"].count() == len(FILM["title.ratings"])  # gzipped


def test_raw_mode_keeps_marker(spark, drop):
    raw = files.read_raw(spark, drop, "title.basics", DROP, decode_sentinel=False)
    assert raw.filter("genres = concat(chr(92), 'N')").count() == 1
    decoded = files.read_raw(spark, drop, "title.basics", DROP)
    assert rows(decode_all(raw)) == rows(decoded)


@pytest.mark.parametrize(
    "header",
    [
        ["tconst", "numVotes", "averageRating"],
        ["tconst", "averageRating"],
        ["tconst", "averageRating", "numVotes", "extra"],
    ],
)
def test_header_drift_fails(spark, tmp_path, header):
    row = ["tt1", "1.0", "5", "x"][: len(header)]
    write_tsv(tmp_path / "title.ratings.tsv", "title.ratings", [row], header=header)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        files.read_raw(spark, str(tmp_path), "title.ratings").collect()


def test_read_a_folder_of_parts(spark, tmp_path):
    for i in range(3):
        part = tmp_path / "title.ratings.tsv" / f"part-{i}.tsv"
        write_tsv(part, "title.ratings", [[f"tt{i}", "1.0", "5"]])
    found = files.read_raw(spark, str(tmp_path), "title.ratings")
    assert rows(found, "tconst") == [("tt0",), ("tt1",), ("tt2",)]


def test_read_asset_by_glob(spark, drop):
    asset = files.read_asset(spark, drop, "title.episode.tsv")
    assert asset.columns == ["tconst", "parentTconst", "seasonNumber", "episodeNumber"]
    assert asset.count() == len(FILM["title.episode"])


def test_files_of_several_headers_meet_by_name(spark, tmp_path):
    write_tsv(tmp_path / "a.tsv", "title.ratings", [["tt1", "1.0", "5"]])
    write_tsv(tmp_path / "b.tsv", "title.ratings", [["tt2", "6", "2.0"]], header=["tconst", "numVotes", "averageRating"])
    write_tsv(tmp_path / "c.tsv.gz", "title.ratings", [["x", "tt3"]], header=["extra", "tconst"], zipped=True)
    write_tsv(tmp_path / "d.tsv", "title.ratings", [["tt4", "3.0", "7"], ["tt5", "", "\\N"]])
    (tmp_path / "e.tsv").write_text("")
    want = [("tt1", "1.0", "5", None), ("tt2", "2.0", "6", None), ("tt3", None, None, "x"), ("tt4", "3.0", "7", None),
            ("tt5", None, "\\N", None)]
    found = files.read_asset(spark, str(tmp_path), "*.tsv*")
    assert found.columns == ["tconst", "averageRating", "numVotes", "extra"] and rows(found) == want
    assert rows(files.as_batch(spark, str(tmp_path), "text")) == want
    heads = {r.file.rsplit("/", 1)[1]: r.header for r in files.headers(spark, str(tmp_path)).collect()}
    assert heads["c.tsv.gz"] == "extra\ttconst" and "e.tsv" not in heads


def test_parts_of_several_headers_are_not_misread(spark, tmp_path):
    write_tsv(tmp_path / "x.tsv" / "part-0.tsv", "", [["1", "2"]], header=["a", "b"])
    write_tsv(tmp_path / "x.tsv" / "part-1.tsv", "", [["4", "3"]], header=["b", "a"])
    assert rows(files.as_batch(spark, str(tmp_path / "x.tsv")), "a", "b") == [("1", "2"), ("3", "4")]
    write_tsv(tmp_path / "y.tsv", "", [["4", "3"]], header=["b", "b"])
    with pytest.raises(ValueError, match="twice"):
        files.as_batch(spark, str(tmp_path / "y.tsv"))


def test_an_asset_without_files_has_no_rows(spark, tmp_path):
    (tmp_path / "e.tsv").write_text("")
    assert files.read_asset(spark, str(tmp_path)).count() == 0


def test_the_header_is_found_in_files_of_many_splits(spark, tmp_path):
    held = [[f"tt{i}", "1.0", str(i)] for i in range(3000)]
    write_tsv(tmp_path / "a.tsv", "title.ratings", held)
    write_tsv(tmp_path / "b.tsv", "title.ratings", [r[::-1] for r in held], header=["numVotes", "averageRating", "tconst"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = files.read_asset(spark, str(tmp_path))
        assert found.count() == 6000 and found.filter("tconst not like 'tt%'").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


BROKEN = [["tt1", "1.0", "5"], ["tt2", "2.0"], ["tt3", "3.0", "7", "more"], ["tt4", "", "\\N"]]


def test_lines_that_do_not_fit_are_not_padded_or_cut(spark, tmp_path):
    write_tsv(tmp_path / "title.ratings.tsv", "title.ratings", BROKEN)
    for columns in (["*"], ["tconst"], ["numVotes"]):
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
            files.read_raw(spark, str(tmp_path), "title.ratings").select(*columns).collect()
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        files.as_batch(spark, str(tmp_path / "title.ratings.tsv")).collect()
    kept = files.read_raw(spark, str(tmp_path), "title.ratings", malformed="keep")
    assert rows(kept.drop("source_file")) == rows(
        spark.createDataFrame(
            [("tt1", "1.0", "5", None), (None, None, None, "tt2\t2.0"), (None, None, None, "tt3\t3.0\t7\tmore"),
             ("tt4", None, None, None)], kept.drop("source_file").schema)
    )
    assert kept.filter("(bad_line is null) <> (source_file is null)").count() == 0
    assert kept.filter("source_file like '%/title.ratings.tsv'").count() == 2
    assert kept.select("tconst").filter("tconst is not null").count() == 2  # also when few columns are asked for
    asset = files.read_asset(spark, str(tmp_path), malformed="keep")
    assert asset.filter("bad_line is not null").count() == 2
    with pytest.raises(ValueError, match="malformed"):
        files.read_raw(spark, str(tmp_path), "title.ratings", malformed="drop")


def test_list_files_reads_no_content(spark, drop):
    listing = files.list_files(spark, files.drop_files(drop, "*"))
    assert listing.count() == len(FILM)
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_as_batch(spark, drop, tmp_path):
    df = spark.range(3)
    assert files.as_batch(spark, df) is df
    df.write.parquet(str(tmp_path / "t"))
    assert files.as_batch(spark, str(tmp_path / "t")).count() == 3
    assert files.as_batch(spark, "SELECT 1 AS one", "query").columns == ["one"]
    df.createOrReplaceTempView("three")
    assert files.as_batch(spark, "three", "table").count() == 3
    path = f"{drop}/2021-06/26/title.basics.tsv"
    assert "primaryTitle" in files.as_batch(spark, path).columns
    with pytest.raises(ValueError):
        files.as_batch(spark, "x", "other")


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:db://host/films", "titles", "me", "secret", "a.Driver")
    assert options["dbtable"] == "titles" and options["driver"] == "a.Driver"
    assert "driver" not in jdbc.jdbc_options("jdbc:db://host/films", "titles", "me", "secret")
