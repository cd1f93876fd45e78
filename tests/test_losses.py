from reelhouse.operators.constraints import cast_losses
from reelhouse.plans import credits
from tests.conftest import rows


def test_losses_of_a_cast_are_counted(film):
    found = rows(cast_losses({"title.basics": film["title.basics"]}), "column_name", "present", "lost")
    assert found == [("endYear", 2, 1), ("runtimeMinutes", 6, 0), ("startYear", 6, 1)]


def test_only_repeated_people_are_compared(spark, film):
    persons = credits.people(film["name.basics"], 2021)
    cast = credits.cast_credits(film["title.principals"])
    twice = persons.unionByName(persons.filter("nconst = 'nm1'").selectExpr("nconst", "'Zoe' name", "age", "is_alive"))
    found = {r.nconst: r.name for r in credits.person_dim(cast, twice).collect()}
    assert found == {"nm1": "Zoe", "nm2": "Bob", "nm5": "Ann", "nm6": "Eve"}
