"""What a role sees of a table with tagged columns."""

import pytest

from vaultline.operators.access import ALL, Access, AccessError, Tag

ACCESS = Access([Tag("silver", "t", "phone", "phone"), Tag("silver", "t", "name", "individual_name"), Tag("gold", "t", "name", "narrative")],
                {"engineer": {ALL}, "desk": {"phone"}, "analyst": set()})


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "0412345678", "Jane Doe", "free"), (2, None, " ", None)], "id INT, phone STRING, name STRING, other STRING")


def test_a_role_sees_what_it_is_exempt_from(people):
    seen = {role: ACCESS.view(people, "silver", "t", role).collect()[0] for role in ("engineer", "desk", "analyst", "nobody")}
    assert tuple(seen["engineer"]) == (1, "0412345678", "Jane Doe", "free")
    assert seen["desk"].phone == "0412345678" and seen["desk"].name != "Jane Doe"
    assert seen["analyst"].phone != "0412345678" and seen["analyst"] == seen["nobody"]   # an unknown role sees no more
    assert {r.other for r in seen.values()} == {"free"}


def test_blank_values_stay_and_untagged_tables_are_whole(people):
    assert tuple(ACCESS.view(people, "silver", "t", "analyst").collect()[1]) == (2, None, " ", None)
    assert ACCESS.view(people, "silver", "unknown", "analyst").columns == people.columns
    assert ACCESS.hidden("gold", "t", "desk") == {"name": "narrative"}


def test_the_plan_tells_what_comes_through(people):
    assert ACCESS.clear(people, people, "silver", "t") == ["phone", "name"]
    assert ACCESS.clear(people, ACCESS.view(people, "silver", "t", "analyst"), "silver", "t") == []
    renamed = people.select("id", people.phone.alias("x")).select("id", "x").withColumnRenamed("x", "y")
    assert ACCESS.clear(people, renamed, "silver", "t") == ["phone"]
    assert ACCESS.clear(people, people.selectExpr("upper(name) AS name"), "silver", "t") == []


def test_mistakes_are_errors(people):
    with pytest.raises(AccessError, match="lacks name"):
        ACCESS.view(people.drop("name"), "silver", "t", "analyst")
    with pytest.raises(AccessError, match="no mask for shoe_size"):
        Access([Tag("silver", "t", "c", "shoe_size")], {})
    with pytest.raises(AccessError, match="tagged twice: silver.t.c"):
        Access([Tag("silver", "t", "c", "phone"), Tag("silver", "t", "c", "email")], {})
