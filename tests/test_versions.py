"""Dimensions that change: versions by date, and joins as of a date."""

from frames import day
from shelfcast.operators.versions import current, join_as_of, merge_versions, versioned
from test_operators import plan

PLAIN = "item_id string, dept_name string, item_type string"


def merged(spark, arrivals):
    """Versions after (day number or None, rows) arrived one after the other."""
    versions = None
    for n, rows in arrivals:
        arrived = spark.createDataFrame(rows, PLAIN)
        versions = versioned(arrived) if versions is None else merge_versions(versions, arrived, "item_id", day(n))
    return versions


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_changed_keys_get_a_version(spark):
    got = merged(spark, [
        (None, [("a", "x", "1"), ("b", "x", None)]),
        (10, [("a", "y", "1"), ("b", "x", None), ("c", "x", "1")]),
        (20, [("a", "y", "2")]),
    ])
    assert listed(got) == sorted([
        ("a", "x", "1", None, day(10)), ("a", "y", "1", day(10), day(20)), ("a", "y", "2", day(20), None),
        ("b", "x", None, None, None), ("c", "x", "1", None, None),
    ], key=str)
    assert listed(current(got)) == [("a", "y", "2"), ("b", "x", None), ("c", "x", "1")]


def test_arriving_twice_late_or_on_one_day(spark):
    first = [(None, [("a", "x", "1")]), (10, [("a", "y", "1")])]
    assert listed(merged(spark, [*first, first[1]])) == listed(merged(spark, first))
    same_day = merged(spark, [*first, (10, [("a", "z", "1")])])
    assert listed(same_day) == [("a", "x", "1", None, day(10)), ("a", "z", "1", day(10), None)]
    late = merged(spark, [*first, (5, [("a", "w", "1"), ("a", "v", "9")])])
    assert listed(late) == [
        ("a", "w", "1", day(5), day(10)), ("a", "x", "1", None, day(5)), ("a", "y", "1", day(10), None),
    ]
    assert listed(merged(spark, [*first, (30, [])])) == listed(merged(spark, first))


def test_join_takes_what_held(spark):
    versions = merged(spark, [(None, [("a", "x", "1")]), (10, [("a", "y", "1"), ("b", "x", "1")])])
    facts = spark.createDataFrame(
        [(day(n), i) for n in (0, 9, 10, 30) for i in ("a", "b", "none")] + [(None, "a")], "date date, item_id string"
    )
    found = {(r["date"], r["item_id"]): r["dept_name"] for r in join_as_of(facts, versions, "item_id").collect()}
    assert len(found) == 13
    assert [found[day(n), "a"] for n in (0, 9, 10, 30)] == ["x", "x", "y", "y"]
    assert {found[day(n), "b"] for n in (0, 30)} == {"x"} and found[day(0), "none"] is None
    assert found[None, "a"] is None


def test_large_versions_are_joined_by_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        versions = merged(spark, [(None, [("a", "x", "1")]), (10, [("a", "y", "1")])])
        facts = spark.createDataFrame([(day(0), "a")], "date date, item_id string")
        text = plan(join_as_of(facts, versions, "item_id"))
        assert "NestedLoop" not in text and "Cartesian" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_plain_dimensions_join_by_key(spark):
    catalog = spark.createDataFrame([("a", "x", "1")], PLAIN)
    facts = spark.createDataFrame([(day(0), "a"), (day(1), "b")], "date date, item_id string")
    assert [r["dept_name"] for r in join_as_of(facts, catalog, "item_id").orderBy("date").collect()] == ["x", None]
