"""Rows that do not parse go to a zone of their own."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import day
from shelfcast.plans import jobs
from shelfcast.schemas import CATALOG, SALES
from shelfcast.sources import rejects, zones

LINES = [
    "date,item_id,Unnamed: 0,quantity,price_base,sum_total,store_id",
    "2024-01-01,a,0,1.5,2.0,3.0,1",
    "2024-01-02 10:00:00,b,1,,2.0,3.0,2.0",
    "2024-02-30,c,2,1,2,3,1",
    "soon,d,3,many,2,3,1.5",
    ",e,4,1,2,3,1",
    "2024-01-03,f,5,1,2,3",
    "2024-01-04,g,6,1,2,3,1,9",
    "2024-01-05,h,7,1,2,3,99999999999",
    "2024-01-06,i,8,1,2,3,",
]


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "sales.csv").write_text("\n".join(LINES) + "\n")
    return folder


def test_each_bad_value_is_named(spark, raw):
    parsed = rejects.parse_csv(spark, f"{raw}/sales.csv", SALES)
    good, bad = rejects.accepted(parsed, SALES), rejects.rejected(parsed, "sales", "2024-03-01")
    assert good.schema == SALES
    assert {r["item_id"]: (r["date"], r["store_id"]) for r in good.collect()} == {
        "a": (day(0), 1), "b": (day(1), 2), "i": (day(5), None),
    }
    assert bad.schema.simpleString() == spark.createDataFrame([], rejects.REJECTS).schema.simpleString()
    found = {r["line"].split(",")[1]: [tuple(p) for p in r["problems"]] for r in bad.collect()}
    assert found == {
        "c": [("date", "2024-02-30", "not a date")],
        "d": [("date", "soon", "not a date"), ("quantity", "many", "not a number"), ("store_id", "1.5", "not a whole number")],
        "e": [("date", None, "missing")],
        "f": [("", LINES[6], "wrong number of fields")],
        "g": [("", LINES[7], "wrong number of fields")],
        "h": [("store_id", "99999999999", "not a whole number")],
    }
    assert good.count() + bad.count() == len(LINES) - 1
    assert {r["file"] for r in bad.collect()} == {"sales.csv"}


def test_a_column_that_is_not_there(spark, raw):
    with pytest.raises(ValueError, match="dept_name"):
        rejects.parse_csv(spark, f"{raw}/sales.csv", CATALOG, required=())


def test_landing_goes_on_or_stops_by_their_share(spark, raw, tmp_path):
    root, on = str(tmp_path / "z"), dt.date(2024, 3, 1)
    with pytest.raises(rejects.TooManyRejects, match="6 of 9"):
        jobs.land_history(spark, str(raw), root, max_rejected=0.5, landed_on=on)
    assert not zones.folder_exists(spark, f"{root}/sales")
    jobs.land_history(spark, str(raw), root, max_rejected=0.7, landed_on=on)
    kept = zones.read_zone(spark, f"{root}/rejects/sales")
    assert kept.count() == 6 and kept.where(F.col("date") == F.lit(on)).count() == 6
    landed = sum(zones.read_zone(spark, f"{root}/{n}", SALES).count() for n in ("sales", "recent"))
    assert landed + kept.count() == len(LINES) - 1


def test_arrivals(spark, raw, tmp_path):
    root = str(tmp_path / "z")
    sales = jobs.arrivals_of(spark, f"{raw}/sales.csv", root, "2024-03-01", 0.9)
    assert sales.count() == 3
    with pytest.raises(rejects.TooManyRejects):
        jobs.arrivals_of(spark, f"{raw}/sales.csv", root, "2024-03-01")
