"""Compaction, published versions and the profile by day."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

import frames
from frames import day
from shelfcast.__main__ import parser, run
from shelfcast.operators.profile import assortment_profile
from shelfcast.operators.summaries import day_summaries, profile_of_summaries
from shelfcast.plans import jobs
from shelfcast.schemas import SALES
from shelfcast.sources import compaction, publish, zones


def files(path):
    found = {}
    for name in glob.glob(f"{path}/year=*/month=*/day=*/*.parquet"):
        found.setdefault(os.path.dirname(name), []).append((name, os.path.getmtime(name)))
    return found


def listed(zone):
    return sorted(map(str, zone.select(*SALES.names).collect()))


@pytest.mark.parametrize("padded", [True, False])
def test_appended_dates_get_the_files_their_size_asks_for(spark, tmp_path, padded):
    path = str(tmp_path / "zone")
    rng = random.Random(1)
    zones.write_by_date(frames.sales(spark, [(n, "a", 1, 1.0, 2.0) for n in range(8)]), path, padded=padded)
    for _ in range(20):
        rows = [(3, f"i{rng.randrange(50)}", rng.randrange(9), rng.random(), 2.0) for _ in range(40)]
        zones.write_by_date(frames.sales(spark, rows), path, mode="append", padded=padded)
    zone = zones.read_zone(spark, path, SALES)
    before, old = listed(zone), files(path)
    sizes = {r["date"]: (r["n_files"], r["n_bytes"]) for r in compaction.file_sizes(spark, path).collect()}
    assert sizes[day(3)][0] == 21 and sizes[day(2)][0] == 1
    assert sizes[day(3)][1] == sum(os.path.getsize(n) for n, _ in old[[d for d in old if len(old[d]) > 1][0]])
    small = sizes[day(3)][1] // 3
    assert compaction.compact(spark, path, SALES, file_bytes=small, slack=2.0) == [day(3)]
    new = files(path)
    assert listed(zones.read_zone(spark, path, SALES)) == before and new.keys() == old.keys()
    assert sorted(len(f) for f in new.values()) == [1] * 7 + [4]
    assert sum(new[d] == old[d] for d in new) == 7
    assert compaction.compact(spark, path, SALES, file_bytes=1 << 20) == [day(3)]
    assert compaction.compact(spark, path, SALES, file_bytes=1 << 20) == []
    assert listed(zones.read_zone(spark, path, SALES)) == before


def test_light_dates_share_a_task():
    plan = [compaction.DateFiles(day(n), 9, size, wanted) for n, (size, wanted) in enumerate([(10, 1), (20, 1), (300, 3), (5, 1)])]
    packed = compaction.pack(plan, 100)
    assert packed == [(day(0), 0, 0), (day(1), 0, 0), (day(2), 0, 1), (day(2), 1, 2), (day(2), 2, 3), (day(3), 0, 4)]


def forecast(spark, n):
    return spark.createDataFrame([(day(0), n)], "date date, predicted_quantity int")


def test_a_run_that_fails_leaves_what_readers_had(spark, tmp_path):
    root, name = str(tmp_path / "p"), "versions_for_test"
    publish.publish_table(forecast(spark, 0), name)  # a table of old has the name
    first = publish.publish_version(forecast(spark, 1), root, name)
    bad = forecast(spark, 2).withColumn("predicted_quantity", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        publish.publish_version(bad, root, name)
    assert [r[1] for r in spark.table(name).collect()] == [1]
    assert publish.published_versions(spark, root, name) == [first]
    later = [publish.publish_version(forecast(spark, n), root, name, keep=2) for n in (3, 4, 5)]
    assert [r[1] for r in spark.table(name).collect()] == [5]
    assert publish.published_versions(spark, root, name) == later[1:]
    publish.switch_version(spark, root, later[1], name)
    assert [r[1] for r in spark.table(name).collect()] == [4]
    assert publish.published_versions(spark, str(tmp_path / "none"), name) == []
    spark.sql(f"DROP VIEW {name}")


def some_sales(spark, n=400, stores=(-1, 0, 1, 32768, 32769, 70000)):
    rng = random.Random(9)
    rows = [(rng.randrange(30), f"i{rng.randrange(6)}", rng.choice(stores), rng.choice([None, 1.0, 2.0]), 2.0) for _ in range(n)]
    return frames.sales(spark, rows)


def test_summaries_give_the_profile(spark):
    sales = some_sales(spark)
    assert day_summaries(sales).where("store_bucket IS NULL").isEmpty()
    want = list(map(tuple, assortment_profile(sales, 4).collect()))
    assert len(want) == 4 and list(map(tuple, profile_of_summaries(day_summaries(sales), 4).collect())) == want
    few = sales.where("store_id < 2 OR item_id <> 'i0'")
    want = list(map(tuple, assortment_profile(few).collect()))
    assert len(want) == 5 and list(map(tuple, profile_of_summaries(day_summaries(few)).collect())) == want
    assert profile_of_summaries(day_summaries(sales.limit(0))).isEmpty()


def test_summaries_take_a_few_bytes_and_no_sort(spark):
    """Rows of unknown items count for the stores there are, and are not shown."""
    data = [(d, i, s, 1.0, 2.0) for i in ("a", "b") for s in (-65, -64, -1, 0, 63, 64) for d in range(3)]
    sales = frames.sales(spark, [*data, (0, "b", 200, 3.0, 2.0)])
    unknown = sales.where("item_id = 'a'").withColumn("item_id", F.lit(None).cast("string"))
    nowhere = sales.where("store_id = 0").withColumn("store_id", F.lit(None).cast("int"))
    stored = day_summaries(sales.unionByName(unknown).unionByName(nowhere))
    assert dict(stored.dtypes)["stores"] == "bigint"
    found = profile_of_summaries(stored)
    assert list(map(tuple, found.collect())) == [("b", 7, 3, 22, 24 / 22)]
    for df in (stored, found):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_profile_after_a_landing_reads_the_new_dates(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "z")
    sales = some_sales(spark)
    manifest = jobs.manifest_path(root, "sales")
    zones.write_by_date(sales, f"{root}/sales", padded=True)
    zones.record_dates(zones.read_zone(spark, f"{root}/sales", SALES), manifest)
    read = []
    real = jobs.on_dates
    monkeypatch.setattr(jobs, "on_dates", lambda df, dates: read.append(sorted(dates)) or real(df, dates))

    def agrees():
        zone = zones.read_zone(spark, f"{root}/sales", SALES)
        return list(map(tuple, jobs.refresh_profile(spark, root).collect())) == list(map(tuple, assortment_profile(zone).collect()))

    assert agrees() and len(read[0]) == 30
    del read[:]
    for n, items in ((7, ["i0", "i1"]), (40, ["i2"])):
        rows = frames.sales(spark, [(n, i, s, 5.0, 2.0) for i in items for s in (1, 2)])
        jobs.land_day(rows, f"{root}/sales", day(n), manifest)
    assert agrees() and read == [[day(7), day(40)]] * 2
    del read[:]
    assert agrees() and read == []


def test_command_line_keeps_zones_up(spark, tmp_path, capsys):
    root = str(tmp_path / "z")
    rows = frames.sales(spark, [(n, "a", 1, 1.0, 2.0) for n in range(3)])
    for _ in range(4):
        zones.write_by_date(rows, f"{root}/sales", mode="append", padded=True)
    zones.record_dates(zones.read_zone(spark, f"{root}/sales", SALES), jobs.manifest_path(root, "sales"))
    run(spark, parser().parse_args(["compact", "--root", root]))
    run(spark, parser().parse_args(["profile", "--root", root]))
    out = capsys.readouterr().out
    assert "3 dates rewritten" in out and "active_days" in out
