"""Range lookup by dyadic blocks, folded newest rows, and the stored SCD-2 history."""

import os
import random

import pytest
from pyspark.sql import functions as F

from dockstat.operators import scd2_store
from dockstat.operators.dedup import latest_per_key
from dockstat.operators.folded import fold, newest
from dockstat.operators.ranges import dyadic_blocks, range_lookup
from dockstat.operators.scd2 import scd2_check
from dockstat.operators.scd2_store import apply_run, read_history, read_open
from dockstat.sources.gbfs import raw_schema
from dockstat.sources.manifest import manifest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- ranges -------------------------------------------------------------------------

def plain_lookup(values, ranges):
    out = []
    for i, v in values:
        met = [n for n, lo, hi in ranges if v is not None and lo is not None and hi is not None and lo <= v <= hi]
        out += [(i, v, n) for n in met] or [(i, v, None)]
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["long", "double", "decimal(20,3)"])
def test_range_lookup_equals_plain_search(spark, kind):
    rnd = random.Random(kind)
    step = 1 if kind == "long" else 0.125
    points = [0, 1, 10 ** 12, -10 ** 12, 10 ** 12 + 7, -1, 255, 256, 257, *(rnd.randrange(-2000, 2000) * step for _ in range(150))]
    ranges = [("all", 0, 10 ** 12), ("wide", -10 ** 12, 10 ** 9 + 1), ("one", 256, 256), ("none", 9, 3), ("open", None, 5), ("same", 256, 256)]
    ranges += [(f"r{i}", *sorted(rnd.randrange(-300, 300) * step for _ in range(2))) for i in range(25)]
    from decimal import Decimal
    cast = {"long": int, "double": float, "decimal(20,3)": lambda x: Decimal(str(x))}[kind]
    values = [(i, cast(p)) for i, p in enumerate(points)] + [(900, None), (901, cast(1)), (901, cast(1))]
    ranges = [(n, None if a is None else cast(a), cast(b)) for n, a, b in ranges]
    df = spark.createDataFrame(values, f"id int, v {kind}")
    r = spark.createDataFrame(ranges, f"name string, lo {kind}, hi {kind}")
    got = range_lookup(df, "v", r, "lo", "hi", ["name"])
    assert got.columns == ["id", "v", "name"]
    assert rows(got) == plain_lookup(values, ranges)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    width = dyadic_blocks(r, "lo", "hi").groupBy("name").count().collect()
    assert max(x["count"] for x in width) <= 2 * 42                    # two a level
    assert range_lookup(df, "v", r.limit(0), "lo", "hi", ["name"]).filter("name is null").count() == len(values)
    assert range_lookup(df.limit(0), "v", r, "lo", "hi", ["name"]).count() == 0


def test_infinite_and_huge_bounds(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-1e300,), (0.5,), (1e300,), (inf,)], "v double")
    r = spark.createDataFrame([("up", 0.5, inf), ("down", -inf, 0.5), ("huge", 1e299, 1e301)], "name string, lo double, hi double")
    assert rows(range_lookup(df, "v", r, "lo", "hi", ["name"])) == sorted(
        [(-1e300, "down"), (0.5, "down"), (0.5, "up"), (1e300, "up"), (1e300, "huge"), (inf, "up")], key=str)


# ---- folded newest rows ---------------------------------------------------------------

def raw_load(spark, path, number, items):
    schema = raw_schema("system_regions")
    df = spark.createDataFrame([(k, n, t) for k, n, t in items], "region_id string, name string, t string") \
        .select("region_id", "name", F.col("t").cast("timestamp").alias("ingested_at"))
    df.withColumn("ingest_date", F.to_date("ingested_at")).withColumn("load", F.lit(number).cast("long")) \
        .write.mode("append").partitionBy("ingest_date", "load").parquet(path)
    return schema


def test_fold_equals_full_rebuild_and_scans_only_new_loads(spark, tmp):
    raw, state = os.path.join(tmp, "raw"), os.path.join(tmp, "state")
    rnd, seen = random.Random(5), 0
    empty, last = fold(spark, raw, raw_schema("system_regions"), state, ["region_id"])
    assert empty.count() == 0 and last == -1
    for number in range(5):
        items = [(rnd.choice(["a", "b", "c", None]), f"n{number}{i}", f"2026-01-{rnd.randrange(1, 28):02d} 00:00:00") for i in range(4)]
        schema = raw_load(spark, raw, number, items)
        folded, last = fold(spark, raw, schema, state, ["region_id"])
        whole = spark.read.schema(schema).parquet(raw).drop("ingest_date", "load")
        assert last == number and rows(folded) == rows(newest(whole, ["region_id"]))
        times = {r.region_id: r.ingested_at for r in latest_per_key(whole, "region_id", "ingested_at").collect()}
        assert {r.region_id: r.ingested_at for r in folded.collect()} == times
    again, last = fold(spark, raw, schema, state, ["region_id"])          # nothing new: no new version
    assert last == 4 and rows(again) == rows(folded) and len([f for f in os.listdir(state) if "=" in f]) == 5
    from dockstat.operators.folded import loads_after
    raw_load(spark, raw, 5, [("a", "x", "2026-02-01 00:00:00")])
    scan = loads_after(spark, raw, schema, 4, 5)
    filters = scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "load" in filters and "> 4" in filters and "<= 5" in filters
    assert scan.rdd.getNumPartitions() == 1 and scan.count() == 1        # one file of twenty is read


# ---- SCD-2 -----------------------------------------------------------------------------

def batches(spark, n, seed=3):
    rnd = random.Random(seed)
    state = {k: [1, "x"] for k in range(30)}
    for run in range(n):
        for k in list(state):
            if rnd.random() < 0.3:
                state[k] = [rnd.randrange(3), rnd.choice(["x", "y", None])]
            if rnd.random() < 0.05:
                del state[k]
        state.update({rnd.randrange(60): [2, "z"] for _ in range(2)})
        out = [(k, *v, f"note{run}") for k, v in state.items()] + [(None, 1, "n", "null key")]
        yield f"2026-01-{run + 1:02d} 06:00:00", spark.createDataFrame(out, "id int, docks int, kiosk string, note string")


def test_stored_history_equals_the_chain_of_runs(spark, tmp):
    path, snap, bases = os.path.join(tmp, "scd2"), None, set()
    for as_of, batch in batches(spark, 10):
        snap = scd2_check(snap, batch, "id", ["docks", "kiosk"], as_of).checkpoint()
        apply_run(batch, path, "id", ["docks", "kiosk"], as_of)
        assert rows(read_history(spark, path)) == rows(snap)
        assert rows(read_open(spark, path)) == rows(snap.filter("dbt_valid_to is null"))
        bases.add(manifest(spark, path)["base"])
    assert len(bases) > 2                                                # it has compacted more than once
    before = rows(read_history(spark, path))
    apply_run(batch, path, "id", ["docks", "kiosk"], as_of)             # repeated
    apply_run(batch.limit(3), path, "id", ["docks", "kiosk"], "2026-01-01 00:00:00")  # of the past
    assert rows(read_history(spark, path)) == before
    gone = scd2_store.drop_old_bases(spark, path, keep=1)
    assert gone and rows(read_history(spark, path)) == before


def test_a_run_writes_only_what_it_closes_and_opens(spark, tmp):
    path = os.path.join(tmp, "scd2")
    base = spark.range(1000).selectExpr("cast(id as int) as id", "1 as docks", "'x' as kiosk")
    apply_run(base, path, "id", ["docks", "kiosk"], "2026-01-01 06:00:00")
    second = base.filter("id <> 7").withColumn("docks", F.when(F.col("id") == 5, 2).otherwise(F.col("docks")))
    state = apply_run(second, path, "id", ["docks", "kiosk"], "2026-01-02 06:00:00")
    assert state["runs"][-1] == {"run": "20260102T060000", "open": 1, "closed": 2} and state["base"] is None
    closed = spark.read.parquet(f"{path}/run=20260102T060000/part=closed")
    assert sorted(r.id for r in closed.collect()) == [5, 7]
    plan = scd2_store.delta(read_open(spark, path), base, "id", ["docks", "kiosk"], "2026-01-03 06:00:00") \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2                                 # the open rows, and the ids closed since


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_crashed_run_changes_nothing_until_it_is_repeated(spark, tmp, monkeypatch, step):
    path = os.path.join(tmp, "scd2")
    runs = list(batches(spark, 2))
    apply_run(runs[0][1], path, "id", ["docks", "kiosk"], runs[0][0])
    before = rows(read_history(spark, path))

    def crash(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(scd2_store, "commit", crash)
        else:
            m.setattr(scd2_store, "compare", crash)
        with pytest.raises(RuntimeError):
            apply_run(runs[1][1], path, "id", ["docks", "kiosk"], runs[1][0])
    assert rows(read_history(spark, path)) == before
    apply_run(runs[1][1], path, "id", ["docks", "kiosk"], runs[1][0])
    chain = scd2_check(scd2_check(None, runs[0][1], "id", ["docks", "kiosk"], runs[0][0]), runs[1][1], "id",
                       ["docks", "kiosk"], runs[1][0])
    assert rows(read_history(spark, path)) == rows(chain)


def test_ten_chained_runs_read_each_input_once(spark):
    snap = None
    for as_of, batch in batches(spark, 10):
        snap = scd2_check(snap, batch, "id", ["docks", "kiosk"], as_of)
    plan = snap._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join FullOuter") == 9 and plan.count("LogicalRDD") == 10


# ---- mergeable distinct counts --------------------------------------------------------------

def test_distinct_stations_from_day_parts(spark):
    from dockstat.plans.marts_ops import (number_stations, region_hour_presence, region_hour_sketches, region_hourly_availability,
                                          region_hourly_parts, region_hourly_rollup, station_ids)
    fact = spark.range(20_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 50 = 7 then null else concat('s', id % 3001) end as station_id",
        "nullif(concat('r', id % 4), 'r3') as region_id", "nullif(concat('R', id % 4), 'R3') as region_name",
        "timestampadd(MINUTE, cast(id * 37 % 40000 as int), timestamp_ntz'2026-01-01 00:00:00') as ingested_at",
        "id % 9 as num_bikes_available", "cast(round(id % 7 / 7, 4) as double) as bike_availability_rate",
        "cast(null as double) as dock_availability_rate")
    ids = station_ids(fact)
    old = ids.filter("station_id < 's2'")
    first = number_stations(old, 0).collect()
    later = number_stations(ids.join(old, "station_id", "left_anti"), len(first) + 70_000).collect()   # a bucket further on
    assert sorted(r.number for r in first) == list(range(len(first)))
    numbers = spark.createDataFrame(first + later)
    want = rows(region_hourly_availability(fact))
    days = [fact.filter(f"dayofmonth(ingested_at) % 3 = {k}") for k in range(3)]
    parts = [region_hourly_parts(d) for d in days]
    seen = [region_hour_presence(d, numbers) for d in days]
    assert rows(region_hourly_rollup(parts[0].union(parts[1]).union(parts[2]), seen[0].union(seen[1]).union(seen[2]))) == want
    rough = region_hourly_rollup(region_hourly_parts(fact), region_hour_sketches(fact)).collect()
    exact = {tuple(r)[:4]: r.stations_observed for r in region_hourly_availability(fact).collect()}
    assert all(abs(r.stations_observed - exact[tuple(r)[:4]]) <= 1 + 0.05 * exact[tuple(r)[:4]] for r in rough)
    unseen = fact.withColumn("station_id", F.lit(None).cast("string"))
    assert {r.stations_observed for r in region_hourly_rollup(region_hourly_parts(unseen), region_hour_presence(unseen, numbers)).collect()} == {0}
