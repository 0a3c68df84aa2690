"""Above the broadcast bound the joins fall back to shuffles -- same results."""

from dockstat.operators.enrich import status_history
from dockstat.operators.nearest import nearest_station
from dockstat.plans import fixtures as fx
from dockstat.plans.context import Models
from dockstat.plans.experiments import intervention_results, with_station_names

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_without_broadcast(spark):
    m = Models(spark, SF)
    expected = rows(m.history)
    # above the bound no hint is given; with Spark's own size threshold off too,
    # the join is a shuffle join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = status_history(m.status, m.enriched, broadcast_rows=10)   # 1,385 stations > 10
        p = plan(small)
        assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
        assert rows(small) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nearest_without_broadcast(spark):
    m = Models(spark, SF)
    bikes = fx.bikes(spark, SF)
    expected = rows(nearest_station(bikes, m.enriched))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(nearest_station(bikes, m.enriched, broadcast_rows=10)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_interventions_without_broadcast(spark):
    m = Models(spark, SF)
    iv = with_station_names(fx.interventions(spark, SF), m.enriched)
    from dockstat.plans import experiments
    j_big = rows(experiments._windowed(iv, m.fact, 14))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j_small = experiments._windowed(iv, m.fact, 14, broadcast_rows=10)
        assert rows(j_small) == j_big
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert intervention_results(iv, m.fact).count() > 0
