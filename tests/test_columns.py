import math

import pytest

from dockstat.functions import columns as C


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("n,d,expected", [
    (5, 10, 0.5), (15, 10, 1.0), (None, 10, None), (5, 0, None), (5, None, None),
    (1, 3, 0.3333), (2, 3, 0.6667), (1, 32, 0.0313), (0, 7, 0.0),
])
def test_capped_rate(spark, n, d, expected):
    got = one(spark, C.capped_rate("n", "d"), "n long, d long", (n, d))
    assert got == expected


@pytest.mark.parametrize("rate,label", [
    (None, "unknown"), (0.0, "empty"), (0.1999, "critical"), (0.2, "low"), (0.4, "moderate"),
    (0.7, "good"), (0.9, "full"), (1.0, "full"),
])
def test_availability_bucket(spark, rate, label):
    assert one(spark, C.availability_bucket("r"), "r double", (rate,)) == label


def test_score_components(spark):
    df = spark.createDataFrame(
        [(0.5, True, True, False, 1, 1, 10), (None, True, True, True, 9, 9, 10),
         (0.0002, False, False, False, 0, 0, 0), (0.3, None, True, True, 1, 0, None)],
        "r double, a boolean, b boolean, c boolean, bd long, dd long, docks long")
    rows = df.select(
        C.hundredths(C.score_rate_h("r")).alias("sr"),
        C.hundredths(C.score_operational_h("a", "b", "c")).alias("so"),
        C.hundredths(C.score_low_disabled_h("bd", "dd", "docks")).alias("sl")).collect()
    assert [tuple(r) for r in rows] == [
        (12.5, 16.67, 20.0),   # 0.5*25; 2/3*25; 25 - 2/10*25
        (0.0, 25.0, 0.0),      # NULL rate -> 0; disabled above docks -> 0, not negative
        (0.01, 0.0, 25.0),     # 0.0002*25 = 0.005 rounds half up; zero docks -> 25
        (7.5, None, None),     # NULL flag -> NULL; NULL docks -> NULL (not 0)
    ]


def test_health_status_boundaries(spark):
    df = spark.createDataFrame([(7500,), (7499,), (5000,), (4999,), (None,)], "t long")
    assert [r[0] for r in df.select(C.health_status("t")).collect()] == [
        "healthy", "at_risk", "at_risk", "critical", "critical"]


def test_composite_rounds_once(spark):
    # components 8.333.. + 8.333.. (rate 1/3) + 16.666.. + 25 -> one rounding
    got = one(spark, C.composite_health_score("br", "dr", "a", "b", "c", "bd", "dd", "docks"),
              "br double, dr double, a boolean, b boolean, c boolean, bd long, dd long, docks long",
              (0.3333, 0.3333, True, True, False, 0, 0, 10))
    assert got == round(0.3333 * 25 * 2 + 50 / 3 + 25, 2)


def test_haversine(spark):
    got = one(spark, C.haversine_km("a", "b", "c", "d"), "a double, b double, c double, d double",
              (40.7, -74.0, 40.8, -74.0))
    assert got == pytest.approx(2 * 6371 * math.asin(math.sin(math.radians(0.1) / 2)), abs=1e-4)
    assert one(spark, C.haversine_km("a", "b", "c", "d"), "a double, b double, c double, d double",
               (1.0, 2.0, 1.0, 2.0)) == 0.0


@pytest.mark.parametrize("pre_n,post_n,expected", [(0, 5, None), (None, 5, None), (10, 10, 0.8944)])
def test_z_score(spark, pre_n, post_n, expected):
    got = one(spark, C.z_score("pm", "qm", "pn", "qn"), "pm double, qm double, pn long, qn long",
              (0.5, 0.6, pre_n, post_n))
    assert got == expected
