"""Column functions: availability rates, buckets, scores, distance, z-score.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` so they stay inside whole-stage code generation.

Rates are kept exact: a rate rounded to four decimals is an integer number
of basis points (``bp``).  Rounding is done on integers (half up), means are
integer sums divided by integer counts, so results do not depend on the
order in which partitions are combined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's definitions.
EARTH_RADIUS_KM = 6371
RATE_BUCKETS = [  # (upper bound exclusive, label); NULL -> unknown, 0 -> empty
    (0.20, "critical"),
    (0.40, "low"),
    (0.70, "moderate"),
    (0.90, "good"),
]
HEALTHY_AT = 75
AT_RISK_AT = 50
Z_POOLED_STD = 0.25
Z_SIGNIFICANT = 1.96


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(n, d) -> Column:
    """``n / d`` as double, NULL when ``d`` is zero or either side is NULL."""
    return F.try_divide(_c(n).cast("double"), _c(d).cast("double"))


def half_up_div(num, den) -> Column:
    """Exact ``round(num / den)`` half up for non-negative integers; NULL if den = 0.

    Integer quotient and remainder, so nothing passes through a double and nothing is
    doubled: exact up to the range of the operands' own type.
    """
    num, den = _c(num), _c(den)
    den = F.when(den != 0, den)
    rest = F.pmod(num, den)
    return F.call_function("div", num, den) + F.when(rest >= den - rest, 1).otherwise(0)


def capped_rate_bp(n, d) -> Column:
    """Basis points of ``least(1, n/d)`` rounded to 4 dp.

    NULL when ``d`` is 0 (zero-capacity station) and -- unlike Spark's
    ``least`` which skips NULLs -- NULL when ``n`` or ``d`` is NULL.
    """
    n, d = _c(n).cast("long"), _c(d).cast("long")
    return (F.when(n.isNull() | d.isNull() | (d == 0), F.lit(None).cast("long"))
            .otherwise(F.least(F.lit(10000).cast("long"),
                               half_up_div(n * 10000, d).cast("long"))))


def bp_to_rate(bp) -> Column:
    return _c(bp).cast("double") / 10000


def capped_rate(n, d) -> Column:
    """``round(least(1.0, safe_divide(n, d)), 4)``, NULL when d = 0 or NULL inputs."""
    return bp_to_rate(capped_rate_bp(n, d))


def rate_to_bp(rate) -> Column:
    """Back from a 4-dp rate to its integer basis points."""
    return F.round(_c(rate) * 10000).cast("long")


def mean_rounded(total, count, unit: int = 10000) -> Column:
    """``total / count`` rounded half up, for integer sums of units of ``1/unit``.

    Basis points (unit 10000) give a 4-dp mean, hundredths (unit 100) a 2-dp one.
    """
    return F.floor(F.try_divide(_c(total), _c(count)) + 0.5) / unit


def avg_rate_4dp(rate) -> Column:
    """Aggregate: ``round(avg(rate), 4)`` computed exactly from basis points."""
    bp = rate_to_bp(rate)
    return mean_rounded(F.sum(bp), F.count(bp))


def availability_bucket(rate) -> Column:
    """Label a 0-1 availability rate."""
    r = _c(rate)
    expr = F.when(r.isNull(), "unknown").when(r == 0, "empty")
    for bound, label in RATE_BUCKETS:
        expr = expr.when(r < bound, label)
    return expr.otherwise("full")


def _deg_to_rad(x: Column) -> Column:
    return x * F.acos(F.lit(-1.0)) / 180.0


def haversine_term(lat1, lon1, lat2, lon2) -> Column:
    """The monotone inner term ``a`` of the haversine formula (rank on this)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    return (F.pow(F.sin(_deg_to_rad(lat2 - lat1) / 2), 2)
            + F.cos(_deg_to_rad(lat1)) * F.cos(_deg_to_rad(lat2))
            * F.pow(F.sin(_deg_to_rad(lon2 - lon1) / 2), 2))


def term_to_km(a) -> Column:
    """Great-circle km from the haversine term, rounded to 4 dp."""
    return F.round(2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(_c(a), F.lit(1.0)))), 4)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Distance in km between two (lat, lon) points, rounded to 4 dp."""
    return term_to_km(haversine_term(lat1, lon1, lat2, lon2))


def z_score(pre_mean, post_mean, pre_n, post_n, pooled_std: float = Z_POOLED_STD) -> Column:
    """Approximate unsigned z statistic of a pre/post mean difference.

    NULL when either count is 0 or NULL.  ``> 1.96`` is significant at 95 %.
    """
    pre_mean, post_mean, pre_n, post_n = map(_c, (pre_mean, post_mean, pre_n, post_n))
    denom = F.lit(float(pooled_std)) * F.sqrt(safe_divide(F.lit(1), pre_n) + safe_divide(F.lit(1), post_n))
    return (F.when((pre_n == 0) | (post_n == 0), F.lit(None).cast("double"))
            .otherwise(F.round(F.try_divide(F.abs(post_mean - pre_mean), denom), 4)))


# -- health score components, in integer hundredths of a point -------------

def score_rate_h(rate) -> Column:
    """``round(coalesce(rate, 0) * 25, 2)`` in hundredths (rate*25 = bp/400)."""
    bp = F.coalesce(rate_to_bp(rate), F.lit(0).cast("long"))
    return half_up_div(bp, F.lit(4))


def _flag_sum(installed, renting, returning) -> Column:
    return (_c(installed).cast("int") + _c(renting).cast("int") + _c(returning).cast("int"))


def score_operational_h(installed, renting, returning) -> Column:
    """``round((installed + renting + returning) / 3 * 25, 2)`` in hundredths."""
    return half_up_div(_flag_sum(installed, renting, returning) * 2500, F.lit(3))


def score_low_disabled_h(bikes_disabled, docks_disabled, total_docks) -> Column:
    """``round(greatest(0, 25 - (bd + dd) / docks * 25), 2)``; 25 when docks = 0.

    NULL when any input is NULL (NULL-propagating ``greatest``).
    """
    bd, dd, docks = _c(bikes_disabled).cast("long"), _c(docks_disabled).cast("long"), _c(total_docks).cast("long")
    free = docks - bd - dd
    return (F.when(docks == 0, F.lit(2500).cast("long"))
            .when(free.isNull(), F.lit(None).cast("long"))
            .when(free <= 0, F.lit(0).cast("long"))
            .otherwise(half_up_div(free * 2500, docks).cast("long")))


def hundredths(h) -> Column:
    return _c(h).cast("double") / 100


def health_status(total_h) -> Column:
    """healthy >= 75, at_risk >= 50, else (including NULL) critical."""
    t = _c(total_h)
    return (F.when(t >= HEALTHY_AT * 100, "healthy")
            .when(t >= AT_RISK_AT * 100, "at_risk")
            .otherwise("critical"))


def composite_health_score(bike_rate, dock_rate, installed, renting, returning,
                           bikes_disabled, docks_disabled, total_docks) -> Column:
    """The four 25-point components summed, then rounded once to 2 dp.

    Exact: all parts are put over the common denominator ``12 * docks``.
    Rates are expected at 4 dp, as produced by :func:`capped_rate`.
    """
    bpb = F.coalesce(rate_to_bp(bike_rate), F.lit(0).cast("long"))
    bpd = F.coalesce(rate_to_bp(dock_rate), F.lit(0).cast("long"))
    k = _flag_sum(installed, renting, returning).cast("long")
    docks = _c(total_docks).cast("long")
    free = docks - _c(bikes_disabled).cast("long") - _c(docks_disabled).cast("long")
    den = F.when(docks == 0, F.lit(1).cast("long")).otherwise(docks) * 12
    low = (F.when(docks == 0, F.lit(30000).cast("long"))
           .when(free.isNull(), F.lit(None).cast("long"))
           .otherwise(F.greatest(free, F.lit(0).cast("long")) * 30000))
    d1 = F.when(docks == 0, F.lit(1).cast("long")).otherwise(docks)
    num = (bpb + bpd) * 3 * d1 + k * 10000 * d1 + low
    return hundredths(half_up_div(num, den))
