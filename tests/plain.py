"""Plain-Python versions of the window and interval operators, for small inputs."""

from dockstat.operators.windows import TIE_COLUMNS, WINDOW_COLUMNS

SCHEMA = ("station_id string, station_name string, region_id string, region_name string, total_docks long, "
          "last_reported_at timestamp, ingested_at timestamp, num_bikes_available long, num_bikes_disabled long, "
          "num_docks_available long, num_docks_disabled long, is_installed boolean, is_renting boolean, "
          "is_returning boolean, bike_availability_rate double, dock_availability_rate double")


def nulls_first(values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def by_key(rows, key, order):
    groups = {}
    for r in rows:
        groups.setdefault(r[key], []).append(r)
    return {k: sorted(g, key=lambda r: nulls_first(r[c] for c in order)) for k, g in groups.items()}


def windows(df, n=3):
    """Rows of availability_windows as sorted tuples."""
    out = []
    for g in by_key(df.collect(), "station_id", ["ingested_at", *TIE_COLUMNS]).values():
        for i, r in enumerate(g):
            rates = [round(x.bike_availability_rate * 10000) for x in g[max(0, i - n + 1):i + 1]
                     if x.bike_availability_rate is not None]
            prev = g[i - 1] if i else None
            out.append((*(r[c] for c in WINDOW_COLUMNS), sum(rates) / len(rates) / 10000 if rates else None,
                        prev and prev.num_bikes_available, prev and prev.num_docks_available, len(g) - i))
    return sorted(out, key=str)


def intervals(df, key, time, checks, keep=()):
    """Rows of scd2_from_history as sorted tuples."""
    out = []
    for k, g in by_key(df.collect(), key, [time, *checks, *keep]).items():
        versions = []
        for r in g:
            if not versions or any(r[c] != versions[-1][-1][c] for c in checks):
                versions.append([])
            versions[-1].append(r)
        for i, v in enumerate(versions):
            times = [r[time] for r in v if r[time] is not None]
            nxt = [r[time] for r in versions[i + 1] if r[time] is not None] if i + 1 < len(versions) else []
            start, end = min(times, default=None), min(nxt, default=None)
            seconds = int((end - start).total_seconds() // 1) if start is not None and end is not None else None
            out.append((k, i + 1, *(v[0][c] for c in checks), *(v[0][c] for c in keep), start, end,
                        max(times, default=None), len(v), seconds))
    return sorted(out, key=str)
