"""Lazy wiring of the model graph over one input folder.

Each property builds its DataFrame from the ones before it, the same order
the warehouse models reference each other; nothing runs until an action.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockstat.operators.enrich import stations_enriched, status_history
from dockstat.operators.health import health_from_history
from dockstat.operators.windows import availability_windows
from dockstat.plans import fixtures as fx
from dockstat.plans.marts_core import dim_regions, dim_stations, fct_status_snapshots
from dockstat.plans.marts_ops import station_daily_performance
from dockstat.session import use_utc
from dockstat.sources.seeds import capacity_tiers


class Models:
    """The model graph over the benchmark tables in ``sf_dir``.

    ``Models.of(spark, sf_dir)`` is a fresh graph: a query sees the tables as they are
    when it is called.
    """

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, grain: str = "declared") -> "Models":
        return cls(spark, sf_dir, grain)

    def __init__(self, spark: SparkSession, sf_dir: str, grain: str = "declared"):
        use_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.grain = grain

    # inputs
    @cached_property
    def stations(self) -> DataFrame:
        return fx.stations(self.spark, self.sf_dir)

    @cached_property
    def regions(self) -> DataFrame:
        return fx.regions(self.spark, self.sf_dir)

    @cached_property
    def status(self) -> DataFrame:
        return fx.status(self.spark, self.sf_dir)

    @cached_property
    def tiers(self) -> DataFrame:
        return capacity_tiers(self.spark)

    # intermediate
    @cached_property
    def enriched(self) -> DataFrame:
        return stations_enriched(self.stations, self.regions, self.grain)

    @cached_property
    def history(self) -> DataFrame:
        return status_history(self.status, self.enriched)

    @cached_property
    def history_read_again(self) -> DataFrame:
        """The history for plans that read it more than once, such as the windows."""
        return status_history(self.status, self.enriched, read_again=True)

    @cached_property
    def windows(self) -> DataFrame:
        return availability_windows(self.history_read_again)

    @cached_property
    def health(self) -> DataFrame:
        return health_from_history(self.history)

    # marts
    @cached_property
    def fact(self) -> DataFrame:
        return fct_status_snapshots(self.history)

    @cached_property
    def dim_stations(self) -> DataFrame:
        return dim_stations(self.enriched, self.health, self.tiers)

    @cached_property
    def dim_regions(self) -> DataFrame:
        return dim_regions(self.regions, self.dim_stations, self.grain)

    @cached_property
    def daily(self) -> DataFrame:
        return station_daily_performance(self.fact)

    def hour_run_key(self) -> F.Column:
        """Runs of the fixture feed: every snapshot of the same UTC hour."""
        return F.date_trunc("hour", F.col("ingested_at")).cast("timestamp_ntz")
