"""The layers over the given tables, each a lazy DataFrame that holds only what a query asks of it."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from riskmart import session
from riskmart.operators import bronze, gold, runlog, silver
from riskmart.sources import given, landing

QUARANTINED_AT = "2024-01-30 00:00:00"


class Layers:
    """Raw, Bronze, Silver, Gold and the run log of one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = session.configured(spark), folder

    @cached_property
    def source(self) -> DataFrame:
        return given.transaction_source(self.spark, self.folder)

    @cached_property
    def raw(self) -> DataFrame:
        return landing.land(self.source, given.LOADED_AT, given.SOURCE_FILE)

    @cached_property
    def fx(self) -> DataFrame:
        return landing.land(given.fx_source(self.spark, self.folder), given.LOADED_AT, "fx_rate.csv")

    @cached_property
    def judged(self) -> DataFrame:
        return bronze.judge(self.raw)

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze.good(self.judged)

    @cached_property
    def whole_bronze(self) -> DataFrame:
        """Bronze by the plan for all columns."""
        return bronze.build(self.raw)

    @cached_property
    def quarantine(self) -> DataFrame:
        return bronze.quarantine(self.judged, QUARANTINED_AT)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.build(self.bronze, self.fx)

    @cached_property
    def whole_silver(self) -> DataFrame:
        return silver.build(self.whole_bronze, self.fx)

    @cached_property
    def gold(self) -> DataFrame:
        return gold.monthly(self.silver)

    @cached_property
    def runs(self) -> DataFrame:
        return runlog.current(given.run_log_events(self.spark, self.folder))

