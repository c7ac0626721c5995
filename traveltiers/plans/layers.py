"""Lazy wiring of the three layers over a set of sources.

Each property builds one table as a DataFrame from the ones it depends on,
so an unused table costs nothing. ``run_pipeline`` (``plans.pipeline``)
writes each layer and reads it back instead, which also cuts lineage.
"""

from __future__ import annotations

from collections.abc import MutableMapping
from functools import cached_property

from pyspark.sql import DataFrame

from traveltiers.operators import bronze, gold, silver
from traveltiers.session import reliable_checkpoint
from traveltiers.sources.fixtures import Sources

# Fixed audit times used by the registered queries, so results are reproducible.
RUN_TS = "2024-02-01 00:00:00"
AS_OF = "2024-02-01 12:00:00"
AS_OF_LATE = "2024-02-02 13:00:00"


class Layers:
    """With ``share``, the two first levels of the gold tables (daily partials, and partials per user
    and destination) are materialised once in the shared checkpoint folder and serve all four."""

    def __init__(self, sources: Sources, run_ts: str | None = RUN_TS, share: bool = False):
        self.sources = sources
        self.run_ts = run_ts
        self.share = share

    @cached_property
    def bronze_travel_purchases(self) -> DataFrame:
        return bronze.bronze_travel_purchases(self.sources.travel_purchase, self.run_ts)

    @cached_property
    def bronze_user_features(self) -> DataFrame:
        return bronze.bronze_user_features(self.sources.user_features, self.run_ts)

    @cached_property
    def bronze_destinations(self) -> DataFrame:
        return bronze.bronze_destinations(self.sources.destination_location, self.run_ts)

    @cached_property
    def silver_travel_purchases(self) -> DataFrame:
        return silver.silver_travel_purchases(self.bronze_travel_purchases, self.run_ts)

    @cached_property
    def silver_users(self) -> DataFrame:
        return silver.silver_users(self.bronze_user_features, self.run_ts)

    @cached_property
    def silver_destinations(self) -> DataFrame:
        return silver.silver_destinations(self.bronze_destinations, self.run_ts)

    @cached_property
    def daily_partials(self) -> DataFrame:
        partials = gold.purchase_partials(self.silver_travel_purchases)
        return reliable_checkpoint(partials) if self.share else partials

    @cached_property
    def _pairs(self) -> DataFrame | None:
        return reliable_checkpoint(gold.purchase_pairs(self.silver_travel_purchases)) if self.share else None

    @cached_property
    def gold_daily_revenue_metrics(self) -> DataFrame:
        return gold.gold_daily_revenue_metrics(None, self.run_ts, self.daily_partials)

    @cached_property
    def destination_metrics(self) -> DataFrame:
        return gold.destination_metrics(self.silver_destinations, self.silver_travel_purchases, self._pairs)

    @cached_property
    def gold_destination_performance(self) -> DataFrame:
        return gold.gold_destination_performance(
            self.silver_destinations, self.silver_travel_purchases, self.run_ts, self._pairs
        )

    @cached_property
    def gold_user_engagement(self) -> DataFrame:
        return gold.gold_user_engagement(self.silver_users, self.silver_travel_purchases, self.run_ts, pairs=self._pairs)

    @cached_property
    def gold_monthly_summary(self) -> DataFrame:
        partials = self.daily_partials if self.share else None
        return gold.gold_monthly_summary(self.silver_travel_purchases, self.run_ts, partials)

    def tables(self) -> LayerTables:
        return LayerTables(self)


class LayerTables(MutableMapping):
    """The ten tables by name; each is built when it is asked for (ranks materialise their metrics then)."""

    NAMES = [
        "bronze_travel_purchases", "bronze_user_features", "bronze_destinations",
        "silver_travel_purchases", "silver_users", "silver_destinations",
        "gold_daily_revenue_metrics", "gold_destination_performance",
        "gold_user_engagement", "gold_monthly_summary",
    ]

    def __init__(self, layers: Layers):
        self._layers, self._own = layers, dict.fromkeys(self.NAMES)

    def __getitem__(self, name: str) -> DataFrame:
        own = self._own[name]
        return getattr(self._layers, name) if own is None else own

    def __setitem__(self, name: str, df: DataFrame) -> None:
        self._own[name] = df

    def __delitem__(self, name: str) -> None:
        del self._own[name]

    def __iter__(self):
        return iter(self._own)

    def __len__(self) -> int:
        return len(self._own)
