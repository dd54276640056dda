"""The set of tables that the reports read."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from promolens.operators.keys import one_row_per_key
from promolens.operators.lifecycle import latest_campaign_views
from promolens.operators.rollup import campaign_facts, campaign_totals
from promolens.schemas import SPECS
from promolens.sources.files import read_table

# Tables whose keys reports count.
COUNTED = ("creators", "videos", "campaigns")


@dataclass(frozen=True)
class CampaignTables:
    """The campaign tables; a report needs only those that it reads.

    The ``stored_`` frames are optional saved copies of ``totals``, ``facts`` and ``latest_views``,
    all that the reports need of the daily rows.
    """

    creators: DataFrame | None = None
    videos: DataFrame | None = None
    campaigns: DataFrame | None = None
    campaign_daily_metrics: DataFrame | None = None
    competitor_benchmarks: DataFrame | None = None
    creator_events: DataFrame | None = None
    stored_totals: DataFrame | None = None
    stored_facts: DataFrame | None = None
    stored_latest_views: DataFrame | None = None

    @classmethod
    def load(
        cls, spark: SparkSession, root: str, fmt: str = "parquet", *, unique_keys: bool = False
    ) -> CampaignTables:
        """Tables stored as ``<root>/<table name>``.

        Reports count distinct creators, videos and campaigns. So of rows with the same key one is read, the
        largest (``one_row_per_key``), and none without a key, unless ``unique_keys`` promises that there are no such rows.
        """
        found = {name: read_table(spark, name, f"{root}/{name}", fmt) for name in SPECS}
        if not unique_keys:
            for name in COUNTED:
                found[name] = one_row_per_key(found[name], SPECS[name].primary_key)
        return cls(**found)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> CampaignTables:
        """Catalog tables of ``database``, such as ``write_bucketed`` makes.

        They are taken as they are stored: a cast would hide the bucketing from the joins.
        """
        return cls(**{name: spark.table(f"{database}.{name}") for name in SPECS})

    @property
    def totals(self) -> DataFrame:
        """The daily rows summed per campaign id, those of unknown campaigns included."""
        if self.stored_totals is not None:
            return self.stored_totals
        return campaign_totals(self.campaign_daily_metrics)

    @property
    def facts(self) -> DataFrame:
        """One row per campaign: the stored facts if there are any, else computed on use."""
        if self.stored_facts is not None:
            return self.stored_facts
        return campaign_facts(self.campaigns, self.totals)

    @property
    def latest_views(self) -> DataFrame:
        """Active creators with the views around the start of their latest campaign."""
        if self.stored_latest_views is not None:
            return self.stored_latest_views
        return latest_campaign_views(self.creators, self.campaigns, self.campaign_daily_metrics)

    def with_facts(self, facts: DataFrame) -> CampaignTables:
        """Same tables, reading campaign facts that were saved earlier instead of the metrics."""
        return replace(self, stored_facts=facts)

    def stored(self, spark: SparkSession, folder: str, mode: str = "errorifexists") -> CampaignTables:
        """Same tables, with totals, facts and latest views saved in ``folder`` and read from there.

        The daily rows are read twice for that, and by no report after it.
        """

        def saved(name: str, df: DataFrame) -> DataFrame:
            df.write.mode(mode).parquet(f"{folder}/{name}")
            return spark.read.parquet(f"{folder}/{name}")

        known = replace(self, stored_totals=saved("campaign_totals", self.totals))
        return replace(
            known,
            stored_facts=saved("campaign_facts", known.facts),
            stored_latest_views=saved("latest_views", known.latest_views),
        )

    def items(self) -> list[tuple[str, DataFrame]]:
        """Name and data of every table that is present."""
        present = ((name, getattr(self, name)) for name in SPECS)
        return [(name, df) for name, df in present if df is not None]

    def register_views(self) -> None:
        """Make the tables available to Spark SQL under their own names."""
        for name, df in self.items():
            df.createOrReplaceTempView(name)
