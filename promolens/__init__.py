"""Campaign analytics on Spark: typed sources, DataFrame operators and ready-made reports."""

from promolens.sources.tables import CampaignTables

__all__ = ["CampaignTables"]
