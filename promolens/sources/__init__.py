"""Reading, typing and writing the campaign tables."""

from promolens.sources.files import conform, read_table, write_bucketed, write_table
from promolens.sources.tables import CampaignTables

__all__ = ["CampaignTables", "conform", "read_table", "write_bucketed", "write_table"]
