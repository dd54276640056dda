"""Column helpers shared by the operators."""

from promolens.functions.dates import completed_months, year_month
from promolens.functions.numeric import money, percent, ratio, round_to

__all__ = ["completed_months", "money", "percent", "ratio", "round_to", "year_month"]
