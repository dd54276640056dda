"""Comparison of one brand with its competitors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions import round_to


def peer_benchmark(
    benchmarks: DataFrame, home: str, home_prefix: str = "home", match_month: bool = False
) -> DataFrame:
    """``home`` against every competitor of the same category.

    ``match_month`` also requires the same benchmark month, for tables that hold several. Without
    it every month of the home brand is compared with every month of a competitor, as the report
    is defined: the rows of a category multiply.
    """
    keys = ["category", "benchmark_month"] if match_month else ["category"]
    kpis = {"cpm": "avg_cpm_usd", "ctr": "avg_ctr_pct", "roas": "avg_roas"}
    own = benchmarks.filter(F.col("competitor_name") == home).select(
        *keys, *(F.col(source).alias(f"own_{kpi}") for kpi, source in kpis.items())
    )
    peers = benchmarks.filter(F.col("competitor_name") != home).select(
        *keys,
        "competitor_name",
        *(F.col(source).alias(f"competitor_{kpi}") for kpi, source in kpis.items()),
    )

    def lead(kpi: str):
        return round_to(F.col(f"own_{kpi}") - F.col(f"competitor_{kpi}"), 2)

    better_roas = F.col("own_roas") > F.col("competitor_roas")
    cheaper = F.col("own_cpm") < F.col("competitor_cpm")
    return peers.join(own, keys).select(
        "category",
        F.col("own_cpm").alias(f"{home_prefix}_cpm"),
        "competitor_cpm",
        "competitor_name",
        lead("cpm").alias("cpm_diff"),
        F.col("own_ctr").alias(f"{home_prefix}_ctr"),
        "competitor_ctr",
        lead("ctr").alias("ctr_diff"),
        F.col("own_roas").alias(f"{home_prefix}_roas"),
        "competitor_roas",
        lead("roas").alias("roas_advantage"),
        F.when(better_roas & cheaper, "Strong Advantage")
        .when(better_roas, "Partial Advantage")
        .otherwise("Disadvantage")
        .alias("competitive_position"),
    )
