"""The figures behind the executive summary; drawing them is left to the reader."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.functions.bands import wait_colour
from visitlake.functions.numbers import mean, ratio
from visitlake.functions.text import thousands_label
from visitlake.operators.windows import gap_tiers
from visitlake.plans.analysis import annual_growth, service_risk
from visitlake.plans.facetcells import FacetCells
from visitlake.sources.star import Star

CRORE = 10_000_000
TIER_GAP = Decimal("1.00")


def demand(star: Star) -> DataFrame:
    """Visits and revenue in crore per year, with the bar label."""
    yearly = annual_growth(star)
    return yearly.select(
        "VisitYear", "TotalVisits", thousands_label(F.col("TotalVisits")).alias("VisitsLabel"),
        ratio(F.col("TotalRevenueINR"), F.lit(CRORE), 2, "decimal(18,2)").alias("RevenueCrore"),
    )


def wait_tiers(star: Star, gap: Decimal = TIER_GAP) -> DataFrame:
    """Departments with their colour and tier; a jump of more than ``gap`` minutes between
    neighbouring averages opens a new tier. One row per department name."""
    risk = service_risk(star)
    tiered = gap_tiers(risk, "AverageWaitMinutes", F.lit(gap), "WaitTier")
    return tiered.select(
        "DepartmentName", "TotalVisits", "AverageWaitMinutes", "AverageSatisfaction",
        wait_colour(F.col("AverageWaitMinutes")).alias("WaitColour"), "WaitTier",
    )


def service_of(cells: FacetCells) -> DataFrame:
    """Average wait and satisfaction per department, out of stored cells."""
    service, n = cells.by("DepartmentName").filter("DepartmentName IS NOT NULL"), F.col("Visits")
    return service.select("DepartmentName", n.alias("TotalVisits"), mean(F.col("Scores"), n).alias("AverageSatisfaction"),
                          mean(F.col("WaitMinutes"), n).alias("AverageWaitMinutes"))


def extremes(star: Star, cells: FacetCells | None = None) -> DataFrame:
    """The departments with the longest and the shortest average wait, from stored cells if there are some."""
    risk = service_risk(star) if cells is None else service_of(cells)
    row = F.struct("DepartmentName", "TotalVisits", "AverageWaitMinutes", "AverageSatisfaction")
    # Equal waits go to the lower satisfaction, then to the name.
    rest = [F.col("AverageSatisfaction"), F.col("DepartmentName")]
    longest = F.min_by(row, F.struct(-F.col("AverageWaitMinutes"), *rest)).alias("longest")
    shortest = F.min_by(row, F.struct(F.col("AverageWaitMinutes"), *rest)).alias("shortest")
    both = risk.agg(longest, shortest)
    pairs = F.array(*(
        F.struct(F.lit(name).alias("Extreme"), F.col(name).alias("row")) for name in ("longest", "shortest")
    ))
    return both.select(F.inline(pairs)).select("Extreme", "row.*")
