"""Reusable plan fragments that keep exact results at cluster scale."""

from riskloom.plans.quantiles import exact_median, quantile_table  # noqa: F401
from riskloom.plans.running import exact_rank, running_totals  # noqa: F401
