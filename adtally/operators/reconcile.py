"""Does the detail add up to the summary?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.operators.rollup import sum_of

# flag -> (measure of the detail table, measure of the summary table)
CLICK = {"gross_clk": ("gross_cnt", "gross_clk_cnt")}
CONVERSION = {
    "gross_conv": ("gross_cnt", "gross_conv_cnt"),
    "valid_conv": ("valid_cnt", "valid_conv_cnt"),
    "notify_conv": ("notify_cnt", "notify_conv_cnt"),
}
KPI = {"kpi_event": ("kpi_event_cnt", "kpi_event_cnt")}


def check(detail: DataFrame, summary: DataFrame, pairs: dict[str, tuple[str, str]], scope: str,
          missing_days: bool = False) -> DataFrame:
    """Equality flags per day (and offset).

    A day that is absent on one side drops out. With ``missing_days`` it stays
    and its flags are 0.
    """
    by = (["timezone"] if scope == "adx" else []) + ["dated"]
    left = detail.groupBy(*by).agg(*[sum_of(d, f"_d_{f}") for f, (d, _) in pairs.items()])
    right = summary.groupBy(*by).agg(*[sum_of(s, f"_s_{f}") for f, (_, s) in pairs.items()])
    both = left.join(right, by, "full_outer" if missing_days else "inner")
    flags = [
        F.coalesce((F.col(f"_d_{f}") == F.col(f"_s_{f}")).cast("int"), F.lit(0)).alias(f"{f}_flag") for f in pairs
    ]
    return both.select(*by, *flags)
