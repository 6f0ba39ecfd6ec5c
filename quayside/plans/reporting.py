"""M20 ``report_inbound`` and M21 ``report_outbound``: tall metric tables.

Both attach warehouse name and country through two small dimension joins.
The fact side is reduced first (per-warehouse partial sums, or the filtered
fill-rate rows), so the dimension joins and the final grouping see only a
handful of rows per warehouse.

The models have the tall columns only.  ``KEYED`` has the same rows before those columns are selected: what tells rows of
one surrogate key apart (warehouses the dimension does not name, facility types of a warehouse) is kept in ``ROW_KEY``,
so a merge takes every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.operators import metrics as M
from quayside.operators import relops as R
from quayside.plans.project import Project, model


def with_warehouse_country(p: Project, df: DataFrame) -> DataFrame:
    """``LEFT JOIN dim_warehouse USING (warehouse_id) LEFT JOIN country USING (country_id)``."""
    wh = p.dimension("dim_warehouse", "warehouse_id", "warehouse_name", "country_id")
    country = p.dimension("country", "country_id", "country_long", source=True)
    return df.join(wh, "warehouse_id", "left").join(country, "country_id", "left")


# The inbound report's branches in their declared order (two repeat).
INBOUND_SUM_BRANCHES = [
    M.MetricBranch("527", "EOD IB Units on Yard & Doors", "sum_total_amount_units"),
    M.MetricBranch("1474", "Trailers out of Compliance vs 72 Hr Yard Arrival to Unload SLA", "sum_out_of_arrival_72_hours"),
    M.MetricBranch("574", "Trailers out of Compliance vs 1 - Day Appointment to Unload SLA", "sum_out_of_appt_1_day"),
    M.MetricBranch("1474", "Trailers out of Compliance vs 72 Hr Yard Arrival to Unload SLA", "sum_out_of_arrival_72_hours"),
    M.MetricBranch("527", "EOD IB Units on Yard & Doors", "sum_total_amount_units"),
    M.MetricBranch("574", "Total Trailers out of Compliance vs IB SLA", "sum_out_of_both_sla"),
]
YARD_UTILIZATION_BRANCH = M.MetricBranch("174", "Yard Utilization", "amount_of_units", "yard_capacity")

# The outbound report's branches (cadence, ship class, id, name).
OUTBOUND_BRANCHES = [
    ("daily", "SP", "310", "Small Parcel Fill Rate - Yesterday"),
    ("last3days", "SP", "310", "Small Parcel Fill Rate - Last 3 Days Average [For graph]"),
]

DIMS = ["warehouse_name", "country_long", "time_base_date"]
ROW_KEY = ["warehouse_id", "is_middle_mile"]  # null where a row is summed over warehouses, or has no facility type


def inbound_keyed_rows(p: Project) -> DataFrame:
    day = cal.lit_date(p.ctx.report_date)
    # branch 174: one row per yard-utilisation row, no grouping
    yu = p.ref("metric_yard_utilization").where(F.col("report_date").cast("date") == day)
    yu = with_warehouse_country(p, yu.select("warehouse_id", "report_date", "amount_of_units", "yard_capacity"))
    yu = M.stack_branches(yu.withColumn("time_base_date", F.col("report_date").cast("date")),
                          ["warehouse_id", *DIMS], [YARD_UTILIZATION_BRANCH])

    # six SUM branches over the same grouping: one aggregate, then stacked
    it = p.ref("metric_inbound_trailers").where(F.col("report_date") == day)
    sums = ["total_amount_units", "out_of_arrival_72_hours", "out_of_appt_1_day", "out_of_both_sla"]
    per_wh = it.groupBy("warehouse_id", "report_date").agg(*[F.sum(c).alias(c) for c in sums])
    named = with_warehouse_country(p, per_wh)
    grouped = named.groupBy(*[F.col(c) for c in ("warehouse_name", "country_long")],
                            F.col("report_date").cast("date").alias("time_base_date")
                            ).agg(*[F.sum(c).alias(f"sum_{c}") for c in sums])
    sb = M.stack_branches(grouped.withColumn("warehouse_id", F.lit(None).cast(yu.schema["warehouse_id"].dataType)),
                          ["warehouse_id", *DIMS], INBOUND_SUM_BRANCHES)
    return R.union_all([yu, sb]).withColumn("is_middle_mile", F.lit(None).cast("string"))


def inbound_rows(p: Project) -> DataFrame:
    return inbound_keyed_rows(p).drop(*ROW_KEY)


@model("report_inbound")
def report_inbound(p: Project) -> DataFrame:
    return M.tall_rows(inbound_rows(p), p.ctx.current_timestamp)


def outbound_keyed_rows(p: Project) -> DataFrame:
    fr = p.ref("metric_fill_rate").where(F.col("report_date") == cal.lit_date(p.ctx.report_date))
    cond = None
    for cadence, ship_class, _, _ in OUTBOUND_BRANCHES:
        c = (F.col("cadence") == cadence) & (F.col("ship_class") == ship_class)
        cond = c if cond is None else cond | c
    fr = fr.where(cond)
    named = with_warehouse_country(p, fr.select("warehouse_id", "report_date", "cadence", "ship_class", "is_middle_mile", "fill_rate_mm"))
    label_id, label_name = None, None
    for cadence, ship_class, mid, mname in OUTBOUND_BRANCHES:
        c = (F.col("cadence") == cadence) & (F.col("ship_class") == ship_class)
        label_id = F.when(c, F.lit(mid)) if label_id is None else label_id.when(c, F.lit(mid))
        label_name = F.when(c, F.lit(mname)) if label_name is None else label_name.when(c, F.lit(mname))
    return named.select(
        *ROW_KEY, "warehouse_name", "country_long",
        label_id.alias("metric_id"), label_name.alias("metric_name"),
        F.col("report_date").cast("date").alias("time_base_date"),
        F.col("fill_rate_mm").cast("double").alias("metric_numerator"),
        F.lit(1.0).alias("metric_denominator"),
    )


def outbound_rows(p: Project) -> DataFrame:
    return outbound_keyed_rows(p).drop(*ROW_KEY).distinct()  # GROUP BY every output column (A10)


@model("report_outbound")
def report_outbound(p: Project) -> DataFrame:
    return M.tall_rows(outbound_rows(p), p.ctx.current_timestamp)


# What a run merges into the targets of the reports: their rows with ``ROW_KEY``.
KEYED = {
    "report_inbound": lambda p: M.tall_rows(inbound_keyed_rows(p), p.ctx.current_timestamp, ROW_KEY),
    "report_outbound": lambda p: M.tall_rows(outbound_keyed_rows(p), p.ctx.current_timestamp, ROW_KEY),
}
