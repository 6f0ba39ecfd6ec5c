"""Single-operator queries of SURVEY §2, each over whole stand-in tables."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.catalog import query
from quayside.functions import backfill as B
from quayside.functions import calendar as cal
from quayside.functions import scalar as S
from quayside.operators import metric_dictionary as MD
from quayside.operators import metrics as M
from quayside.operators import quality as Q
from quayside.operators import relops as R
from quayside.operators.percentiles import discrete_percentile
from quayside.operators import sinks
from quayside.plans import dim_date as DD
from quayside.plans import dim_warehouse as DW
from quayside.plans import throughput as TV
from quayside.plans import yard_utilization as YU
from quayside.plans.context import RunContext
from quayside.plans.project import Project
from quayside.plans.run import run_models
from quayside.sources.registry import Sources


# --- calendar -----------------------------------------------------------------------------

@query("dim_date")
def q_dim_date(p: Project) -> DataFrame:
    """M2: calendar attributes for every distinct order and ship date, sorted by date."""
    t = p.src.tables
    dates = (t.orders.select(F.col("o_orderdate").alias("d"))
             .unionByName(t.lineitem.select(F.col("l_shipdate").alias("d"))))
    return DD.calendar_for(dates, "d", p.ctx.current_timestamp).orderBy("date_actual")


@query("gen_date_range")
def q_gen_date_range(p: Project) -> DataFrame:
    """One row per day from the first to the last order date, both ends included."""
    return DD.calendar(DD.date_range_of(p.src.tables.orders, "o_orderdate"), p.ctx.current_timestamp)


# --- §2.1 scans, sinks, materialisation -----------------------------------------------------------


def _out_path(p: Project, name: str) -> str:
    return os.path.join(p.materialize_dir, "sinks", name, uuid.uuid4().hex[:8])


@query("scan_source")
def q_scan_source(p: Project) -> DataFrame:
    """Declared source scan (the weekly fill-rate fact)."""
    return p.source("weekly_fill_rate")


@query("scan_ref")
def q_scan_ref(p: Project) -> DataFrame:
    """Scan of another model's output (materialised warehouse dimension)."""
    return p.ref("dim_warehouse")


@query("scan_external")
def q_scan_external(p: Project) -> DataFrame:
    """S3: scan of a table outside the model registry (journeys)."""
    return p.source("journey")


@query("scan_upload_snapshot")
def q_scan_upload_snapshot(p: Project) -> DataFrame:
    """Only yesterday's upload of the daily yard sheet."""
    return p.source("yard_sheet").where(F.col("upload_date") == cal.lit_date(p.ctx.report_date))


@query("sink_full_refresh")
def q_sink_full_refresh(p: Project) -> DataFrame:
    """Replace the target; written twice, read back once (idempotent)."""
    path = _out_path(p, "fill_rate_table")
    df = p.ref("metric_fill_rate")
    sinks.write_table(df, path)
    sinks.write_table(df, path)
    return p.spark.read.parquet(path)


@query("sink_cluster_by")
def q_sink_cluster_by(p: Project) -> DataFrame:
    """Output clustered (co-partitioned and sorted) by warehouse."""
    path = _out_path(p, "fill_rate_clustered")
    sinks.write_table(p.ref("metric_fill_rate"), path, cluster_by=["warehouse_id"])
    return p.spark.read.parquet(path)


@query("sink_insert_overwrite")
def q_sink_insert_overwrite(p: Project) -> DataFrame:
    """The previous day's partition survives a run that writes today's."""
    path = _out_path(p, "fill_rate_partitioned")
    fr = p.ref("metric_fill_rate")
    prev = fr.withColumn("report_date", F.date_sub("report_date", 1))
    sinks.insert_overwrite(prev, path, cluster_by=["warehouse_id"])
    sinks.insert_overwrite(fr, path, cluster_by=["warehouse_id"])
    sinks.insert_overwrite(fr, path, cluster_by=["warehouse_id"])
    return p.spark.read.parquet(path)


# Fixed value: an earlier run of the warehouse dimension (European offsets differ then).
EARLIER_RUN = dt.datetime(1998, 3, 30, 12, 0, 0)


def _earlier_project(p: Project) -> Project:
    ctx = RunContext(as_of=EARLIER_RUN, params=p.ctx.params)
    return Project(p.spark, p.src, ctx, materialize_dir=os.path.join(p.materialize_dir, "earlier", uuid.uuid4().hex[:8]))


@query("incremental_antijoin_target")
def q_incremental_antijoin_target(p: Project) -> DataFrame:
    """An incremental run emits only rows whose record hash is not in the target."""
    target = _earlier_project(p).ref("dim_warehouse")
    run = p.fork()
    run.targets["dim_warehouse"] = target
    return run.build("dim_warehouse")


@query("sink_merge_upsert")
def q_sink_merge_upsert(p: Project) -> DataFrame:
    """Keyed upsert of the incremental rows into the earlier table; matched
    rows update the listed columns only (creation time and name stay)."""
    path = _out_path(p, "dim_warehouse_table")
    earlier = _earlier_project(p).ref("dim_warehouse")
    sinks.write_table(earlier, path)
    run = p.fork()
    run.targets["dim_warehouse"] = p.spark.read.parquet(path)
    updates = run.build("dim_warehouse")
    return sinks.merge_upsert(p.spark, updates, path, [DW.UNIQUE_KEY], DW.MERGE_UPDATE_COLUMNS)


@query("incremental_lookback")
def q_incremental_lookback(p: Project) -> DataFrame:
    """An incremental run reads visits created in the last six months only."""
    start = B.regular_6_month_backfill(p.ctx)
    q = Project(p.spark, p.src, RunContext(as_of=p.ctx.as_of, params={**p.ctx.params, "visit_lookback_start": start}),
                materialize_dir=os.path.join(p.materialize_dir, "lookback", uuid.uuid4().hex[:8]))
    return q.build("dim_yard_trailer")


@query("audit_columns")
def q_audit_columns(p: Project) -> DataFrame:
    """Creation and modification stamps from the run's as_of."""
    ts = cal.lit_ntz(p.ctx.current_timestamp)
    return p.source("facility_type").select("*", ts.alias("dwh_creation_timestamp"), ts.alias("dwh_modified_timestamp"))


@query("run_limit")
def q_run_limit(p: Project) -> DataFrame:
    """A CI run writes the first rows of a table in grain order (the cap is the feature)."""
    path = _out_path(p, "fill_rate_ci")
    sinks.write_table(sinks.ci_limit(p.ref("metric_fill_rate"), 10, ["warehouse_id", "ship_class", "cadence"]), path)
    return p.spark.read.parquet(path)


@query("view_materialization")
def q_view_materialization(p: Project) -> DataFrame:
    """A model published as a temporary view and read by name."""
    sinks.register_view(p.ref("metric_fill_rate"), "quayside_fill_rate_view")
    return p.spark.table("quayside_fill_rate_view")


# --- §2.2 projections, filters, predicates --------------------------------------------------------

@query("project_alias")
def q_project_alias(p: Project) -> DataFrame:
    fr = p.source("weekly_fill_rate")
    return fr.select(F.col("whid").alias("warehouse_id"), F.col("shipclass").alias("ship_class"),
                     "cptdatetime", "ShippedOnTime")


@query("project_star_plus")
def q_project_star_plus(p: Project) -> DataFrame:
    sc = p.source("spot_capacity")
    return sc.select("*", F.concat(F.col("FCID").cast("string"), F.lit("-"), F.col("Week").cast("string")).alias("identifier"))


@query("distinct_rows")
def q_distinct_rows(p: Project) -> DataFrame:
    return p.source("yard_sheet").distinct()


@query("literal_columns")
def q_literal_columns(p: Project) -> DataFrame:
    fr = p.source("weekly_fill_rate")
    return fr.select("whid", "shipclass", F.lit("daily").alias("cadence"), F.lit("happy_path").alias("qty_path"),
                     F.lit("310").alias("metric_id"))


@query("case_code_override")
def q_case_code_override(p: Project) -> DataFrame:
    return DW.warehouse_attributes(p).select("wms_wh_id", "wh_id", "sva_id", "wh")


@query("case_in_list")
def q_case_in_list(p: Project) -> DataFrame:
    return DW.warehouse_attributes(p).select("wms_wh_id", "wh_id", "region")


@query("case_code_minutes")
def q_case_code_minutes(p: Project) -> DataFrame:
    return DW.warehouse_attributes(p).select("wms_wh_id", "wh_id", "current_ground_time_in_minutes")


@query("case_like_first_match")
def q_case_like_first_match(p: Project) -> DataFrame:
    sheet = p.source("yard_sheet")
    return sheet.select("External_Reference", "upload_date", "WarehouseName",
                        YU.warehouse_of("WarehouseName").alias("warehouse_id"))


@query("case_nested_bucket")
def q_case_nested_bucket(p: Project) -> DataFrame:
    from quayside.plans import on_yard as OY
    snap = p.ref("stg_unit_snapshot")
    now_local = cal.add_hours(cal.lit_ntz(p.ctx.current_datetime_hq), F.col("time_zone_hours_offset"))
    return snap.select("inbound_trailer_reservation_id", "arrival_status", "remaining_unload_time_hours",
                       OY.accountability_bucket(now_local).alias("accountability_bucket"))


@query("case_status_compare")
def q_case_status_compare(p: Project) -> DataFrame:
    yt = p.ref("dim_yard_trailer")
    a, s = F.to_date("trailer_arrival_datetime_local"), F.to_date("trailer_scheduled_start_datetime_local")
    status = F.when(a < s, "arrived_early").when(a == s, "arrived_on_time").when(a > s, "arrived_late")
    return yt.select("trailer_visit_id", status.alias("arrival_status"))


@query("flags_from_compare")
def q_flags_from_compare(p: Project) -> DataFrame:
    return p.ref("dim_yard_trailer").select(
        "trailer_visit_id", "is_arrival_null_and_scheduledstart_before_refresh", "is_arrival_date_equal_scheduled_date",
        "is_arrival_datetime_before_scheduled_datetime", "is_arrival_date_before_scheduled_date",
        "is_arrival_date_after_scheduled_date", "is_trailer_unloaded")


@query("flag_int")
def q_flag_int(p: Project) -> DataFrame:
    from quayside.plans.inbound_trailers import APPOINTMENT_SLA_DAYS, ARRIVAL_SLA_HOURS, sla_calculation
    a = sla_calculation(p)
    return a.select("inbound_reservation_id", "warehouse_id", "sum_trailer_units",
                    R.flag_int(F.col("unload_diff_arrival") > ARRIVAL_SLA_HOURS).alias("out_of_arrival_72_hours"),
                    R.flag_int(F.col("unload_diff_appt") > APPOINTMENT_SLA_DAYS).alias("out_of_appt_1_day"))


@query("case_zero_fallback")
def q_case_zero_fallback(p: Project) -> DataFrame:
    tv = p.source("truckload_volume")
    return tv.select("truck_id", S.zero_fallback("loaded_carton_count", "total_cartons").alias("loaded_carton_count"))


@query("case_priority")
def q_case_priority(p: Project) -> DataFrame:
    up = p.ref("units_happy_sad").unionByName(
        R.tag(p.ref("units_json_fallback"), path="dbf_path_yard_management"))
    return up.select("inbound_trailer_reservation_id", "path", "trailer_reservation_units",
                     F.when(F.col("trailer_reservation_units") == 400, 2).otherwise(1).alias("priority"))


@query("case_choose_side")
def q_case_choose_side(p: Project) -> DataFrame:
    return p.ref("dim_yard_trailer").select("trailer_visit_id", "site_id", "site_name", "warehouse_id", "warehouse_name")


@query("filter_is_true_false")
def q_filter_is_true_false(p: Project) -> DataFrame:
    yt = p.ref("dim_yard_trailer")
    return yt.where(R.is_true("is_trailer_inbound") & R.is_false("is_trailer_cancelled")).select(
        "trailer_visit_id", "inbound_trailer_reservation_id")


@query("filter_not_in")
def q_filter_not_in(p: Project) -> DataFrame:
    return p.source("warehouse").where(~F.col("wms_wh_id").isin(DW.TEST_WAREHOUSES)).select("wms_wh_id", "wh_id")


@query("filter_in_list")
def q_filter_in_list(p: Project) -> DataFrame:
    return p.source("content_detail").where(F.col("ContentType").isin(2, 3)).select("ContentRefID", "ReservationID", "Qty")


@query("filter_null")
def q_filter_null(p: Project) -> DataFrame:
    v = p.source("trailer_visit_flat")
    return v.where(F.col("arrival").isNull() & F.col("depart").isNotNull()).select("trailer_visit_id", "depart")


@query("filter_equality")
def q_filter_equality(p: Project) -> DataFrame:
    fr = p.source("weekly_fill_rate")
    return fr.where((F.col("performanceexclusions") == 0) & (F.col("OrderType_Performance") == "Standard"))


@query("filter_date_between")
def q_filter_date_between(p: Project) -> DataFrame:
    lo, hi = cal.py_week_to_date_window(p.ctx.report_date)
    tl = p.source("tran_log_units")
    return tl.where(F.to_date("log_datetime_local").between(cal.lit_date(lo), cal.lit_date(hi)))


@query("filter_like_any")
def q_filter_like_any(p: Project) -> DataFrame:
    from quayside.plans.inbound_trailers import INBOUND_SUBWAREHOUSES
    r = p.source("reservation")
    return r.where(R.like_any("subwarehouse", INBOUND_SUBWAREHOUSES)).select("ReservationID", "subwarehouse")


@query("filter_inequality")
def q_filter_inequality(p: Project) -> DataFrame:
    return p.source("po").where(F.col("SpoId") != F.col("SpoParentSpoId"))


@query("compare_string_numeric")
def q_compare_string_numeric(p: Project) -> DataFrame:
    """Lexicographic compare of numeric strings, per transaction-log row."""
    tl = p.source("tran_log_units_freight").select("warehouse_id", "log_datetime_local", "freight_class_id")
    fc = tl.join(p.dimension("freight_class", source=True), "freight_class_id")
    n = F.col("freight_class_number")
    return fc.select("warehouse_id", "log_datetime_local", "freight_class_number", (n > "1").alias("above_one"),
                     F.when(n == "1", "Bulk_Picks_SP_Bins").when(n > "1", "Bulk_Picks_LP")
                      .when(n.isNull(), "Bulk_Picks_SP_Bins").alias("Freight_Class"))


@query("compare_date_string")
def q_compare_date_string(p: Project) -> DataFrame:
    sc = p.source("spot_capacity")
    return sc.where(F.col("Week") >= F.lit("2000-01-01").cast("date"))


@query("filter_asof_on_site")
def q_filter_asof_on_site(p: Project) -> DataFrame:
    from quayside.plans.snapshot import on_site
    return on_site(p.ref("dim_yard_trailer"), p.ctx).select(
        "trailer_visit_id", "inbound_trailer_reservation_id", "trailer_arrival_datetime_local")


@query("arith_offset")
def q_arith_offset(p: Project) -> DataFrame:
    sc = p.source("spot_capacity")
    return sc.select("FCID", "Week", (F.col("Yard_Capacity") + YU.SHARED_CAPACITY_UPLIFT).alias("yard_capacity"),
                     (F.col("Yard_Capacity") - F.col("FCID")).alias("difference"))


@query("filter_numeric_range")
def q_filter_numeric_range(p: Project) -> DataFrame:
    snap = p.ref("stg_unit_snapshot")
    return snap.where(F.col("remaining_unload_time_hours").between(-48, 0) | (F.col("remaining_unload_time_hours") > 48)).select(
        "inbound_trailer_reservation_id", "remaining_unload_time_hours")


# --- §2.3 joins ---------------------------------------------------------------------------------------

@query("join_inner_equi")
def q_join_inner_equi(p: Project) -> DataFrame:
    tr = p.source("reservation").select("ReservationID", "TrailerNumber")
    ev = p.source("reservation_event").select("EventQueueID", "ReservationID", "ActionID")
    return tr.join(ev, "ReservationID")


@query("join_left_equi")
def q_join_left_equi(p: Project) -> DataFrame:
    from quayside.plans.fill_rate import fill_rate_base
    return fill_rate_base(p)


@query("join_using")
def q_join_using(p: Project) -> DataFrame:
    fr = p.ref("metric_fill_rate").select("warehouse_id", "cadence", "ship_class", "fill_rate_mm")
    wh = p.ref("dim_warehouse").select("warehouse_id", "warehouse_name", "country_id")
    return fr.join(wh, "warehouse_id", "left")


@query("join_left_on_filter")
def q_join_left_on_filter(p: Project) -> DataFrame:
    lm = p.source("load_master").select("load_id")
    jr = p.source("journey")
    return lm.join(jr, (lm.load_id == jr.loadId) & jr.shipperGateOutTimestamp.isNotNull(), "left").select(
        "load_id", "shipperGateOutTimestamp")


@query("join_left_on_left_filter")
def q_join_left_on_left_filter(p: Project) -> DataFrame:
    cd = p.source("content_detail").select("ContentRefID", "ContentType", S.split_first("spoid").alias("CleanSpoID"))
    slm = p.source("shipping_load_manifest")
    cond = (cd.CleanSpoID.try_cast("bigint") == slm.SlmTruckID) & cd.ContentType.isin(2, 3)
    return cd.join(slm, cond, "left").select("ContentRefID", "ContentType", "CleanSpoID", "slmID")


@query("join_inner_on_filter")
def q_join_inner_on_filter(p: Project) -> DataFrame:
    sml = p.source("shipment_manifest")
    tu = p.source("transport_unit")
    # units are counted per bill of lading before the join, so pairs of manifests and units are never built
    per_bill = (tu.where(F.col("shipment_destination_entity_type") == "Warehouse")
                  .groupBy("bill_of_lading_number").agg(F.count(F.lit(1)).alias("n")))
    return sml.join(per_bill, "bill_of_lading_number").groupBy("truck_id").agg(F.sum("n").alias("n_transport_units"))


@query("join_on_inequality")
def q_join_on_inequality(p: Project) -> DataFrame:
    spi = p.source("po_item")
    spo = p.source("po")
    cond = (spi.SpiSpoID == spo.SpoId) & (spo.SpoId != spo.SpoParentSpoId) & (spo.SpoType == 3)
    return spi.join(spo, cond).select("SpiID", "SpiSpoID", "SpiQty", "SpoParentSpoId")


@query("join_band_date")
def q_join_band_date(p: Project) -> DataFrame:
    """J8 (+J9): loads matched to reservation events by normalised trailer number and
    ship date within ±1 day; the smallest matching reservation per load."""
    from quayside.plans.yard_trailer import _sad_matches
    return _sad_matches(p)


@query("join_key_regex")
def q_join_key_regex(p: Project) -> DataFrame:
    """Loads joined to reservations on the normalised trailer number; the
    reservation side is reduced to one row per key first (count, smallest id)."""
    res = (p.source("reservation").groupBy(S.strip_alpha_prefix("TrailerNumber").alias("tkey"))
           .agg(F.count(F.lit(1)).alias("n_reservations"), F.min("ReservationID").alias("first_reservation")))
    lm = p.source("load_master").select("load_id", S.strip_alpha_prefix("trailer_number").alias("tkey"))
    return lm.join(res, "tkey")


@query("join_key_case")
def q_join_key_case(p: Project) -> DataFrame:
    sheet = (p.source("yard_sheet").where(F.col("upload_date") == cal.lit_date(p.ctx.report_date))
             .select("External_Reference", "WarehouseName", YU.warehouse_of("WarehouseName").alias("warehouse_id")))
    today = p.ctx.current_date
    cap = (p.source("spot_capacity").where((cal.week_number_sunday("Week") == cal.py_week_number_sunday(today))
                                             & (F.year("Week") == today.year))
           .select(F.col("FCID").alias("warehouse_id"), "Yard_Capacity"))
    return sheet.join(cap, "warehouse_id", "left")


@query("join_key_split")
def q_join_key_split(p: Project) -> DataFrame:
    cd = p.source("content_detail").select("ContentRefID", S.split_first("spoid").alias("CleanSpoID"))
    spi = p.source("po_item").select("SpiID", "SpiQty")
    return cd.join(spi, cd.CleanSpoID.try_cast("bigint") == spi.SpiID).select("ContentRefID", "CleanSpoID", "SpiQty")


@query("join_key_safe_cast")
def q_join_key_safe_cast(p: Project) -> DataFrame:
    cd = p.source("content_detail").select("ContentRefID", "spoid", S.split_first("spoid").alias("CleanSpoID"))
    sml = p.source("shipment_manifest")
    return cd.join(sml, cd.CleanSpoID.try_cast("bigint") == sml.truck_id, "left").select(
        "ContentRefID", "spoid", "truck_id")


@query("join_multi_key")
def q_join_multi_key(p: Project) -> DataFrame:
    cr = p.source("reservation_content")
    cd = p.source("content_detail").select("ContentRefID", "ReservationID", "Qty", "SpiID")
    return cr.join(cd, ["ContentRefID", "ReservationID"]).select("ReservationID", "ContentRefID", "Qty", "SpiID")


@query("join_anti_left_null")
def q_join_anti_left_null(p: Project) -> DataFrame:
    r = p.source("reservation").select("ReservationID", "subwarehouse")
    cd = p.source("content_detail").select("ReservationID")
    return R.anti_join(r, cd, "ReservationID")


@query("join_role_playing")
def q_join_role_playing(p: Project) -> DataFrame:
    dims = p.dimension("dim_warehouse", "warehouse_id", "warehouse_name")
    r = p.source("reservation").select("ReservationID", "WarehouseID", "siteID", "CarrierID")
    wh = dims.select(F.col("warehouse_id").alias("wh_id"), F.col("warehouse_name").alias("warehouse_name"))
    site = dims.select(F.col("warehouse_id").alias("site_wh"), F.col("warehouse_name").alias("site_name"))
    carrier = dims.select(F.col("warehouse_id").alias("carrier_wh"), F.col("warehouse_name").alias("carrier_home"))
    return (r.join(wh, r.WarehouseID == wh.wh_id, "left").join(site, r.siteID == site.site_wh, "left")
             .join(carrier, (r.CarrierID % 100) == carrier.carrier_wh, "left")
             .select("ReservationID", "warehouse_name", "site_name", "carrier_home"))


@query("join_self_partial_key")
def q_join_self_partial_key(p: Project) -> DataFrame:
    """The inbound-trailer self join on reservation id, multiplication kept."""
    return p.build("metric_inbound_trailers")


@query("join_left_then_inner")
def q_join_left_then_inner(p: Project) -> DataFrame:
    """Left join to capacity followed by an inner join on its column = inner join."""
    return p.build("metric_on_yard_units")


@query("join_scalar_max")
def q_join_scalar_max(p: Project) -> DataFrame:
    return R.newest(p.source("receiving_capacity"), "upload_date").select("warehouse_id", "day_of_unit_capacity", "inbound_unit_capacity")


@query("join_star_chain")
def q_join_star_chain(p: Project) -> DataFrame:
    """Six left joins of per-warehouse aggregates (throughput variance)."""
    return p.build("metric_throughput_variance")


@query("join_lateral_unnest")
def q_join_lateral_unnest(p: Project) -> DataFrame:
    from quayside.plans.yard_trailer import VISIT_ARRAYS
    v = R.explode_all_outer(p.source("trailer_visit"), VISIT_ARRAYS)
    return v.select("trailer_visit_id", *[alias for _, alias in VISIT_ARRAYS])


# --- §2.4 aggregations ---------------------------------------------------------------------------------

@query("agg_sum_group")
def q_agg_sum_group(p: Project) -> DataFrame:
    return p.source("tran_log_units").groupBy("warehouse_id").agg(F.sum("inbound_receiving_units").alias("units"))


@query("agg_sum_case")
def q_agg_sum_case(p: Project) -> DataFrame:
    from quayside.plans.snapshot import unit_ladder
    ur = p.ref("stg_units_reservation")
    return ur.groupBy("subwarehouse").agg(F.sum(unit_ladder()).alias("sum_trailer_units"))


@query("agg_sum_round")
def q_agg_sum_round(p: Project) -> DataFrame:
    spi = p.source("po_item")
    return spi.groupBy("SpiSprID").agg(F.sum(F.round(F.col("SpiQty") * F.lit(0.25), 0)).cast("double").alias("qc_units"))


@query("agg_count_col")
def q_agg_count_col(p: Project) -> DataFrame:
    return p.source("weekly_fill_rate").groupBy("whid").agg(F.count("ShippedOnTime").alias("n_on_time_known"))


@query("agg_count_predicate")
def q_agg_count_predicate(p: Project) -> DataFrame:
    """A5: COUNT(x IS NOT NULL) counts every row; count_if counts the true ones."""
    tu = p.source("transport_unit")
    pred = F.col("shipment_destination_unloaded_date").isNotNull()
    return tu.groupBy("bill_of_lading_number").agg(F.count(pred).alias("trailer_received_qty"),
                                                  F.count_if(pred).alias("unloaded_qty"))


@query("agg_count_distinct")
def q_agg_count_distinct(p: Project) -> DataFrame:
    return p.source("yard_sheet").groupBy("upload_date", "WarehouseName").agg(
        F.count_distinct("External_Reference").alias("amount_of_units"))


@query("agg_avg")
def q_agg_avg(p: Project) -> DataFrame:
    return p.source("tran_log_units").groupBy("warehouse_id").agg(F.avg("inbound_receiving_units").alias("avg_units"))


@query("agg_max_global")
def q_agg_max_global(p: Project) -> DataFrame:
    return p.source("receiving_capacity").agg(F.max("upload_date").alias("upload_date"))


@query("agg_ratio_null_safe")
def q_agg_ratio_null_safe(p: Project) -> DataFrame:
    fr = p.source("weekly_fill_rate")
    return fr.groupBy("whid", "shipclass").agg(
        S.null_safe_ratio(F.sum("ShippedOnTime"), F.count("ShippedOnTime")).cast("double").alias("fill_rate"))


@query("agg_group_as_distinct")
def q_agg_group_as_distinct(p: Project) -> DataFrame:
    return p.source("content_detail").select("ReservationID", "ContentType").distinct()


@query("agg_group_ordinal")
def q_agg_group_ordinal(p: Project) -> DataFrame:
    tl = p.source("tran_log_units")
    d = F.to_date("log_datetime_local")
    return tl.groupBy("warehouse_id", d.alias("day"), cal.week_number_sunday(d).alias("week")).agg(
        F.sum("inbound_receiving_units").alias("units"))


def _freight_fine(p: Project) -> DataFrame:
    tl = p.source("tran_log_units_freight")
    fc = p.dimension("freight_class", source=True)
    num = F.col("freight_class_number")
    label = F.when(num == "1", "Bulk_Picks_SP_Bins").when(num > "1", "Bulk_Picks_LP").when(num.isNull(), "Bulk_Picks_SP_Bins")
    # summed per class id before the classes join: the log is not shuffled by its few ids
    per_id = tl.groupBy("warehouse_id", F.to_date("log_datetime_local").alias("date"), "freight_class_id").agg(*TV.pick_sums())
    fine = per_id.join(fc, "freight_class_id").groupBy("warehouse_id", "date", num).agg(
        (F.sum("bulk_pick_units") + F.sum("bins_pick_units")).alias("BulkPick_Units"))
    return fine.select("warehouse_id", "date", label.alias("Freight_Class"), "BulkPick_Units")


@query("agg_group_finer_than_output")
def q_agg_group_finer_than_output(p: Project) -> DataFrame:
    return _freight_fine(p)


def _freight_pivot(p: Project) -> DataFrame:
    return (_freight_fine(p).groupBy("warehouse_id", "date")
            .pivot("Freight_Class", ["Bulk_Picks_LP", "Bulk_Picks_SP_Bins"]).agg(F.sum("BulkPick_Units")))


@query("agg_pivot")
def q_agg_pivot(p: Project) -> DataFrame:
    return _freight_pivot(p)


@query("agg_sum_plus_sum")
def q_agg_sum_plus_sum(p: Project) -> DataFrame:
    return _freight_pivot(p).groupBy("warehouse_id").agg(
        (F.sum("Bulk_Picks_LP") + F.sum("Bulk_Picks_SP_Bins")).alias("fc_total_units_shipped_actuals"))


def _median_qty(p: Project) -> DataFrame:
    return discrete_percentile(p.source("content_detail"), "ContentType", "Qty", "median_qty",
                               store=lambda df: p.stage("median_values", df))


@query("agg_median_then_avg")
def q_agg_median_then_avg(p: Project) -> DataFrame:
    """Discrete median per group over counted values."""
    return _median_qty(p)


@query("agg_on_join_fanout")
def q_agg_on_join_fanout(p: Project) -> DataFrame:
    return p.build("metric_inbound_trailers")


@query("agg_lag_capacity")
def q_agg_lag_capacity(p: Project) -> DataFrame:
    from quayside.plans.throughput import capacity
    today = p.ctx.current_date
    yday = today - dt.timedelta(days=1)
    lagged = "sum_ib_unit_capacity_daily_lag2"
    return capacity(p, today, yday, cal.py_week_to_date_window(yday)).where(F.col(lagged).isNotNull()).select("warehouse_id", lagged)


# --- §2.5 windows ------------------------------------------------------------------------------------

@query("win_latest_row")
def q_win_latest_row(p: Project) -> DataFrame:
    return p.build("latest_inbound_visit")


@query("win_first_event")
def q_win_first_event(p: Project) -> DataFrame:
    ev = p.source("reservation_event").select("EventQueueID", "ReservationID", "ActionID", "EventDate")
    return R.pick_first(ev, ["ReservationID", "ActionID"], [F.col("EventDate"), F.col("EventQueueID")])


@query("win_any_row")
def q_win_any_row(p: Project) -> DataFrame:
    """One row per key where the reference orders by the key itself; a full
    tie-break (load id) makes the pick fixed."""
    lm = p.source("load_master").select("trailer_number", "load_id", "actual_ship_date")
    return R.pick_first(lm, ["trailer_number"], [F.col("load_id")])


@query("win_qualify_one")
def q_win_qualify_one(p: Project) -> DataFrame:
    return p.build("load_gate_out")


@query("win_priority_pick")
def q_win_priority_pick(p: Project) -> DataFrame:
    return p.build("units_priority")


@query("win_rank_latest_ties")
def q_win_rank_latest_ties(p: Project) -> DataFrame:
    cap = p.source("receiving_capacity")
    return R.pick_rank_first(cap, ["warehouse_id", "day_of_unit_capacity"], [F.col("upload_date").desc()])


@query("win_percentile_disc")
def q_win_percentile_disc(p: Project) -> DataFrame:
    """``PERCENTILE_DISC(x, 0.5) OVER (PARTITION BY k)`` — every row carries its
    group's median.  A window would put a whole group into one task (a hot
    group holds a third of the rows); the median is found over counted values in ranges
    and the one-row-per-group result joined back."""
    cd = p.source("content_detail").select("ContentRefID", "ReservationID", "ContentType", "Qty")
    med = _median_qty(p)
    return cd.join(med, "ContentType", "left").select(
        "ContentRefID", "ReservationID", "ContentType", "Qty", "median_qty")


@query("win_over_grouped")
def q_win_over_grouped(p: Project) -> DataFrame:
    """ROW_NUMBER over a GROUP BY result partitioned by its key is always 1."""
    from pyspark.sql import Window
    g = p.source("content_detail").groupBy("ReservationID").agg(F.sum("Qty").alias("qty"))
    return g.withColumn("row_num", F.row_number().over(Window.partitionBy("ReservationID").orderBy("ReservationID")).cast("bigint"))


@query("win_latest_event_json")
def q_win_latest_event_json(p: Project) -> DataFrame:
    path = p.ctx.param("units_json_path", "$.reservationDetails.totalQuantity")
    eq = p.source("event_queue")
    re_ = p.source("reservation_event")
    ev = re_.join(eq, re_.EventQueueID == eq.ID)
    newest = R.pick_first(ev, ["ReservationID"], [F.col("EventDate").desc(), F.col("EventQueueID").desc()])
    return newest.select("ReservationID", S.json_int("EventDetail", path).alias("total_quantity"))


# --- §2.6 sorts, §2.7 set operations ---------------------------------------------------------------------

@query("sort_output")
def q_sort_output(p: Project) -> DataFrame:
    return DD.calendar(DD.date_range_of(p.src.tables.orders, "o_orderdate"), p.ctx.current_timestamp).orderBy("date_actual")


@query("topk_per_group")
def q_topk_per_group(p: Project) -> DataFrame:
    """The top row per group (newest capacity upload per warehouse and day)."""
    cap = p.source("receiving_capacity")
    return R.pick_first(cap, ["warehouse_id", "day_of_unit_capacity"],
                        [F.col("upload_date").desc(), F.col("inbound_unit_capacity").desc()])


@query("union_all_paths")
def q_union_all_paths(p: Project) -> DataFrame:
    return p.build("load_reservation_match")


@query("union_all_cadences")
def q_union_all_cadences(p: Project) -> DataFrame:
    return p.build("metric_fill_rate")


@query("union_all_metrics")
def q_union_all_metrics(p: Project) -> DataFrame:
    from quayside.plans.reporting import inbound_rows
    return inbound_rows(p)


# --- §2.8 scalar functions -----------------------------------------------------------------------------

@query("fn_concat_op")
def q_fn_concat_op(p: Project) -> DataFrame:
    wh = p.source("warehouse")
    return wh.select("wms_wh_id", S.concat_op("wh_id", "state", "zip", sep="#").alias("joined"))


@query("fn_concat")
def q_fn_concat(p: Project) -> DataFrame:
    sc = p.source("spot_capacity")
    return sc.select("FCID", "Week", F.concat(F.col("FCID").cast("string"), F.lit("-"), F.col("Week").cast("string")).alias("identifier"))


@query("fn_split_first")
def q_fn_split_first(p: Project) -> DataFrame:
    return p.source("content_detail").select("ContentRefID", "spoid", S.split_first("spoid").alias("CleanSpoID"))


@query("fn_left")
def q_fn_left(p: Project) -> DataFrame:
    return p.source("content_detail").select("ContentRefID", F.left("spoid", F.lit(1)).alias("first_char"))


@query("fn_regexp_strip_prefix")
def q_fn_regexp_strip_prefix(p: Project) -> DataFrame:
    return p.source("reservation").select("ReservationID", "TrailerNumber", S.strip_alpha_prefix("TrailerNumber").alias("trailer_key"))


@query("fn_like")
def q_fn_like(p: Project) -> DataFrame:
    return p.source("reservation").select("ReservationID", F.col("subwarehouse").like("%Inbound%").alias("is_inbound_sub"),
                                          F.col("subwarehouse").like("VAS").alias("is_vas"))


@query("fn_hash_record")
def q_fn_hash_record(p: Project) -> DataFrame:
    return p.ref("dim_warehouse").select("warehouse_id", "hash_record")


@query("fn_surrogate_key")
def q_fn_surrogate_key(p: Project) -> DataFrame:
    wh = p.source("warehouse")
    return wh.select("wms_wh_id", S.surrogate_key(["wh_id", "name", "city", "state", "zip"]).alias("surrogate_key"))


@query("fn_json_query")
def q_fn_json_query(p: Project) -> DataFrame:
    ev = p.source("reservation_event")
    return ev.select("EventQueueID", S.json_int("EventDetail", p.ctx.param("units_json_path", "$.k")).alias("total_quantity"))


@query("fn_ifnull")
def q_fn_ifnull(p: Project) -> DataFrame:
    return p.source("warehouse").select("wms_wh_id", F.coalesce("state", F.lit("N/A")).alias("warehouse_state"))


@query("fn_coalesce")
def q_fn_coalesce(p: Project) -> DataFrame:
    return p.source("warehouse").select("wms_wh_id", F.coalesce("zip", "state", "city").alias("locality"))


@query("fn_nullif")
def q_fn_nullif(p: Project) -> DataFrame:
    return p.source("truckload_volume").select("truck_id", S.nullif("loaded_carton_count", 0).alias("loaded"))


@query("fn_safe_divide")
def q_fn_safe_divide(p: Project) -> DataFrame:
    tv = p.source("truckload_volume")
    return tv.select("truck_id", S.safe_divide(F.col("total_cartons"), F.col("loaded_carton_count")).alias("ratio"))


@query("fn_round")
def q_fn_round(p: Project) -> DataFrame:
    spi = p.source("po_item")
    return spi.select("SpiID", F.round(F.col("SpiQty") * F.lit(0.25), 0).cast("double").alias("qc"),
                      F.round(S.safe_divide(F.col("SpiQty"), F.lit(7)), 1).alias("per_week"))


@query("fn_mod")
def q_fn_mod(p: Project) -> DataFrame:
    return p.source("content_detail").select("ContentRefID", (F.col("Qty") % 400).alias("qty_mod"))


@query("fn_safe_cast")
def q_fn_safe_cast(p: Project) -> DataFrame:
    cd = p.source("content_detail")
    return cd.select("ContentRefID", S.split_first("spoid").try_cast("bigint").alias("truck_id"))


@query("fn_cast")
def q_fn_cast(p: Project) -> DataFrame:
    fr = p.source("weekly_fill_rate")
    return fr.select(F.col("whid").cast("bigint").alias("warehouse_id"), F.col("cptdatetime").cast("date").alias("day"),
                     F.col("ShippedOnTime").cast("double").alias("on_time"), F.col("ShippedOnTime").cast("string").alias("on_time_s"))


@query("fn_if")
def q_fn_if(p: Project) -> DataFrame:
    tl = p.source("tran_log_units")
    return tl.select("warehouse_id", F.when(F.col("bulk_pick_units") > 0, F.lit("bulk")).otherwise(F.lit("bins")).alias("pick_kind"))


def _days_before_today(p: Project, col: str, today) -> DataFrame:
    return F.datediff(cal.lit_date(today), F.to_date(col)).cast("bigint")


@query("fn_current_date")
def q_fn_current_date(p: Project) -> DataFrame:
    fr = p.source("weekly_fill_rate")
    return fr.select("whid", "cptdatetime", _days_before_today(p, "cptdatetime", p.ctx.current_date).alias("days_utc"),
                     _days_before_today(p, "cptdatetime", p.ctx.current_date_hq).alias("days_ny"))


@query("fn_current_datetime")
def q_fn_current_datetime(p: Project) -> DataFrame:
    v = p.source("trailer_visit_flat")
    return v.select("trailer_visit_id", cal.hour_boundaries(cal.lit_ntz(p.ctx.current_datetime_hq), F.col("arrival")).alias("hours_ago"))


@query("fn_current_timestamp")
def q_fn_current_timestamp(p: Project) -> DataFrame:
    return p.source("facility_type").select("wh_id", cal.lit_ntz(p.ctx.current_timestamp).alias("refreshed_at"))


@query("fn_datetime_in_zone")
def q_fn_datetime_in_zone(p: Project) -> DataFrame:
    v = p.source("trailer_visit_flat")
    return v.select("trailer_visit_id", cal.utc_to_zone("arrival", "America/New_York").alias("arrival_ny"),
                    cal.utc_to_zone("depart", "Europe/Berlin").alias("depart_berlin"))


@query("fn_local_by_offset")
def q_fn_local_by_offset(p: Project) -> DataFrame:
    ev = p.source("reservation_event").select("EventQueueID", "ReservationID", "EventDate")
    tr = p.source("reservation").select("ReservationID", "WarehouseID")
    dw = p.dimension("dim_warehouse", "warehouse_id", "time_zone_hours_offset")
    j = ev.join(tr, "ReservationID").join(dw, F.col("WarehouseID") == dw.warehouse_id, "left")
    return j.select("EventQueueID", cal.add_hours("EventDate", F.col("time_zone_hours_offset")).alias("event_local"))


@query("fn_zone_offset_hours")
def q_fn_zone_offset_hours(p: Project) -> DataFrame:
    return DW.warehouse_attributes(p).select("wms_wh_id", "sty_id", "hours_offset", "hours_offset_old")


@query("fn_datetime_diff_hour")
def q_fn_datetime_diff_hour(p: Project) -> DataFrame:
    v = p.source("trailer_visit_flat")
    return v.select("trailer_visit_id", cal.hour_boundaries("unload_complete", "arrival").alias("hours_to_unload"))


@query("fn_hours_to_days")
def q_fn_hours_to_days(p: Project) -> DataFrame:
    v = p.source("trailer_visit_flat")
    return v.select("trailer_visit_id", (cal.hour_boundaries("depart", "arrival") / 24).alias("days_on_yard"))


@query("fn_date_add_sub")
def q_fn_date_add_sub(p: Project) -> DataFrame:
    fr = p.source("weekly_fill_rate")
    d = F.to_date("cptdatetime")
    return fr.select("whid", F.date_sub(d, 3).alias("minus_3d"), F.date_add(d, 7).alias("plus_1w"),
                     F.add_months(d, -6).alias("minus_6m"), F.date_add(d, -1).alias("minus_1d"))


@query("fn_datetime_add_sub")
def q_fn_datetime_add_sub(p: Project) -> DataFrame:
    v = p.source("trailer_visit_flat")
    return v.select("trailer_visit_id", cal.add_days("arrival", -1).alias("arrival_minus_1d"),
                    cal.add_hours("arrival", 4).alias("arrival_plus_4h"), cal.add_days("arrival", 1).alias("arrival_plus_1d"))


@query("fn_cutoff_time")
def q_fn_cutoff_time(p: Project) -> DataFrame:
    v = p.source("trailer_visit_flat")
    return v.select("trailer_visit_id", cal.cutoff(F.to_date("arrival"), 4).alias("cutoff_4h"),
                    cal.cutoff(F.to_date("arrival"), 0).alias("cutoff_0h"))


@query("fn_date_trunc_week")
def q_fn_date_trunc_week(p: Project) -> DataFrame:
    return p.source("weekly_fill_rate").select("cptdatetime", cal.week_start_sunday("cptdatetime").alias("week_start"))


@query("fn_week_number_sunday")
def q_fn_week_number_sunday(p: Project) -> DataFrame:
    return p.source("weekly_fill_rate").select("cptdatetime", cal.week_number_sunday("cptdatetime").alias("week"))


@query("fn_extract_parts")
def q_fn_extract_parts(p: Project) -> DataFrame:
    v = p.source("trailer_visit_flat")
    a = F.col("arrival")
    return v.select("trailer_visit_id", F.year(a).cast("bigint").alias("y"), F.dayofmonth(a).cast("bigint").alias("d"),
                    F.hour(a).cast("bigint").alias("h"), cal.day_of_week_sunday1(a).cast("bigint").alias("dow"))


@query("fn_week_to_date_window")
def q_fn_week_to_date_window(p: Project) -> DataFrame:
    tl = p.source("tran_log_units")
    y = F.date_sub(F.to_date("log_datetime_local"), 1)
    start = F.date_add(y, 1 - cal.day_of_week_sunday1(y))
    end = F.date_add(F.date_sub(y, cal.day_of_week_sunday1(y)), 7)
    return tl.select("log_datetime_local", start.alias("wtd_start"), end.alias("wtd_end"))


@query("fn_date_of")
def q_fn_date_of(p: Project) -> DataFrame:
    return p.source("journey").select("loadId", F.to_date("shipperGateOutTimestamp").alias("gate_out_day"))


@query("fn_timestamp_of")
def q_fn_timestamp_of(p: Project) -> DataFrame:
    """TIMESTAMP(x) reads a wall-clock value as an instant (UTC), which a zone's wall clock shows."""
    instant = F.col("shipperGateOutTimestamp").cast("timestamp")
    return p.source("journey").select("loadId", F.unix_micros(instant).alias("gate_out_micros"),
                                      F.from_utc_timestamp(instant, "America/New_York").cast("timestamp_ntz").alias("gate_out_new_york"))


# --- §2.11 backfill windows --------------------------------------------------------------------------------

@query("backfill_window_filter")
def q_backfill_window_filter(p: Project) -> DataFrame:
    """B1: regular run = last six months; backfill from 1995 on Saturdays; a Wednesday
    run takes the backfill bounds because the condition (Saturday) is false."""
    today = p.ctx.current_date
    tl = p.source("tran_log_units")
    cond = today.isoweekday() == 6
    pred = B.backfill_window(F.to_date("log_datetime_local"), B.regular_6_month_backfill(p.ctx), today,
                             dt.date(1995, 1, 1), today, cond)
    return tl.where(pred)


@query("backfill_lookback_start")
def q_backfill_lookback_start(p: Project) -> DataFrame:
    start = B.regular_14_day_backfill(p.ctx)
    return p.source("tran_log_units").where(F.to_date("log_datetime_local") >= cal.lit_date(start))


# --- §2.12 data-quality checks ----------------------------------------------------------------------------------


@query("dq_not_null")
def q_dq_not_null(p: Project) -> DataFrame:
    return Q.not_null(p.ref("metric_throughput_variance"), "received_units_actual_reporting_daily")


@query("dq_unique")
def q_dq_unique(p: Project) -> DataFrame:
    return Q.unique(p.ref("stg_unit_snapshot"), "inbound_trailer_reservation_id")


@query("dq_accepted_values")
def q_dq_accepted_values(p: Project) -> DataFrame:
    return Q.accepted_values(p.ref("dim_yard_trailer"), "trailer_status", ["F", "O"], allow_null=False).select(
        "trailer_visit_id", "trailer_status")


@query("dq_compound_unique")
def q_dq_compound_unique(p: Project) -> DataFrame:
    return Q.compound_unique(p.ref("report_inbound"), ["metric_id", "metric_name", "time_base_date", "warehouse_name", "country_long"])


@query("dq_relationships")
def q_dq_relationships(p: Project) -> DataFrame:
    return Q.relationships(p.ref("metric_fill_rate"), "warehouse_id", p.ref("dim_warehouse"), "warehouse_id").select(
        "warehouse_id", "cadence", "ship_class")


@query("dq_suite")
def q_dq_suite(p: Project) -> DataFrame:
    frames = {c.model: p.ref(c.model) for c in Q.MODEL_CHECKS}
    return Q.run_suite(Q.MODEL_CHECKS, frames)


# --- §2.13 metric dictionary ------------------------------------------------------------------------------------


@query("metric_dictionary_eval")
def q_metric_dictionary_eval(p: Project) -> DataFrame:
    fr = p.ref("metric_fill_rate")
    daily = M.evaluate(M.DAILY_FILL_RATE, fr.where(F.col("cadence") == "daily"), ["warehouse_id", "ship_class"])
    weekly = M.evaluate(M.WEEKLY_FILL_RATE, fr.where(F.col("cadence") == "weekly"), ["warehouse_id", "ship_class"])
    return daily.unionByName(weekly)


@query("metric_dictionary_planned")
def q_metric_dictionary_planned(p: Project) -> DataFrame:
    """K1: the dictionary file's metrics, variations and final aggregations, one pass per model and level."""
    metrics = MD.load(Path(__file__).with_name("metric_dictionary.yml"))
    return MD.evaluate_all(metrics, p.ref, ["warehouse_id"])


@query("metric_tall_row")
def q_metric_tall_row(p: Project) -> DataFrame:
    return p.build("report_outbound")


# --- remaining inventory lines: S8, O1, O3 ---------------------------------------------------------

@query("merge_immutable_cols")
def q_merge_immutable_cols(p: Project) -> DataFrame:
    """After the upsert, columns outside the update list keep their first value
    (creation time, name) while the listed ones move on."""
    merged = q_sink_merge_upsert(p)
    return merged.select("warehouse_id", "dwh_creation_timestamp", "warehouse_name",
                         "dwh_modified_timestamp", "time_zone_hours_offset")


@query("sort_in_cte")
def q_sort_in_cte(p: Project) -> DataFrame:
    """O1: an ORDER BY inside an intermediate relation has no effect on the
    result; Catalyst removes the sort below the aggregate."""
    ordered = _freight_fine(p).orderBy("warehouse_id", "date")
    return ordered.groupBy("warehouse_id").agg(F.sum("BulkPick_Units").alias("bulk_pick_units"))


@query("limit_rows")
def q_limit_rows(p: Project) -> DataFrame:
    """O3: LIMIT n as a report feature — the first ten fill-rate rows in grain order
    (a per-partition top-k, then one merge of at most ten rows per task)."""
    fr = p.ref("metric_fill_rate")
    return fr.orderBy(F.col("warehouse_id").asc_nulls_last(), F.col("ship_class").asc_nulls_last(),
                      F.col("cadence").asc_nulls_last()).limit(10)


@query("backfill_range")
def q_backfill_range(p: Project) -> DataFrame:
    """A backfill of the fill-rate model over the seven run days up to as_of,
    computed in one scan (equal to seven daily runs)."""
    from quayside.plans.fill_rate import fill_rate_for_days
    last = p.ctx.current_date
    return fill_rate_for_days(p, last - dt.timedelta(days=6), last)


def _range(p: Project, name: str, days: int = 7) -> DataFrame:
    from quayside.plans.range_runs import RANGE_RUNS
    last = p.ctx.current_date
    return RANGE_RUNS[name](p, last - dt.timedelta(days=days - 1), last)


@query("range_inbound_trailers")
def q_range_inbound_trailers(p: Project) -> DataFrame:
    """M16 over seven run days from one sweep of the visits' stays."""
    return _range(p, "metric_inbound_trailers")


@query("range_on_yard_units")
def q_range_on_yard_units(p: Project) -> DataFrame:
    """M17 over seven run days from one sweep of the visits' stays."""
    return _range(p, "metric_on_yard_units")


@query("range_throughput_variance")
def q_range_throughput_variance(p: Project) -> DataFrame:
    """M18 over seven run days, one scan per input."""
    return _range(p, "metric_throughput_variance")


@query("range_yard_utilization")
def q_range_yard_utilization(p: Project) -> DataFrame:
    """M14 and M19 over seven run days, one scan per input."""
    return _range(p, "metric_yard_utilization")


# --- runs over written targets -----------------------------------------------------------------------

class _RenamedWarehouses(Sources):
    """The stand-in sources after every warehouse was renamed."""

    def get(self, name: str) -> DataFrame:
        df = super().get(name)
        return df.withColumn("name", F.concat("name", F.lit(" renamed"))) if name == "warehouse" else df


def _two_runs(p: Project) -> dict[str, str]:
    """A run, and the run after a renaming of all warehouses, into the same targets."""
    root = os.path.join(_out_path(p, "two_runs"), uuid.uuid4().hex[:8])
    names = ["report_outbound", "dim_warehouse", "metric_fill_rate"]
    for sources in (Sources(p.spark, p.src.sf_dir), _RenamedWarehouses(p.spark, p.src.sf_dir)):
        paths = run_models(Project(p.spark, sources, p.ctx), names, root)
    return paths


@query("incremental_two_runs")
def q_incremental_two_runs(p: Project) -> DataFrame:
    """The report of the second run reads the merged dimension, whose names are those of the first load;
    the target's rows as the model has them (its columns, grouped by all of them)."""
    return p.spark.read.parquet(_two_runs(p)["report_outbound"]).select(*M.TALL_COLUMNS).distinct()


@query("incremental_two_runs_dimension")
def q_incremental_two_runs_dimension(p: Project) -> DataFrame:
    """The dimension after both runs: names kept, hashes of the renamed rows taken over."""
    return p.spark.read.parquet(_two_runs(p)["dim_warehouse"]).select(
        "warehouse_id", "warehouse_name", "warehouse_string_id")


@query("merge_multi_element_visits")
def q_merge_multi_element_visits(p: Project) -> DataFrame:
    """Visits with several array elements keep a row per combination, named by its number.  The earlier target has
    other states, and combinations that the visits no longer have; the merge updates the first and removes the second."""
    from quayside.plans import yard_trailer as YT
    rows = YT.keyed_visits(p)
    kept = [*YT.UNIQUE_KEY, "trailer_status", "spot_id", "dwh_creation_timestamp"]
    path = _out_path(p, "multi_element_visits")
    before = rows.where("trailer_visit_id % 3 <> 0").select(*kept).withColumns({
        "trailer_status": F.lit("before"), "dwh_creation_timestamp": cal.lit_ntz(dt.datetime(1998, 1, 1)),
        "visit_element": F.explode(F.array("visit_element", F.col("visit_element") + 100))})
    sinks.delete_path(p.spark, path)
    sinks.merge_upsert(p.spark, before, path, YT.UNIQUE_KEY, YT.MERGE_UPDATE_COLUMNS, ["trailer_visit_id"], group_key=YT.GROUP_KEY)
    return sinks.merge_upsert(p.spark, rows.select(*kept), path, YT.UNIQUE_KEY, YT.MERGE_UPDATE_COLUMNS, ["trailer_visit_id"],
                              group_key=YT.GROUP_KEY)


# --- evidence for checks and windows -------------------------------------------------------------------

@query("dq_not_null_violations")
def q_dq_not_null_violations(p: Project) -> DataFrame:
    """Q1 where there are violations: visits without a load."""
    return Q.not_null(p.ref("dim_yard_trailer"), "load_id").select("trailer_visit_id")


@query("dq_unique_violations")
def q_dq_unique_violations(p: Project) -> DataFrame:
    """Q2 where there are violations: reservations with several content rows."""
    return Q.unique(p.source("content_detail"), "ReservationID")


@query("dq_relationships_violations")
def q_dq_relationships_violations(p: Project) -> DataFrame:
    """Q5 where there are violations: facility types of warehouses the dimension does not hold."""
    return Q.relationships(p.source("facility_type"), "wh_id", p.ref("dim_warehouse"), "warehouse_string_id").select(
        "wh_id", "FacilityType")


@query("win_qualify_row_number")
def q_win_qualify_row_number(p: Project) -> DataFrame:
    """``QUALIFY ROW_NUMBER() OVER (PARTITION BY trailer ORDER BY ship date DESC, load) = 1``."""
    lm = p.source("load_master").select("trailer_number", "load_id", "actual_ship_date")
    return R.pick_first(lm, ["trailer_number"], [F.col("actual_ship_date").desc_nulls_last(), F.col("load_id")])


@query("event_lookback")
def q_event_lookback(p: Project) -> DataFrame:
    """An incremental run filters events by creation date at the scan and ranks what is left."""
    start = B.regular_6_month_backfill(p.ctx)
    q = Project(p.spark, p.src, RunContext(as_of=p.ctx.as_of, params={**p.ctx.params, "event_lookback_start": start}),
                materialize_dir=os.path.join(p.materialize_dir, "events", uuid.uuid4().hex[:8]))
    return q.build("first_reservation_event").select("ReservationID", "ActionID", "EventDate")


@query("backfill_window_regular")
def q_backfill_window_regular(p: Project) -> DataFrame:
    """B1, the regular branch: the condition holds, so the run takes the last six months."""
    today = p.ctx.current_date
    pred = B.backfill_window(F.to_date("log_datetime_local"), B.regular_6_month_backfill(p.ctx), today,
                             dt.date(1995, 1, 1), today, True)
    return p.source("tran_log_units").where(pred)


@query("backfill_window_manual")
def q_backfill_window_manual(p: Project) -> DataFrame:
    """B1, the manual branch: a run with both bounds set takes them, whatever the condition says."""
    today = p.ctx.current_date
    ctx = RunContext(as_of=p.ctx.as_of, params={**p.ctx.params, "manual_backfill": True,
                                                "backfill_start": dt.date(1996, 2, 1), "backfill_end": dt.date(1996, 3, 31)})
    pred = B.backfill_window(F.to_date("log_datetime_local"), B.regular_6_month_backfill(ctx), today,
                             dt.date(1995, 1, 1), today, True, **B.manual_bounds(ctx))
    return p.source("tran_log_units").where(pred)
