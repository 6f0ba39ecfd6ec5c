"""Oracle SQL of the single-operator queries, DuckDB dialect."""

from __future__ import annotations

from oracle.catalog import ORACLES, oracle
from oracle.models_sql import _WH_CASE, _q
from oracle.sql import FRAGMENTS, build, build_runs
from quayside.functions.scalar import SURROGATE_NULL
from quayside.plans import dim_warehouse as DW

# --- §2.1 -------------------------------------------------------------------------------------
oracle("scan_source", "SELECT * FROM fx_fill_rate")
oracle("scan_ref", "SELECT * FROM om_dim_warehouse")
oracle("scan_external", "SELECT * FROM fx_journey")
oracle("scan_upload_snapshot", "SELECT * FROM fx_yard_sheet WHERE upload_date = {TODAY} - 1")
oracle("sink_full_refresh", "SELECT * FROM om_metric_fill_rate")
oracle("sink_cluster_by", "SELECT * FROM om_metric_fill_rate")
oracle("sink_insert_overwrite", """
SELECT * FROM om_metric_fill_rate
UNION ALL SELECT * REPLACE (CAST(report_date - 1 AS DATE) AS report_date) FROM om_metric_fill_rate""")

_EARLIER = "1998-03-30 12:00:00"
_DIM_COLS = ["dwh_creation_timestamp", "dwh_modified_timestamp", "record_source", "hash_record", "warehouse_id",
             "warehouse_string_id", "warehouse_name", "region", "campus_id", "time_zone_hours_offset",
             "warehouse_city", "warehouse_state", "warehouse_zip", "warehouse_supplier_id", "country_id",
             "is_dedicated_break_bulk_facility", "is_physical_retail_store_warehouse", "is_active",
             "is_fulfillment_center"]
_T = build("SELECT * FROM om_dim_warehouse", as_of=_EARLIER)
_NOW = build("SELECT * FROM om_dim_warehouse")
_U = f"SELECT n.* FROM ({_NOW}) n WHERE n.hash_record NOT IN (SELECT hash_record FROM ({_T}) e WHERE hash_record IS NOT NULL)"
oracle("incremental_antijoin_target", _U)


def _merge_col(c: str) -> str:
    if c == DW.UNIQUE_KEY:
        return f"coalesce(t.{c}, u.{c}) AS {c}"
    if c in DW.MERGE_UPDATE_COLUMNS:
        return f"CASE WHEN u.__hit THEN u.{c} ELSE t.{c} END AS {c}"
    return f"CASE WHEN t.__hit IS NULL THEN u.{c} ELSE t.{c} END AS {c}"


oracle("sink_merge_upsert", f"""
SELECT {', '.join(_merge_col(c) for c in _DIM_COLS)}
FROM (SELECT *, true AS __hit FROM ({_T})) t
FULL OUTER JOIN (SELECT *, true AS __hit FROM ({_U})) u ON t.warehouse_id = u.warehouse_id""")
oracle("incremental_lookback", "SELECT * FROM om_dim_yard_trailer WHERE CAST(cdl_event_created_timestamp AS DATE) >= DATE '1997-12-17'")
oracle("audit_columns", "SELECT *, {AS_OF} AS dwh_creation_timestamp, {AS_OF} AS dwh_modified_timestamp FROM fx_facility_type")
oracle("view_materialization", "SELECT * FROM om_metric_fill_rate")

# --- §2.2 -------------------------------------------------------------------------------------
oracle("project_alias", "SELECT whid AS warehouse_id, shipclass AS ship_class, cptdatetime, ShippedOnTime FROM fx_fill_rate")
oracle("project_star_plus", "SELECT *, concat(CAST(FCID AS VARCHAR), '-', CAST(Week AS VARCHAR)) AS identifier FROM fx_spot_capacity")
oracle("distinct_rows", "SELECT DISTINCT * FROM fx_yard_sheet")
oracle("literal_columns", "SELECT whid, shipclass, 'daily' AS cadence, 'happy_path' AS qty_path, '310' AS metric_id FROM fx_fill_rate")
oracle("case_code_override", "SELECT wms_wh_id, wh_id, sva_id, wh FROM om_warehouse_attributes")
oracle("case_in_list", "SELECT wms_wh_id, wh_id, region FROM om_warehouse_attributes")
_GROUND = "CASE " + " ".join(f"WHEN wh_id = {_q(k)} THEN {v}" for k, v in DW.GROUND_MINUTES) + " ELSE NULL END"
oracle("case_code_minutes", f"SELECT wms_wh_id, wh_id, CAST({_GROUND} AS BIGINT) AS current_ground_time_in_minutes FROM om_warehouse_attributes")
oracle("case_like_first_match", f"SELECT External_Reference, upload_date, WarehouseName, CAST({_WH_CASE} AS BIGINT) AS warehouse_id FROM fx_yard_sheet")
oracle("case_nested_bucket", """
SELECT inbound_trailer_reservation_id, arrival_status, remaining_unload_time_hours, accountability_bucket
FROM om_snapshot_buckets""")
oracle("case_status_compare", """
SELECT trailer_visit_id,
  CASE WHEN CAST(trailer_arrival_datetime_local AS DATE) < CAST(trailer_scheduled_start_datetime_local AS DATE) THEN 'arrived_early'
       WHEN CAST(trailer_arrival_datetime_local AS DATE) = CAST(trailer_scheduled_start_datetime_local AS DATE) THEN 'arrived_on_time'
       WHEN CAST(trailer_arrival_datetime_local AS DATE) > CAST(trailer_scheduled_start_datetime_local AS DATE) THEN 'arrived_late'
  END AS arrival_status
FROM om_dim_yard_trailer""")
oracle("flags_from_compare", """
SELECT trailer_visit_id, is_arrival_null_and_scheduledstart_before_refresh, is_arrival_date_equal_scheduled_date,
  is_arrival_datetime_before_scheduled_datetime, is_arrival_date_before_scheduled_date,
  is_arrival_date_after_scheduled_date, is_trailer_unloaded FROM om_dim_yard_trailer""")
oracle("flag_int", "SELECT inbound_reservation_id, warehouse_id, sum_trailer_units, out_of_arrival_72_hours, out_of_appt_1_day FROM om_sla_flags")
oracle("case_zero_fallback", "SELECT truck_id, CASE WHEN loaded_carton_count = 0 THEN total_cartons ELSE loaded_carton_count END AS loaded_carton_count FROM fx_truckload")
oracle("case_priority", "SELECT inbound_trailer_reservation_id, path, trailer_reservation_units, priority FROM om_unit_paths")
oracle("case_choose_side", "SELECT trailer_visit_id, site_id, site_name, warehouse_id, warehouse_name FROM om_dim_yard_trailer")
oracle("filter_is_true_false", "SELECT trailer_visit_id, inbound_trailer_reservation_id FROM om_dim_yard_trailer WHERE is_trailer_inbound IS TRUE AND is_trailer_cancelled IS FALSE")
oracle("filter_not_in", f"SELECT wms_wh_id, wh_id FROM fx_wh WHERE wms_wh_id NOT IN ({', '.join(str(i) for i in DW.TEST_WAREHOUSES)})")
oracle("filter_in_list", "SELECT ContentRefID, ReservationID, Qty FROM fx_content WHERE ContentType IN (2, 3)")
oracle("filter_null", "SELECT trailer_visit_id, depart FROM fx_visit_flat WHERE arrival IS NULL AND depart IS NOT NULL")
oracle("filter_equality", "SELECT * FROM fx_fill_rate WHERE performanceexclusions = 0 AND OrderType_Performance = 'Standard'")
oracle("filter_date_between", """
SELECT * FROM fx_tran_log WHERE CAST(log_datetime_local AS DATE)
  BETWEEN CAST({TODAY} - 1 - CAST(dayofweek({TODAY} - 1) AS INTEGER) AS DATE)
      AND CAST({TODAY} - 1 - CAST(dayofweek({TODAY} - 1) AS INTEGER) + 6 AS DATE)""")
oracle("filter_like_any", """
SELECT ReservationID, subwarehouse FROM fx_reservation
WHERE subwarehouse LIKE '%Inbound%' OR subwarehouse LIKE '%Receiv%' OR subwarehouse LIKE '%VAS%'
   OR subwarehouse LIKE 'SubSatelliteLotRomeoville' OR subwarehouse LIKE '%Rug%'""")
oracle("filter_inequality", "SELECT * FROM fx_po WHERE SpoId <> SpoParentSpoId")
oracle("compare_string_numeric", """
SELECT tl.warehouse_id, tl.log_datetime_local, fc.freight_class_number, fc.freight_class_number > '1' AS above_one,
  concat('Bulk_Picks_', IF(coalesce(fc.freight_class_number, '1') > '1', 'LP', 'SP_Bins')) AS Freight_Class
FROM fx_tran_log tl JOIN fx_freight_class fc ON tl.freight_class_id = fc.freight_class_id""")
oracle("compare_date_string", "SELECT * FROM fx_spot_capacity WHERE Week >= '2000-01-01'")
oracle("filter_asof_on_site", "SELECT trailer_visit_id, inbound_trailer_reservation_id, trailer_arrival_datetime_local FROM om_on_site")
oracle("arith_offset", "SELECT FCID, Week, Yard_Capacity + 350 AS yard_capacity, Yard_Capacity - FCID AS difference FROM fx_spot_capacity")
oracle("filter_numeric_range", """
SELECT inbound_trailer_reservation_id, remaining_unload_time_hours FROM om_stg_unit_snapshot
WHERE remaining_unload_time_hours BETWEEN -48 AND 0 OR remaining_unload_time_hours > 48""")

# --- §2.3 joins -----------------------------------------------------------------------------------
_SPLIT = "split_part(cd.spoid, '_', 1)"
_STRIP = "regexp_replace({x}, '^[a-zA-Z_-]+([0-9]+$)', '\\1')"
oracle("join_inner_equi", """
SELECT tr.ReservationID, tr.TrailerNumber, ev.EventQueueID, ev.ActionID
FROM fx_reservation tr JOIN fx_event ev ON tr.ReservationID = ev.ReservationID""")
oracle("join_left_equi", "SELECT * FROM om_fill_rate_base")
oracle("join_using", """
SELECT fr.warehouse_id, fr.cadence, fr.ship_class, fr.fill_rate_mm, w.warehouse_name, w.country_id
FROM om_metric_fill_rate fr LEFT JOIN om_dim_warehouse w USING (warehouse_id)""")
oracle("join_left_on_filter", """
SELECT lm.load_id, jr.shipperGateOutTimestamp FROM fx_load_master lm
LEFT JOIN fx_journey jr ON lm.load_id = jr.loadId AND jr.shipperGateOutTimestamp IS NOT NULL""")
oracle("join_left_on_left_filter", f"""
SELECT cd.ContentRefID, cd.ContentType, {_SPLIT} AS CleanSpoID, slm.slmID FROM fx_content cd
LEFT JOIN fx_manifest slm ON TRY_CAST({_SPLIT} AS BIGINT) = slm.SlmTruckID AND cd.ContentType IN (2, 3)""")
oracle("join_inner_on_filter", """
SELECT sml.truck_id, cast(count(*) AS BIGINT) AS n_transport_units FROM fx_ship_manifest sml
JOIN fx_transport_unit tu ON sml.bill_of_lading_number = tu.bill_of_lading_number AND tu.shipment_destination_entity_type = 'Warehouse'
GROUP BY 1""")
oracle("join_on_inequality", """
SELECT spi.SpiID, spi.SpiSpoID, spi.SpiQty, spo.SpoParentSpoId FROM fx_po_item spi
JOIN fx_po spo ON spi.SpiSpoID = spo.SpoId AND spo.SpoId <> spo.SpoParentSpoId AND spo.SpoType = 3""")
oracle("join_band_date", "SELECT load_id, reservationID FROM om_band_pick")
oracle("join_key_regex", f"""
SELECT lm.tkey, lm.load_id, k.n_reservations, k.first_reservation
FROM (SELECT load_id, {_STRIP.format(x='trailer_number')} AS tkey FROM fx_load_master) lm
JOIN (SELECT {_STRIP.format(x='TrailerNumber')} AS tkey, count(*) AS n_reservations, min(ReservationID) AS first_reservation
      FROM fx_reservation GROUP BY 1) k ON lm.tkey = k.tkey""")
oracle("join_key_case", f"""
SELECT s.warehouse_id, s.External_Reference, s.WarehouseName, c.Yard_Capacity
FROM (SELECT External_Reference, WarehouseName, CAST({_WH_CASE} AS BIGINT) AS warehouse_id FROM fx_yard_sheet
      WHERE upload_date = {{TODAY}} - 1) s
LEFT JOIN om_spot_capacity_this_week c ON s.warehouse_id = c.FCID""")
oracle("join_key_split", f"""
SELECT cd.ContentRefID, {_SPLIT} AS CleanSpoID, spi.SpiQty FROM fx_content cd
JOIN fx_po_item spi ON TRY_CAST({_SPLIT} AS BIGINT) = spi.SpiID""")
oracle("join_key_safe_cast", f"""
SELECT cd.ContentRefID, cd.spoid, sml.truck_id FROM fx_content cd
LEFT JOIN fx_ship_manifest sml ON TRY_CAST({_SPLIT} AS BIGINT) = sml.truck_id""")
oracle("join_multi_key", """
SELECT cd.ReservationID, cd.ContentRefID, cd.Qty, cd.SpiID FROM fx_reservation_content cr
JOIN fx_content cd ON cr.ContentRefID = cd.ContentRefID AND cr.ReservationID = cd.ReservationID""")
oracle("join_anti_left_null", """
SELECT r.ReservationID, r.subwarehouse FROM fx_reservation r
LEFT JOIN fx_content cd ON r.ReservationID = cd.ReservationID WHERE cd.ReservationID IS NULL""")
oracle("join_role_playing", """
SELECT r.ReservationID, wh.warehouse_name, site.warehouse_name AS site_name, carrier.warehouse_name AS carrier_home
FROM fx_reservation r
LEFT JOIN om_dim_warehouse wh ON r.WarehouseID = wh.warehouse_id
LEFT JOIN om_dim_warehouse site ON r.siteID = site.warehouse_id
LEFT JOIN om_dim_warehouse carrier ON r.CarrierID % 100 = carrier.warehouse_id""")
oracle("join_self_partial_key", "SELECT * FROM om_metric_inbound_trailers")
oracle("join_left_then_inner", "SELECT * FROM om_metric_on_yard_units")
oracle("join_scalar_max", """
SELECT warehouse_id, day_of_unit_capacity, inbound_unit_capacity FROM fx_capacity
WHERE upload_date = (SELECT max(upload_date) FROM fx_capacity)""")
oracle("join_star_chain", "SELECT * FROM om_metric_throughput_variance")
from quayside.plans.yard_trailer import VISIT_ARRAYS  # noqa: E402
oracle("join_lateral_unnest", f"SELECT trailer_visit_id, {', '.join(a for _, a in VISIT_ARRAYS)} FROM om_visit_unnested")

# --- §2.4 aggregations ---------------------------------------------------------------------------------
# the unit ladder: the reservation count, else cross-dock units, else the subwarehouse median
_LADDER = "coalesce(CAST(trailer_inbound_reservation_units AS DOUBLE), CAST(xd_trailer_reservation_units AS DOUBLE), average_subwarehouse_qty)"
oracle("agg_sum_group", "SELECT warehouse_id, CAST(SUM(inbound_receiving_units) AS BIGINT) AS units FROM fx_tran_log GROUP BY 1")
oracle("agg_sum_case", f"SELECT subwarehouse, SUM({_LADDER}) AS sum_trailer_units FROM om_stg_units_reservation GROUP BY 1")
oracle("agg_sum_round", "SELECT SpiSprID, CAST(SUM(ROUND(SpiQty * 0.25, 0)) AS DOUBLE) AS qc_units FROM fx_po_item GROUP BY 1")
oracle("agg_count_col", "SELECT whid, COUNT(ShippedOnTime) AS n_on_time_known FROM fx_fill_rate GROUP BY 1")
oracle("agg_count_predicate", """
SELECT bill_of_lading_number, COUNT(shipment_destination_unloaded_date IS NOT NULL) AS trailer_received_qty,
       CAST(count_if(shipment_destination_unloaded_date IS NOT NULL) AS BIGINT) AS unloaded_qty
FROM fx_transport_unit GROUP BY 1""")
oracle("agg_count_distinct", "SELECT upload_date, WarehouseName, count(DISTINCT External_Reference) AS amount_of_units FROM fx_yard_sheet GROUP BY 1, 2")
oracle("agg_avg", "SELECT warehouse_id, AVG(inbound_receiving_units) AS avg_units FROM fx_tran_log GROUP BY 1")
oracle("agg_max_global", "SELECT max(upload_date) AS upload_date FROM fx_capacity")
oracle("agg_ratio_null_safe", """
SELECT whid, shipclass, CAST(coalesce(sum(ShippedOnTime), 0) / coalesce(nullif(count(ShippedOnTime), 0), 1) AS DOUBLE) AS fill_rate
FROM fx_fill_rate GROUP BY 1, 2""")
oracle("agg_group_as_distinct", "SELECT ReservationID, ContentType FROM fx_content GROUP BY 1, 2")
oracle("agg_group_ordinal", """
SELECT warehouse_id, CAST(log_datetime_local AS DATE) AS day, CAST(strftime(CAST(log_datetime_local AS DATE), '%U') AS BIGINT) AS week,
       CAST(SUM(inbound_receiving_units) AS BIGINT) AS units
FROM fx_tran_log GROUP BY 1, 2, 3""")
oracle("agg_group_finer_than_output", "SELECT warehouse_id, date, Freight_Class, BulkPick_Units FROM om_freight_by_class")
oracle("agg_pivot", """
SELECT warehouse_id, date, Bulk_Picks_LP, Bulk_Picks_SP_Bins FROM om_freight_pivot""")
oracle("agg_sum_plus_sum", """
SELECT warehouse_id, CAST(SUM(Bulk_Picks_LP) + SUM(Bulk_Picks_SP_Bins) AS BIGINT) AS fc_total_units_shipped_actuals
FROM om_freight_pivot GROUP BY 1""")
oracle("agg_median_then_avg", """
SELECT ContentType, CAST(AVG(m) AS DOUBLE) AS median_qty
FROM (SELECT ContentType, quantile_disc(Qty, 0.5) OVER (PARTITION BY ContentType) AS m FROM fx_content) GROUP BY 1""")
oracle("agg_on_join_fanout", "SELECT * FROM om_metric_inbound_trailers")
oracle("agg_lag_capacity", "SELECT warehouse_id, capacity AS sum_ib_unit_capacity_daily_lag2 FROM om_capacity_lag2")

# --- §2.5 windows -----------------------------------------------------------------------------------------
oracle("win_latest_row", "SELECT * FROM om_latest_inbound_visit")
oracle("win_first_event", """
SELECT EventQueueID, ReservationID, ActionID, EventDate FROM fx_event
QUALIFY ROW_NUMBER() OVER (PARTITION BY ReservationID, ActionID ORDER BY EventDate, EventQueueID) = 1""")
oracle("win_any_row", """
SELECT trailer_number, load_id, actual_ship_date FROM fx_load_master
QUALIFY ROW_NUMBER() OVER (PARTITION BY trailer_number ORDER BY load_id) = 1""")
oracle("win_qualify_one", "SELECT * FROM om_load_gate_out")
oracle("win_priority_pick", "SELECT * FROM om_units_priority")
oracle("win_rank_latest_ties", """
SELECT * FROM fx_capacity QUALIFY RANK() OVER (PARTITION BY warehouse_id, day_of_unit_capacity ORDER BY upload_date DESC) = 1""")
oracle("win_percentile_disc", """
SELECT ContentRefID, ReservationID, ContentType, Qty,
       CAST(quantile_disc(Qty, 0.5) OVER (PARTITION BY ContentType) AS DOUBLE) AS median_qty FROM fx_content""")
oracle("win_over_grouped", """
SELECT ReservationID, CAST(SUM(Qty) AS BIGINT) AS qty,
       ROW_NUMBER() OVER (PARTITION BY ReservationID ORDER BY ReservationID) AS row_num
FROM fx_content GROUP BY 1""")
oracle("win_latest_event_json", "SELECT ReservationID, total_quantity FROM om_newest_event")

# --- §2.6 / §2.7 -------------------------------------------------------------------------------------------
from oracle.models_sql import calendar_sql  # noqa: E402
oracle("sort_output", calendar_sql(
    "(SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), "
    "INTERVAL 1 DAY)) AS DATE) AS d FROM orders)") + "\nORDER BY date_actual")
oracle("topk_per_group", """
SELECT * FROM fx_capacity QUALIFY ROW_NUMBER() OVER (PARTITION BY warehouse_id, day_of_unit_capacity
                                                     ORDER BY upload_date DESC, inbound_unit_capacity DESC) = 1""")
oracle("union_all_paths", "SELECT * FROM om_load_reservation_match")
oracle("union_all_cadences", "SELECT * FROM om_metric_fill_rate")
oracle("union_all_metrics", "SELECT * FROM om_report_inbound_rows")

# --- §2.8 scalar functions ------------------------------------------------------------------------------
_NY = "timezone('America/New_York', timezone('UTC', {x}))"
oracle("fn_concat_op", "SELECT wms_wh_id, wh_id || '#' || state || '#' || zip AS joined FROM fx_wh")
oracle("fn_concat", "SELECT FCID, Week, concat(CAST(FCID AS VARCHAR), '-', CAST(Week AS VARCHAR)) AS identifier FROM fx_spot_capacity")
oracle("fn_split_first", "SELECT ContentRefID, spoid, split_part(spoid, '_', 1) AS CleanSpoID FROM fx_content")
oracle("fn_left", "SELECT ContentRefID, left(spoid, 1) AS first_char FROM fx_content")
oracle("fn_regexp_strip_prefix", f"SELECT ReservationID, TrailerNumber, {_STRIP.format(x='TrailerNumber')} AS trailer_key FROM fx_reservation")
oracle("fn_like", "SELECT ReservationID, subwarehouse LIKE '%Inbound%' AS is_inbound_sub, subwarehouse LIKE 'VAS' AS is_vas FROM fx_reservation")
oracle("fn_hash_record", "SELECT warehouse_id, hash_record FROM om_dim_warehouse")
oracle("fn_surrogate_key", "SELECT wms_wh_id, md5(" + " || '-' || ".join(
    f"coalesce(CAST({c} AS VARCHAR), '{SURROGATE_NULL}')" for c in ("wh_id", "name", "city", "state", "zip"))
    + ") AS surrogate_key FROM fx_wh")
oracle("fn_json_query", "SELECT EventQueueID, CAST(json_extract_string(EventDetail, '$.k') AS BIGINT) AS total_quantity FROM fx_event")
oracle("fn_ifnull", "SELECT wms_wh_id, coalesce(state, 'N/A') AS warehouse_state FROM fx_wh")
oracle("fn_coalesce", "SELECT wms_wh_id, coalesce(zip, state, city) AS locality FROM fx_wh")
oracle("fn_nullif", "SELECT truck_id, nullif(loaded_carton_count, 0) AS loaded FROM fx_truckload")
oracle("fn_safe_divide", "SELECT truck_id, CASE WHEN loaded_carton_count = 0 THEN NULL ELSE total_cartons / loaded_carton_count END AS ratio FROM fx_truckload")
oracle("fn_round", "SELECT SpiID, CAST(ROUND(SpiQty * 0.25, 0) AS DOUBLE) AS qc, round(SpiQty / 7, 1) AS per_week FROM fx_po_item")
oracle("fn_mod", "SELECT ContentRefID, Qty % 400 AS qty_mod FROM fx_content")
oracle("fn_safe_cast", "SELECT ContentRefID, TRY_CAST(split_part(spoid, '_', 1) AS BIGINT) AS truck_id FROM fx_content")
oracle("fn_cast", """
SELECT CAST(whid AS BIGINT) AS warehouse_id, CAST(cptdatetime AS DATE) AS day, CAST(ShippedOnTime AS DOUBLE) AS on_time,
       CAST(ShippedOnTime AS VARCHAR) AS on_time_s FROM fx_fill_rate""")
oracle("fn_if", "SELECT warehouse_id, IF(bulk_pick_units > 0, 'bulk', 'bins') AS pick_kind FROM fx_tran_log")
oracle("fn_current_date", """
SELECT whid, cptdatetime, date_diff('day', CAST(cptdatetime AS DATE), {TODAY}) AS days_utc,
       date_diff('day', CAST(cptdatetime AS DATE), {TODAY_NY}) AS days_ny FROM fx_fill_rate""")
oracle("fn_current_datetime", "SELECT trailer_visit_id, date_diff('hour', arrival, {NOW_NY}) AS hours_ago FROM fx_visit_flat")
oracle("fn_current_timestamp", "SELECT wh_id, {AS_OF} AS refreshed_at FROM fx_facility_type")
oracle("fn_datetime_in_zone", f"""
SELECT trailer_visit_id, {_NY.format(x='arrival')} AS arrival_ny,
       timezone('Europe/Berlin', timezone('UTC', depart)) AS depart_berlin FROM fx_visit_flat""")
oracle("fn_local_by_offset", """
SELECT ev.EventQueueID, ev.EventDate + CAST(dw.time_zone_hours_offset AS BIGINT) * INTERVAL '1' HOUR AS event_local
FROM fx_event ev JOIN fx_reservation tr ON ev.ReservationID = tr.ReservationID
LEFT JOIN om_dim_warehouse dw ON tr.WarehouseID = dw.warehouse_id""")
oracle("fn_zone_offset_hours", """
SELECT a.wms_wh_id, a.sty_id, a.hours_offset, wh.hours_offset AS hours_offset_old
FROM om_warehouse_attributes a JOIN fx_wh wh ON a.wms_wh_id = wh.wms_wh_id""")
oracle("fn_datetime_diff_hour", "SELECT trailer_visit_id, date_diff('hour', arrival, unload_complete) AS hours_to_unload FROM fx_visit_flat")
oracle("fn_hours_to_days", "SELECT trailer_visit_id, date_diff('hour', arrival, depart) / 24 AS days_on_yard FROM fx_visit_flat")
oracle("fn_date_add_sub", """
SELECT whid, CAST(CAST(cptdatetime AS DATE) - 3 AS DATE) AS minus_3d, CAST(CAST(cptdatetime AS DATE) + 7 AS DATE) AS plus_1w,
       CAST(CAST(cptdatetime AS DATE) - INTERVAL 6 MONTH AS DATE) AS minus_6m, CAST(CAST(cptdatetime AS DATE) - 1 AS DATE) AS minus_1d
FROM fx_fill_rate""")
oracle("fn_datetime_add_sub", """
SELECT trailer_visit_id, arrival - INTERVAL 1 DAY AS arrival_minus_1d, arrival + INTERVAL 4 HOUR AS arrival_plus_4h,
       arrival + INTERVAL 1 DAY AS arrival_plus_1d FROM fx_visit_flat""")
oracle("fn_cutoff_time", """
SELECT trailer_visit_id, CAST(CAST(arrival AS DATE) AS TIMESTAMP) + INTERVAL 4 HOUR AS cutoff_4h,
       CAST(CAST(arrival AS DATE) AS TIMESTAMP) AS cutoff_0h FROM fx_visit_flat""")
oracle("fn_date_trunc_week", "SELECT cptdatetime, CAST(CAST(cptdatetime AS DATE) - CAST(dayofweek(cptdatetime) AS INTEGER) AS DATE) AS week_start FROM fx_fill_rate")
oracle("fn_week_number_sunday", "SELECT cptdatetime, CAST(strftime(cptdatetime, '%U') AS BIGINT) AS week FROM fx_fill_rate")
oracle("fn_extract_parts", """
SELECT trailer_visit_id, year(arrival) AS y, day(arrival) AS d, hour(arrival) AS h, dayofweek(arrival) + 1 AS dow FROM fx_visit_flat""")
oracle("fn_week_to_date_window", """
SELECT log_datetime_local,
  CAST(CAST(log_datetime_local AS DATE) - 1 - CAST(dayofweek(CAST(log_datetime_local AS DATE) - 1) AS INTEGER) AS DATE) AS wtd_start,
  CAST(CAST(log_datetime_local AS DATE) - 1 - CAST(dayofweek(CAST(log_datetime_local AS DATE) - 1) AS INTEGER) - 1 + 7 AS DATE) AS wtd_end
FROM fx_tran_log""")
oracle("fn_date_of", "SELECT loadId, CAST(shipperGateOutTimestamp AS DATE) AS gate_out_day FROM fx_journey")
oracle("fn_timestamp_of", """
SELECT loadId, epoch_us(timezone('UTC', shipperGateOutTimestamp)) AS gate_out_micros,
       timezone('America/New_York', timezone('UTC', shipperGateOutTimestamp)) AS gate_out_new_york FROM fx_journey""")

# --- §2.11 backfill ------------------------------------------------------------------------------------
oracle("backfill_window_filter", "SELECT * FROM fx_tran_log WHERE CAST(log_datetime_local AS DATE) BETWEEN DATE '1995-01-01' AND {TODAY}")
oracle("backfill_lookback_start", "SELECT * FROM fx_tran_log WHERE CAST(log_datetime_local AS DATE) >= {TODAY} - 7")

# --- §2.12 quality -------------------------------------------------------------------------------------
from quayside.operators import quality as _Q  # noqa: E402
oracle("dq_not_null", "SELECT * FROM om_metric_throughput_variance WHERE received_units_actual_reporting_daily IS NULL")
oracle("dq_unique", """
SELECT inbound_trailer_reservation_id, count(*) AS n_records FROM om_stg_unit_snapshot
WHERE inbound_trailer_reservation_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
oracle("dq_accepted_values", """
SELECT trailer_visit_id, trailer_status FROM om_dim_yard_trailer
WHERE NOT coalesce(trailer_status IN ('F', 'O'), false)""")
oracle("dq_compound_unique", """
SELECT metric_id, metric_name, time_base_date, warehouse_name, country_long, count(*) AS n_records
FROM om_report_inbound GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1""")
oracle("dq_relationships", """
SELECT warehouse_id, cadence, ship_class FROM om_metric_fill_rate
WHERE warehouse_id IS NOT NULL AND warehouse_id NOT IN (SELECT warehouse_id FROM om_dim_warehouse WHERE warehouse_id IS NOT NULL)""")


def _check_sql(c) -> str:
    src = f"om_{c.model}"
    cols = list(c.columns)
    if c.kind == "not_null":
        body = f"SELECT count(*) FROM {src} WHERE {cols[0]} IS NULL"
    elif c.kind == "unique":
        body = f"SELECT count(*) FROM (SELECT {cols[0]} FROM {src} WHERE {cols[0]} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    elif c.kind == "accepted_values":
        vals = ", ".join(_q(v) for v in c.values)
        ok = f"{cols[0]} IN ({vals})" + (f" OR {cols[0]} IS NULL" if c.allow_null else "")
        body = f"SELECT count(*) FROM {src} WHERE NOT coalesce({ok}, false)"
    elif c.kind == "compound_unique":
        body = f"SELECT count(*) FROM (SELECT {', '.join(cols)} FROM {src} GROUP BY ALL HAVING count(*) > 1)"
    else:
        raise ValueError(c.kind)
    return (f"SELECT '{c.kind}' AS \"check\", '{c.model}' AS model, '{','.join(cols)}' AS columns, "
            f"({body}) AS n_violations")


oracle("dq_suite", "\nUNION ALL\n".join(_check_sql(c) for c in _Q.MODEL_CHECKS))

# --- §2.13 metric dictionary ---------------------------------------------------------------------------------
oracle("metric_dictionary_eval", """
SELECT warehouse_id, ship_class, report_date, 'Daily FR' AS metric_name, fill_rate_mm AS numerator, CAST(1 AS DOUBLE) AS denominator,
       fill_rate_mm / 1.0 AS metric_value FROM om_metric_fill_rate WHERE cadence = 'daily'
UNION ALL
SELECT warehouse_id, ship_class, report_date, 'Weekly FR', fill_rate_mm, CAST(1 AS DOUBLE), fill_rate_mm / 1.0
FROM om_metric_fill_rate WHERE cadence = 'weekly'""")
_ROW = "SELECT warehouse_id, report_date AS time_base_date, '{id}' AS metric_id, '{name}' AS metric_name, '{unit}' AS unit"
_FR = f"""{_ROW}, fill_rate_mm AS numerator, CAST(1 AS DOUBLE) AS denominator, fill_rate_mm AS metric_value
FROM om_metric_fill_rate WHERE cadence = '{{cadence}}'"""
oracle("metric_dictionary_planned", "\nUNION ALL\n".join([
    _FR.format(id="1", name="Daily FR", unit="#", cadence="daily"),
    _FR.format(id="1.A", name="Weekly FR", unit="#", cadence="weekly"),
    _ROW.format(id="1.B", name="Best FR", unit="%") + """, max(fill_rate_mm), CAST(1 AS DOUBLE), 100 * max(fill_rate_mm)
FROM om_metric_fill_rate WHERE cadence = 'last3days' GROUP BY ALL""",
    _ROW.format(id="2", name="Units out of compliance", unit="share") + """,
       coalesce(sum(total_amount_units) FILTER (WHERE out_of_both_sla = 1), 0), sum(total_amount_units),
       coalesce(sum(total_amount_units) FILTER (WHERE out_of_both_sla = 1), 0) / nullif(sum(total_amount_units), 0)
FROM om_metric_inbound_trailers GROUP BY ALL""",
    _ROW.format(id="2.A", name="Units out of arrival time", unit="share") + """, sum(total_amount_units), sum(total_amount_units),
       sum(total_amount_units) / nullif(sum(total_amount_units), 0)
FROM om_metric_inbound_trailers WHERE out_of_arrival_72_hours = 1 GROUP BY ALL""",
    _ROW.format(id="2.B", name="Trailers out of appointment", unit="trailers") + """,
       CAST(count(DISTINCT inbound_reservation_id) AS DOUBLE), CAST(1 AS DOUBLE), CAST(count(DISTINCT inbound_reservation_id) AS DOUBLE)
FROM om_metric_inbound_trailers WHERE out_of_appt_1_day = 1 GROUP BY ALL""",
    _ROW.format(id="2.C", name="Units within both times", unit="units") + """,
       coalesce(sum(total_amount_units) FILTER (WHERE out_of_both_sla = 1), 0), sum(total_amount_units),
       sum(total_amount_units) - coalesce(sum(total_amount_units) FILTER (WHERE out_of_both_sla = 1), 0)
FROM om_metric_inbound_trailers GROUP BY ALL""",
    _ROW.format(id="3", name="Yard load", unit="share") + """, CAST(sum(sum_trailer_units) AS DOUBLE), CAST(max(inbound_unit_capacity) AS DOUBLE),
       sum(sum_trailer_units) / nullif(max(inbound_unit_capacity), 0)
FROM om_metric_on_yard_units GROUP BY ALL""",
    _ROW.format(id="3.A", name="Late units", unit="units") + """, CAST(sum(sum_trailer_units) AS DOUBLE), CAST(1 AS DOUBLE),
       CAST(sum(sum_trailer_units) AS DOUBLE)
FROM om_metric_on_yard_units WHERE accountability_bucket LIKE 'arrived_late%' GROUP BY ALL"""]))
oracle("metric_tall_row", "SELECT * FROM om_report_outbound")

# --- S8, O1, O3 ------------------------------------------------------------------------------------------
oracle("merge_immutable_cols", f"""
SELECT warehouse_id, dwh_creation_timestamp, warehouse_name, dwh_modified_timestamp, time_zone_hours_offset FROM (
SELECT {', '.join(_merge_col(c) for c in _DIM_COLS)}
FROM (SELECT *, true AS __hit FROM ({_T})) t
FULL OUTER JOIN (SELECT *, true AS __hit FROM ({_U})) u ON t.warehouse_id = u.warehouse_id)""")
oracle("sort_in_cte", """
SELECT warehouse_id, CAST(SUM(BulkPick_Units) AS BIGINT) AS bulk_pick_units
FROM (SELECT * FROM om_freight_by_class ORDER BY warehouse_id, date) GROUP BY 1""")
oracle("run_limit", """
SELECT * FROM om_metric_fill_rate ORDER BY warehouse_id NULLS LAST, ship_class NULLS LAST, cadence NULLS LAST LIMIT 10""")
oracle("limit_rows", """
SELECT * FROM om_metric_fill_rate ORDER BY warehouse_id NULLS LAST, ship_class NULLS LAST, cadence NULLS LAST LIMIT 10""")

# --- backfill range: seven daily runs of the four-branch model, one per as_of ------------------------------
import datetime as _dt  # noqa: E402
_runs = [(_dt.datetime(1998, 6, 17, 12) - _dt.timedelta(days=i)).strftime("%Y-%m-%d %H:%M:%S") for i in range(7)]
oracle("backfill_range", "\nUNION ALL\n".join(f"SELECT * FROM ({build('SELECT * FROM om_metric_fill_rate', as_of=r)})" for r in _runs))

_STAY = ["om_on_site", "om_stg_unit_snapshot", "om_sla_rows", "om_sla_flags", "om_metric_inbound_trailers", "om_snapshot_buckets",
         "om_yard_buckets", "om_metric_on_yard_units"]
_THROUGHPUT = [n for n in FRAGMENTS if n.startswith("om_") and n not in _STAY]
ORACLES["range_inbound_trailers"] = build_runs("om_metric_inbound_trailers", _STAY, _runs)
ORACLES["range_on_yard_units"] = build_runs("om_metric_on_yard_units", _STAY, _runs)
for _key, _name in (("range_throughput_variance", "om_metric_throughput_variance"), ("range_yard_utilization", "om_metric_yard_utilization")):
    ORACLES[_key] = build_runs(_name, _THROUGHPUT, _runs)

# --- runs over written targets: the second run renames every warehouse, the first load's names stay --------
oracle("incremental_two_runs", "SELECT * FROM om_report_outbound")
oracle("incremental_two_runs_dimension", "SELECT warehouse_id, warehouse_name, warehouse_string_id FROM om_dim_warehouse")
oracle("merge_multi_element_visits", """
SELECT trailer_visit_id, CAST(((s - 1) * len(spot_id) + t - 1) * n_unload + u - 1 AS BIGINT) AS visit_element,
       trailer_status[s] AS trailer_status, spot_id[t] AS spot_id,
       CASE WHEN trailer_visit_id % 3 <> 0 THEN TIMESTAMP '1998-01-01' ELSE {AS_OF} END AS dwh_creation_timestamp
FROM (SELECT *, unnest(range(1, n_unload + 1)) AS u FROM (
  SELECT *, unnest(range(1, len(spot_id) + 1)) AS t FROM (
    SELECT trailer_visit_id, trailer_status, spot_id, greatest(len(trailer_unload_reservation_id), 1) AS n_unload,
           unnest(range(1, len(trailer_status) + 1)) AS s
    FROM fx_visit JOIN om_dim_warehouse w ON w.warehouse_id = facility_id[1])))""")

# --- evidence for checks and windows ------------------------------------------------------------------------
oracle("dq_not_null_violations", "SELECT trailer_visit_id FROM om_dim_yard_trailer WHERE load_id IS NULL")
oracle("dq_unique_violations", """
SELECT ReservationID, count(*) AS n_records FROM fx_content WHERE ReservationID IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
oracle("dq_relationships_violations", """
SELECT wh_id, FacilityType FROM fx_facility_type f
WHERE NOT EXISTS (SELECT 1 FROM om_dim_warehouse w WHERE w.warehouse_string_id = f.wh_id)""")
oracle("win_qualify_row_number", """
SELECT trailer_number, load_id, actual_ship_date FROM fx_load_master
QUALIFY row_number() OVER (PARTITION BY trailer_number ORDER BY actual_ship_date DESC NULLS LAST, load_id) = 1""")
oracle("event_lookback", """
SELECT r.ReservationID, e.ActionID, e.EventDate
FROM fx_reservation r JOIN fx_event e ON e.ReservationID = r.ReservationID
JOIN om_dim_warehouse w ON w.warehouse_id = r.WarehouseID
WHERE CAST(e.CreatedDate AS DATE) >= {TODAY} - INTERVAL 6 MONTH
QUALIFY row_number() OVER (PARTITION BY r.ReservationID, e.ActionID ORDER BY e.EventDate, e.EventQueueID) = 1""")
oracle("backfill_window_manual", "SELECT * FROM fx_tran_log WHERE CAST(log_datetime_local AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1996-03-31'")
oracle("backfill_window_regular", "SELECT * FROM fx_tran_log WHERE CAST(log_datetime_local AS DATE) BETWEEN {TODAY} - INTERVAL 6 MONTH AND {TODAY}")
