"""Unit counts per inbound reservation from competing sources.

The reference builds several per-reservation products (every content
reference × every content line of a reservation; every visit × every QC
line) and then sums over them.  Here such products are never materialised:
each surviving row carries a weight ``w`` = the number of copies the product
would hold, and every SUM/COUNT downstream is weighted.  Lookups over the
purchase-order tables are reduced per truck / per content line first, so
each join is key-to-key and a hot reservation costs no more than its own
rows.

Tie-breaks where the reference's pick is arbitrary:
* latest visit per reservation: visit id descending, then the remaining columns;
* loaded cartons per reservation: the smallest carton count;
* unit path: priority, then happy < sad < event JSON;
* newest reservation event: event time descending, then event id descending.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.functions import scalar as S
from quayside.operators import relops as R
from quayside.operators.percentiles import discrete_percentile
from quayside.plans.project import Project, model

RES = "inbound_trailer_reservation_id"

# Sentinel unit count demoted in the path priority.
SENTINEL_UNITS = 400
# Subwarehouse patterns.
XD_SUBWAREHOUSES = ["%Recei%", "%SPDomesticInbound%", "%SPCGFInbound%", "%PPXD%"]
MEDIAN_SUBWAREHOUSES = ["%SPDomesticInbound%", "%SPCGFInbound%", "%Receiv%"]
# Item activity codes counted as QC; path labels (in tie-break order); the
# JSON path of the event's unit count; the median's look-back in weeks.
QC_ACTIVITY_CODES = [63, 6]
PATH_ORDER = ["happy_path_yard_management", "sad_path_yard_management", "dbf_path_yard_management"]
DEFAULT_UNITS_JSON_PATH = "$.reservationDetails.totalQuantity"
MEDIAN_LOOKBACK_WEEKS = 12


def inbound_visits(p: Project) -> DataFrame:
    """``lri``: inbound visits with a reservation (all visits, not only the latest)."""
    yt = p.ref("dim_yard_trailer")
    return (yt.where(R.is_true("is_trailer_inbound") & F.col(RES).isNotNull())
              .select(RES, "trailer_visit_id", "warehouse_id", "subwarehouse",
                      "trailer_arrival_datetime_local", "is_trailer_unloaded"))


@model("latest_inbound_visit")
def latest_inbound_visit(p: Project) -> DataFrame:
    """``lri`` with ``latest_res_id = 1``: the newest visit per reservation."""
    order = [F.col("trailer_visit_id").desc(), F.col("warehouse_id").asc_nulls_last(),
             F.col("subwarehouse").asc_nulls_last(), F.col("trailer_arrival_datetime_local").asc_nulls_last(),
             F.col("is_trailer_unloaded").asc_nulls_last()]
    return R.pick_first(inbound_visits(p), [RES], order).drop("trailer_visit_id")


def _content_lines(p: Project) -> DataFrame:
    cd = p.source("content_detail")
    return cd.select("ContentRefID", "ReservationID", "Qty", "IsContentRefDetailDeleted", "ContentType",
                     S.split_first("spoid").alias("CleanSpoID"), "SpiID")


@model("units_base")
def units_base(p: Project) -> DataFrame:
    """``base``: happy-path lines (content refs → their lines) and, for lines whose
    cleaned order id no happy line has, sad-path lines (every line of the
    reservation, once per content reference: weight ``w``)."""
    lri = p.ref("latest_inbound_visit").select(RES, "warehouse_id")
    cr = p.source("reservation_content").select(F.col("ReservationID").alias(RES), "ContentRefID")
    lines = _content_lines(p)
    cols = ["Qty", "IsContentRefDetailDeleted", "ContentType", "CleanSpoID"]

    happy = (lri.join(cr, RES)
                .join(lines.select("ContentRefID", *cols), "ContentRefID", "left")
                .select(RES, "warehouse_id", *cols, F.lit("happy_path").alias("qty_path"), F.lit(1).cast("bigint").alias("w")))

    n_refs = cr.groupBy(RES).agg(F.count(F.lit(1)).alias("w"))
    sad_lines = lines.select(F.col("ReservationID").alias(RES), *cols)
    sad = (lri.join(n_refs, RES)
              .join(sad_lines, RES, "left")
              .select(RES, "warehouse_id", *cols, F.lit("sad_path").alias("qty_path"), "w"))
    happy_ids = happy.select("CleanSpoID").where(F.col("CleanSpoID").isNotNull()).distinct()
    sad = R.anti_join(sad, happy_ids, "CleanSpoID")
    return R.union_all([happy, sad])


def _wsum(c: str):
    return F.sum(F.col(c) * F.col("w"))


def happy_sad_units(p: Project) -> tuple[DataFrame, DataFrame]:
    base = p.ref("units_base").where(R.is_false("IsContentRefDetailDeleted"))
    happy = base.where(F.col("ContentType") == 1).groupBy(RES).agg(_wsum("Qty").alias("trailer_reservation_units"))
    sad = base.groupBy(RES).agg(_wsum("Qty").alias("trailer_reservation_units"))
    return happy, sad


@model("units_happy_sad")
def units_happy_sad(p: Project) -> DataFrame:
    """M7: units per reservation from the happy and the sad content paths."""
    happy, sad = happy_sad_units(p)
    return R.union_all([R.tag(happy, path=PATH_ORDER[0]), R.tag(sad, path=PATH_ORDER[1])])


@model("units_json_fallback")
def units_json_fallback(p: Project) -> DataFrame:
    """M8: units from the newest reservation event's JSON, for reservations
    neither content path covers (W9, F9)."""
    path = p.ctx.param("units_json_path", DEFAULT_UNITS_JSON_PATH)
    eq = p.source("event_queue").select("ID")
    re_ = p.source("reservation_event").select("EventQueueID", F.col("ReservationID").alias(RES), "EventDate", "EventDetail")
    ev = re_.join(eq, re_.EventQueueID == eq.ID)
    newest = R.pick_first(ev, [RES], [F.col("EventDate").desc(), F.col("EventQueueID").desc()])
    dbf = newest.select(RES, S.json_int("EventDetail", path).alias("trailer_reservation_units"))
    happy, sad = happy_sad_units(p)
    lri = p.ref("latest_inbound_visit").select(RES)
    rest = R.anti_join(R.anti_join(lri, happy.select(RES), RES), sad.select(RES), RES)
    return rest.join(dbf, RES, "left").select(RES, "trailer_reservation_units")


@model("units_priority")
def units_priority(p: Project) -> DataFrame:
    """M9: best of the three paths; the sentinel count is demoted."""
    happy, sad = happy_sad_units(p)
    paths = R.union_all([R.tag(happy, path=PATH_ORDER[0]), R.tag(sad, path=PATH_ORDER[1]),
                         R.tag(p.ref("units_json_fallback"), path=PATH_ORDER[2])])
    prio = F.when(F.col("trailer_reservation_units") == SENTINEL_UNITS, 2).otherwise(1)
    rank = F.when(F.col("path") == PATH_ORDER[0], 0).when(F.col("path") == PATH_ORDER[1], 1).otherwise(2)
    best = R.pick_first(paths, [RES], [prio, rank])
    return best.select(RES, "path", "trailer_reservation_units")


def _truck_key(c: str = "CleanSpoID"):
    return F.col(c).try_cast("bigint")


def _by_truck(lines: DataFrame) -> DataFrame:
    """``lines`` to be joined by truck: they grow with the reservations, and the size of their (well compressed) files would
    have them broadcast through the driver."""
    return lines.hint("merge")


def loaded_cartons(p: Project) -> DataFrame:
    """Cartons per reservation: smallest count over its linked trucks."""
    base = p.ref("units_base").where(F.col("ContentType").isin(2, 3)).select(RES, _truck_key().alias("truck"))
    trucks = p.source("shipping_load_manifest").select(F.col("SlmTruckID").alias("truck")).distinct()
    tv = p.source("truckload_volume")
    per_truck = tv.groupBy(F.col("truck_id").alias("truck")).agg(
        F.min(S.zero_fallback("loaded_carton_count", "total_cartons")).alias("loaded_carton_count"))
    truck_count = trucks.join(per_truck, "truck", "left")
    return _by_truck(base).join(truck_count, "truck").groupBy(RES).agg(F.min("loaded_carton_count").alias("loaded_carton_count"))


def received_units(p: Project) -> DataFrame:
    """Transport units per reservation via its trucks' bills of lading (A4, A5)."""
    base = p.ref("units_base").select(RES, _truck_key().alias("truck"), "w")
    tu = p.source("transport_unit").where(F.col("shipment_destination_entity_type") == "Warehouse")
    per_bol = tu.groupBy("bill_of_lading_number").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("transport_unit_id").alias("n_ids"))
    sml = p.source("shipment_manifest").select(F.col("truck_id").alias("truck"), "bill_of_lading_number")
    per_truck = sml.join(per_bol, "bill_of_lading_number").groupBy("truck").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_ids").alias("n_ids"))
    j = _by_truck(base).join(per_truck, "truck")
    # COUNT(x IS NOT NULL) counts every joined row; COUNT(id) only non-NULL ids
    return j.groupBy(RES).agg(
        F.sum(F.col("n_rows") * F.col("w")).alias("trailer_received_qty"),
        F.sum(F.col("n_ids") * F.col("w")).alias("trailer_outstanding_qty"))


def qc_units(p: Project) -> DataFrame:
    """QC units per reservation: a quarter of the QC-coded item quantity, rounded,
    once per inbound visit of the reservation (A3)."""
    visits = inbound_visits(p).groupBy(RES).agg(F.count(F.lit(1)).alias("n_visits"))
    cr = p.source("reservation_content").select(F.col("ReservationID").alias(RES), "ContentRefID")
    cd = (_content_lines(p).where(F.col("ContentType").isin(2, 3))
          .select("ContentRefID", F.col("ReservationID").alias(RES), "SpiID"))
    sli = p.source("shipping_load_item").select("SliSlmID", "SliSpiID")
    spi = p.source("po_item").select("SpiID", "SpiSprID", "SpiQty")
    ia = p.source("item_activity").where(F.col("ActivityCode").isin(QC_ACTIVITY_CODES)).select("SprID")
    qc_item = (sli.join(spi.withColumnRenamed("SpiID", "SliSpiID"), "SliSpiID")
                  .join(ia, F.col("SpiSprID") == ia.SprID)
                  .groupBy(F.col("SliSlmID").alias("SpiID"))
                  .agg(F.sum(F.round(F.col("SpiQty") * F.lit(0.25), 0)).alias("qc")))
    per_line = cd.join(qc_item, "SpiID").groupBy("ContentRefID", RES).agg(F.sum("qc").alias("qc"))
    per_res = cr.join(per_line, ["ContentRefID", RES]).groupBy(RES).agg(F.sum("qc").alias("qc"))
    return per_res.join(visits, RES).select(RES, (F.col("qc") * F.col("n_visits")).cast("double").alias("trailer_qc_units"))


def xd_units(p: Project) -> DataFrame:
    """Cross-dock units per reservation from child purchase orders of type 3."""
    base = (p.ref("units_base")
            .where(F.col("ContentType").isin(2, 3) & (F.substring("CleanSpoID", 1, 1) != "M")
                   & R.is_false("IsContentRefDetailDeleted"))
            .select(RES, _truck_key().alias("truck"), "w"))
    slm = p.source("shipping_load_manifest").select(F.col("SlmTruckID").alias("truck"), F.col("slmID").alias("SliSlmID"))
    sli = p.source("shipping_load_item").select("SliSlmID", F.col("SliSpiID").alias("SpiID"))
    spi = p.source("po_item").where(F.col("SpiQty") != 0).select("SpiID", "SpiSpoID", "SpiQty", "SpiReceivedQty")
    spo = (p.source("po").where((F.col("SpoId") != F.col("SpoParentSpoId")) & (F.col("SpoType") == 3))
           .select(F.col("SpoId").alias("SpiSpoID")))
    per_truck = (slm.join(sli, "SliSlmID").join(spi, "SpiID").join(spo, "SpiSpoID")
                 .groupBy("truck").agg(F.sum("SpiReceivedQty").alias("rcv"), F.sum("SpiQty").alias("qty"),
                                       F.count(F.lit(1)).alias("n")))
    j = _by_truck(base).join(per_truck, "truck")
    return j.groupBy(RES).agg(F.sum(F.col("rcv") * F.col("w")).alias("xd_received_units"),
                              F.sum(F.col("qty") * F.col("w")).alias("xd_trailer_reservation_units"))


@model("units_carton_qc_xd")
def units_carton_qc_xd(p: Project) -> DataFrame:
    """Cartons, received/outstanding transport units, QC and cross-dock units per reservation."""
    lri = p.ref("latest_inbound_visit").select(RES)
    return (lri.join(loaded_cartons(p), RES, "left")
               .join(received_units(p), RES, "left")
               .join(qc_units(p), RES, "left")
               .join(xd_units(p), RES, "left"))


@model("units_logic")
def units_logic(p: Project) -> DataFrame:
    lri = p.ref("latest_inbound_visit")
    parts = p.ref("units_carton_qc_xd")
    ru = p.ref("units_priority")
    j = lri.join(parts, RES, "left").join(ru, RES, "left")
    return j.select(
        RES, "trailer_arrival_datetime_local", "subwarehouse",
        F.coalesce("trailer_received_qty", "xd_received_units").alias("trailer_received_units"),
        F.when(R.like_any("subwarehouse", XD_SUBWAREHOUSES),
               F.coalesce("xd_trailer_reservation_units", "loaded_carton_count")).alias("xd_trailer_reservation_units"),
        F.col("trailer_outstanding_qty").alias("total_trailer_units"),
        "trailer_qc_units", "loaded_carton_count",
        F.coalesce("trailer_reservation_units", "trailer_outstanding_qty").alias("trailer_inbound_reservation_units"),
        "path", "is_trailer_unloaded",
    )


@model("units_median_backup")
def units_median_backup(p: Project) -> DataFrame:
    """Discrete median of recent unit totals per subwarehouse.

    Every row of a subwarehouse carries the same windowed median, so the
    reference's AVG over them equals the grouped median (A15), found over
    counted values in ranges.
    """
    ul = p.ref("units_logic")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    start = p.ctx.current_date - dt.timedelta(weeks=MEDIAN_LOOKBACK_WEEKS)
    recent = ul.where(
        R.like_any("subwarehouse", MEDIAN_SUBWAREHOUSES)
        & (F.to_date("trailer_arrival_datetime_local") >= cal.lit_date(start))
        & (F.col("trailer_arrival_datetime_local") < cal.lit_ntz(p.ctx.current_datetime))
        & (z("trailer_inbound_reservation_units") + z("xd_trailer_reservation_units") + z("total_trailer_units") > 0))
    x = (z("trailer_inbound_reservation_units") + z("xd_trailer_reservation_units")).alias("x")
    return discrete_percentile(recent.select("subwarehouse", x), "subwarehouse", "x", "average_subwarehouse_qty",
                               store=lambda df: p.stage("units_median_values", df))


@model("stg_units_reservation")
def stg_units_reservation(p: Project) -> DataFrame:
    """Every unit measure per inbound reservation, with the subwarehouse median."""
    ul = p.ref("units_logic")
    sub = p.ref("units_median_backup")
    out = ul.join(sub, "subwarehouse", "left").select(
        RES, "trailer_arrival_datetime_local", "subwarehouse", "trailer_qc_units",
        "trailer_inbound_reservation_units", "trailer_received_units", "xd_trailer_reservation_units",
        "average_subwarehouse_qty", "loaded_carton_count", "total_trailer_units", "is_trailer_unloaded", "path")
    return out
