"""Stand-in source tables derived from the driver tables (FIXTURES.md part B).

The reference reads operational warehouse tables that are not part of the
test data.  Each stand-in here is a plain DataFrame transformation of one or
two driver tables, so its size grows with the scale factor and Catalyst
still prunes columns and pushes filters down to the parquet scans.  No
stand-in uses a cross join: small fixed multipliers are ``explode`` of a
literal array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources.tables import Tables


def _hours(ts: Column, n: Column) -> Column:
    return F.timestamp_add("HOUR", n.cast("bigint"), ts)


def _days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n.cast("bigint"), ts)


def _yard_day(o: DataFrame) -> F.Column:
    """The day of a reservation and its visit: the order date, but for every fortieth key a day of the week of the
    stand-ins' ``as_of``, so every kind of arrival is on the yard then."""
    return F.when(o.o_orderkey % 40 == 7, F.timestamp_add("DAY", (o.o_custkey % 7).cast("bigint"), F.lit("1998-06-14").cast("timestamp_ntz"))) \
        .otherwise(o.o_orderdate)


def _three_or(cond: F.Column, elements: list, otherwise: F.Column) -> F.Column:
    """An array of three elements where ``cond`` holds."""
    return F.when(cond, F.array(*elements)).otherwise(otherwise)


def _one_or_empty(x: Column, elem: T.DataType) -> Column:
    """One-element array, or an empty array when ``x`` is NULL."""
    return F.when(x.isNull(), F.array().cast(T.ArrayType(elem))).otherwise(F.array(x))


def _case(value: Column, pairs: list[tuple], default) -> Column:
    expr = None
    for k, v in pairs:
        expr = (F.when(value == k, F.lit(v)) if expr is None else expr.when(value == k, F.lit(v)))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


# Fixed value: upload date of the capacity stand-in's latest plan (after every order day).
LATEST_PLAN_UPLOAD = "2001-12-31"
# Fixed value: start of the driver's event stream.
EVENT_EPOCH = "2024-01-01 00:00:00"


def _bill(partkey: Column) -> Column:
    """Forty bills of lading for every two thousand parts."""
    return F.concat(F.lit("BL"), (partkey % 40 + 40 * F.floor(partkey / 2000)).cast("string"))


class Fixtures:
    """Stand-ins keyed by the names used in FIXTURES.md (``fx_*``)."""

    def __init__(self, tables: Tables):
        self.t = tables

    # --- warehouse dimension inputs ------------------------------------------------
    def fx_country(self) -> DataFrame:
        n = self.t.nation
        return n.select(n.n_nationkey.cast("bigint").alias("country_id"), n.n_name.alias("country_long"))

    def fx_wh(self) -> DataFrame:
        s, n = self.t.supplier, self.t.nation
        j = s.join(n, s.s_nationkey == n.n_nationkey)
        k = F.col("s_suppkey")
        return j.select(
            k.alias("wms_wh_id"),
            F.lpad(k.cast("string"), 2, "0").alias("wh_id"),
            (k * 100).alias("sva_id"),
            F.col("s_name").alias("name"),
            F.col("n_regionkey").cast("bigint").alias("sty_id"),
            (F.col("n_regionkey").cast("bigint") - 2).alias("hours_offset"),
            F.col("n_name").alias("city"),
            F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.substring("n_name", 1, 2)).alias("state"),
            F.when(k % 6 == 0, F.lit(None).cast("string"))
             .otherwise(F.lpad(((k * 37) % 100000).cast("string"), 5, "0")).alias("zip"),
            F.col("n_name").alias("country_name"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )

    def fx_site(self) -> DataFrame:
        s = self.t.supplier
        return s.where(s.s_suppkey % 7 != 0).select(
            s.s_suppkey.alias("WarehouseID"), (s.s_suppkey % 4).alias("CampusID"))

    def fx_wms_supplier(self) -> DataFrame:
        s = self.t.supplier
        k = s.s_suppkey
        return s.select(
            k.alias("wswhid"),
            (k + 1000).alias("WSSuID"),
            F.when(k % 3 != 0, k % 2 == 0).alias("WsIsBreakBulkFacility"),
            F.when(k % 5 != 0, s.s_acctbal > 0).alias("WSIsActive"),
            (k % 2 == 0).alias("WSIsFulfillmentcenter"),
        )

    def fx_retail_store(self) -> DataFrame:
        s = self.t.supplier
        return s.where(s.s_suppkey % 4 == 0).select(
            s.s_suppkey.alias("WarehouseID"),
            F.when(s.s_suppkey % 8 == 0, 1).otherwise(0).alias("IsActive"))

    # --- reservations, events, content -------------------------------------------------
    def fx_reservation(self) -> DataFrame:
        o = self.t.orders
        c = o.o_custkey
        return o.select(
            o.o_orderkey.alias("ReservationID"),
            (c % 10).alias("WarehouseID"),
            _case(o.o_orderpriority, [("1-URGENT", "SPDomesticInbound"), ("2-HIGH", "MainReceiving"),
                                      ("3-MEDIUM", "SPCGFInbound"), ("4-NOT SPECIFIED", "VAS")],
                  "OutboundDock").alias("subwarehouse"),
            c.alias("CarrierID"),
            F.concat(F.when(c % 2 == 0, F.lit("TR-")).otherwise(F.lit("")), c.cast("string")).alias("TrailerNumber"),
            (c % 7).alias("siteID"),
            _yard_day(o).alias("ScheduledStartDate"),
            (o.o_orderstatus != "P").alias("IsInbound"),
            (c % 13 == 0).alias("IsTerminated"),
        )

    def fx_event(self) -> DataFrame:
        """Reservation events.  Each event is placed after its reservation's
        day by its offset into January 2024, compressed tenfold (0-3 days), so
        events sit next to the reservation they belong to."""
        e, o = self.t.events, self.t.orders
        j = e.join(o.select("o_orderkey", _yard_day(o).alias("o_orderdate")), e.user_id == o.o_orderkey)
        offset = F.floor(F.timestamp_diff("SECOND", F.lit(EVENT_EPOCH).cast("timestamp_ntz"), e.ts) / 10)
        when = F.timestamp_add("SECOND", offset.cast("bigint"), F.col("o_orderdate"))
        return j.select(
            e.event_id.alias("EventQueueID"),
            e.user_id.alias("ReservationID"),
            _case(e.event_type, [("click", 28), ("view", 29)], 30).alias("ActionID"),
            when.alias("EventDate"),
            when.alias("CreatedDate"),
            e.props.alias("EventDetail"),
        )

    def fx_event_queue(self) -> DataFrame:
        e = self.t.events
        return e.select(e.event_id.alias("ID"))

    def fx_content(self) -> DataFrame:
        li = self.t.lineitem
        return li.select(
            (li.l_orderkey * 2 + F.when(li.l_partkey % 10 == 7, 1).otherwise(0)).alias("ContentRefID"),
            li.l_orderkey.alias("ReservationID"),
            F.when((li.l_orderkey % 53 == 0) & (li.l_partkey % 3 == 0), F.when(li.l_linenumber == 1, 400).otherwise(0))
             .otherwise(li.l_quantity).cast("bigint").alias("Qty"),
            (1 + li.l_partkey % 3).alias("ContentType"),
            (li.l_returnflag == "R").alias("IsContentRefDetailDeleted"),
            F.concat(F.when(li.l_suppkey % 10 == 0, F.lit("M")).otherwise(F.lit("")),
                     li.l_partkey.cast("string"), F.lit("_"), li.l_linenumber.cast("string")).alias("spoid"),
            (li.l_partkey * 10).alias("SpiID"),
            F.concat(F.lit("BOL"), li.l_orderkey.cast("string")).alias("BolNumber"),
        )

    def fx_reservation_content(self) -> DataFrame:
        """Content references: ``2k`` for most reservations, plus ``2k+1`` for every
        fifth one, so some reservations hold two references."""
        o = self.t.orders
        k = o.o_orderkey
        refs = F.when(k % 5 == 0, F.array(k * 2, k * 2 + 1)).otherwise(F.array(k * 2))
        return o.where(k % 15 != 0).select(k.alias("ReservationID"), F.explode(refs).alias("ContentRefID"))

    # --- loads and journeys -------------------------------------------------------------------
    def fx_load_master(self) -> DataFrame:
        o = self.t.orders
        k = o.o_orderkey
        return o.where(k % 2 == 0).select(
            k.alias("load_id"),
            F.when(k % 3 == 0, F.concat(F.lit("BOL"), k.cast("string"))).alias("reference_number"),
            o.o_custkey.cast("string").alias("trailer_number"),
            _days(_yard_day(o), k % 5 - 2).alias("actual_ship_date"),
        )

    def fx_journey(self) -> DataFrame:
        o = self.t.orders
        k = o.o_orderkey
        return o.where(k % 2 == 0).select(
            k.alias("loadId"),
            F.when(k % 5 != 0, _hours(_yard_day(o), F.lit(30))).alias("shipperGateOutTimestamp"))

    # --- trailer visits (arrays) ----------------------------------------------------------------
    def fx_visit_flat(self) -> DataFrame:
        o = self.t.orders
        k, c, d = o.o_orderkey, o.o_custkey, _yard_day(o)
        base = (c * 7 + k) % 97 - 36
        return o.select(
            k.alias("trailer_visit_id"),
            k.alias("res_id"),
            F.when(k % 11 != 0, _hours(d, base)).alias("arrival"),
            F.when(k % 3 != 0, _hours(d, base + k % 400)).alias("unload_complete"),
            F.when(k % 4 != 0, _hours(d, base + k % 700)).alias("depart"),
        )

    def fx_visit(self) -> DataFrame:
        """``tbl_yard_trailer_visit``: one row per visit, 21 attribute arrays."""
        o = self.t.orders
        k, c, d = o.o_orderkey, o.o_custkey, _yard_day(o)
        base = (c * 7 + k) % 97 - 36
        L, S, B, TS = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()
        one = _one_or_empty
        return o.select(
            k.alias("trailer_visit_id"),
            d.alias("event_created_timestamp"),
            one(c % 7, L).alias("site_id"),
            one(F.concat(F.lit("Site-"), (c % 7).cast("string")), S).alias("site"),
            one(c, L).alias("trailer_id"),
            one(F.concat(F.when(c % 2 == 0, F.lit("TR-")).otherwise(F.lit("")), c.cast("string")), S).alias("trailer_number"),
            _three_or(k % 8 == 5, [o.o_orderstatus, F.lit("Q"), F.lit(None).cast(S)], one(o.o_orderstatus, S)).alias("trailer_status"),
            one(o.o_orderpriority, S).alias("trailer_type"),
            one(c % 4, L).alias("campus_id"),
            one(F.concat(F.lit("Campus-"), (c % 4).cast("string")), S).alias("campus"),
            _three_or(k % 4 == 1, [k % 100, k % 100 + 100, k % 100 + 200], one(k % 100, L)).alias("spot_id"),
            one(k % 3, L).alias("spot_type_id"),
            one(_case(k % 3, [(0, "Door"), (1, "Yard")], "Offsite"), S).alias("spot_type"),
            one(k % 3 == 2, B).alias("is_spot_offsite"),
            one(k % 17 == 0, B).alias("is_trailer_lost"),
            one(k, L).alias("trailer_reservation_id"),
            _three_or(k % 64 == 33, [k - 1, k - 33, k], one(F.when(k % 4 == 1, k - 1), L)).alias("trailer_unload_reservation_id"),
            one(F.when(k % 23 != 0, c % 10), L).alias("facility_id"),
            one(F.when(k % 11 != 0, _hours(d, base)), TS).alias("trailer_arrival_date"),
            one(F.when(k % 3 != 0, _hours(d, base + k % 400)), TS).alias("trailer_unload_complete_date"),
            one(F.when(k % 6 != 0, _hours(d, F.lit(2))), TS).alias("trailer_load_complete_date"),
            one(F.when(k % 4 != 0, _hours(d, base + k % 700)), TS).alias("trailer_depart_date"),
            one(F.when(c % 13 == 0, d), TS).alias("trailer_reservation_cancelled_date"),
        )

    # --- fill rate ----------------------------------------------------------------------------------
    def fx_fill_rate(self) -> DataFrame:
        li = self.t.lineitem
        return li.select(
            (li.l_suppkey % 10).cast("string").alias("whid"),
            F.when(li.l_quantity < 25, "SP").otherwise("LP").alias("shipclass"),
            li.l_shipdate.alias("cptdatetime"),
            F.when(li.l_partkey % 17 == 0, F.lit(None).cast("int"))
             .when(li.l_returnflag == "N", F.lit(0))
             .otherwise(F.lit(1)).alias("ShippedOnTime"),
            F.when(li.l_partkey % 7 == 0, 1).otherwise(0).alias("performanceexclusions"),
            F.when(li.l_partkey % 5 == 0, "Other").otherwise("Standard").alias("OrderType_Performance"),
        )

    def fx_facility_type(self) -> DataFrame:
        s = self.t.supplier
        return s.select(
            s.s_suppkey.cast("string").alias("wh_id"),
            F.when(s.s_suppkey % 2 == 0, "MM").otherwise("FC").alias("FacilityType"))

    # --- throughput inputs --------------------------------------------------------------------------
    def fx_tran_log(self) -> DataFrame:
        li = self.t.lineitem
        q = li.l_quantity.cast("bigint")
        return li.select(
            (li.l_suppkey % 10).alias("warehouse_id"),
            li.l_shipdate.alias("log_datetime_local"),
            q.alias("inbound_receiving_units"),
            (li.l_partkey % 3).alias("freight_class_id"),
            F.when(li.l_linenumber % 2 == 1, q).otherwise(F.lit(0).cast("bigint")).alias("bulk_pick_units"),
            F.when(li.l_linenumber % 2 == 0, q).otherwise(F.lit(0).cast("bigint")).alias("bins_pick_units"),
        )

    def fx_freight_class(self) -> DataFrame:
        # Freight class id → class number ('1', '2', NULL).
        rows = [(0, "1"), (1, "2"), (2, None)]
        return self.t.spark.createDataFrame(rows, "freight_class_id bigint, freight_class_number string")

    def fx_capacity(self) -> DataFrame:
        """Receiving capacity: warehouses 0..9 × every order day × five uploads."""
        o, s = self.t.orders, self.t.supplier
        days = o.select(o.o_orderdate.cast("date").alias("day")).distinct()
        per_wh = days.select("day", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(9).cast("bigint"))).alias("wid"))
        w = s.select(s.s_suppkey)
        j = per_wh.join(w, per_wh.wid == w.s_suppkey)
        # uploads 0/7/14/21 days before the day, plus the latest plan (lag 28) uploaded on LATEST_PLAN_UPLOAD
        j = j.select("s_suppkey", "day", F.explode(F.array(*[F.lit(x) for x in (0, 7, 14, 21, 28)])).alias("lag"))
        upload = F.when(F.col("lag") == 28, F.lit(LATEST_PLAN_UPLOAD).cast("date")).otherwise(F.date_sub("day", F.col("lag")))
        return j.select(
            F.col("s_suppkey").alias("warehouse_id"),
            F.col("day").alias("day_of_unit_capacity"),
            upload.alias("upload_date"),
            (20 + (F.col("s_suppkey") * 7 + F.col("lag")) % 50).alias("inbound_unit_capacity"),
        )

    # --- yard sheet and spot capacity ---------------------------------------------------------------
    def fx_yard_sheet(self) -> DataFrame:
        o = self.t.orders
        names = _case(o.o_custkey % 6, [(0, "Hebron DC"), (1, "Perris DC"), (2, "Erlanger DC"),
                                         (3, "FC 13"), (4, "South Elgin DC")], "Unmapped DC")
        lags = F.array(*[F.lit(x) for x in list(range(14)) + [13]])  # 13 twice: exact duplicates
        x = o.select(o.o_orderkey.alias("External_Reference"), names.alias("WarehouseName"),
                     o.o_orderdate.cast("date").alias("d"), F.explode(lags).alias("lag"))
        return x.select("External_Reference", "WarehouseName",
                        F.date_add("d", F.col("lag")).alias("upload_date"))

    def fx_spot_capacity(self) -> DataFrame:
        o = self.t.orders
        # 362 weeks per five centres; further orders make further centres
        w = o.select((o.o_orderkey % 362).alias("week"), F.floor(o.o_orderkey / 362).alias("block"))
        w = w.select(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("week") * 7).cast("int")).alias("Week"), "block",
                     F.explode(F.array(*[F.lit(x).cast("bigint") for x in (5, 9, 10, 13, 30)])).alias("c"))
        return w.select((F.col("c") + 40 * F.col("block")).alias("FCID"), "Week",
                        (100 + F.col("c") + 40 * F.col("block")).alias("Yard_Capacity"))

    # --- order / purchase-order tables ------------------------------------------------------------------
    def fx_manifest(self) -> DataFrame:
        p = self.t.part
        return p.select(p.p_partkey.alias("SlmTruckID"), (p.p_partkey * 10).alias("slmID"))

    def fx_load_item(self) -> DataFrame:
        p = self.t.part
        return p.select((p.p_partkey * 10).alias("SliSlmID"), p.p_partkey.alias("SliSpiID"))

    def fx_po_item(self) -> DataFrame:
        p = self.t.part
        k = p.p_partkey
        size = p.p_size.cast("bigint")
        return p.select(
            k.alias("SpiID"), (k % 50).alias("SpiSpoID"), (k % 20).alias("SpiSprID"),
            F.when(k % 9 == 0, F.lit(0).cast("bigint")).otherwise(size).alias("SpiQty"),
            (size - size % 3).alias("SpiReceivedQty"))

    def fx_po(self) -> DataFrame:
        p = self.t.part
        k = p.p_partkey
        return p.select(
            k.alias("SpoId"), (k - k % 2).alias("SpoParentSpoId"),
            F.when(k % 3 == 0, 1).otherwise(3).alias("SpoType"))

    def fx_activity(self) -> DataFrame:
        p = self.t.part
        k = p.p_partkey
        return p.select(k.alias("SprID"), _case(k % 3, [(0, 63), (1, 6)], 1).alias("ActivityCode"))

    def fx_ship_manifest(self) -> DataFrame:
        p = self.t.part
        return p.select(p.p_partkey.alias("truck_id"),
                        _bill(p.p_partkey).alias("bill_of_lading_number"))

    def fx_transport_unit(self) -> DataFrame:
        p = self.t.part
        k = p.p_partkey
        return p.select(
            k.alias("transport_unit_id"),
            _bill(k).alias("bill_of_lading_number"),
            F.when(k % 4 != 0, F.lit("1998-06-10 00:00:00").cast("timestamp_ntz")).alias("shipment_destination_unloaded_date"),
            F.when(k % 5 == 0, "Store").otherwise("Warehouse").alias("shipment_destination_entity_type"))

    def fx_truckload(self) -> DataFrame:
        p = self.t.part
        size = p.p_size.cast("bigint")
        return p.select(p.p_partkey.alias("truck_id"),
                        F.when(p.p_partkey % 6 == 0, F.lit(0).cast("bigint")).otherwise(size).alias("loaded_carton_count"),
                        (size + 5).alias("total_cartons"))
