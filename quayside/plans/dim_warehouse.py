"""M1 ``dim_warehouse``: conformed warehouse dimension with a record hash.

Inputs are small (one row per warehouse); every join is a left join on the
warehouse key, planned by statistics and AQE (broadcast hash joins at this size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.functions import scalar as S
from quayside.operators import relops as R
from quayside.plans.project import Project, model

# Warehouse id → display name overrides.
NAME_OVERRIDES = [
    ("05", "Hebron"), ("09", "PerrisLP"), ("10", "Erlanger"), ("13", "Cranbury"),
    ("15", "Greensboro"), ("17", "McDonough"), ("18", "PerrisSP"), ("20", "Kassel"),
    ("21", "Mississauga"), ("22", "Florence"), ("23", "CranburyLargeParcel"), ("24", "Lancaster"),
    ("25", "PortWentworth"), ("26", "Lathrop"), ("27", "Mallow"), ("28", "Jacksonville"),
    ("30", "South Elgin"), ("31", "Cranbury 2"), ("32", "Hammersbach"), ("33", "Lich"),
    ("35", "Aberdeen"), ("42", "Romeoville"), ("45", "Richmond"),
]

# Warehouse id → sva id overrides.
SVA_OVERRIDES = [("20", 904), ("33", 1190)]

# Region membership by warehouse id (others: NULL).
REGIONS = [
    ("Central", ["05", "10", "15", "21", "22", "30", "42", "45"]),
    ("West", ["09", "18", "24", "26"]),
    ("East", ["13", "17", "23", "25", "28", "31", "35"]),
    ("EU", ["20", "27", "32", "33"]),
]

# Current ground time in minutes by warehouse id (others: NULL).
GROUND_MINUTES = [
    ("05", 1380), ("09", 1200), ("10", 1380), ("13", 1320), ("17", 1410), ("18", 1470),
    ("21", 1350), ("22", 1320), ("23", 990), ("24", 1380), ("25", 1020), ("26", 1200),
    ("28", 1050), ("31", 1320), ("35", 960),
]

# Test warehouses excluded from the dimension.
TEST_WAREHOUSES = [34, 36, 44, 998, 999]

# Style id → zone whose offset from New York is recomputed each run.
ZONE_BY_STYLE = [(2, "Europe/London"), (3, "Europe/Berlin")]

# The columns a merge may update; the others keep their first value.
MERGE_UPDATE_COLUMNS = [
    "dwh_modified_timestamp", "hash_record", "record_source", "warehouse_id", "warehouse_string_id",
    "region", "campus_id", "time_zone_hours_offset", "warehouse_city", "warehouse_state",
    "warehouse_zip", "warehouse_supplier_id", "country_id", "is_dedicated_break_bulk_facility",
    "is_physical_retail_store_warehouse", "is_active", "is_fulfillment_center",
]
UNIQUE_KEY = "warehouse_id"
RECORD_SOURCE = "warehouse"


def _region(wh_id) -> F.Column:
    expr = None
    for name, ids in REGIONS:
        cond = F.col(wh_id).isin(ids)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def warehouse_attributes(p: Project) -> DataFrame:
    """Warehouse attributes before naming defaults: one row per warehouse."""
    wh = p.source("warehouse").where(~F.col("wms_wh_id").isin(TEST_WAREHOUSES))
    site = p.dimension("site", "WarehouseID", "CampusID", source=True)
    country = p.dimension("country", "country_id", "country_long", source=True)
    supplier = p.dimension("wms_supplier", source=True)
    store = p.dimension("retail_store", F.col("WarehouseID").alias("st_wh"),
                        F.col("IsActive").alias("st_active"), source=True)

    j = (wh.join(site, wh.wms_wh_id == site.WarehouseID, "left")
           .join(country, wh.country_name == country.country_long, "left")
           .join(supplier, wh.wms_wh_id == supplier.wswhid, "left")
           .join(store, wh.wms_wh_id == store.st_wh, "left"))

    # the offset of European sites from New York is recomputed from as_of (DST-aware)
    hours_offset = None
    for style, zone in ZONE_BY_STYLE:
        cond = F.col("sty_id") == style
        val = F.lit(p.ctx.zone_offset_hours(zone)).cast("bigint")
        hours_offset = F.when(cond, val) if hours_offset is None else hours_offset.when(cond, val)
    hours_offset = hours_offset.otherwise(F.col("hours_offset"))

    return j.select(
        "wh_id",
        R.code_lookup("wh_id", SVA_OVERRIDES, default=F.col("sva_id")).cast("bigint").alias("sva_id"),
        "sty_id", "wms_wh_id", "CampusID",
        R.code_lookup("wh_id", NAME_OVERRIDES, default=F.col("name")).alias("wh"),
        _region("wh_id").alias("region"),
        hours_offset.alias("hours_offset"),
        F.col("hours_offset").alias("hours_offset_old"),
        "city", "state", "zip",
        R.code_lookup("wh_id", GROUND_MINUTES).cast("bigint").alias("current_ground_time_in_minutes"),
        F.col("WSSuID").alias("warehouse_supplier_id"),
        F.coalesce("country_id", F.lit(-1).cast("bigint")).alias("country_id"),
        F.coalesce("WsIsBreakBulkFacility", F.lit(False)).alias("is_dedicated_break_bulk_facility"),
        (F.coalesce("st_active", F.lit(0)) == 1).alias("is_physical_retail_store_warehouse"),
        F.col("WSIsActive").alias("is_active"),
        F.col("WSIsFulfillmentcenter").alias("is_fulfillment_center"),
    )


def record_hash(w: DataFrame) -> F.Column:
    """SHA-1 over the '#'-joined attributes.

    Every part has a NULL default here ('N/A', or '-1' for the supplier id);
    the reference leaves ``is_active`` and ``is_fulfillment_center`` without
    one, which makes the whole hash NULL and re-emits the row on every run.
    """
    na = F.lit("N/A")
    s = lambda c: F.col(c).cast("string")
    return S.hash_record([
        F.coalesce(F.col("wh_id"), na), s("wms_wh_id"),
        F.coalesce(F.col("wh"), na), F.coalesce(F.col("region"), na),
        F.coalesce(s("CampusID"), na), F.coalesce(s("hours_offset"), na),
        F.coalesce(F.col("city"), na), F.coalesce(F.col("state"), na), F.coalesce(F.col("zip"), na),
        F.coalesce(s("warehouse_supplier_id"), F.lit("-1")), s("country_id"),
        F.coalesce(s("is_dedicated_break_bulk_facility"), na), F.coalesce(s("is_physical_retail_store_warehouse"), na),
        F.coalesce(s("is_active"), na), F.coalesce(s("is_fulfillment_center"), na),
    ])


@model("dim_warehouse")
def dim_warehouse(p: Project) -> DataFrame:
    w = warehouse_attributes(p)
    na = F.lit("N/A")
    ts = cal.lit_ntz(p.ctx.current_timestamp)
    out = w.select(
        ts.alias("dwh_creation_timestamp"),
        ts.alias("dwh_modified_timestamp"),
        F.lit(RECORD_SOURCE).alias("record_source"),
        record_hash(w).alias("hash_record"),
        F.col("wms_wh_id").alias("warehouse_id"),
        F.col("wh_id").alias("warehouse_string_id"),
        F.coalesce("wh", na).alias("warehouse_name"),
        F.coalesce("region", na).alias("region"),
        F.col("CampusID").alias("campus_id"),
        F.col("hours_offset").alias("time_zone_hours_offset"),
        F.coalesce("city", na).alias("warehouse_city"),
        F.coalesce("state", na).alias("warehouse_state"),
        F.coalesce("zip", na).alias("warehouse_zip"),
        "warehouse_supplier_id", "country_id", "is_dedicated_break_bulk_facility",
        "is_physical_retail_store_warehouse", "is_active", "is_fulfillment_center",
    )
    target = p.this("dim_warehouse")
    if target is not None:  # S11: only rows whose hash is new
        out = R.anti_join(out, target.select("hash_record"), on="hash_record")
    return out
