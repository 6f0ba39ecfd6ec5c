"""The declared sources — database, table and the columns that the models read, with their types.

A source may have more columns; one that a model reads must be there with its type.  ``check`` says by name what is
missing or of another type, when a source is read and before rows are merged into a written table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql.types import StructType


class SchemaError(ValueError):
    """A table lacks declared columns, or has them with other types."""


@dataclass(frozen=True)
class Declared:
    database: str
    table: str
    columns: str  # DDL

    @lru_cache(maxsize=None)
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)


def check(name: str, found: StructType, declared: StructType) -> None:
    """Refuse ``found`` where a declared column is missing or of another type."""
    types = {f.name: f.dataType.simpleString() for f in found.fields}
    faults = [f"column {f.name} is missing" if f.name not in types else
              f"column {f.name} is {types[f.name]}, not {f.dataType.simpleString()}"
              for f in declared.fields if types.get(f.name) != f.dataType.simpleString()]
    if faults:
        raise SchemaError(f"{name}: " + "; ".join(faults))


# The sources' columns and types.
DECLARED: dict[str, Declared] = {
    "warehouse": Declared(
        "curated", "warehouse",
        "wms_wh_id bigint, wh_id string, sva_id bigint, name string, sty_id bigint, hours_offset bigint, "
        "city string, state string, zip string, country_name string, is_active boolean"),
    "site": Declared(
        "curated", "site",
        "WarehouseID bigint, CampusID bigint"),
    "wms_supplier": Declared(
        "curated", "wms_supplier",
        "wswhid bigint, WSSuID bigint, WsIsBreakBulkFacility boolean, WSIsActive boolean, "
        "WSIsFulfillmentcenter boolean"),
    "retail_store": Declared(
        "curated", "retail_store",
        "WarehouseID bigint, IsActive int"),
    "country": Declared(
        "curated", "country",
        "country_id bigint, country_long string"),
    "reservation": Declared(
        "curated", "reservation",
        "ReservationID bigint, WarehouseID bigint, subwarehouse string, CarrierID bigint, "
        "TrailerNumber string, siteID bigint, ScheduledStartDate timestamp_ntz, IsInbound boolean, "
        "IsTerminated boolean"),
    "reservation_event": Declared(
        "curated", "reservation_event",
        "EventQueueID bigint, ReservationID bigint, ActionID int, EventDate timestamp_ntz, "
        "CreatedDate timestamp_ntz, EventDetail string"),
    "event_queue": Declared(
        "curated", "event_queue",
        "ID bigint"),
    "reservation_content": Declared(
        "curated", "reservation_content",
        "ReservationID bigint, ContentRefID bigint"),
    "content_detail": Declared(
        "curated", "content_detail",
        "ContentRefID bigint, ReservationID bigint, Qty bigint, ContentType bigint, "
        "IsContentRefDetailDeleted boolean, spoid string, SpiID bigint, BolNumber string"),
    "load_master": Declared(
        "curated", "load_master",
        "load_id bigint, reference_number string, trailer_number string, actual_ship_date timestamp_ntz"),
    "journey": Declared(
        "curated", "journey",
        "loadId bigint, shipperGateOutTimestamp timestamp_ntz"),
    "trailer_visit": Declared(
        "curated", "trailer_visit",
        "trailer_visit_id bigint, event_created_timestamp timestamp_ntz, site_id array<bigint>, "
        "site array<string>, trailer_id array<bigint>, trailer_number array<string>, "
        "trailer_status array<string>, trailer_type array<string>, campus_id array<bigint>, "
        "campus array<string>, spot_id array<bigint>, spot_type_id array<bigint>, "
        "spot_type array<string>, is_spot_offsite array<boolean>, is_trailer_lost array<boolean>, "
        "trailer_reservation_id array<bigint>, trailer_unload_reservation_id array<bigint>, "
        "facility_id array<bigint>, trailer_arrival_date array<timestamp_ntz>, "
        "trailer_unload_complete_date array<timestamp_ntz>, "
        "trailer_load_complete_date array<timestamp_ntz>, trailer_depart_date array<timestamp_ntz>, "
        "trailer_reservation_cancelled_date array<timestamp_ntz>"),
    "trailer_visit_flat": Declared(
        "curated", "trailer_visit_flat",
        "trailer_visit_id bigint, res_id bigint, arrival timestamp_ntz, unload_complete timestamp_ntz, "
        "depart timestamp_ntz"),
    "weekly_fill_rate": Declared(
        "curated", "weekly_fill_rate",
        "whid string, shipclass string, cptdatetime timestamp_ntz, ShippedOnTime int, "
        "performanceexclusions int, OrderType_Performance string"),
    "facility_type": Declared(
        "curated", "facility_type",
        "wh_id string, FacilityType string"),
    "tran_log_units": Declared(
        "aad", "tran_log_units",
        "warehouse_id bigint, log_datetime_local timestamp_ntz, inbound_receiving_units bigint, "
        "freight_class_id bigint, bulk_pick_units bigint, bins_pick_units bigint"),
    "tran_log_units_freight": Declared(
        "aad", "tran_log_units",
        "warehouse_id bigint, log_datetime_local timestamp_ntz, inbound_receiving_units bigint, "
        "freight_class_id bigint, bulk_pick_units bigint, bins_pick_units bigint"),
    "freight_class": Declared(
        "aad", "freight_class",
        "freight_class_id bigint, freight_class_number string"),
    "receiving_capacity": Declared(
        "curated", "receiving_capacity",
        "warehouse_id bigint, day_of_unit_capacity date, upload_date date, inbound_unit_capacity bigint"),
    "yard_sheet": Declared(
        "curated", "yard_sheet",
        "External_Reference bigint, WarehouseName string, upload_date date"),
    "spot_capacity": Declared(
        "curated", "spot_capacity",
        "FCID bigint, Week date, Yard_Capacity bigint"),
    "shipping_load_manifest": Declared(
        "curated", "shipping_load_manifest",
        "SlmTruckID bigint, slmID bigint"),
    "shipping_load_item": Declared(
        "curated", "shipping_load_item",
        "SliSlmID bigint, SliSpiID bigint"),
    "po_item": Declared(
        "curated", "po_item",
        "SpiID bigint, SpiSpoID bigint, SpiSprID bigint, SpiQty bigint, SpiReceivedQty bigint"),
    "po": Declared(
        "curated", "po",
        "SpoId bigint, SpoParentSpoId bigint, SpoType int"),
    "item_activity": Declared(
        "curated", "item_activity",
        "SprID bigint, ActivityCode int"),
    "shipment_manifest": Declared(
        "curated", "shipment_manifest",
        "truck_id bigint, bill_of_lading_number string"),
    "transport_unit": Declared(
        "curated", "transport_unit",
        "transport_unit_id bigint, bill_of_lading_number string, "
        "shipment_destination_unloaded_date timestamp_ntz, shipment_destination_entity_type string"),
    "truckload_volume": Declared(
        "curated", "truckload_volume",
        "truck_id bigint, loaded_carton_count bigint, total_cartons bigint"),
}
