"""Source registry: logical source name → DataFrame.

In production every logical source is a declared table of a database (``declared.py``), or a
table or parquet folder named in a ``{name: path}`` mapping.  Against the driver's test data each source is the
stand-in of ``fixtures.py`` derived from the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.sources.declared import DECLARED, check
from quayside.sources.fixtures import Fixtures
from quayside.sources.tables import Tables

# logical source name → stand-in builder
STAND_INS = {
    "warehouse": "fx_wh",
    "site": "fx_site",
    "wms_supplier": "fx_wms_supplier",
    "retail_store": "fx_retail_store",
    "country": "fx_country",
    "reservation": "fx_reservation",
    "reservation_event": "fx_event",
    "event_queue": "fx_event_queue",
    "reservation_content": "fx_reservation_content",
    "content_detail": "fx_content",
    "load_master": "fx_load_master",
    "journey": "fx_journey",
    "trailer_visit": "fx_visit",
    "trailer_visit_flat": "fx_visit_flat",
    "weekly_fill_rate": "fx_fill_rate",
    "facility_type": "fx_facility_type",
    "tran_log_units": "fx_tran_log",
    "tran_log_units_freight": "fx_tran_log",
    "freight_class": "fx_freight_class",
    "receiving_capacity": "fx_capacity",
    "yard_sheet": "fx_yard_sheet",
    "spot_capacity": "fx_spot_capacity",
    "shipping_load_manifest": "fx_manifest",
    "shipping_load_item": "fx_load_item",
    "po_item": "fx_po_item",
    "po": "fx_po",
    "item_activity": "fx_activity",
    "shipment_manifest": "fx_ship_manifest",
    "transport_unit": "fx_transport_unit",
    "truckload_volume": "fx_truckload",
}


class Sources:
    """``source(name)``: one DataFrame per logical source, with the declared columns (``declared.check``).

    A source is read from its entry in ``paths`` (a folder, or ``table:database.table``), else, with ``databases``, from
    the declared table of the database given for its declared one, else from the stand-ins of ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 paths: dict[str, str] | None = None, fmt: str = "parquet", databases: dict[str, str] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.paths = dict(paths or {})
        self.fmt = fmt
        self.databases = dict(databases or {})
        self.tables = Tables(spark, sf_dir) if sf_dir else None
        self._fx = Fixtures(self.tables) if self.tables else None

    def __call__(self, name: str) -> DataFrame:
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        declared = DECLARED.get(name)
        if name in self.paths:  # S1/S3: declared or external table scan
            where = self.paths[name]
            df = self.spark.table(where[len("table:"):]) if where.startswith("table:") else self.spark.read.format(self.fmt).load(where)
        elif declared is not None and declared.database in self.databases:
            df = self.spark.table(f"{self.databases[declared.database]}.{declared.table}")
        elif self._fx is None or name not in STAND_INS:
            raise KeyError(f"no path, database or stand-in for source {name!r}")
        else:
            return getattr(self._fx, STAND_INS[name])()
        if declared is not None:
            check(f"source {name}", df.schema, declared.schema())
        return df

    def names(self) -> list[str]:
        return sorted(set(STAND_INS) | set(self.paths))
