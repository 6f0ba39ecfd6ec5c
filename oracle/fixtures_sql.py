"""DuckDB text of the stand-in sources (FIXTURES.md part B), for the oracle.

Independent of the Spark code on purpose: the oracle recomputes every
stand-in and every model from the driver's parquet views with its own SQL.
Placeholders in braces are replaced by ``oracle.sql.render``.
"""

FIXTURES = {
    "fx_country": """
SELECT cast(n_nationkey AS BIGINT) AS country_id, n_name AS country_long FROM nation""",
    "fx_wh": """
SELECT s_suppkey AS wms_wh_id, lpad(cast(s_suppkey AS VARCHAR), 2, '0') AS wh_id, s_suppkey * 100 AS sva_id,
       s_name AS name, cast(n_regionkey AS BIGINT) AS sty_id, cast(n_regionkey AS BIGINT) - 2 AS hours_offset,
       n_name AS city,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE substring(n_name, 1, 2) END AS state,
       CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE lpad(cast((s_suppkey * 37) % 100000 AS VARCHAR), 5, '0') END AS zip,
       n_name AS country_name, s_acctbal > 0 AS is_active
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "fx_site": """
SELECT s_suppkey AS WarehouseID, s_suppkey % 4 AS CampusID FROM supplier WHERE s_suppkey % 7 <> 0""",
    "fx_wms_supplier": """
SELECT s_suppkey AS wswhid, 1000 + s_suppkey AS WSSuID,
       CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey % 2 = 0 END AS WsIsBreakBulkFacility,
       CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal > 0 END AS WSIsActive,
       s_suppkey % 2 = 0 AS WSIsFulfillmentcenter
FROM supplier""",
    "fx_retail_store": """
SELECT s_suppkey AS WarehouseID, CASE WHEN s_suppkey % 8 = 0 THEN 1 ELSE 0 END AS IsActive
FROM supplier WHERE s_suppkey % 4 = 0""",
    "fx_reservation": """
SELECT o_orderkey AS ReservationID, o_custkey % 10 AS WarehouseID,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'SPDomesticInbound' WHEN '2-HIGH' THEN 'MainReceiving'
            WHEN '3-MEDIUM' THEN 'SPCGFInbound' WHEN '4-NOT SPECIFIED' THEN 'VAS' ELSE 'OutboundDock' END AS subwarehouse,
       o_custkey AS CarrierID,
       concat(CASE WHEN o_custkey % 2 = 0 THEN 'TR-' ELSE '' END, cast(o_custkey AS VARCHAR)) AS TrailerNumber,
       o_custkey % 7 AS siteID,
       (CASE WHEN o_orderkey % 40 = 7 THEN TIMESTAMP '1998-06-14' + (o_custkey % 7) * INTERVAL '1' DAY ELSE o_orderdate END) AS ScheduledStartDate, o_orderstatus <> 'P' AS IsInbound, o_custkey % 13 = 0 AS IsTerminated
FROM orders""",
    "fx_event": """
SELECT event_id AS EventQueueID, user_id AS ReservationID,
       CASE event_type WHEN 'click' THEN 28 WHEN 'view' THEN 29 ELSE 30 END AS ActionID,
       (CASE WHEN o_orderkey % 40 = 7 THEN TIMESTAMP '1998-06-14' + (o_custkey % 7) * INTERVAL '1' DAY ELSE o_orderdate END) + to_seconds(date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) // 10) AS EventDate,
       (CASE WHEN o_orderkey % 40 = 7 THEN TIMESTAMP '1998-06-14' + (o_custkey % 7) * INTERVAL '1' DAY ELSE o_orderdate END) + to_seconds(date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) // 10) AS CreatedDate,
       props AS EventDetail
FROM events JOIN orders ON user_id = o_orderkey""",
    "fx_event_queue": """
SELECT event_id AS ID FROM events""",
    "fx_content": """
SELECT l_orderkey * 2 + CASE WHEN l_partkey % 10 = 7 THEN 1 ELSE 0 END AS ContentRefID, l_orderkey AS ReservationID,
       CASE WHEN l_orderkey % 53 = 0 AND l_partkey % 3 = 0 THEN CASE WHEN l_linenumber = 1 THEN 400::BIGINT ELSE 0::BIGINT END
            ELSE cast(l_quantity AS BIGINT) END AS Qty, 1 + l_partkey % 3 AS ContentType, l_returnflag = 'R' AS IsContentRefDetailDeleted,
       concat(CASE WHEN l_suppkey % 10 = 0 THEN 'M' ELSE '' END, cast(l_partkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR)) AS spoid,
       l_partkey * 10 AS SpiID, concat('BOL', cast(l_orderkey AS VARCHAR)) AS BolNumber
FROM lineitem""",
    "fx_reservation_content": """
SELECT o_orderkey AS ReservationID, o_orderkey * 2 AS ContentRefID FROM orders WHERE o_orderkey % 15 <> 0
UNION ALL
SELECT o_orderkey, o_orderkey * 2 + 1 FROM orders WHERE o_orderkey % 15 <> 0 AND o_orderkey % 5 = 0""",
    "fx_load_master": """
SELECT o_orderkey AS load_id, CASE WHEN o_orderkey % 3 = 0 THEN concat('BOL', cast(o_orderkey AS VARCHAR)) END AS reference_number,
       cast(o_custkey AS VARCHAR) AS trailer_number,
       (CASE WHEN o_orderkey % 40 = 7 THEN TIMESTAMP '1998-06-14' + (o_custkey % 7) * INTERVAL '1' DAY ELSE o_orderdate END) + (o_orderkey % 5 - 2) * INTERVAL '1' DAY AS actual_ship_date
FROM orders WHERE o_orderkey % 2 = 0""",
    "fx_journey": """
SELECT o_orderkey AS loadId,
       CASE WHEN o_orderkey % 5 <> 0 THEN (CASE WHEN o_orderkey % 40 = 7 THEN TIMESTAMP '1998-06-14' + (o_custkey % 7) * INTERVAL '1' DAY ELSE o_orderdate END) + 30 * INTERVAL '1' HOUR END AS shipperGateOutTimestamp
FROM orders WHERE o_orderkey % 2 = 0""",
    "fx_visit_flat": """
SELECT o_orderkey AS trailer_visit_id, o_orderkey AS res_id,
       CASE WHEN o_orderkey % 11 <> 0 THEN d + ((o_custkey*7+o_orderkey) % 97 - 36) * INTERVAL '1' HOUR END AS arrival,
       CASE WHEN o_orderkey % 3 <> 0 THEN d + ((o_custkey*7+o_orderkey) % 97 - 36 + o_orderkey % 400) * INTERVAL '1' HOUR END AS unload_complete,
       CASE WHEN o_orderkey % 4 <> 0 THEN d + ((o_custkey*7+o_orderkey) % 97 - 36 + o_orderkey % 700) * INTERVAL '1' HOUR END AS depart
FROM (SELECT *, (CASE WHEN o_orderkey % 40 = 7 THEN TIMESTAMP '1998-06-14' + (o_custkey % 7) * INTERVAL '1' DAY ELSE o_orderdate END) AS d FROM orders)""",
    # arrays of one element, empty where the value is NULL, and some of three
    "fx_visit": """
SELECT o_orderkey AS trailer_visit_id, d AS event_created_timestamp,
       [o_custkey % 7] AS site_id,
       [concat('Site-', cast(o_custkey % 7 AS VARCHAR))] AS site,
       [o_custkey] AS trailer_id,
       [concat(CASE WHEN o_custkey % 2 = 0 THEN 'TR-' ELSE '' END, cast(o_custkey AS VARCHAR))] AS trailer_number,
       CASE WHEN o_orderkey % 8 = 5 THEN [o_orderstatus, 'Q', NULL] ELSE [o_orderstatus] END AS trailer_status,
       [o_orderpriority] AS trailer_type,
       [o_custkey % 4] AS campus_id,
       [concat('Campus-', cast(o_custkey % 4 AS VARCHAR))] AS campus,
       CASE WHEN o_orderkey % 4 = 1 THEN [o_orderkey % 100, o_orderkey % 100 + 100, o_orderkey % 100 + 200] ELSE [o_orderkey % 100] END AS spot_id,
       [o_orderkey % 3] AS spot_type_id,
       [CASE o_orderkey % 3 WHEN 0 THEN 'Door' WHEN 1 THEN 'Yard' ELSE 'Offsite' END] AS spot_type,
       [o_orderkey % 3 = 2] AS is_spot_offsite,
       [o_orderkey % 17 = 0] AS is_trailer_lost,
       [o_orderkey] AS trailer_reservation_id,
       CASE WHEN o_orderkey % 64 = 33 THEN [o_orderkey - 1, o_orderkey - 33, o_orderkey]
            WHEN o_orderkey % 4 = 1 THEN [o_orderkey - 1] ELSE []::BIGINT[] END AS trailer_unload_reservation_id,
       CASE WHEN o_orderkey % 23 <> 0 THEN [o_custkey % 10] ELSE []::BIGINT[] END AS facility_id,
       CASE WHEN o_orderkey % 11 <> 0 THEN [d + ((o_custkey*7+o_orderkey) % 97 - 36) * INTERVAL '1' HOUR] ELSE []::TIMESTAMP[] END AS trailer_arrival_date,
       CASE WHEN o_orderkey % 3 <> 0 THEN [d + ((o_custkey*7+o_orderkey) % 97 - 36 + o_orderkey % 400) * INTERVAL '1' HOUR] ELSE []::TIMESTAMP[] END AS trailer_unload_complete_date,
       CASE WHEN o_orderkey % 6 <> 0 THEN [d + INTERVAL '2' HOUR] ELSE []::TIMESTAMP[] END AS trailer_load_complete_date,
       CASE WHEN o_orderkey % 4 <> 0 THEN [d + ((o_custkey*7+o_orderkey) % 97 - 36 + o_orderkey % 700) * INTERVAL '1' HOUR] ELSE []::TIMESTAMP[] END AS trailer_depart_date,
       CASE WHEN o_custkey % 13 = 0 THEN [d] ELSE []::TIMESTAMP[] END AS trailer_reservation_cancelled_date
FROM (SELECT *, (CASE WHEN o_orderkey % 40 = 7 THEN TIMESTAMP '1998-06-14' + (o_custkey % 7) * INTERVAL '1' DAY ELSE o_orderdate END) AS d FROM orders)""",
    "fx_fill_rate": """
SELECT cast(l_suppkey % 10 AS VARCHAR) AS whid, CASE WHEN l_quantity < 25 THEN 'SP' ELSE 'LP' END AS shipclass,
       l_shipdate AS cptdatetime,
       CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS ShippedOnTime,
       CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE 0 END AS performanceexclusions,
       CASE WHEN l_partkey % 5 = 0 THEN 'Other' ELSE 'Standard' END AS OrderType_Performance
FROM lineitem""",
    "fx_facility_type": """
SELECT cast(s_suppkey AS VARCHAR) AS wh_id, CASE WHEN s_suppkey % 2 = 0 THEN 'MM' ELSE 'FC' END AS FacilityType
FROM supplier""",
    "fx_tran_log": """
SELECT l_suppkey % 10 AS warehouse_id, l_shipdate AS log_datetime_local, cast(l_quantity AS BIGINT) AS inbound_receiving_units,
       l_partkey % 3 AS freight_class_id,
       CASE WHEN l_linenumber % 2 = 1 THEN cast(l_quantity AS BIGINT) ELSE 0 END AS bulk_pick_units,
       CASE WHEN l_linenumber % 2 = 0 THEN cast(l_quantity AS BIGINT) ELSE 0 END AS bins_pick_units
FROM lineitem""",
    "fx_freight_class": """
SELECT * FROM (VALUES (0::BIGINT, '1'), (1::BIGINT, '2'), (2::BIGINT, NULL::VARCHAR)) AS t(freight_class_id, freight_class_number)""",
    "fx_capacity": """
SELECT w.s_suppkey AS warehouse_id, d.day AS day_of_unit_capacity,
       CASE WHEN k.lag = 28 THEN DATE '2001-12-31' ELSE cast(d.day - k.lag * INTERVAL '1' DAY AS DATE) END AS upload_date,
       20 + (w.s_suppkey * 7 + k.lag) % 50 AS inbound_unit_capacity
FROM supplier w CROSS JOIN (SELECT DISTINCT cast(o_orderdate AS DATE) AS day FROM orders) d
CROSS JOIN (VALUES (0), (7), (14), (21), (28)) AS k(lag)
WHERE w.s_suppkey BETWEEN 0 AND 9""",
    "fx_yard_sheet": """
SELECT o_orderkey AS External_Reference,
       CASE o_custkey % 6 WHEN 0 THEN 'Hebron DC' WHEN 1 THEN 'Perris DC' WHEN 2 THEN 'Erlanger DC' WHEN 3 THEN 'FC 13'
            WHEN 4 THEN 'South Elgin DC' ELSE 'Unmapped DC' END AS WarehouseName,
       cast(o_orderdate + k.lag * INTERVAL '1' DAY AS DATE) AS upload_date
FROM orders CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11),(12),(13),(13)) AS k(lag)""",
    "fx_spot_capacity": """
SELECT f.fcid + 40 * w.block AS FCID, w.Week, 100 + f.fcid + 40 * w.block AS Yard_Capacity
FROM (VALUES (5::BIGINT),(9::BIGINT),(10::BIGINT),(13::BIGINT),(30::BIGINT)) AS f(fcid)
CROSS JOIN (SELECT cast(DATE '1995-01-01' + (o_orderkey % 362) * 7 * INTERVAL '1' DAY AS DATE) AS Week, o_orderkey // 362 AS block FROM orders) w""",
    "fx_manifest": """
SELECT p_partkey AS SlmTruckID, p_partkey * 10 AS slmID FROM part""",
    "fx_load_item": """
SELECT p_partkey * 10 AS SliSlmID, p_partkey AS SliSpiID FROM part""",
    "fx_po_item": """
SELECT p_partkey AS SpiID, p_partkey % 50 AS SpiSpoID, p_partkey % 20 AS SpiSprID,
       CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE cast(p_size AS BIGINT) END AS SpiQty,
       cast(p_size AS BIGINT) - cast(p_size AS BIGINT) % 3 AS SpiReceivedQty
FROM part""",
    "fx_po": """
SELECT p_partkey AS SpoId, p_partkey - p_partkey % 2 AS SpoParentSpoId, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 3 END AS SpoType
FROM part""",
    "fx_activity": """
SELECT p_partkey AS SprID, CASE p_partkey % 3 WHEN 0 THEN 63 WHEN 1 THEN 6 ELSE 1 END AS ActivityCode FROM part""",
    "fx_ship_manifest": """
SELECT p_partkey AS truck_id, concat('BL', cast(p_partkey % 40 + 40 * (p_partkey // 2000) AS VARCHAR)) AS bill_of_lading_number FROM part""",
    "fx_transport_unit": """
SELECT p_partkey AS transport_unit_id, concat('BL', cast(p_partkey % 40 + 40 * (p_partkey // 2000) AS VARCHAR)) AS bill_of_lading_number,
       CASE WHEN p_partkey % 4 <> 0 THEN TIMESTAMP '1998-06-10 00:00:00' END AS shipment_destination_unloaded_date,
       CASE WHEN p_partkey % 5 = 0 THEN 'Store' ELSE 'Warehouse' END AS shipment_destination_entity_type
FROM part""",
    "fx_truckload": """
SELECT p_partkey AS truck_id, CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE cast(p_size AS BIGINT) END AS loaded_carton_count,
       cast(p_size AS BIGINT) + 5 AS total_cartons
FROM part""",
}
