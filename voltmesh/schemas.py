"""Schemas of raw elements and of the tables that the plans exchange."""

from __future__ import annotations

from voltmesh.functions.geometry import LINE, POINT, POLYGON

ELEMENT = f"type string, id bigint, tags map<string,string>, geometry {LINE}, lat double, lon double, members array<struct<type:string,ref:bigint,role:string,geometry:{LINE}>>"
PAYLOAD = f"elements array<struct<{', '.join(':'.join(x.split(' ', 1)) for x in ELEMENT.split(', '))}>>"

SUBSTATIONS = f"bus_id string, voltage int, country string, under_construction boolean, start_date date, contains string, geometry {POINT}"
SUBSTATION_POLYGONS = f"bus_id string, voltage int, geometry {POLYGON}"
LINES = f"line_id string, circuits int, voltage int, underground boolean, under_construction boolean, start_date date, contains array<string>, geometry {LINE}"

BUSES_OUT = f"bus_id string, station_id string, voltage_kv int, osm_ids string, geometry {POINT}"
LINES_OUT = f"line_id string, bus0 string, bus1 string, voltage_kv int, circuits int, length_m double, underground boolean, osm_ids string, geometry {LINE}"
TRANSFORMERS_OUT = f"transformer_id string, station_id string, bus0 string, bus1 string, voltage_bus0_kv int, voltage_bus1_kv int, geometry {LINE}"
STATIONS_POLYGON_OUT = f"station_id string, geometry {POLYGON}"
BUSES_POLYGON_OUT = f"bus_id string, geometry {POLYGON}"
