"""Column names and types of the model's tables, as Spark DDL."""

from __future__ import annotations

TABLES: dict[str, str] = {
    "campuses": "campus_id string, name string, identifier string",
    "buildings": "building_id string, name string, campus_id string, identifier string",
    "zones": "zone_id string, name string, building_id string, zone_type string, identifier string",
    "media_types": "media_type_id string, name string, description string, brick_meter_class string, brick_substance string",
    "meters": "meter_id string, name string, building_id string, media_type_id string, is_virtual_meter boolean, identifier string, valid_from date, valid_to date",
    "meter_relations": "parent_meter_id string, child_meter_id string, relation_type string, flow_coefficient double, valid_from date, valid_to date, derived_from string",
    "meter_measures": "meter_id string, target_kind string, target_id string, valid_from date, valid_to date",
    "databases": "database_id string, name string, kind string, identifier string",
    "devices": "device_id string, serial string, manufacturer string, identifier string",
    "sensors": "sensor_id string, meter_id string, point_type string, unit string, identifier string",
    "timeseries_refs": (
        "timeseries_id string, sensor_id string, aggregate string, reading_type string, kind string, preferred boolean, valid_from date, valid_to date, "
        "database_id string, path string, external_id string, device_id string, sources array<string>, aggregation string"
    ),
    "readings": "timeseries_id string, timestamp timestamp, value double, recorded_at timestamp",
    "annotations": (
        "annotation_id string, target_kind string, target_id string, category string, valid_from date, valid_to date, description string, "
        "related_refs array<string>, media string, is_resolved boolean"
    ),
}

#: What an empty or missing cell stands for.
DEFAULTS: dict[str, dict[str, object]] = {
    "meters": {"is_virtual_meter": False},
    "sensors": {"point_type": "Energy_Sensor", "unit": "KiloW-HR"},
    "timeseries_refs": {"preferred": True},
    "annotations": {"description": "", "is_resolved": True},
}
