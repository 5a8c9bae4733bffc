"""Fixed column lists, thresholds and tiers of the hazard tables."""

from __future__ import annotations

#: Wind-radius thresholds of track messages in m/s, and the knots they stand for.
RADIUS_KNOTS = {18: 34, 26: 50, 33: 64}
QUADRANTS = {1: "ne", 2: "se", 3: "sw", 4: "nw"}
RADIUS_COLUMNS = [f"radius_{kt}_knot_winds_{q}_km" for kt in RADIUS_KNOTS.values() for q in QUADRANTS.values()]
POLYGON_COLUMNS = [f"wind_field_polygon_{kt}kt" for kt in RADIUS_KNOTS.values()]

#: The columns of raw track rows that a transform needs, and those of wind radii, which files may lack.
RAW_REQUIRED = ["storm_id", "ensemble_member", "step", "datetime", "latitude", "longitude", "pressure", "wlatitude", "wlongitude", "wind"]
RAW_RADII = ["wind_threshold", "quadrant", "wind_radius"]
RAW_SCHEMA = (
    "storm_id string, storm_identifier string, long_storm_name string, ensemble_member int, step int, datetime timestamp_ntz, latitude double, longitude double, "
    "pressure double, wlatitude double, wlongitude double, wind double, wind_threshold int, quadrant int, bearing_start double, bearing_end double, wind_radius double"
)
#: The columns of standard tracks, in order.
TRACK_SCHEMA = (
    "forecast_time timestamp_ntz, track_id string, storm_identifier string, long_storm_name string, ensemble_member int, valid_time timestamp_ntz, lead_time int, "
    "latitude double, longitude double, pressure_hpa double, wind_speed_knots double, radius_of_maximum_winds_km double, "
    + ", ".join(f"{c} double" for c in RADIUS_COLUMNS) + ", " + ", ".join(f"{c} string" for c in POLYGON_COLUMNS)
)
TRACK_COLUMNS = [x.split()[0] for x in TRACK_SCHEMA.split(", ")]

#: Envelope thresholds, name in knots and value in m/s, and the gust names (m/s) of the same values.
WIND_THRESHOLDS = {34: 17.49, 40: 20.58, 50: 25.72, 64: 32.92, 83: 42.70, 96: 49.39, 113: 58.12, 137: 70.48}
GUST_THRESHOLDS = {17: 17.49, 21: 20.58, 26: 25.72, 33: 32.92, 43: 42.70, 49: 49.39, 58: 58.12, 70: 70.48}

#: River return periods: the tier whose flood map each uses.
TIER_SOURCE = {2: 10, 5: 10, 10: 10, 20: 20, 50: 50, 100: 100}
STEPS_H = [24, 48, 72, 96, 120, 144, 168]
MEMBERS = 51
CELL_DEG = 0.05
MISSING = 1e100
