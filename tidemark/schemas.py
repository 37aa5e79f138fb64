"""Explicit schemas of everything that is read from outside."""

FACILITY_RESPONSE = (
    "data array<struct<code string, name string, location struct<lat double, lng double>>>"
)

# A point is [time, value]; times and values come as numbers or as text.
SERIES_RESPONSE = "data array<struct<results array<struct<name string, data array<array<string>>>>>>"

FACILITY_CSV = "facility_code string, facility_name string, lat double, lng double"

MEASURES_CSV = (
    "ts timestamp, power_value double, emission_value double, facility_code string, "
    "price_per_mwh double, demand_mw double"
)

# Everything stays text here, so that a field of another type spoils only itself;
# what is a number is decided when it is read.
MESSAGE = (
    "seq string, facility_code string, facility_name string, timestamp string, state string, "
    "fuel_list string, power_value string, emission_value string, price_per_mwh string, "
    "demand_mw string, lat string, lng string, unit string, "
    "sent_mono_ns string, slot_mono_ns string"
)

METRICS = ("power_value", "emission_value", "price_per_mwh", "demand_mw")
FILLED = ("power_value", "emission_value")

# Place of a metric in a response, its column, and its unit.
METRIC_POSITION = {"power": 0, "emissions": 1, "price": 0, "demand": 1}
METRIC_COLUMN = {
    "power": "power_value",
    "emissions": "emission_value",
    "price": "price_per_mwh",
    "demand": "demand_mw",
}
METRIC_UNIT = {"power_value": "MW", "emission_value": "tCO2e"}
