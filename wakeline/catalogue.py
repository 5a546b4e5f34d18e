"""Fixed values of the domain: names, thresholds and dimension rows that results must agree on."""

from __future__ import annotations

# Stream field names, in wire order.
TELEMETRY_STRINGS = ("timestamp", "mission_id", "ship_id")
TELEMETRY_NUMBERS = (
    "coord_x",
    "coord_y",
    "coord_z",
    "fuel_prc",
    "motor_temp_c",
    "engine_pressure_kpa",
    "power_core_temp_c",
    "navigation_signal_db",
    "distance_from_hocotate_km",
)
TELEMETRY_STATES = ("status", "mission_status")
ORIGIN_DISTANCE = "distance_from_hocotate_km"

# Mission and tick states.
RUNNING, SUCCESS, FAILURE = "RUNNING", "SUCCESS", "FAILURE"
OK, REPAIR = "OK", "REPAIR"
MISSION_STATES = (RUNNING, SUCCESS, FAILURE)
TICK_STATES = (OK, REPAIR, FAILURE)
TERMINAL_STATES = (SUCCESS, FAILURE)
UNKNOWN = "UNKNOWN"
INGESTED = "INGESTED"

# Subsystem -> (field, centre and half-width of the triangular score, lowest and highest working value).
SUBSYSTEMS = {
    "motor": ("motor_temp_c", 90.0, 30.0, 180.0),
    "engine": ("engine_pressure_kpa", 325.0, 100.0, 600.0),
    "core": ("power_core_temp_c", 600.0, 300.0, 950.0),
}
FUEL_FIELD, FUEL_BROKEN_AT = "fuel_prc", 5.0
HEALTH_WEIGHTS = {"motor": 0.3, "engine": 0.3, "core": 0.3, "fuel": 0.1}
REPAIR_CAP, MALFUNCTION_CAP = 0.4, 0.3
CONDITION_STEPS = ((0.8, "GOOD"), (0.5, "MID"), (0.3, "BAD"))
LOWEST_CONDITION = "CRITICAL"

# Gauge name, help text, telemetry field.
GAUGES = (
    ("ship_fuel_percent", "Current fuel percentage", "fuel_prc"),
    ("ship_coord_x", "Ship X coordinate", "coord_x"),
    ("ship_coord_y", "Ship Y coordinate", "coord_y"),
    ("ship_coord_z", "Ship Z coordinate", "coord_z"),
    ("ship_motor_temp_c", "Motor temperature (C)", "motor_temp_c"),
    ("ship_engine_pressure_kpa", "Engine pressure (kPa)", "engine_pressure_kpa"),
    ("ship_power_core_temp_c", "Power core temperature (C)", "power_core_temp_c"),
    ("ship_navigation_signal_db", "Navigation signal (dB)", "navigation_signal_db"),
    ("ship_distance_km", "Distance from Hocotate (km)", "distance_from_hocotate_km"),
)
# Flag gauge name, help text, telemetry field, value that sets the flag.
FLAG_GAUGES = (
    ("ship_repair_flag", "1 if ship under repair, else 0", "status", "REPAIR"),
    ("ship_mission_success", "1 if mission success, 0 otherwise", "mission_status", "SUCCESS"),
    ("ship_mission_failure", "1 if mission failed, 0 otherwise", "mission_status", "FAILURE"),
)

# Radar marker per status.
STATUS_COLOURS = {"REPAIR": "#ff3333", "FAILURE": "#888888"}
DEFAULT_COLOUR = "#ffaa00"
STATUS_MARKERS = {"OK": "yellow", "REPAIR": "red", "FAILURE": "black"}
DEFAULT_MARKER = "blue"

# Cruise speed per axis (km/s), relative tolerance of the arrival test, reporting year shift.
CRUISE_SPEED = 2.4e6
ARRIVAL_RTOL = 1e-5
YEAR_SHIFT = 1000

# Destination, x, y, z in km.
PLANETS = (
    ("Hocotate", 0.0, 0.0, 0.0),
    ("PNF-404", 0.7e8, -1.3e8, -1.5e8),
    ("Karut", 1.2e8, 0.8e8, 0.1e8),
    ("Giya", -1.5e8, 0.3e8, -0.6e8),
    ("Nijo", 0.7e8, -1.1e8, 0.2e8),
    ("Sozor", -0.9e8, -0.6e8, 0.5e8),
    ("Koppai", 6.8e8, 2.1e8, -1.2e8),
    ("Ohri", 5.2e8, -2.4e8, 2.9e8),
    ("Moyama", -6.1e8, 3.5e8, 0.9e8),
    ("Flukuey", 4.0e8, -3.8e8, -1.0e8),
    ("Enohay", 3.3e8, 1.9e8, 2.2e8),
    ("Mihama", -3.7e8, -1.6e8, 2.6e8),
    ("Ooji", 7.5e8, 0.0e8, 0.8e8),
    ("Ogura", -5.5e8, 2.2e8, -2.3e8),
    ("Conohan", 9.4e8, -4.1e8, 1.6e8),
    ("Ocobo", -1.0e9, 3.8e8, -1.9e8),
    ("Tagwa", 1.12e9, 1.1e8, -3.4e8),
    ("Enohee", -1.25e9, -0.2e9, 2.7e8),
    ("Neechki", 1.35e9, -3.0e8, 0.0e8),
    ("Koodgio", -1.10e9, 4.5e8, 3.2e8),
    ("Maxima", 1.45e9, 0.0e8, 4.0e8),
)

# Cargo item and price.
CARGO_ITEMS = (
    ("Sunseed Berry", 170),
    ("Anxious Sprout", 80),
    ("Flame of Tomorrow", 100),
    ("Professional Noisemaker", 280),
    ("Dream Architect", 1000),
    ("Conifer Spire", 130),
    ("Crystal King", 1200),
    ("Lustrous Element", 150),
    ("Remembered Old Buddy", 230),
    ("Stone of Glory", 300),
    ("Pileated Snagret Beak", 450),
    ("Spiny Alien Trap", 220),
    ("Essence of Despair", 90),
    ("Mirrored Stage", 320),
    ("Infernal Vegetation", 70),
    ("Paradoxical Enigma", 650),
    ("Aluminum Crates", 50),
    ("Processed Fuel Cells", 110),
    ("Frozen Food Containers", 75),
    ("Industrial Lubricants", 95),
    ("Consumer Electronics Pallet", 180),
    ("Agricultural Seeds", 60),
    ("Machinery Parts", 140),
)
