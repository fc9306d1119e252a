"""Fixed values that results depend on.

These must equal the values the curated pipeline uses, so they are stated
plainly here, together, in their natural order. Every operator takes them as
keyword defaults, so a caller can override any of them.
"""

# --- fixed values: categories and years -----------------------------------
CATEGORIES = ["CRASH", "COMMVEH", "CYCLE", "FLAG", "PERSON", "ROADWAY", "TRAILVEH", "VEHICLE"]
START_YEAR = 2005
END_YEAR = 2024

# --- fixed values: geography -----------------------------------------------
BOUNDS = {"lat_min": 39.867, "lat_max": 40.138, "lon_min": -75.280, "lon_max": -74.956}
# boundary polygon as (lon, lat) vertices, closed
BOUNDARY = [(-75.280, 39.867), (-75.280, 40.138), (-74.956, 40.138), (-74.956, 39.867), (-75.280, 39.867)]
SRID = 4326
HOME_COUNTY = 51          # county code the geographic stage expects
MISCODED_COUNTY = 67      # county code of the known whole-table miscoding
COORD_DECIMALS = 6
LAT_COL, LON_COL = "DEC_LATITUDE", "DEC_LONGITUDE"
FLAG_INVALID = "INVALID"
FLAG_OUTSIDE = "OUTSIDE_PHILLY"
FLAG_COUNTY = "NON_PHILLY_COUNTY"

# --- fixed values: weather --------------------------------------------------
WEATHER_NAMES = {
    "TMAX": "temp_max_c",
    "TMIN": "temp_min_c",
    "TAVG": "temp_avg_c",
    "PRCP": "precipitation_mm",
    "AWND": "wind_speed_avg_ms",
    "WSF2": "wind_speed_max_ms",
    "SNOW": "snowfall_mm",
    "SNWD": "snow_depth_mm",
}
TEMPERATURE_COLUMNS = ["temp_max_c", "temp_min_c", "temp_avg_c"]
TEMPERATURE_SCALE = 10.0
# right-closed bins: value <= edge gets the label; above the last edge, the last label
PRECIP_BINS = [(0.1, "none"), (2.5, "light"), (10.0, "moderate")]
PRECIP_TOP = "heavy"
TEMP_BINS = [(0.0, "cold"), (10.0, "cool"), (20.0, "mild"), (30.0, "warm")]
TEMP_TOP = "hot"
ADVERSE_PRECIP_MM = 2.5
ADVERSE_WIND_MS = 15.0
ADVERSE_SNOW_MM = 0.0
EXTREME_COLD_C = -5.0
EXTREME_HOT_C = 35.0

# --- fixed values: dates ----------------------------------------------------
FALLBACK_DAY = 15
METHOD_EXACT = "exact_day"
METHOD_WEEKDAY = "weekday_reconstructed"
METHOD_FALLBACK = "mid_month_fallback"
METHOD_MID_ONLY = "mid_month_only"

# --- fixed values: persons, helmets -----------------------------------------
CYCLIST_TYPES = ["PEDALCYCLIST", "BICYCLIST"]
PEDESTRIAN_TYPE = "PEDESTRIAN"
HELMET_VALID = ["Y", "N", "U"]
HELMET_UNKNOWN = "U"

# --- fixed values: profiling ------------------------------------------------
TOP_VALUES_MAX_DISTINCT = 20   # top values only when distinct count is below this
TOP_VALUES_N = 10
# tokens a pandas CSV reader turns into missing values
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
