"""Fixed values that must equal the reference's for the same results.

Everything here is data (names, labels, numbers), stated once, in natural
order. Logic that uses these values lives in the functions/operators modules.
"""

# --- Fixed values: severity labels -------------------------------------------
# raw severity_3class value -> model class
SEVERITY_MAP = {"No Injury": "Low", "Injury": "Medium", "Fatal": "High"}
# model class -> severity score used by the neighbourhood average
SEVERITY_SCORE = {"Low": 0.0, "Medium": 1.0, "High": 2.0}
# model class order (probability vector order of the trained models)
CLASSES = ["High", "Low", "Medium"]
# risk rank used by route roll-up (worst class, hotspot test)
RISK_ORDER = {"Low": 0, "Medium": 1, "High": 2}

# --- Fixed values: spatial neighbourhood -------------------------------------
EARTH_RADIUS_M = 6_371_009.0
RADIUS_1KM = 1000.0
RADIUS_500M = 500.0

# --- Fixed values: feature engineering ---------------------------------------
WEATHER_MIN_SUM = 50            # keep a weather one-hot column if its sum >= 50
UNKNOWN_CATEGORY = "Unknown"    # null categorical value before one-hot
SPATIAL_COLS = [
    "nearby_crash_count_1km",
    "nearby_fatal_count_1km",
    "nearby_injury_count_1km",
    "nearby_crash_count_500m",
    "nearby_fatal_count_500m",
    "nearby_avg_severity_1km",
]
TIME_COLS = ["hour_of_day", "day_of_week", "month", "is_weekend", "is_rush_hour"]
V1_NUMERIC_COLS = ["speed_limit", "numb_vehc", "ems_hotspot_flag", "ems_ped_hotspot_flag",
                   "ems_peak_hour", "district_num", "lat", "lon"]
V1_CATEGORICAL_COLS = ["weath_cond_descr", "road_surf_cond_descr", "ambnt_light_descr",
                       "manr_coll_descr", "rdwy_jnct_type_descr", "city_town_name"]
V2_NUMERIC_COLS = ["lat", "lon", "speed_limit", "hour_of_day", "day_of_week", "month",
                   "is_weekend", "is_rush_hour"]
LIGHT_PHASES = ["Dark", "Dawn_Dusk", "Daylight"]

# rush-hour hour ranges per variant (inclusive); "serve" also excludes weekends
RUSH_HOURS = {
    "v1": [(7, 9), (16, 18)],
    "v2": [(7, 9), (16, 19)],
    "serve": [(7, 9), (16, 19)],
}
# dawn/dusk hours per variant; Daylight is 7..18 in both
DAWN_DUSK_HOURS = {"train": [6, 19], "serve": [5, 6, 19, 20]}

# --- Fixed values: thresholds and weights ------------------------------------
DEFAULT_THRESHOLDS = {"High": 0.15, "Low": 0.25, "Medium": 0.40}
MANUAL_CLASS_WEIGHTS = {"High": 8.0, "Low": 1.0, "Medium": 2.0}
THRESHOLD_GRID_START = 0.10
THRESHOLD_GRID_STEP = 0.05
THRESHOLD_GRID_SIZE = 17        # 0.10, 0.15, ..., 0.90
DEFAULT_THRESHOLD = 0.5
V3_MACRO_F1 = 0.3894            # deploy baseline: v4 must beat it

# --- Fixed values: routes ----------------------------------------------------
METERS_PER_MILE = 1609.344
MIN_ROUTE_MILES = 0.3
MIN_ROUTE_MINUTES = 2.0
# base speed by route distance: < 2 mi -> 25, < 10 mi -> 35, else 55
SPEED_TIERS = [(2.0, 25.0), (10.0, 35.0)]
SPEED_FAR = 55.0
# traffic category -> (offset from base speed, floor)
TRAFFIC_SPEED = {"SLOW": (10.0, 15.0), "TRAFFIC_JAM": (20.0, 10.0)}
LOW_VISIBILITY_M = 5000
SAFETY_WEIGHTS = {"High": 10.0, "Medium": 3.0, "duration_min": 0.1}
LOCAL_TIMEZONE = "America/New_York"

# weather service condition -> one-hot feature column
WEATHER_CONDITION_MAP = {
    "Clear": "weath_cond_descr_Clear",
    "Clouds": "weath_cond_descr_Cloudy",
    "Rain": "weath_cond_descr_Rain",
    "Drizzle": "weath_cond_descr_Rain",
    "Snow": "weath_cond_descr_Snow",
    "Fog": "weath_cond_descr_Fog__smog__smoke",
    "Mist": "weath_cond_descr_Fog__smog__smoke",
    "Haze": "weath_cond_descr_Fog__smog__smoke",
    "Smoke": "weath_cond_descr_Fog__smog__smoke",
    "Dust": "weath_cond_descr_Fog__smog__smoke",
    "Sand": "weath_cond_descr_Fog__smog__smoke",
    "Ash": "weath_cond_descr_Fog__smog__smoke",
    "Thunderstorm": "weath_cond_descr_Severe_crosswinds",
    "Squall": "weath_cond_descr_Severe_crosswinds",
    "Tornado": "weath_cond_descr_Severe_crosswinds",
}
WEATHER_FALLBACK_COL = "weath_cond_descr_Not_Reported"
# reverse-geocode neighbourhood component types, in preference order
NEIGHBOURHOOD_TYPES = ["neighborhood", "sublocality_level_1", "sublocality"]

# --- Fixed values: recommendation text ---------------------------------------
REASON_SINGLE = "Only one route available — no comparison possible."
REASON_DEFAULT_CLEAN = "Default route is already the safest: no elevated-risk hotspots detected."
TIME_SAME = "at the same travel time"
LABEL_DEFAULT = "Default route"
LABEL_ALTERNATIVE = "Alternative {i}"
ROUTE_TOO_SHORT = "Route too short for meaningful prediction"
