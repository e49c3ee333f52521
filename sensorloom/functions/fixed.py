"""Windows, thresholds, word lists and feature lists.

Everything here must equal the published pipeline for results to agree.
"""

# --- fixed values: time windows (minutes) ---------------------------------
PRE_ASOF_MIN = 15
POST_MIN = 180
MIN_POST_READINGS = 5
PRE_SHORT_MIN = 30
PRE_LONG_MIN = 60
PRE_FALLBACK_MIN = 90
TWO_HOUR_LO_MIN = 110
TWO_HOUR_HI_MIN = 130
ACTIVITY_HOURS = 24
ACTIVITY_MULTI_HOURS = (2, 6, 48)
ROLL_MEALS_DAYS = 30
ROLL_MEALS_MIN = 3
ROLL_READINGS_DAYS = 14
ROLL_READINGS_MIN = 10
SLICE_PRE_MIN = 90
SLICE_POST_MIN = 240

# --- fixed values: time texts beside the ISO forms, in the order they are tried ---
TIME_FORMATS = (
    "yyyy/M/d[ H:mm[:ss]]", "yyyyMMdd'T'HHmmss", "yyyyMMdd", "yyyy-MM-dd hh:mm[:ss] a", "M/d/yyyy[ H:mm[:ss]]",
    "d/M/yyyy[ H:mm[:ss]]", "MMMM d[,] yyyy[ H:mm[:ss]]", "d MMMM yyyy[ H:mm[:ss]]",
)

# --- fixed values: levels ----------------------------------------------------
VALUE_LO, VALUE_HI = 40.0, 400.0
TARGET_LO, TARGET_HI = 70.0, 140.0
HIGH_PEAK = 160.0
RECOVERY_MARGIN = 5.0
SINCE_DATE = "2020-01-01"
ITEM_LIMITS = {"calories": 3000.0, "protein": 150.0, "fat": 200.0, "carbs": 500.0, "amount": 2000.0}
ACTIVITY_LIMIT = 300.0
MORNING_BANDS = {"resting_hr": (30.0, 120.0), "glucose_basal": (40.0, 300.0)}
MORNING_LIMITS = {"sleep_time": 840.0, "hr_variability": 300.0}
ITEM_NON_NEGATIVE = ("protein", "fat", "carbs", "calories")
QUALITY_MIN = {"readings": 500, "meals": 20, "sport": 5, "questionnaire": 5}
FAST_BELOW, LATE_ABOVE = 45.0, 75.0
WEIGHT_LO, WEIGHT_HI = 0.5, 3.0
ERROR_THRESHOLDS = (1, 2, 3, 4, 5, 7, 10, 12, 15, 20, 25, 30, 40, 50)
CUTOFFS = (0.30, 0.35, 0.40, 0.45, 0.50)
# (low, high, label), low included, high excluded
BIAS_RANGES = (
    (0.0, 100.0, "<100"),
    (100.0, 120.0, "100-120"),
    (120.0, 140.0, "120-140"),
    (140.0, 160.0, "140-160"),
    (160.0, 200.0, "160-200"),
    (200.0, 999.0, ">200"),
)

# --- fixed values: activity names (alias -> name) ----------------------------
ACTIVITY_ALIASES = {
    "Running": ["Running", "Run", "Correr", "Correr al aire libre"],
    "Trail Running": ["Trail running", "Trail Running"],
    "Cycling": ["Ride", "Cycling", "Ciclismo", "Ciclismo al aire libre"],
    "Cycling_Indoor": ["VirtualRide", "Bicicleta estática"],
    "Walking": ["Walking", "Walk", "Caminar", "Caminar al aire libre"],
    "Hiking": ["Hike", "Hiking", "Senderismo"],
    "Swimming": ["Swim", "Swimming", "Natación"],
    "Strength": ["WeightTraining", "Strength_training", "Entrenamiento de fuerza"],
    "Workout": ["Workout", "Entrenamiento funcional"],
    "CrossFit": ["CrossFit", "Crossfit"],
    "Soccer": ["Soccer", "Fútbol"],
    "Tennis": ["Tennis", "Tenis"],
    "Skiing": ["Skiing", "Esquí", "AlpineSki"],
    "Nordic_Ski": ["NordicSki"],
    "Elliptical": ["Elliptical", "Elíptica"],
    "Climbing": ["RockClimbing", "Escalada"],
    "EBike": ["EBikeRide"],
}
ACTIVITY_INTENSITY = {
    "high": ["Running", "Trail Running", "CrossFit", "Swimming", "Soccer", "Rowing"],
    "moderate": [
        "Cycling", "Cycling_Indoor", "Hiking", "Strength", "Workout", "Tennis", "Padel",
        "Climbing", "Elliptical", "Surf", "Skiing", "Nordic_Ski",
    ],
    "low": ["Walking", "Yoga", "Pilates", "Stretching", "EBike"],
}
INTENSITY_DEFAULT = "moderate"
INTENSITY_SCORE = {"none": 0.0, "low": 1.0, "moderate": 2.0, "high": 3.0}

# --- fixed values: words that read as a set flag ------------------------------
FLAG_WORDS = ("si", "sí", "true", "1", "1.0")

# --- fixed values: names of groups and bands ---------------------------------
NUTRITION_CLUSTER_NAMES = ("Bajo registro", "Moderado", "Alto registro")
RESPONSE_CLUSTER_NAMES = ("Reactivo-Alto", "Estable")
# upper bound excluded
RESPONSE_BANDS = ((140.0, "Normal"), (180.0, "Elevado"))
RESPONSE_BAND_ELSE = "Muy elevado"
TTP_MINUTES = {"late": 90, "fast": 35, "uncertain": 60}
MEAL_PERIOD_HOURS = {"Desayuno": 8, "Media mañana": 11, "Almuerzo": 14, "Merienda": 17, "Cena": 21}
MEAL_PERIOD_CODES = {"Desayuno": 0, "Media mañana": 3, "Almuerzo": 2, "Merienda": 5, "Cena": 1}
MEAL_TYPE_CODES = {"Desayuno": 3, "Media mañana": 2, "Almuerzo": 2, "Merienda": 5, "Cena": 1}

# --- fixed values: scoring requests (request column -> feature column), energy per gram, minutes of the windows ---
REQUEST_COLUMNS = {
    "carbs": "total_carbs", "fat": "total_fat", "protein": "total_protein", "fibre": "total_fibre",
    "avg_sat_fat": "avg_saturated_fat", "sport_2h": "sport_2h_duration", "sport_6h": "sport_6h_duration",
    "sport_intensity": "sport_intensity_score",
}
ENERGY = {"protein": 4.0, "fat": 9.0, "carbs": 4.0}
SLOPE_MINUTES = {"best": 60, "30m": 30, "90m": 90}
SPREADS = ("cgm_std_30m", "cgm_std_90m")
# a feature without a median: its value, or first the median of another feature
STAND_INS = {
    "cgm_slope_best": 0.007, "cgm_delta_best": 0.0, "cgm_slope_90m": 0.007, "cgm_delta_90m": 0.0,
    "cgm_std_30m": 2.5, "cgm_std_90m": 2.5, "sport_intensity_score": 2.0, "n_readings_pre_60m": 12.0,
    "hour_of_day": 14.0, "day_of_week": 3.0, "is_weekend": 0.0,
}
STAND_IN_OF = {
    "cgm_slope_best": "cgm_slope_60m", "cgm_delta_best": "cgm_delta_60m", "cgm_slope_90m": "cgm_slope_60m",
    "cgm_delta_90m": "cgm_delta_60m", "cgm_std_90m": "cgm_std_30m",
}

# --- fixed values: feature lists ----------------------------------------------
NUTRITION_CLUSTER_INPUTS = [
    "avg_pct_carbs", "avg_pct_protein", "avg_pct_fat", "avg_fibre_carb_ratio",
    "avg_ultraprocessed", "avg_food_groups", "est_daily_calories", "avg_items_per_meal",
]
RESPONSE_CLUSTER_INPUTS = [
    "avg_iauc", "avg_amplitude", "avg_peak", "time_in_range", "glucose_std",
    "pct_high_spikes", "avg_preprandial",
]
BASE_FEATURES = [
    "glucose_preprandial", "total_calories", "total_protein", "total_fat", "total_carbs",
    "total_fibre", "n_items", "pct_cal_carbs", "pct_cal_protein", "pct_cal_fat",
    "fibre_carb_ratio", "n_ultraprocessed", "n_high_gi", "avg_saturated_fat", "n_food_groups",
    "hour_of_day", "day_of_week", "is_weekend", "sport_prior_duration", "sport_prior_sessions",
    "hours_since_last_sport", "sleep_time_prev", "sleep_quality_prev", "tiredness",
    "fasting_hunger", "resting_hr_morning", "hrv_morning", "training_effort_prev",
    "anxiety_prev", "nutrition_plan_prev", "day_eval_prev", "pct_items_with_fibre",
]
USER_FEATURES = [
    "user_glucose_mean", "user_glucose_std", "user_glucose_median", "user_glucose_q25",
    "user_glucose_q75", "user_time_in_range",
]
CATEGORICAL_FEATURES = ["meal_period", "meal_type", "sport_prior_intensity"]
INTERACTION_FEATURES = [
    "net_carbs", "carbs_x_hour", "carbs_x_preprandial", "fat_protein_ratio",
    "nutri_cluster_num", "glyc_cluster_num",
]
ROLLING_FEATURES = [
    "user_peak_mean_roll", "user_peak_std_roll", "user_ttp_mean_roll",
    "user_glucose_mean_roll", "user_glucose_std_roll",
]
PRE_FEATURES = [
    "cgm_slope_30m", "cgm_slope_60m", "cgm_std_30m", "cgm_delta_30m", "cgm_delta_60m",
    "cgm_tir_pre", "cgm_pct_above_target", "n_readings_pre_60m",
]
PRE_BEST_FEATURES = [
    "cgm_slope_best", "cgm_delta_best", "cgm_slope_30m", "cgm_std_30m", "cgm_slope_90m",
    "cgm_delta_90m", "cgm_std_90m", "cgm_tir_pre", "cgm_pct_above_target", "n_readings_pre_60m",
]
NUTRITION_FEATURES = [
    "net_carbs", "pct_high_gi_items", "fat_delay_score", "effective_gi_score", "carbs_per_item",
]
SPORT_FEATURES = [
    "sport_2h_duration", "sport_6h_duration", "sport_48h_duration", "sport_48h_sessions",
    "sport_intensity_score",
]
DAY_FEATURES = ["prev_meals_today", "prev_peak_today_max", "hours_since_last_meal", "carbs_load_today"]
LATE_FEATURES = ["fat_carb_ratio_meal", "gi_fiber_interaction", "sport_2h_insulin_proxy"]

# --- fixed values: response measures of one meal --------------------------------
TARGETS = [
    "glucose_preprandial", "glucose_preprandial_mean", "peak_value", "time_to_peak_min",
    "amplitude", "iauc", "recovery_time_min", "cv_postprandial", "glucose_2h", "n_readings_post",
]

# --- fixed values: partitioned training -----------------------------------------
FED_LOCAL_EPOCHS = 1
FED_RATE = 0.01
FED_MOMENTUM = 0.9
FED_EXPERIMENTS = [
    {"name": "small-iid", "clients": 5, "kind": "iid"},
    {"name": "large-iid", "clients": 20, "kind": "iid"},
    {"name": "small-dirichlet", "clients": 5, "kind": "dirichlet", "alpha": 0.1},
    {"name": "large-dirichlet", "clients": 20, "kind": "dirichlet", "alpha": 0.1},
    {"name": "small-pathological", "clients": 5, "kind": "pathological", "classes": 2},
    {"name": "large-pathological", "clients": 20, "kind": "pathological", "classes": 2},
]
