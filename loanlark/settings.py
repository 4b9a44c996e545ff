"""They must equal the published workload settings for the results to match."""

ID = "SK_ID_CURR"
TARGET = "TARGET"
SEED = 42
TEST_SIZE = 0.2
NULL_FRACTION_LIMIT = 0.6

EMPLOYED_SENTINEL = 365243
DAYS_PER_YEAR = 365

STATUS_LEVELS = {"C": 0, "X": 0, "0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5}
OVERDUE_STATUSES = ["1", "2", "3", "4", "5"]
CONTACT_FLAGS = [
    "FLAG_MOBIL",
    "FLAG_EMP_PHONE",
    "FLAG_WORK_PHONE",
    "FLAG_CONT_MOBILE",
    "FLAG_PHONE",
    "FLAG_EMAIL",
]

ALPHA = 0.05
KS_MIN_ROWS = 10
KS_MIN_DISTINCT = 3
CHI2_MAX_DISTINCT = 10
REPORT_ROWS = 30

BOOTSTRAP_ITERATIONS = 1000
BOOTSTRAP_CI = 0.95

THRESHOLD_LOW = 0.01
THRESHOLD_HIGH = 0.99
THRESHOLD_STEPS = 200
DEFAULT_THRESHOLD = 0.35
CURVE_POINTS = 200
CALIBRATION_BINS = 10
HISTOGRAM_BINS = 30

BAND_MEDIUM = 0.25
BAND_HIGH = 0.55

RESAMPLE_RATIO = 0.3
NEIGHBOURS = 5

SEARCH_TRIALS = 50
SEARCH_FOLDS = 5
EARLY_STOPPING_ROUNDS = 50
IMPORTANCE_STORED = 50
IMPORTANCE_TOP = 20
PAGE_ROWS = 7

# Search ranges of the tuned learner that it has a counterpart for: (low, high, log scale).
SEARCH_RANGES = {
    "n_estimators": (300, 1500, False),
    "learning_rate": (0.01, 0.1, True),
    "max_depth": (3, 12, False),
    "min_child_samples": (10, 100, False),
    "subsample": (0.5, 1.0, False),
    "colsample_bytree": (0.4, 1.0, False),
}
