"""Values that must equal the original pipeline's for the same results, kept in one place."""

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's).
# ---------------------------------------------------------------------------------------------

# Tracked coins as (symbol, vendor-A coin id), in the original order.
COINS = [("BTC", "bitcoin"), ("ETH", "ethereum"), ("BNB", "binancecoin")]
# Display names per symbol (the symbol itself when absent).
DISPLAY_NAMES = {"BTC": "Bitcoin (BTC)", "ETH": "Ethereum (ETH)", "BNB": "BNB (BNB)"}
# Manual USD -> IDR rate used when a vendor has no local-currency price.
FX_USD_TO_IDR = 16500
# Price / local price / 24 h change precision of a price event.
PRICE_DIGITS, LOCAL_PRICE_DIGITS, CHANGE_DIGITS = 2, 0, 4

# News record defaults and limits.
DEFAULT_TITLE = "No Title"
SUMMARY_CHARS = 500
NEWS_SNAPSHOT_SIZE = 20
NEWS_VIEW_SIZE = 5

# Landing flush cadence.
LANDING_TRIGGER = "120 seconds"

# Forecast set-up.
MIN_ROWS_TOTAL = 20
MIN_ROWS_PER_KEY = 20
MIN_VAL_ROWS = 5
TRAIN_FRACTION = 0.8
HISTORY_POINTS = 50
CONTEXT_POINTS = 15
INTERVAL_DIFFS = 10
DEFAULT_INTERVAL = 60
HORIZON = 10
MODEL_ORDER = ["LinearRegression", "RandomForest", "GBT"]
LR_MAX_ITER = 200
RF_TREES, RF_DEPTH = 100, 6
GBT_ITER, GBT_DEPTH = 80, 5
SEED = 42
NO_MODEL_R2 = -999.0
R2_DIGITS, MAE_DIGITS = 4, 6

# Monitoring.
FRESH_OK_MIN = 5
FRESH_WARN_MIN = 30
ROOT_CAUSE_AGE_MIN = 10
LOG_TAIL_LINES = 50
LOG_SHOW_LINES = 3
ERROR_PATTERN = "(?i)(error|failed|exception|traceback)"
NULL_DASH = "—"
