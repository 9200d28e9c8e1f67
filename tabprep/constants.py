"""Fixed values the cleaning and modelling jobs must agree on.

Everything in this module is a contract value (column names, vocabularies,
bucket edges, null tokens).  They are stated plainly and in their natural
order; code elsewhere only refers to them by name.
"""

# ---------------------------------------------------------------------------
# Raw column contract (ordered), business key, publish order.
# ---------------------------------------------------------------------------
CONTRACT_COLUMNS = [
    "age", "workclass", "education_level", "education_num", "marital_status",
    "occupation", "relationship", "race", "sex", "capital_gain", "capital_loss",
    "hours_per_week", "native_country", "income", "event_time", "random_flag",
    "source_system",
]

BUSINESS_KEY = [
    "age", "workclass", "education_level", "education_num", "marital_status",
    "occupation", "relationship", "race", "sex", "native_country", "event_time_std",
    "income", "source_system",
]

NUMERIC_CLEAN_COLUMNS = ["education_num", "capital_gain", "capital_loss", "hours_per_week"]

CURATED_COLUMNS = [
    "age", "workclass", "education_level", "education_num", "marital_status",
    "occupation", "relationship", "race", "sex", "capital_gain", "capital_loss",
    "hours_per_week", "native_country", "income", "event_time_std", "random_flag",
    "source_system",
]

# Audit projection: label published as income_label plus raw copies.
AUDIT_COLUMNS = [
    "age", "workclass", "education_level", "education_num", "marital_status",
    "occupation", "relationship", "race", "sex", "capital_gain", "capital_loss",
    "hours_per_week", "native_country", "income_label", "event_time_std",
    "random_flag", "source_system", "age_raw", "income_raw", "event_time_raw",
]

# ---------------------------------------------------------------------------
# Null tokens (compared after trim, case-insensitively).
# ---------------------------------------------------------------------------
NULL_TOKENS_CORE = ("null", "none", "nan")
NULL_TOKENS_PIPE = ()
NULL_TOKENS_SERVICE = ("null", "none", "nan", "?")
# Raw null scan: case-sensitive tokens after trim.
RAW_NULL_TOKENS = ("", "null", "NULL", "None")

ERROR_TOKEN_PATTERN = "^error_?"
ERROR_TOKEN_PATTERN_PIPE = "^error"

# ---------------------------------------------------------------------------
# Label vocabularies (after lower-casing and removing whitespace).
# ---------------------------------------------------------------------------
LABEL_LOW = "<=80k"
LABEL_HIGH = ">80k"
LABELS = [LABEL_LOW, LABEL_HIGH]

LABEL_VOCAB = {
    "core": {
        LABEL_LOW: ["<=80k", "=<80k", "le80k", "lessorequal80k", "low", "0"],
        LABEL_HIGH: [">80k", "gt80k", "greaterthan80k", "high", "1"],
    },
    "pipe": {
        LABEL_LOW: ["<=80k", "=<80k", "le80k", "low", "0"],
        LABEL_HIGH: [">80k", "gt80k", "high", "1"],
    },
    "service": {
        LABEL_LOW: ["<=80k", "=<80k", "le80k", "lessorequal80k", "<=50k", "low", "0"],
        LABEL_HIGH: [">80k", "gt80k", "greaterthan80k", ">50k", "high", "1"],
    },
}

# ---------------------------------------------------------------------------
# Timestamp formats tried in order by each cascade.
# ---------------------------------------------------------------------------
ISO_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd"]
DAY_FIRST_FORMATS = ["dd/MM/yy HH:mm", "dd/MM/yy"]
MONTH_FIRST_FORMATS = ["MM/dd/yy HH:mm", "MM/dd/yy"]

# ---------------------------------------------------------------------------
# Data-quality ranges (inclusive bounds).
# ---------------------------------------------------------------------------
AGE_RANGE = (0, 120)
HOURS_RANGE = (0, 168)

# ---------------------------------------------------------------------------
# Model feature sets.
# ---------------------------------------------------------------------------
LABEL_COLUMN = "income"
NUMERIC_FEATURES = ["age", "education_num", "capital_gain", "capital_loss", "hours_per_week"]
CATEGORICAL_FEATURES = [
    "workclass", "education_level", "marital_status", "occupation", "relationship",
    "race", "sex", "native_country", "random_flag", "source_system",
]
CATEGORICAL_FEATURES_7 = [
    "workclass", "education_level", "marital_status", "occupation", "relationship",
    "race", "sex",
]
CATEGORICAL_FEATURES_6 = [
    "workclass", "education_level", "marital_status", "occupation", "relationship",
    "sex",
]
FEATURE_SETS = {
    "full": CATEGORICAL_FEATURES,
    "compact7": CATEGORICAL_FEATURES_7,
    "compact6": CATEGORICAL_FEATURES_6,
}
UNKNOWN_CATEGORY = "Unknown"

# ---------------------------------------------------------------------------
# Engineered features (service profile).
# ---------------------------------------------------------------------------
DERIVED_NUMERIC_FEATURES = [
    "capital_net", "capital_total", "has_capital_gain", "has_capital_loss",
    "hours_x_education", "age_x_education", "event_year", "event_month",
    "event_dayofweek", "event_hour",
]
DERIVED_CATEGORICAL_FEATURES = [
    "age_bucket", "hours_bucket", "education_group", "marital_group",
    "capital_profile", "is_us_native", "event_quarter", "event_is_weekend",
]
MODEL_NUMERIC_FEATURES = NUMERIC_FEATURES + DERIVED_NUMERIC_FEATURES
MODEL_CATEGORICAL_FEATURES = CATEGORICAL_FEATURES + DERIVED_CATEGORICAL_FEATURES

# Right-closed bins: (edge[i], edge[i+1]] -> label[i]; None edge = +infinity.
AGE_BUCKETS = ([0, 24, 34, 44, 54, 64, None], ["<=24", "25-34", "35-44", "45-54", "55-64", "65+"])
HOURS_BUCKETS = ([0, 19, 34, 40, 50, None], ["part_time", "reduced", "standard", "extended", "heavy"])
EDUCATION_BUCKETS = ([0, 8, 12, 13, 14, None], ["pre_hs", "hs_or_some_college", "bachelors", "masters", "advanced"])

# First match wins, in this order.
MARITAL_GROUPS = [
    ("married", "married"),
    ("never", "never_married"),
    ("divorced", "divorced"),
    ("separated", "separated"),
    ("widowed", "widowed"),
]

# Request-field aliases applied after name standardisation.
FIELD_ALIASES = {
    "education": "education_level",
    "event_time": "event_time_std",
}

SEED = 42
