"""Fixed values as the oracle's SQL states them.

Written out here a second time, apart from ``tabprep.constants``, so that a
wrong token, spelling, format or edge in the implementation does not turn up on
both sides of a comparison.
"""

NULL_TOKENS_CORE = ("null", "none", "nan")
NULL_TOKENS_PIPE = ()
NULL_TOKENS_SERVICE = ("null", "none", "nan", "?")
RAW_NULL_TOKENS = ("", "null", "NULL", "None")

ERROR_TOKEN_PATTERN = "^error_?"
ERROR_TOKEN_PATTERN_PIPE = "^error"

LABEL_VOCAB = {
    "core": {"<=80k": ["<=80k", "=<80k", "le80k", "lessorequal80k", "low", "0"],
             ">80k": [">80k", "gt80k", "greaterthan80k", "high", "1"]},
    "pipe": {"<=80k": ["<=80k", "=<80k", "le80k", "low", "0"],
             ">80k": [">80k", "gt80k", "high", "1"]},
    "service": {"<=80k": ["<=80k", "=<80k", "le80k", "lessorequal80k", "<=50k", "low", "0"],
                ">80k": [">80k", "gt80k", "greaterthan80k", ">50k", "high", "1"]},
}

ISO_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd"]
DAY_FIRST_FORMATS = ["dd/MM/yy HH:mm", "dd/MM/yy"]
MONTH_FIRST_FORMATS = ["MM/dd/yy HH:mm", "MM/dd/yy"]

AGE_BUCKETS = ([0, 24, 34, 44, 54, 64, None], ["<=24", "25-34", "35-44", "45-54", "55-64", "65+"])
HOURS_BUCKETS = ([0, 19, 34, 40, 50, None], ["part_time", "reduced", "standard", "extended", "heavy"])
EDUCATION_BUCKETS = ([0, 8, 12, 13, 14, None], ["pre_hs", "hs_or_some_college", "bachelors", "masters", "advanced"])
MARITAL_GROUPS = [("married", "married"), ("never", "never_married"), ("divorced", "divorced"),
                  ("separated", "separated"), ("widowed", "widowed")]
