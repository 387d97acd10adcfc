"""Lists, lookup tables and settings that decide what the results are.

Everything here is data. Changing an entry changes results, so the values are kept
in one place and written out plainly.
"""

# --- target -----------------------------------------------------------------

# The three yearly salary bounds and the factors applied when only one is known.
TARGET = "salary_normalized"
TARGET_BOUNDS = ("salary_yearly_min", "salary_yearly_max", "salary_yearly_med")
SMALLEST_MEDIAN = 1000.0
MIN_ONLY_FACTOR = 1.15
MAX_ONLY_FACTOR = 0.85

# Pay periods per year.
PERIODS_PER_YEAR = {"YEARLY": 1.0, "HOURLY": 2080.0, "MONTHLY": 12.0, "WEEKLY": 52.0}

# Plausible yearly pay.
OUTLIER_LOW = 10_000.0
OUTLIER_HIGH = 500_000.0

# --- projections ------------------------------------------------------------

# Columns removed when the final table is built.
NON_ESSENTIAL = (
    "job_id", "salary_id", "company_id",
    "job_posting_url", "application_url", "url",
    "original_listed_time", "listed_time", "expiry", "closed_time", "time_recorded",
    "normalized_salary", "min_salary", "max_salary", "med_salary",
    "salary_yearly_min", "salary_yearly_max", "salary_yearly_med",
    "pay_period", "pay_period_salary", "compensation_type", "compensation_type_salary",
    "currency_salary", "max_salary_salary", "med_salary_salary", "min_salary_salary",
    "work_type",
    "posting_domain", "application_type", "sponsored", "fips",
    "zip_code", "zip_code_company", "address",
)

# Columns made redundant by the target.
REDUNDANT_TARGETS = (
    "salary_yearly_min", "salary_yearly_max", "salary_yearly_med",
    "min_salary", "max_salary", "med_salary",
)

# Columns that leak the target into the numeric model table.
LEAKAGE = (
    "salary_normalized", "normalized_salary", "salary",
    "min_salary", "max_salary", "salary_min", "salary_max",
)

# Columns that are never model features.
NOT_FEATURES = ("salary_normalized", "normalized_salary", "benefits_list_missing")

# --- missing values ---------------------------------------------------------

# Percent missing at which a column is dropped / gets an indicator.
DROP_AT_PERCENT = 90.0
INDICATOR_AT_PERCENT = 30.0

# Imputed by mode.
MODE_COLUMNS = (
    "formatted_work_type", "formatted_experience_level", "company_size",
    "state", "city", "remote_allowed",
)

# Imputed by median.
MEDIAN_COLUMNS = (
    "views", "applies", "employee_count", "follower_count", "industry_count",
    "skill_count", "company_industry_count", "speciality_count", "benefit_count",
)

# Imputed by a constant, and that constant.
CONSTANT_COLUMNS = (
    "company_name", "description_company", "primary_industry", "all_industries",
    "primary_skill", "all_skills", "primary_company_industry", "all_company_industries",
    "primary_speciality", "all_specialities", "country", "benefits_list",
)
CONSTANT_FILL = "Unknown"

# --- text -------------------------------------------------------------------

# Technical terms rewritten, in this order, before punctuation is removed.
TECHNICAL_TERMS = (
    ("c++", "cplusplus"), ("c#", "csharp"), (".net", "dotnet"), ("node.js", "nodejs"),
)

# What counts as a URL, an e-mail address and a word character.
URL_PATTERN = r"http\S+|www\.\S+"
EMAIL_PATTERN = r"\S+@\S+"

# Fields holding lists separated by a pipe.
PIPE_FIELDS = ("all_skills", "all_industries", "benefits_list")

# Term-weighting settings (max_features, min_df, max_df, longest n-gram) per field.
# Track A weighs 1 + ln(tf) over tokens of two or more characters.
TRACK_A_TERMS = {
    "title": (50, 5, 0.95, 2),
    "description": (100, 5, 0.95, 2),
    "all_skills": (50, 5, 0.95, 1),
}
# Track B weighs raw counts over tokens of any length.
TRACK_B_TERMS = {
    "description": (100, 5, 0.95, 2),
    "title": (50, 3, 0.95, 2),
    "all_skills": (50, 3, 0.95, 1),
    "description_company": (50, 5, 0.95, 2),
    "all_industries": (30, 3, 0.95, 1),
    "benefits_list": (30, 3, 0.95, 1),
}
TRACK_B_OTHER_FIELD = (50, 5, 0.95, 1)

# Sentence-encoder batch sizes and the number of words it reads.
TITLE_BATCH = 256
DESCRIPTION_BATCH = 64
DESCRIPTION_WORDS = 500

# --- validation -------------------------------------------------------------

# Rules a row must satisfy before it may be modelled.
CRITICAL_FIELDS = {
    "title": {"required": True, "min_length": 3},
    "description": {"required": True, "min_length": 20},
    "salary_normalized": {"required": True, "min_value": 10000, "max_value": 1000000},
}
INFERENCE_ROWS = 100
SMALLEST_SAMPLE = 100

# --- encoders ---------------------------------------------------------------

# Experience scale; order matters for the substring fallback.
EXPERIENCE_SCALE = {
    "Internship": 0,
    "Entry level": 1,
    "Associate": 2,
    "Mid-Senior level": 3,
    "Director": 4,
    "Executive": 5,
    "": -1,
    "missing": -1,
}
ORDINAL_COLUMNS = {"formatted_experience_level": EXPERIENCE_SCALE}
ONE_HOT_COLUMNS = ("formatted_work_type", "company_size")
FREQUENCY_COLUMNS = ("city", "state")
BINARY_COLUMNS = {"country": "US"}
DROPPED_AFTER_ENCODING = ("currency",)
KEPT_AFTER_ENCODING = ("salary_normalized", "benefits_list_missing")
TEXT_DROPPED_AFTER_ENCODING = (
    "company_name", "title", "description", "location", "description_company",
    "primary_industry", "all_industries", "primary_skill", "all_skills", "benefits_list",
    "primary_company_industry", "all_company_industries",
    "primary_speciality", "all_specialities",
)

# US state names and their postal codes.
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR",
    "California": "CA", "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE",
    "District of Columbia": "DC", "Florida": "FL", "Georgia": "GA", "Hawaii": "HI",
    "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA",
    "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME",
    "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE",
    "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM",
    "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH",
    "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI",
    "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX",
    "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}

# --- models -----------------------------------------------------------------

# Split, cross-validation and model settings.
TEST_SHARE = 0.2
SEED = 42
FOLDS = 10
RIDGE_ALPHA = 1.0
RIDGE_FALLBACK_BELOW_R2 = -100.0
FOREST = {"trees": 100, "depth": 15, "min_leaf": 2}
BOOSTING = {"trees": 100, "depth": 6, "step": 0.1, "row_share": 0.8, "column_share": 0.8}
NETWORK = {
    "hidden": (128, 64), "l2": 0.001, "step": 0.001, "batch": 200,
    "epochs": 500, "validation_share": 0.1, "patience": 20, "tolerance": 1e-4,
}
WORD_VECTORS = {"size": 100, "window": 5, "min_count": 5, "epochs": 10}
PERMUTATION = {"rows": 500, "repeats": 5}

# Absolute-error percentiles and histogram edges.
ERROR_PERCENTILES = (10, 25, 50, 75, 90, 95, 99)
ERROR_BINS = (
    (1, "< $5K", 0.0, 5_000.0),
    (2, "$5K - $10K", 5_000.0, 10_000.0),
    (3, "$10K - $20K", 10_000.0, 20_000.0),
    (4, "$20K - $50K", 20_000.0, 50_000.0),
    (5, "> $50K", 50_000.0, float("inf")),
)

# Labels for a train-minus-test R2 gap, as (upper bound, label).
GAP_BANDS = {
    "comparison": ((0.05, "None"), (0.1, "Mild"), (0.2, "Moderate"), (None, "Severe")),
    "final": ((0.01, "EXCELLENT"), (0.05, "GOOD"), (0.10, "MODERATE"), (None, "SIGNIFICANT")),
    "production": ((0.05, "none"), (0.15, "moderate"), (None, "significant")),
}
# Labels for an R2, as (lower bound, label).
R2_BANDS = ((0.7, "EXCELLENT"), (0.5, "GOOD"), (0.3, "MODERATE"), (None, "POOR"))

# Recommendation thresholds.
LOW_TYPE_IMPORTANCE = 0.01
HIGH_TYPE_IMPORTANCE = {"TF-IDF": 0.2, "Word2Vec": 0.2, "One-Hot": 0.15}
MANY_FEATURES = 1000
