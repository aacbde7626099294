"""Fixed values of the rating domain, stated plainly."""

from __future__ import annotations

from decimal import Decimal as D

# 13 inclusive applicant age bands.
AGE_BANDS = [
    (18, 24, "18-24"),
    (25, 29, "25-29"),
    (30, 34, "30-34"),
    (35, 39, "35-39"),
    (40, 44, "40-44"),
    (45, 49, "45-49"),
    (50, 54, "50-54"),
    (55, 59, "55-59"),
    (60, 64, "60-64"),
    (65, 69, "65-69"),
    (70, 74, "70-74"),
    (75, 79, "75-79"),
    (80, 99, "80-99"),
]
AGE_LABELS = [label for _, _, label in AGE_BANDS]

# Ten-year mortality group each fine age band belongs to.
COARSE_GROUP = {
    "18-24": "15-24",
    "25-29": "25-34",
    "30-34": "25-34",
    "35-39": "35-44",
    "40-44": "35-44",
    "45-49": "45-54",
    "50-54": "45-54",
    "55-59": "55-64",
    "60-64": "55-64",
    "65-69": "65-74",
    "70-74": "65-74",
    "75-79": "75-84",
    "80-99": "85+",
}
COARSE_LABELS = ["15-24", "25-34", "35-44", "45-54", "55-64", "65-74", "75-84", "85+"]

# Survey code to label maps; codes not listed are unknown (null).
AGE_CODES = {i + 1: label for i, label in enumerate(AGE_LABELS)}
GENDER_CODES = {1: "M", 2: "F"}
SMOKING_CODES = {1: "current", 2: "current", 3: "former", 4: "never"}
DIABETES_CODES = {1: "yes", 2: "gest", 3: "no", 4: "pre"}
BMI_CODES = {1: "under", 2: "normal", 3: "over", 4: "obese"}
EXERCISE_CODES = {1: "yes", 2: "no"}
EXAM_DIABETES_CODES = {1: "yes", 2: "no", 3: "borderline", 7: "refused", 9: "unknown"}

# Vocabularies of the modelling profile.
GENDERS = ["F", "M"]
SMOKING_LEVELS = ["current", "former", "never"]
BMI_LEVELS = ["under", "normal", "over", "obese"]
EXERCISE_LEVELS = ["no", "yes"]
OUTCOMES_IN_SET = ["yes", "no", "gest", "pre"]
PROFILE = ["age_band", "gender", "smoking_status", "bmi_band", "exercise_freq"]
FACTOR_KEY = ["age_band", "gender", "smoking_status", "diabetes_status", "bmi_band"]

# Upper bounds (exclusive) of the BMI bands; above the last is obese.
BMI_UPPER = [("under", D("18.5")), ("normal", D("25")), ("over", D("30"))]

# Mortality relativities and rating constants.
SMOKING_RELATIVITY = {"never": D("1.00"), "former": D("1.30"), "current": D("2.30")}
BMI_RELATIVITY = {"normal": D("1.00"), "under": D("1.20"), "over": D("1.05"), "obese": D("1.35")}
UNDIAGNOSED_FRACTION = D("0.20")
LOADING = D("1.50")
CREDIT_CAP = D("15.00")
BASELINE_YEAR = 2023
DEFAULT_COHORT = 2023

# Product structure factors by product id.
PRODUCT_FACTORS = {
    1: D("1.00"), 2: D("1.00"),
    3: D("1.15"), 4: D("1.15"), 5: D("1.15"),
    6: D("1.35"), 7: D("1.35"), 8: D("1.35"), 9: D("1.35"), 10: D("1.35"),
    11: D("1.20"), 12: D("1.20"), 13: D("1.20"), 14: D("1.20"), 15: D("1.20"),
}

# Request vocabularies.
FACE_AMOUNTS = [100000, 250000, 500000, 1000000]
ACTIVITY_TYPES = ["Gym Visit", "Step Challenge", "Health Screen", "Nutrition Log"]
MEASURE_TYPES = ["bmi", "smoking", "exercise"]

# Gate tolerance of the model metric.
AUC_TOLERANCE = 0.02

# Fixed value: pattern of generator error text left in a delimited file.
MALFORMED_PATTERN = (
    r"(?i)undefined method|nil:NilClass|error:\s*invalid"
    r"|\bitem\s+1\s*,\s*item\s+2\s*,\s*item\s+3\b|^\(blank\)$"
)


def age_midpoints() -> dict[str, float]:
    """Band centre in years; the open top band is centred like the others."""
    return {label: (lo + hi) / 2 for lo, hi, label in AGE_BANDS}
