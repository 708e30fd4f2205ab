"""Code dictionaries (CPT categories, high-cost set, places of service).

These are bounded, hand-maintained dimensions (tens of rows), so they are
safe to broadcast and to inline as literal arrays in column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the reference's dictionaries for equal results.
# ---------------------------------------------------------------------------
CPT_TO_CATEGORY: dict[str, str] = {
    "99201": "evaluation_management",
    "99202": "evaluation_management",
    "99203": "evaluation_management",
    "99204": "evaluation_management",
    "99205": "evaluation_management",
    "99211": "evaluation_management",
    "99212": "evaluation_management",
    "99213": "evaluation_management",
    "99214": "evaluation_management",
    "99215": "evaluation_management",
    "99221": "evaluation_management",
    "99222": "evaluation_management",
    "99223": "evaluation_management",
    "99231": "evaluation_management",
    "99232": "evaluation_management",
    "99233": "evaluation_management",
    "99281": "evaluation_management",
    "99282": "evaluation_management",
    "99283": "evaluation_management",
    "99284": "evaluation_management",
    "99285": "evaluation_management",
    "99354": "evaluation_management",
    "99355": "evaluation_management",
    "27447": "surgery",
    "27130": "surgery",
    "29881": "surgery",
    "47562": "surgery",
    "49505": "surgery",
    "43239": "surgery",
    "43249": "surgery",
    "27446": "surgery",
    "23472": "surgery",
    "28296": "surgery",
    "44970": "surgery",
    "58661": "surgery",
    "71046": "radiology",
    "71250": "radiology",
    "72148": "radiology",
    "73721": "radiology",
    "74177": "radiology",
    "77067": "radiology",
    "70553": "radiology",
    "72141": "radiology",
    "73221": "radiology",
    "76700": "radiology",
    "76856": "radiology",
    "73610": "radiology",
    "80053": "pathology",
    "85025": "pathology",
    "80048": "pathology",
    "83036": "pathology",
    "82947": "pathology",
    "84443": "pathology",
    "80061": "pathology",
    "81001": "pathology",
    "87086": "pathology",
    "88305": "pathology",
    "86900": "pathology",
    "82306": "pathology",
    "90834": "medicine",
    "90837": "medicine",
    "90846": "medicine",
    "96372": "medicine",
    "96413": "medicine",
    "93000": "medicine",
    "93306": "medicine",
    "92014": "medicine",
    "90460": "medicine",
    "96365": "medicine",
    "97110": "medicine",
    "97140": "medicine",
}

CATEGORY_DESCRIPTIONS: dict[str, str] = {
    "evaluation_management": "Office visits, hospital visits, consultations, and ED encounters",
    "surgery": "Surgical procedures including orthopedic, GI, and general surgery",
    "radiology": "Imaging services: X-ray, CT, MRI, ultrasound, mammography",
    "pathology": "Laboratory tests and surgical pathology",
    "medicine": "Therapeutic services, psychiatric, infusions, physical therapy",
}

HIGH_COST_PROCEDURES: list[str] = [
    "27447", "27130", "23472", "27446",
    "96413",
    "70553", "74177",
    "44970", "47562", "58661",
]

CHRONIC_CONDITION_PREFIXES: list[str] = ["E11", "I10", "J44", "N18"]
EMERGENCY_POS_CODES: list[str] = ["23"]
INPATIENT_POS_CODES: list[str] = ["21", "31"]

# Place of service: generator's long labels and the dashboard's short labels.
PLACES_OF_SERVICE: dict[str, str] = {
    "11": "Office",
    "21": "Inpatient Hospital",
    "22": "On Campus-Outpatient Hospital",
    "23": "Emergency Room",
    "31": "Skilled Nursing Facility",
    "81": "Independent Laboratory",
    "12": "Home",
    "20": "Urgent Care Facility",
    "24": "Ambulatory Surgical Center",
    "99": "Other",
}
POS_SHORT_LABELS: dict[str, str] = {
    "11": "Office", "21": "Inpatient", "22": "Outpatient",
    "23": "Emergency", "31": "SNF", "81": "Lab",
    "12": "Home", "20": "Urgent Care", "24": "ASC", "99": "Other",
}
# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

CATEGORIES = list(CATEGORY_DESCRIPTIONS)


def codes_in(category: str) -> list[str]:
    """CPT codes of one category, in dictionary order."""
    return [c for c, cat in CPT_TO_CATEGORY.items() if cat == category]


def dim_cpt(spark: SparkSession) -> DataFrame:
    """Code → category, high-cost flag (71 rows; broadcastable)."""
    hc = set(HIGH_COST_PROCEDURES)
    rows = [(code, cat, code in hc) for code, cat in CPT_TO_CATEGORY.items()]
    schema = T.StructType([
        T.StructField("cpt_code", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("is_high_cost", T.BooleanType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def dim_cpt_category(spark: SparkSession) -> DataFrame:
    """Category descriptions (5 rows)."""
    return spark.createDataFrame(list(CATEGORY_DESCRIPTIONS.items()),
                                 "category STRING, description STRING")


def dim_high_cost(spark: SparkSession) -> DataFrame:
    """The high-cost code set as a one-column dimension."""
    return spark.createDataFrame([(c,) for c in HIGH_COST_PROCEDURES], "cpt_code STRING")


def dim_pos(spark: SparkSession) -> DataFrame:
    """Place-of-service code → long label, dashboard short label."""
    rows = [(k, v, POS_SHORT_LABELS[k]) for k, v in PLACES_OF_SERVICE.items()]
    return spark.createDataFrame(rows, "place_of_service STRING, pos_name STRING, pos_label STRING")
