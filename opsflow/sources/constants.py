"""Inline constant tables (A6) and fixed code lists.

These are fixed values that must equal the source's for right results; they
are kept together, in natural order, as plain text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: certification code -> group (17 rows) ----
CERT_GROUPS = [
    ("CNA", "CLASS A"),
    ("CNAACUTE", "CLASS A"),
    ("HMK", "CLASS B - PHS"),
    ("IHSHMK", "CLASS B - IHSS"),
    ("IHSPCR", "CLASS B - IHSS"),
    ("IHSPCW", "CLASS B - IHSS"),
    ("IHSS", "CLASS B - IHSS"),
    ("MLHMKR", "CLASS B - PHS"),
    ("MLPECA", "CLASS B - PHS"),
    ("MLRESP", "CLASS B - PHS"),
    ("NURSE ACUT", "CLASS A"),
    ("NURSING", "CLASS A"),
    ("PCW", "CLASS B - PHS"),
    ("PDN", "CLASS A"),
    ("PPCW", "CLASS B - PPC"),
    ("Respite", "CLASS B - PHS"),
    ("RPCW", "CLASS B - PHS"),
]

# ---- fixed values: group -> required task item (8 rows) ----
GROUP_TASKS = [
    ("CLASS B - IHSS", "HCA 3MO SUPER"),
    ("CLASS B - IHSS", "HCA 6MO SUPER"),
    ("CLASS B - IHSS", "HCA 9MO SUPER"),
    ("CLASS B - IHSS", "HCA ANNUAL VISIT"),
    ("CLASS B - PHS", "HCA 3MO SUPER"),
    ("CLASS B - PHS", "HCA 6MO SUPER"),
    ("CLASS B - PHS", "HCA 9MO SUPER"),
    ("CLASS B - PHS", "HCA ANNUAL VISIT"),
]

# ---- fixed values: code lists used by the rules ----
NON_CARE_CERT_CODES = ["SUPERV", "AUTH", "485POC"]
CHECK_FACILITIES = ["LUS", "CSU"]
SKILLED_FACILITIES = ["LSK", "CSS"]
SKILLED_PLANS = ["SKILLT", "SKILAC"]
VISIT_STATUSES_OT = ["P", "VP", "V", "BP", "C"]
VISIT_STATUSES_OVER15 = ["V", "C", "VP"]
QUARTER_MINUTES = ["00", "15", "30", "45"]
REQUIRED_ITEMS_PER_GROUP = 4

# ---- fixed values: task status lifecycle ----
STATUS_PENDING = "Pending"
STATUS_SENT = "Sent"
STATUS_FAILED = "Failed"
STATUS_COMPLETED = "Completed"


def cert_groups(spark: SparkSession) -> DataFrame:
    """17-row mapping; broadcast-safe by construction (fixed size)."""
    return F.broadcast(spark.createDataFrame(CERT_GROUPS, "cert_code string, the_group string"))


def group_tasks(spark: SparkSession) -> DataFrame:
    """8-row mapping; broadcast-safe by construction (fixed size)."""
    return F.broadcast(spark.createDataFrame(GROUP_TASKS, "the_group string, task_item string"))
