"""Driver-table analogue of the care-operations tables.

The jobs consume care-operations schemas (FIXTURES.md). The driver ships
TPC-H-like tables instead, so each care table is *derived by Spark* from a
driver table: every row of the driver table feeds the job, nothing is
sampled, and the work grows with the data. Each view is declared once as
``(column, spark_expr, duckdb_expr)``; the Spark side is a ``selectExpr``
(pruned and pushed into the parquet scan by Catalyst), the DuckDB side is the
CTE the oracle SQL starts from.

Derived attributes use bands of existing columns. Where a value has to be
invented (the coordinator of an admission, a task code, a visit hour) it is
computed from a key with ``% n`` -- e.g. ``o_custkey % 10`` lands on supplier
ids that exist at every scale factor. Such arithmetic only *derives column
values*; no view filters rows by id, so every query sees every driver row.
The few ``where`` clauses are attribute rules of the modelled world (users
with a non-negative balance, orders on hold, finished orders already loaded,
household customers new since the last snapshot, overtime reports for weeks
with a line of 45+ units, small low-priority tasks not
yet answered).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Tables


@dataclass(frozen=True)
class View:
    name: str
    base: str                       # driver table, or "lineitem_orders"
    cols: list[tuple[str, str, str | None]]
    where: str | None = None        # same text in both dialects
    pre: list[tuple[str, str, str | None]] = field(default_factory=list)
    distinct: bool = False

    def spark(self, t: Tables) -> DataFrame:
        df = _base_spark(t, self.base)
        if self.where:
            df = df.where(self.where)
        if self.pre:
            df = df.selectExpr("*", *[f"{s} AS {n}" for n, s, _ in self.pre])
        df = df.selectExpr(*[f"{s} AS {n}" for n, s, _ in self.cols])
        return df.distinct() if self.distinct else df

    def duck_cte(self) -> str:
        src = _base_duck(self.base)
        if self.pre:
            pre = ", ".join(f"{d if d is not None else s} AS {n}" for n, s, d in self.pre)
            src = f"(SELECT *, {pre} FROM {src}{' WHERE ' + self.where if self.where else ''}) b"
            where = ""
        else:
            where = f" WHERE {self.where}" if self.where else ""
        sel = ",\n    ".join(f"{d if d is not None else s} AS {n}" for n, s, d in self.cols)
        dist = "DISTINCT " if self.distinct else ""
        return f"{self.name} AS (\n  SELECT {dist}\n    {sel}\n  FROM {src}{where}\n)"


def _base_spark(t: Tables, base: str) -> DataFrame:
    if base == "customer_moved":
        cu, na = t["customer"], t["nation"]
        return cu.join(na, na.n_nationkey == (cu.c_nationkey + 1) % 25, "inner")
    if base == "lineitem_orders":
        li = t["lineitem"]
        od = t["orders"].select("o_orderkey", "o_custkey")
        return li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return t[base]


def _base_duck(base: str) -> str:
    if base == "customer_moved":
        return "customer JOIN nation ON n_nationkey = (c_nationkey + 1) % 25"
    if base == "lineitem_orders":
        return "lineitem JOIN orders ON l_orderkey = o_orderkey"
    return base


LINE_KEY = ("concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', "
            "CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING))")
PLAN = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'SKILLT' WHEN '2-HIGH' THEN 'SKILAC' "
        "WHEN '3-MEDIUM' THEN 'PPC' ELSE 'UNSK' END")
VISIT_TS_SPARK = "timestampadd(HOUR, CAST(l_partkey % 24 AS INT), l_shipdate)"
VISIT_TS_DUCK = "l_shipdate + to_hours(CAST(l_partkey % 24 AS BIGINT))"


def _hhmm(m: str) -> str:
    return (f"concat(lpad(CAST(CAST(floor({m} / 60) AS BIGINT) AS STRING), 2, '0'), ':', "
            f"lpad(CAST({m} % 60 AS STRING), 2, '0'))")


PATIENTS = View("patients", "customer", [
    ("patient_number", "CAST(c_custkey AS STRING)", None),
    ("first_name", "c_mktsegment", None),
    ("last_name", "c_name", None),
    ("residency_codes", "CAST(c_nationkey AS STRING)", None),
])

RESIDENCY = View("residency", "nation", [
    ("residency_codes", "CAST(n_nationkey AS STRING)", None),
    ("residency_desc", "CASE WHEN n_regionkey = 1 THEN 'CO-DENVER COUNTY' ELSE n_name END", None),
])

EMPLOYEES = View("employees", "supplier", [
    ("nurse_id", "CAST(s_suppkey AS STRING)", None),
    ("first_name", "'Nurse'", None),
    ("last_name", "s_name", None),
    ("employee_profile_code", "CASE WHEN s_nationkey < 3 THEN 'CCT' WHEN s_nationkey < 6 THEN 'RN' "
                              "WHEN s_nationkey < 8 THEN 'LPN' ELSE 'HCA' END", None),
    ("phone", "concat('555-', CAST(s_nationkey AS STRING))", None),
])

USERS = View("users", "supplier", [
    ("user_code", "concat('U', CAST(s_suppkey AS STRING))", None),
    ("user_name", "concat('Nurse ', s_name)", None),
], where="s_acctbal >= 0")

ADMISSIONS = View("admissions", "orders", [
    ("patient_number", "CAST(o_custkey AS STRING)", None),
    ("admission_number", "CAST(o_orderkey AS STRING)", None),
    ("facility_code", "CASE o_orderpriority WHEN '1-URGENT' THEN 'LUS' WHEN '2-HIGH' THEN 'CSU' "
                      "WHEN '3-MEDIUM' THEN 'LSK' WHEN '4-NOT SPECIFIED' THEN 'CSS' ELSE 'DEN' END", None),
    ("discharge_code", "CASE WHEN o_orderstatus = 'F' THEN 'DC' WHEN o_orderstatus = 'P' THEN 'H' "
                       "WHEN o_totalprice < 60000 THEN 'PA' WHEN o_totalprice > 450000 THEN 'CL' "
                       "ELSE 'A' END", None),
    ("nurse_id", "CASE WHEN o_totalprice < 30000 THEN '' ELSE CAST(o_custkey % 10 AS STRING) END", None),
    ("nurse_id_arr7_2", "CASE WHEN o_totalprice > 470000 THEN '' "
                        "ELSE CAST((o_custkey + 3) % 10 AS STRING) END", None),
    ("primary_plan", PLAN, None),
])

CERTIFICATIONS = View("certifications", "orders", [
    ("patient_number", "CAST(o_custkey AS STRING)", None),
    ("admission_number", "CAST(o_orderkey AS STRING)", None),
    ("certification_code", "CASE o_orderkey % 6 WHEN 0 THEN 'IHSS' WHEN 1 THEN 'HMK' "
                           "WHEN 2 THEN 'ihspcw ' WHEN 3 THEN 'CNA' WHEN 4 THEN 'PPCW' "
                           "ELSE 'SUPERV' END", None),
    ("certification_from", "o_orderdate - INTERVAL 200 DAY", None),
    ("certification_thru", "o_orderdate + INTERVAL 165 DAY", None),
])

TASK_ENTRIES = View("task_entries", "lineitem_orders", [
    ("wf_task_number", LINE_KEY, None),
    ("wf_task_code", "CASE l_partkey % 5 WHEN 0 THEN 'HCA 3MO SUPER' WHEN 1 THEN 'HCA 6MO SUPER' "
                     "WHEN 2 THEN 'HCA 9MO SUPER' WHEN 3 THEN CASE WHEN l_linestatus = 'F' "
                     "THEN 'HCA ANNUAL VISIT – RN/CC IN PERS' ELSE 'NON-HMA HCA ANNUAL VISIT' END "
                     "ELSE 'WOUND CARE' END", None),
    ("patient_number", "CAST(o_custkey AS STRING)", None),
    ("admission_number", "CAST(l_orderkey AS STRING)", None),
    ("start_date", "l_shipdate", None),
    ("end_date", "l_shipdate + INTERVAL 365 DAY", None),
    ("frequency_type", "CASE WHEN l_returnflag = 'N' THEN 2 ELSE 1 END", None),
    ("cb_completed", "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 1 ELSE 0 END", None),
    ("cb_skipped", "CASE WHEN l_discount >= 0.1 THEN 1 ELSE 0 END", None),
    ("cb_deleted", "0", None),
])

_SCHED = "CAST(l_quantity AS INT) * 30 + (l_linenumber % 3) * 5"
_CONF = ("CAST(l_quantity AS INT) * 30 + (l_linenumber % 3) * 5 + CAST(round(l_tax * 500) AS INT) "
         "- CASE WHEN l_returnflag = 'A' THEN 20 ELSE 0 END")

VISITS = View("visits", "lineitem_orders", pre=[
    ("sched_min", _SCHED, None),
    ("conf_min", _CONF, None),
], cols=[
    ("visit_id", LINE_KEY, None),
    ("nurse_id", "CAST(l_suppkey AS STRING)", None),
    ("patient_number", "CAST(o_custkey AS STRING)", None),
    ("admission_number", "CAST(l_orderkey AS STRING)", None),
    ("schedule_date", VISIT_TS_SPARK, VISIT_TS_DUCK),
    ("schedule_time", VISIT_TS_SPARK, VISIT_TS_DUCK),
    ("schedule_status_code", "CASE concat(l_returnflag, l_linestatus) WHEN 'NO' THEN 'P' "
                             "WHEN 'NF' THEN 'V' WHEN 'AF' THEN 'C' WHEN 'AO' THEN 'VP' "
                             "WHEN 'RF' THEN 'BP' ELSE 'Z' END", None),
    ("duration", _hhmm("sched_min"), None),
    ("confirmed_duration", _hhmm("conf_min"), None),
    ("update_date", "l_shipdate + INTERVAL 2 DAY", None),
    ("service_category", "l_returnflag", None),
])

HOLD_REPORTS = View("hold_reports", "orders", [
    ("admission_number", "CAST(o_orderkey AS STRING)", None),
    ("hold_report_date", "CAST(o_orderdate + INTERVAL 30 DAY AS DATE)", None),
    ("hold_end_date", "CASE WHEN o_totalprice > 250000 THEN CAST(o_orderdate + INTERVAL 60 DAY AS DATE) END",
     None),
], where="o_orderstatus = 'P'")

COMM_LOGS = View("comm_logs", "lineitem_orders", [
    ("note_id", LINE_KEY, None),
    ("patient_number", "CAST(o_custkey AS STRING)", None),
    ("admission_number", "CAST(l_orderkey AS STRING)", None),
    ("nurse_id", "CAST(l_suppkey AS STRING)", None),
    ("user_code", "concat('U', CAST(l_suppkey AS STRING))", None),
    ("communication_date_time", VISIT_TS_SPARK, VISIT_TS_DUCK),
    ("cb_delete", "CASE WHEN l_discount >= 0.1 THEN 1 ELSE 0 END", None),
    ("communication_ctg_code", "CASE WHEN l_returnflag = 'R' THEN 'HOL' ELSE 'GEN' END", None),
])

_LOG_STATUS = ("CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Pending' "
               "WHEN o_totalprice > 250000 THEN 'Failed' ELSE 'Sent' END")

TASK_LOG = View("task_log", "orders", [
    ("taskid", "o_orderkey", None),
    ("task_code", "CASE o_orderpriority WHEN '1-URGENT' THEN 'ADD HOLD NOTE' "
                  "WHEN '2-HIGH' THEN 'LOST ELIGIBILITY' WHEN '3-MEDIUM' THEN 'ASSIGN COORDINATOR' "
                  "WHEN '4-NOT SPECIFIED' THEN 'ASSIGN NURSE' ELSE 'UTIL REPORT' END", None),
    ("due", "date_add(CAST(o_orderdate AS DATE), CAST(o_custkey % 60 AS INT))",
     "CAST(o_orderdate AS DATE) + CAST(o_custkey % 60 AS INTEGER)"),
    ("start_date", "CAST(NULL AS DATE)", None),
    ("end_date", "CAST(NULL AS DATE)", None),
    ("patient_number", "CAST(o_custkey AS STRING)", None),
    ("admission_number", "CAST(o_orderkey AS STRING)", None),
    ("clinical_note_number", "CAST(NULL AS STRING)", None),
    ("employeeid", "CAST(NULL AS STRING)", None),
    ("notes", "concat('Follow up <', o_orderpriority, '> & \"check\"')", None),
    ("grp1_type1", "CASE WHEN o_orderstatus = 'O' THEN 3 ELSE 1 END", None),
    ("grp1_assignee1", "CASE WHEN o_orderstatus = 'O' THEN concat('U', CAST(o_custkey % 10 AS STRING)) "
                       "ELSE 'CaseManager' END", None),
    ("grp1_type2", "CAST(NULL AS INT)", None),
    ("grp1_assignee2", "CAST(NULL AS STRING)", None),
    ("grp2_type1", "CASE WHEN o_orderpriority = '2-HIGH' THEN 2 END", None),
    ("grp2_assignee1", "CASE WHEN o_orderpriority = '2-HIGH' THEN 'MRPAR' END", None),
    ("grp2_type2", "CAST(NULL AS INT)", None),
    ("grp2_assignee2", "CAST(NULL AS STRING)", None),
    ("status", _LOG_STATUS, None),
    ("status_note", "CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 "
                    "THEN concat('Error <', o_orderpriority, '> & retry') END", None),
    ("ehr_task_number", "CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_totalprice <= 250000) "
                        "THEN CAST(o_orderkey AS STRING) END", None),
    ("processed_date", "CAST(NULL AS TIMESTAMP)", None),
])

VENDOR_ENTRIES = View("vendor_entries", "orders", [
    ("wf_task_number", "CAST(o_orderkey AS STRING)", None),
    ("cb_completed", "CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END", None),
])

ELIGIBILITY = View("eligibility", "orders", [
    ("entry_date", "CAST(date_trunc('year', o_orderdate) AS DATE)", None),
    ("patient_number", "CAST(o_custkey AS STRING)", None),
    ("plan_code", PLAN, None),
    ("ddl_eligibility_status", "CASE WHEN o_orderstatus = 'O' THEN '6' ELSE '1' END", None),
])

UTILIZATION = View("utilization", "lineitem_orders", [
    ("system", "CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'EHR2' ELSE 'EHR1' END", None),
    ("system_id", "CAST(o_custkey AS STRING)", None),
    ("client_id", "CAST(o_custkey AS STRING)", None),
    ("service", "l_returnflag", None),
    ("programgroup", "CASE l_partkey % 4 WHEN 0 THEN 'HOMEMAKER' WHEN 1 THEN 'PERSONAL CARE' "
                     "WHEN 2 THEN 'CNA SERVICES' ELSE 'RESPITE' END", None),
    ("themonth", "date_format(l_shipdate, 'yyyy-MM')", "strftime(l_shipdate, '%Y-%m')"),
    ("measure_type", "'HOURS'", None),
    ("numerator", "CAST(CAST(l_quantity AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) "
                  "* CASE WHEN l_returnflag = 'R' THEN 0.4 ELSE 1.0 END AS DECIMAL(18,4))", None),
    ("denominator", "CAST(l_quantity AS DECIMAL(18,4))", None),
    ("active_status", "1", None),
    ("frq_entered", "1", None),
    ("no_outliers", "CASE WHEN l_discount = 0 THEN 0 ELSE 1 END", None),
    ("no_duplicate_systems", "1", None),
])

OVERTIME_REPORTS = View("overtime_reports", "lineitem", [
    ("nurse_id", "CAST(l_suppkey AS STRING)", None),
    ("weekstart", "CAST(date_trunc('week', l_shipdate) AS DATE)", None),
    ("reportdate", "date_add(CAST(date_trunc('week', l_shipdate) AS DATE), 10)",
     "CAST(date_trunc('week', l_shipdate) AS DATE) + 10"),
], where="l_quantity >= 45", distinct=True)

# Previous county snapshot: every patient one nation over (so region, and
# with it the DENVER class, moves for some), HOUSEHOLD customers absent (new).
PREV_COUNTY = View("prev_county", "customer_moved", [
    ("patient_number", "CAST(c_custkey AS STRING)", None),
    ("residency_codes", "CAST(n_nationkey AS STRING)", None),
    ("residency_desc", "CASE WHEN n_regionkey = 1 THEN 'CO-DENVER COUNTY' ELSE n_name END", None),
    ("county", "CASE WHEN n_regionkey = 1 THEN 'DENVER' ELSE 'NON-DENVER' END", None),
], where="c_mktsegment <> 'HOUSEHOLD'")

# Vendor API answers, at most one per task id: success with a quoted task
# number, an error with a message, or an error with neither (quirk Q12
# inputs). Small low-priority orders' tasks got no answer in this batch
# and must stay queued, untouched.
_ASSIGNEE = ("CASE WHEN o_orderstatus = 'O' THEN concat('U', CAST(o_custkey % 10 AS STRING)) "
             "ELSE 'CaseManager' END")
RESPONSES = View("responses", "orders", [
    ("taskid", "o_orderkey", None),
    ("response", "CASE WHEN o_custkey % 10 = 7 THEN concat('{\"statusCode\":400,\"detailedMessage\":\"Assignee ', "
                 + _ASSIGNEE + ", ' <not> & found\"}') "
                 "WHEN o_custkey % 10 = 3 THEN '{\"statusCode\":500}' "
                 "ELSE concat('{\"statusCode\":200,\"data\":\"Task ', chr(39), CAST(o_orderkey * 7 AS STRING), "
                 "chr(39), ' created\"}') END", None),
], where="NOT (o_orderpriority = '5-LOW' AND o_totalprice < 100000)")

# Assignee type names by id (the lookup the payload builder resolves).
ASSIGNEE_TYPES = View("assignee_types", "region", [
    ("id", "r_regionkey", None),
    ("type", "CASE r_regionkey WHEN 1 THEN 'CaseManager' WHEN 2 THEN 'Role' WHEN 3 THEN 'User' ELSE r_name END",
     None),
])

_PRICE_TXT = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)"
_TOTAL = "CAST(l_quantity AS DECIMAL(12,0)) * CAST(l_extendedprice AS DECIMAL(12,2))"

# Sales rows as text, as a delimited file would deliver them; one "file" per
# ship year. Spoiled on purpose: '5.0' and empty quantities, NaN/exponent/
# thousands-comma prices, wrong and 3-decimal totals, invalid calendar days,
# the three accepted date layouts; sale_id repeats (lines of one order).
RAW_SALES = View("raw_sales", "lineitem", [
    ("sale_id", "concat('S-', CAST(l_orderkey AS STRING))", None),
    ("customer_name", "concat('Customer ', CAST(l_suppkey AS STRING))", None),
    ("product", "concat('Part ', CAST(l_partkey AS STRING))", None),
    ("quantity", "CASE WHEN l_linenumber = 7 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '.0') "
                 "WHEN l_returnflag = 'R' AND l_linenumber = 5 THEN '' "
                 "ELSE concat(' ', CAST(CAST(l_quantity AS INT) AS STRING), ' ') END", None),
    ("unit_price", "CASE WHEN l_linenumber = 6 AND l_extendedprice >= 1000 THEN "
                   "concat(CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS STRING), ',', right("
                   + _PRICE_TXT + ", 6)) "
                   "WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN 'NaN' "
                   "WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN concat(" + _PRICE_TXT + ", 'e0') "
                   "ELSE " + _PRICE_TXT + " END", None),
    ("total_amount", "CASE WHEN l_linenumber = 5 THEN CAST(" + _TOTAL + " + 0.01 AS STRING) "
                     "WHEN l_linenumber = 2 THEN concat(CAST(" + _TOTAL + " AS STRING), '5') "
                     "WHEN l_linestatus = 'O' AND l_linenumber = 1 AND l_returnflag = 'N' THEN 'abc' "
                     "ELSE CAST(" + _TOTAL + " AS STRING) END", None),
    ("sale_date", "CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 "
                  "THEN concat(CAST(year(l_shipdate) AS STRING), '-02-30') "
                  "WHEN l_linenumber % 3 = 0 THEN date_format(l_shipdate, 'yyyy-MM-dd') "
                  "WHEN l_linenumber % 3 = 1 THEN date_format(l_shipdate, 'MM/dd/yyyy') "
                  "ELSE date_format(l_shipdate, 'd-M-yyyy') END",
     "CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 "
     "THEN concat(CAST(year(l_shipdate) AS STRING), '-02-30') "
     "WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') "
     "WHEN l_linenumber % 3 = 1 THEN strftime(l_shipdate, '%m/%d/%Y') "
     "ELSE strftime(l_shipdate, '%-d-%-m-%Y') END"),
    ("region", "l_returnflag", None),
    ("salesperson", "concat('Rep ', l_linestatus)", None),
    ("source_file", "concat('sales', CAST(year(l_shipdate) AS STRING), '.txt')", None),
    ("ord1", "l_orderkey", None),
    ("ord2", "l_linenumber", None),
    ("ord3", "l_partkey", None),
    ("ord4", "l_suppkey", None),
])

# Keys already in the target sales table: finished orders.
SALES_TARGET = View("sales_target", "orders", [
    ("sale_id", "concat('S-', CAST(o_orderkey AS STRING))", None),
], where="o_orderstatus = 'F'")

ALL_VIEWS = {v.name: v for v in [
    PATIENTS, RESIDENCY, EMPLOYEES, USERS, ADMISSIONS, CERTIFICATIONS, TASK_ENTRIES, VISITS,
    HOLD_REPORTS, COMM_LOGS, TASK_LOG, VENDOR_ENTRIES, ELIGIBILITY, UTILIZATION, OVERTIME_REPORTS,
    PREV_COUNTY, RESPONSES, ASSIGNEE_TYPES, RAW_SALES, SALES_TARGET]}


def care_tables(t: Tables) -> Tables:
    """Lazy care-operations tables derived from driver tables ``t``."""
    return Tables({name: (lambda v=v: v.spark(t)) for name, v in ALL_VIEWS.items()})


def duck_with(*names: str) -> str:
    """``WITH`` prefix defining the named views for an oracle query."""
    return "WITH " + ",\n".join(ALL_VIEWS[n].duck_cte() for n in names)
