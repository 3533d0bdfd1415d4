"""Quarterly-visit compliance.

``compliance_check`` expands every active admission into the visits its
certification group requires, matches scheduled tasks, keeps the newest task
per patient and item and reports gaps. ``task_actions`` turns that report into
a corrective action per row. Every step is a DataFrame transformation; the
two constant mapping tables are the only broadcasts (fixed 17 and 8 rows).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators import core as O
from ..sources import constants as K


def _first_of_month(as_of: datetime) -> Column:
    return D.month_start(D.ts_lit(as_of))


def ranked_tasks(adm: DataFrame, cer: DataFrame, wft: DataFrame, as_of: datetime,
                 spark: SparkSession | None = None) -> DataFrame:
    """Required-item expansion (D16) + task match (D2) + newest per item (F1).

    Returns one row per (patient, task item) -- the ``row_num = 1`` rows.
    """
    spark = spark or adm.sparkSession
    now = D.ts_lit(as_of)
    cg = K.cert_groups(spark).withColumn("_cg_key", T.norm("cert_code"))
    tk = K.group_tasks(spark)

    a = adm.select("patient_number", "admission_number", "facility_code", "discharge_code")
    c = cer.select(F.col("patient_number").alias("_c_pat"), F.col("admission_number").alias("_c_adm"),
                   "certification_code", "certification_from", "certification_thru")
    # WHERE predicates on the admission and certification are pushed below the
    # joins by Catalyst (the LEFT JOIN to cer becomes inner: §1.4).
    a = a.where(~T.ci_like("discharge_code", "D%")
                & ~T.ci_in("discharge_code", ["PA", "CL"])
                & (F.trim("patient_number") != F.lit("154"))
                & T.ci_in(F.trim("facility_code"), K.CHECK_FACILITIES))
    c = c.where(now.between(F.col("certification_from").cast("date"),
                            F.col("certification_thru").cast("date"))
                & ~F.upper(F.trim("certification_code")).isin(K.NON_CARE_CERT_CODES)
                & (F.trim("certification_code") != F.lit("")))
    base = (a.join(c, (a.patient_number == c._c_pat) & (a.admission_number == c._c_adm), "inner")
            .join(cg, T.norm("certification_code") == cg._cg_key, "left")
            .join(tk, "the_group", "left"))

    in_f1 = (F.col("frequency_type") == 1) & F.col("start_date").between(D.add_days(now, -60), D.add_days(now, 420))
    in_f2 = ((F.col("frequency_type") == 2)
             & F.col("start_date").between(D.add_days(now, -422), D.add_days(now, 420))
             & (F.col("end_date") > now))
    t = wft.select(F.col("patient_number").alias("_t_pat"), F.col("admission_number").alias("_t_adm"),
                   "wf_task_number", "wf_task_code", "start_date", "end_date", "frequency_type",
                   "cb_completed", "cb_skipped", "cb_deleted").where(in_f1 | in_f2)
    cond = ((base.patient_number == t._t_pat) & (base.admission_number == t._t_adm)
            & (T.ci_like_col(t.wf_task_code, F.concat(F.lit("%"), base.task_item, F.lit("%")))
               | base.task_item.isNull()))
    j = base.join(t, cond, "left")
    keep = (F.col("start_date").isNull() | in_f1
            | (in_f2 & (F.col("cb_completed") == 0) & (F.col("cb_skipped") == 0) & (F.col("cb_deleted") == 0)))
    j = j.where(keep)

    rolled = F.when((F.col("frequency_type") == 2) & (F.col("start_date") < _first_of_month(as_of)),
                    D.add_days(F.col("start_date"), 365)).otherwise(F.col("start_date"))
    # Total order (quirk Q15): newest start first, then admission and task id.
    w = W.partitionBy("patient_number", "task_item").orderBy(
        F.col("start_date").desc_nulls_last(), F.col("admission_number").asc(),
        F.col("wf_task_number").asc_nulls_first())
    return (j.withColumn("row_num", F.row_number().over(w))
             .where(F.col("row_num") == 1)
             .select("patient_number", "admission_number", "the_group", "facility_code",
                     "discharge_code", "task_item", "wf_task_number", "wf_task_code", rolled.alias("start_date")))


def compliance_check(adm: DataFrame, cer: DataFrame, wft: DataFrame, pat: DataFrame,
                     as_of: datetime, sort: bool = True, with_code: bool = False) -> DataFrame:
    """Required quarterly visits vs scheduled tasks (12 columns).

    ``with_code`` adds the scheduled task's own code as ``wf_task_code``, which spares ``task_actions`` a read of the task table.
    """
    rt = ranked_tasks(adm, cer, wft, as_of)
    p = pat.select(F.col("patient_number").alias("_p_pat"), "first_name", "last_name")
    j = rt.join(p, rt.patient_number == p._p_pat, "left")
    by_pat = W.partitionBy("patient_number")
    order = [F.col("start_date").asc_nulls_first(), F.col("task_item").asc_nulls_first(),
             F.col("admission_number").asc(), F.col("wf_task_number").asc_nulls_first()]
    w_last = by_pat.orderBy(*order)
    w_next = W.partitionBy("patient_number", "admission_number").orderBy(*order)
    out = j.select(
        T.last_first("first_name", "last_name").alias("patient_name"),
        "patient_number", "admission_number",
        (F.lit(K.REQUIRED_ITEMS_PER_GROUP) - F.count("wf_task_number").over(by_pat)).cast("bigint")
        .alias("number_of_missing_tasks"),
        "the_group", "facility_code", "discharge_code", "task_item", "wf_task_number",
        D.local_to_utc(F.col("start_date")).alias("start_date"),
        D.day_diff(F.lag("start_date").over(w_last), F.col("start_date")).alias("days_from_last"),
        D.day_diff(F.col("start_date"), F.lead("start_date").over(w_next)).alias("days_until_next"),
        "last_name", "first_name", F.col("start_date").alias("_local_start"), *(["wf_task_code"] if with_code else []))
    if sort:
        out = out.orderBy(F.col("last_name").asc_nulls_first(), F.col("first_name").asc_nulls_first(),
                          F.col("_local_start").asc_nulls_first())
    return out.drop("last_name", "first_name", "_local_start")


# ---- fixed values: item -> month offset of the corrected due date (J7) ----
DUE_OFFSETS = [("%ANNUAL%", 9), ("%3MO%", 0), ("%6MO%", 3), ("%9MO%", 6)]
# ---- fixed values: expected vendor task codes (J8); note the trailing blank
# on the 3MO code and the en dash in the HMA annual code ----
CODE_3MO = "HCA 3MO SUPER "
CODE_6MO = "HCA 6MO SUPER"
CODE_9MO = "HCA 9MO SUPER"
CODE_ANNUAL_NON_HMA = "NON-HMA HCA ANNUAL VISIT"
CODE_ANNUAL_HMA = "HCA ANNUAL VISIT – RN/CC IN PERS"
# ---- fixed values: action labels (J11) ----
ACTION_OK = "Existing task is good, no action"
ACTION_WRONG_ANNUAL = "Wrong annual visit HMA/nonHMA type - Delete existing task and create new task"
ACTION_WRONG_DUE = "Incorrect due date - Delete existing task and create new task"
ACTION_CREATE = "No visit scheduled or existing task - Create new task"
ACTION_UNKNOWN = "Unknown, needs review"
# ---- fixed values: sibling item -> months added, per missing item (J9) ----
FALLBACK_PLAN = {
    "%ANNUAL%": [("%9MO%", 3), ("%6MO%", 6), ("%3MO%", 9)],
    "%3MO%": [("%ANNUAL%", 3), ("%9MO%", 6), ("%6MO%", 9)],
    "%6MO%": [("%3MO%", 3), ("%ANNUAL%", 6), ("%9MO%", 9)],
    "%9MO%": [("%6MO%", 3), ("%3MO%", 6), ("%ANNUAL%", 9)],
}
LATEST_PLAN = {
    "%ANNUAL%": [("%9MO%", 3), ("%6MO%", 6), ("%3MO%", 9), ("%ANNUAL%", 12)],
    "%3MO%": [("%ANNUAL%", 3), ("%9MO%", 6), ("%6MO%", 9), ("%3MO%", 12)],
    "%6MO%": [("%3MO%", 3), ("%ANNUAL%", 6), ("%9MO%", 9), ("%6MO%", 12)],
    "%9MO%": [("%6MO%", 3), ("%3MO%", 6), ("%ANNUAL%", 9), ("%9MO%", 12)],
}
STAGGER_MONTHS = {"%ANNUAL%": 0, "%3MO%": 3, "%6MO%": 6, "%9MO%": 9}
ITEM_KEYS = {"%ANNUAL%": "annual", "%3MO%": "m3", "%6MO%": "m6", "%9MO%": "m9"}


def latest_task(wft: DataFrame, as_of: datetime) -> DataFrame:
    """Newest HCA task date and highest task id per admission, and the code of the
    entry that has both (the maxima are independent: quirk Q7).

    One aggregation, no join back: an entry has both maxima exactly if the highest id among the newest date's
    entries is the highest of all. Task numbers are the vendor's key, so there is one such entry at most.
    """
    hca = wft.where(T.ci_like("wf_task_code", "HCA %") & (F.col("start_date") < D.ts_lit(as_of)))
    newest = F.max(F.struct("start_date", "wf_task_number", "wf_task_code")).alias("_newest")
    agg = hca.groupBy("patient_number", "admission_number").agg(F.max("wf_task_number").alias("latest_task_id"), newest)
    both = F.when(F.col("_newest.wf_task_number") == F.col("latest_task_id"), F.col("_newest.wf_task_code"))
    return agg.select("patient_number", "admission_number", F.col("_newest.start_date").alias("latestitemdate"),
                      "latest_task_id", both.alias("latest_task"))


def cert_summary(check: DataFrame, cer: DataFrame, as_of: datetime) -> DataFrame:
    """Latest certification window and service type per patient.

    HMA when any qualifying certification code contains IHSS (E10). The
    first OR arm of the source's window test is implied by the third and is
    dropped (C8).
    """
    now = D.ts_lit(as_of)
    d_from, d_thru = F.col("certification_from").cast("date"), F.col("certification_thru").cast("date")
    c = cer.where((now.between(d_from, d_thru) | D.add_days(now, 365).between(d_from, d_thru))
                  & ~F.upper(F.trim("certification_code")).isin(K.NON_CARE_CERT_CODES)
                  & (F.trim("certification_code") != F.lit("")))
    adm = check.select(F.col("admission_number").alias("_k_adm")).distinct()
    c = c.join(adm, c.admission_number == adm._k_adm, "left_semi")
    return c.groupBy("patient_number").agg(
        F.max("certification_from").alias("certification_from"),
        F.max("certification_thru").alias("certification_thru"),
        F.when(O.any_match(F.trim("certification_code"), "%IHSS%"), F.lit("HMA")).otherwise(F.lit("Non_HMA"))
        .alias("servicetype"))


def correct_due(thru: Column, item: Column, as_of: datetime) -> Column:
    """Thru + 1 day - 1 year + item offset; +12 months if before this month."""
    base = D.add_months(D.add_days(thru, 1), -12)
    fom = _first_of_month(as_of)
    out = None
    for pat, k in DUE_OFFSETS:
        v = F.when(D.add_months(base, k) < fom, D.add_months(base, k + 12)).otherwise(D.add_months(base, k))
        out = (F.when(T.ci_like(item, pat), v) if out is None else out.when(T.ci_like(item, pat), v))
    return out.cast("date")


def expected_code(item: Column, servicetype: Column) -> Column:
    """Vendor task code the item should be scheduled under."""
    annual = F.when(servicetype == "Non_HMA", F.lit(CODE_ANNUAL_NON_HMA)).otherwise(F.lit(CODE_ANNUAL_HMA))
    return (F.when(T.ci_like(item, "%3MO%"), F.lit(CODE_3MO))
             .when(T.ci_like(item, "%6MO%"), F.lit(CODE_6MO))
             .when(T.ci_like(item, "%9MO%"), F.lit(CODE_9MO))
             .when(T.ci_like(item, "%ANNUAL%"), annual))


def prepare_actions(check: DataFrame, cer: DataFrame, wft: DataFrame | None, as_of: datetime) -> DataFrame:
    """Check rows with their certification summary and the J7/J8 columns; with ``wft`` also the latest task."""
    c2 = cert_summary(check, cer, as_of).withColumnRenamed("patient_number", "_c2_pat")
    code = ["wf_task_code"] if "wf_task_code" in check.columns else []
    tt = check.select("patient_number", "admission_number", "task_item", "wf_task_number", "start_date", *code)
    j = tt.join(c2, tt.patient_number == c2._c2_pat, "left")
    if wft is not None:
        lt = latest_task(wft, as_of).select(F.col("patient_number").alias("_lt_pat"),
                                            F.col("admission_number").alias("_lt_adm"),
                                            "latestitemdate", "latest_task")
        j = j.join(lt, (tt.patient_number == lt._lt_pat) & (tt.admission_number == lt._lt_adm), "left")
    return j.select("*", correct_due(F.col("certification_thru"), F.col("task_item"), as_of).alias("correctduedate"),
                    D.utc_to_local(F.col("start_date")).cast("date").alias("wft_due_date"),
                    expected_code(F.col("task_item"), F.col("servicetype")).alias("task_code"))


def fallback_due(check: DataFrame, cer: DataFrame, wft: DataFrame, as_of: datetime) -> DataFrame:
    """Due date for a missing visit from its siblings (Q5: own operator).

    The source runs 24 correlated scalar subqueries against the check
    result; here the sibling dates are pivoted once per admission
    (``groupBy + max(when)``) and joined back -- one aggregation and one
    equi-join instead of 24 lookups.
    """
    t2 = prepare_actions(check, cer, wft, as_of)
    sib = check.groupBy(F.col("patient_number").alias("_s_pat"), F.col("admission_number").alias("_s_adm")).agg(
        *[F.max(F.when(T.ci_like("task_item", pat), F.col("start_date"))).alias(f"sib_{key}")
          for pat, key in ITEM_KEYS.items()])
    j = t2.join(sib, (t2.patient_number == sib._s_pat) & (t2.admission_number == sib._s_adm), "left")
    now = D.ts_lit(as_of)
    recent = F.col("latestitemdate") > D.add_months(now, -2)
    week_n = F.right(F.col("patient_number"), F.lit(1)).try_cast("int")
    stagger = D.add_days(D.add_days(now, 21), week_n * 7)

    def chain(item_pat: str) -> Column:
        out = None
        for sib_pat, k in FALLBACK_PLAN[item_pat]:
            s = F.col(f"sib_{ITEM_KEYS[sib_pat]}")
            out = F.when(s.isNotNull(), D.add_months(s, k)) if out is None else out.when(s.isNotNull(), D.add_months(s, k))
        for code_pat, k in LATEST_PLAN[item_pat]:
            out = out.when(T.ci_like("latest_task", code_pat) & recent, D.add_months(F.col("latestitemdate"), k))
        return out.otherwise(D.add_months(stagger, STAGGER_MONTHS[item_pat]))

    annual_wrong = (((F.col("servicetype") == "Non_HMA") & (F.col("latest_task") != F.lit(CODE_ANNUAL_NON_HMA)))
                    | ((F.col("servicetype") == "HMA") & (F.col("latest_task") != F.lit(CODE_ANNUAL_HMA))))
    no_start = F.col("start_date").isNull()
    due = (F.when((T.ci_like("task_item", "%ANNUAL%") & no_start) | F.coalesce(annual_wrong, F.lit(False)),
                  chain("%ANNUAL%"))
            .when(T.ci_like("task_item", "%3MO%") & no_start, chain("%3MO%"))
            .when(T.ci_like("task_item", "%6MO%") & no_start, chain("%6MO%"))
            .when(T.ci_like("task_item", "%9MO%") & no_start, chain("%9MO%"))
            .otherwise(F.col("start_date")))
    return j.select("patient_number", "admission_number", "task_item", "wf_task_number",
                    D.utc_to_local(due).cast("date").alias("due"))


def task_actions(check: DataFrame, cer: DataFrame, wft: DataFrame, adm: DataFrame, employees: DataFrame,
                 users: DataFrame, as_of: datetime, sort: bool = True) -> DataFrame:
    """J10 + J11: corrective action per compliance row.

    ``ok`` = the scheduled task has the expected code (or any non-annual
    code) and sits in the corrected due month. Unresolved care managers
    fall back to the manager queue (UNSMGR).
    """
    t2 = prepare_actions(check, cer, None, as_of).where(F.col("correctduedate").isNotNull())
    a = adm.select(F.col("admission_number").alias("_a_adm"), F.col("nurse_id").alias("_cm1_id"),
                   F.col("nurse_id_arr7_2").alias("_cm3_id"))
    j = t2.join(a, t2.admission_number == a._a_adm, "left")
    j = O.with_user_code(j, employees, users, "_cm1_id", "cm1_")
    j = O.with_user_code(j, employees, users, "_cm3_id", "cm3_")
    if "wf_task_code" in check.columns:
        j = j.withColumnRenamed("wf_task_code", "entry_code")
    else:
        wte = wft.select(F.col("wf_task_number").alias("_e_num"), F.col("wf_task_code").alias("entry_code"))
        j = j.join(wte, j.wf_task_number == wte._e_num, "left")

    due = F.trunc(F.col("correctduedate"), "MM")
    ok = F.coalesce((T.ci_eq("task_code", F.col("entry_code"))
                     | (F.col("entry_code").isNotNull() & ~T.ci_like("entry_code", "%ANNUAL%")))
                    & (due == F.col("wft_due_date")), F.lit(False))
    use3 = T.ci_like("task_code", "%annual%") & (F.col("servicetype") == "HMA")

    def blank(c: str) -> Column:
        return F.coalesce(F.trim(F.col(c)), F.lit("")) == ""

    unres1 = (blank("cm1_first_name") & blank("cm1_last_name")) | F.col("cm1_user_code").isNull()
    unres3 = (blank("cm3_first_name") & blank("cm3_last_name")) | F.col("cm3_user_code").isNull()
    name1 = T.full_name("cm1_first_name", "cm1_last_name")
    name3 = T.full_name("cm3_first_name", "cm3_last_name")
    short = F.when(T.ci_like("task_code", "%MO%"), F.left(F.trim("task_code"), F.lit(7))) \
             .otherwise(F.left(F.trim("task_code"), F.lit(10)))
    notes = F.when(ok, F.lit("")).otherwise(F.concat(F.lit("Client needs an "), short,
                                                     F.lit(" visit scheduled for the assigned due date.")))
    t3 = j.select(
        "wf_task_number", F.col("entry_code").alias("wf_task_code"), "servicetype", "task_code",
        due.alias("due"), "wft_due_date",
        F.col("certification_from").cast("date").alias("certification_from"),
        F.col("certification_thru").cast("date").alias("certification_thru"),
        "patient_number", "admission_number", notes.alias("notes"),
        F.when(ok, F.lit(None).cast("int"))
         .when(use3, F.when(unres3, F.lit(2)).otherwise(F.lit(3)))
         .otherwise(F.when(unres1, F.lit(2)).otherwise(F.lit(3))).alias("grp1_type1"),
        F.when(ok, F.lit(""))
         .when(use3, F.when(unres3, F.lit("UNSMGR")).otherwise(F.col("cm3_user_code")))
         .otherwise(F.when(unres1, F.lit("UNSMGR")).otherwise(F.col("cm1_user_code"))).alias("grp1_assignee1"),
        F.when(ok, F.lit("")).otherwise(F.lit(K.STATUS_PENDING)).alias("status"),
        F.when(ok, F.lit(""))
         .when(use3, F.when(unres3, F.lit("UNASSIGNED MGR")).otherwise(name3))
         .otherwise(F.when(unres1, F.lit("UNASSIGNED MGR")).otherwise(name1)).alias("assignee_casemanager_name"),
    ).distinct()
    has = F.col("wf_task_number").isNotNull()
    action = (F.when(has & (F.col("notes") == ""), F.lit(ACTION_OK))
               .when(has & (F.col("notes") != "") & F.coalesce(~T.ci_eq("wf_task_code", F.col("task_code")), F.lit(False))
                     & T.ci_like("task_code", "%ANNUAL%"), F.lit(ACTION_WRONG_ANNUAL))
               .when(has & (F.col("notes") != "") & F.coalesce(F.col("due") != F.col("wft_due_date"), F.lit(False)),
                     F.lit(ACTION_WRONG_DUE))
               .when(~has, F.lit(ACTION_CREATE))
               .otherwise(F.lit(ACTION_UNKNOWN)))
    out = t3.select(action.alias("action"), "*")
    if sort:
        out = out.orderBy(F.col("patient_number").asc_nulls_first(), F.col("due").asc_nulls_first())
    return out
