"""Rule queries that generate workflow tasks.

Each trigger is ``(care tables, task log, as_of, ...) -> DataFrame`` of new
task rows (``schemas.NEW_TASK_COLUMNS``). Calendar gates (C15) are decided on
the driver from the scalar ``as_of`` -- a closed gate returns an empty frame
of the task schema without touching any data. Assignees that the source
redacted are parameters.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import parse as P
from ..functions import text as T
from ..operators import core as O
from ..operators.pages import paged_text
from ..schemas import empty_tasks, task_rows
from ..sources import constants as K
from ..sources.tables import Tables

# ---- fixed values: task codes and note texts of the rules ----
HOLD_NOTE_TEXT = ("This client has been placed on hold. Please add a note to Patient Log with today's date, "
                  "the client admission number, and the communication category 'HOL' with information on "
                  "client status")
TO_DENVER_TEXT = "Client county changed to a DENVER COUNTY RESIDENCE from a NON-DENVER COUNTY"
TO_NON_DENVER_TEXT = "Client county changed to a NON-DENVER COUNTY RESIDENCY from a DENVER COUNTY"
LOST_ELIG_PREFIX = "Client has lost eligibility as of last eligibility run on "
LOST_ELIG_SUFFIX = ". Please verify with your manager to check if this client should be placed on hold."
OVER_UTIL_PREFIX = "Overutilization Report for Previous Month: "
UNDER_UTIL_PREFIX = "Underutilization Report for Previous Quarter: "
OT_WEEK_PREFIX = "Overtime Notice for Following Employee(s): "
NOT_DIV_PREFIX = ("There are visit(s) on these dates over the next two weeks that have a duration not "
                  "divisible by 15 minutes: ")
DENVER_DESC = "CO-DENVER COUNTY"
UTIL_SYSTEM = "EHR1"          # source-system value of the utilisation rows the rules read
EXCLUDED_PATIENTS = ["154", "15201"]


# ---------------------------------------------------------------- gates
def gate(as_of: datetime, rule: str) -> bool:
    """Calendar gate of a rule, evaluated once on the driver."""
    if rule == "day15":
        return as_of.day == 15
    if rule == "quarter_day15":
        return as_of.day == 15 and as_of.month in (1, 4, 7, 10)
    if rule == "day1_or_15":
        return as_of.day in (1, 15)
    if rule == "thursday":
        return as_of.weekday() == 3
    if rule == "tuesday":
        return as_of.weekday() == 1
    return True


def _today(as_of: datetime):
    return D.date_lit(as_of)


# ------------------------------------------------------------------ J12
def add_hold_note(c: Tables, log: DataFrame, as_of: datetime) -> DataFrame:
    """ADD HOLD NOTE: on-hold admissions with no recent HOL note."""
    notes = c["comm_logs"].where(T.ci_eq("communication_ctg_code", "HOL") & (F.col("cb_delete") == 0))
    # newest note per patient; the join keeps only note number 1.
    newest = O.newest_per_group(
        notes, ["patient_number"],
        [F.col("communication_date_time").desc(), F.col("note_id").desc()]).select(
        F.col("admission_number").alias("_n_adm"),
        F.col("communication_date_time").cast("date").alias("communication_date"))
    adm = c["admissions"].where(T.ci_like("discharge_code", "H%")).select("patient_number", "admission_number")
    hol = c["hold_reports"].select(F.col("admission_number").alias("_h_adm"), "hold_report_date", "hold_end_date")
    a = adm.join(hol, adm.admission_number == hol._h_adm, "left").where(F.col("hold_end_date").isNull())
    bound = F.date_sub(F.col("hold_report_date"), 1)
    # LEFT JOIN ... WHERE note IS NULL == anti join.
    a = a.join(newest, (a.admission_number == newest._n_adm) & (newest.communication_date >= bound), "left_anti")
    a = O.reopen_guard(a, log, "ADD HOLD NOTE", [("admission_number", "admission_number")], bound, mode="any")
    return task_rows(a, task_code="ADD HOLD NOTE", due=F.date_add(_today(as_of), 7),
                     patient_number=F.col("patient_number"), admission_number=F.col("admission_number"),
                     notes=HOLD_NOTE_TEXT, grp1_type1=1, grp1_assignee1="CaseManager",
                     status=K.STATUS_PENDING).distinct()


# ------------------------------------------------------------------ J13
def county_now(c: Tables) -> DataFrame:
    """Current county class per patient/admission (J13 ``#county``)."""
    pat = c["patients"].select("patient_number", "residency_codes")
    cde = c["residency"].select(F.col("residency_codes").alias("_r_codes"), "residency_desc")
    adm = c["admissions"].where(~T.ci_like("discharge_code", "D%") & ~T.ci_eq("discharge_code", "CL")).select(
        F.col("patient_number").alias("_a_pat"), "admission_number")
    j = (pat.join(cde, pat.residency_codes == cde._r_codes, "left")
            .join(adm, pat.patient_number == adm._a_pat, "inner")
            .where(F.col("residency_desc").isNotNull()))
    county = F.when(T.ci_eq("residency_desc", DENVER_DESC), F.lit("DENVER")).otherwise(F.lit("NON-DENVER"))
    return j.select("patient_number", "admission_number", "residency_codes", "residency_desc",
                    county.alias("county")).distinct()


def denver_status_change(c: Tables, snapshot: DataFrame, as_of: datetime) -> DataFrame:
    """DENVER STATUS CHANGE: county class differs from the snapshot.

    Fixes Q2 (unused fan-out join dropped, one task per admission) and Q22
    (the note describes the *new* county).
    """
    cur = county_now(c)
    changed = O.snapshot_diff(cur, snapshot, "patient_number", "county")
    note = F.when(F.col("county") == "DENVER", F.lit(TO_DENVER_TEXT)).otherwise(F.lit(TO_NON_DENVER_TEXT))
    return task_rows(changed, task_code="DENVER STATUS CHANGE", due=F.date_add(_today(as_of), 7),
                     patient_number=F.col("patient_number"), admission_number=F.col("admission_number"),
                     notes=note, grp1_type1=2, grp1_assignee1="MRPAR", grp2_type1=1,
                     grp2_assignee1="CaseManager", status=K.STATUS_PENDING).distinct()


def next_county_snapshot(c: Tables) -> DataFrame:
    """The replacement snapshot (distinct patient/residency/county)."""
    return county_now(c).select("patient_number", "residency_codes", "residency_desc", "county").distinct()


# ------------------------------------------------------------------ J14
def lost_eligibility(c: Tables, log: DataFrame, as_of: datetime) -> DataFrame:
    """LOST ELIGIBILITY: status 6 in the latest eligibility run."""
    elg = c["eligibility"]
    latest = elg.agg(F.max("entry_date")).scalar()  # uncorrelated scalar subquery (C14)
    e = elg.where((F.col("entry_date") == latest) & (F.col("ddl_eligibility_status") == "6")).select(
        F.col("entry_date").cast("date").alias("entry_date"), F.col("patient_number").alias("_e_pat"), "plan_code")
    adm = c["admissions"].where(~T.ci_like("discharge_code", "D%")
                                & ~T.ci_in("facility_code", K.SKILLED_FACILITIES)).select(
        "patient_number", "admission_number", "primary_plan")
    j = e.join(adm, (e._e_pat == adm.patient_number) & (e.plan_code == adm.primary_plan), "inner")
    j = O.reopen_guard(j, log, "LOST ELIGIBILITY", [("admission_number", "admission_number")], F.col("entry_date"),
                       mode="any")
    note = T.concat_nn(LOST_ELIG_PREFIX, F.col("entry_date").cast("string"), LOST_ELIG_SUFFIX)
    return task_rows(j, task_code="LOST ELIGIBILITY", due=F.date_add(_today(as_of), 7),
                     patient_number=F.col("patient_number"), admission_number=F.col("admission_number"),
                     notes=note, grp1_type1=1, grp1_assignee1="CaseManager", status=K.STATUS_PENDING).distinct()


# ------------------------------------------------------------------ J15/J16
def _util(c: Tables, as_of: datetime, by_month: bool) -> DataFrame:
    now = D.ts_lit(as_of)
    fu = c["utilization"].where(
        T.ci_eq("system", UTIL_SYSTEM) & (F.col("active_status") == 1) & (F.col("frq_entered") == 1)
        & (F.col("no_outliers") == 1) & (F.col("no_duplicate_systems") == 1)
        & F.col("themonth").between(D.year_month(D.add_days(now, -90)), D.year_month(D.add_days(now, -30))))
    keys = ["system", "system_id", "client_id", "service", "programgroup"] + (["themonth"] if by_month else []) \
        + ["measure_type"]
    # Whole decimals: a ratio that is exactly a threshold must not pass it by a rounding error.
    total = lambda c: F.sum(F.col(c).cast("decimal(24,6)"))
    return fu.groupBy(*keys).agg(total("numerator").alias("billed_hrs"), total("denominator").alias("auth_hrs"))


def _util_admissions(c: Tables) -> DataFrame:
    adm = c["admissions"].select("patient_number", "facility_code", "admission_number", "nurse_id")
    nur = c["employees"].select(F.col("nurse_id").alias("_n_id"), "first_name", "last_name")
    j = adm.join(nur, adm.nurse_id == nur._n_id, "left")
    return j.select("patient_number", "facility_code", "admission_number", "nurse_id",
                    T.last_first("first_name", "last_name").alias("coordinator"))


def util_client_lines(c: Tables, as_of: datetime, over: bool) -> DataFrame:
    """One line per client with its programs (the inner string_agg, E9): nurse_id, _agg."""
    util = _util(c, as_of, by_month=over)
    adm = _util_admissions(c).where(~T.ci_in("facility_code", K.SKILLED_FACILITIES))
    pat = c["patients"].select(F.col("patient_number").alias("_p_pat"), F.trim("last_name").alias("client_last_name"))
    j = (util.join(adm, util.system_id == adm.patient_number, "left")
             .join(pat, util.system_id == pat._p_pat, "left"))
    if over:
        latest = util.agg(F.max("themonth")).scalar()  # uncorrelated scalar subquery (C14)
        j = j.where((F.col("themonth") == latest) & O.ratio_exceeds(F.col("billed_hrs"), F.col("auth_hrs"), 105))
        word = ", overutilized by "
    else:
        j = j.where(O.ratio_exceeds(-F.col("billed_hrs"), F.col("auth_hrs"), -50))
        word = ", underutilized by "
    j = j.where(~T.ci_like("programgroup", "%CNA%") & ~T.ci_like("programgroup", "%NURSING%")
                & ~T.ci_like("programgroup", "%PDN%"))
    line = T.concat_nn(F.col("programgroup"), ": ", "billed hours: ", O.dec72_text(F.col("billed_hrs")),
                       ", auth hours: ", O.dec72_text(F.col("auth_hrs")), word,
                       O.percent_over_text(F.col("billed_hrs"), F.col("auth_hrs")), "%")
    per_client = (j.withColumn("_line", line)
                   .groupBy("patient_number", "client_last_name", "admission_number", "nurse_id", "coordinator")
                   .agg(O.ordered_listagg("_line", "; ").alias("_lines")))
    per_client = per_client.withColumn("_agg", T.concat_nn("patient number ", F.trim("patient_number"), " ",
                                                           F.col("client_last_name"), ", ", F.col("_lines")))
    return per_client.select("nurse_id", "_agg")


def util_notes(c: Tables, as_of: datetime, over: bool) -> DataFrame:
    """Per-coordinator utilisation notes (the two-level string_agg, E9): one text each, as the source sends them."""
    prefix = OVER_UTIL_PREFIX if over else UNDER_UTIL_PREFIX
    return util_client_lines(c, as_of, over).groupBy("nurse_id").agg(
        T.concat_nn(prefix, O.ordered_listagg("_agg", " --- ")).alias("notes"))


def util_pages(c: Tables, as_of: datetime, over: bool, page_bytes: int = 1 << 20) -> DataFrame:
    """The notes of ``util_notes`` in bounded pages: nurse_id, page, n_lines, text. A coordinator may have any number of clients."""
    return paged_text(util_client_lines(c, as_of, over), ["nurse_id"], ["_agg"], "_agg", " --- ", page_bytes)


def _util_task(c: Tables, log: DataFrame, as_of: datetime, over: bool, assignee1: str,
               assignee2: str) -> tuple[DataFrame, DataFrame]:
    """Guarded notes (with ``nurse_id``) and the same rows as task rows."""
    notes = util_notes(c, as_of, over)
    j = O.with_user_code(notes, c["employees"], c["users"], "nurse_id", "cm_")
    # Both outputs are DISTINCT, so the guard only needs "some prior report
    # of this assignee passes": reduce the log to one row per assignee first.
    this_month = D.year_month(D.date_lit(as_of))
    prior = log.where(T.ci_eq("task_code", "UTIL REPORT")).groupBy(
        F.col("grp1_assignee1").alias("_w_assignee")).agg(
        F.max((F.col("due").isNull() | (D.year_month(F.col("due")) < this_month)).cast("int")).alias("_w_pass"))
    j = j.join(prior, j.cm_user_code == prior._w_assignee, "left")
    keep = F.col("_w_assignee").isNull() | (F.col("_w_pass") == 1)
    if not over:
        keep = keep & F.col("cm_user_code").isNotNull()
    j = j.where(keep)
    return j, task_rows(j, task_code="UTIL REPORT", due=F.date_add(_today(as_of), 14), grp1_type1=3,
                        grp1_assignee1=assignee1, grp1_type2=3, grp1_assignee2=assignee2,
                        notes=F.col("notes"), status=K.STATUS_PENDING)


def over_utilization(c: Tables, log: DataFrame, as_of: datetime, assignee1: str = "UTILMGR1",
                     assignee2: str = "UTILMGR2", limit: int | None = 1) -> DataFrame:
    """UTIL REPORT over (> 1.05 in the latest month), day 15.

    The source emits ``DISTINCT TOP 1`` without an order (Q10); we pick the
    row of the lowest coordinator id, deterministically. ``limit=None`` keeps
    every coordinator's report.
    """
    if not gate(as_of, "day15"):
        return empty_tasks(log.sparkSession)
    j, rows = _util_task(c, log, as_of, True, assignee1, assignee2)
    if limit is None:
        return rows.distinct()
    first = j.select("nurse_id", "notes").distinct().orderBy(
        F.col("nurse_id").asc_nulls_first(), F.col("notes").asc_nulls_first()).limit(limit)
    return task_rows(first, task_code="UTIL REPORT", due=F.date_add(_today(as_of), 14), grp1_type1=3,
                     grp1_assignee1=assignee1, grp1_type2=3, grp1_assignee2=assignee2,
                     notes=F.col("notes"), status=K.STATUS_PENDING)


def under_utilization(c: Tables, log: DataFrame, as_of: datetime, assignee1: str = "UTILMGR1",
                      assignee2: str = "UTILMGR2") -> DataFrame:
    """UTIL REPORT under (< 0.5 over the quarter), quarterly day 15."""
    if not gate(as_of, "quarter_day15"):
        return empty_tasks(log.sparkSession)
    _, rows = _util_task(c, log, as_of, False, assignee1, assignee2)
    return rows.distinct()


# ------------------------------------------------------------------ J17
def _visit_minutes(v: DataFrame) -> DataFrame:
    return v.withColumn("sched_min", P.hhmm_minutes(F.col("duration"))) \
            .withColumn("conf_min", P.hhmm_minutes(F.col("confirmed_duration")))


def weekly_overtime_rows(c: Tables, as_of: datetime) -> DataFrame:
    """``#ot3``: weekly overtime lines per employee (J17 body).

    Only (employee, week) pairs with an overtime report dated in the
    reporting window can survive the report join, so visits are first cut
    to those keys with a semi-join against the (small) report-key set: the
    weekly job reads recent weeks, not the whole visit history's sums.
    """
    today = _today(as_of)
    now = D.ts_lit(as_of)
    rep = c["overtime_reports"]
    wft = rep.select(F.col("nurse_id").alias("_w_nurse"), F.col("weekstart").alias("_w_week"), "reportdate") \
        .where(F.col("reportdate").between(D.add_days(now, -10), D.add_days(now, -4)))
    keys = wft.select(F.col("_w_nurse").alias("_k_nurse"), F.col("_w_week").alias("_k_week")).distinct()
    past = _visit_minutes(c["visits"]).where(F.col("schedule_date").cast("date") < today) \
        .withColumn("weekstart", D.week_start(F.col("schedule_date")))
    past = past.join(keys, (past.nurse_id == keys._k_nurse) & (past.weekstart == keys._k_week), "left_semi")
    ot = (past.where(T.ci_in("schedule_status_code", K.VISIT_STATUSES_OT))
              .groupBy("nurse_id", "weekstart")
              .agg(F.sum("conf_min").alias("conf_min"), F.sum("sched_min").alias("sched_min"))
              .where((F.col("conf_min") >= 40 * 60) & (F.col("conf_min") > F.col("sched_min"))
                     & ((F.col("conf_min") - F.col("sched_min")) > 15)))
    cor = past.select(F.col("nurse_id").alias("_c_nurse"), F.col("admission_number").alias("_c_adm"),
                      F.col("weekstart").alias("_c_week")).distinct()
    this_year = rep.where(F.year("weekstart") == as_of.year)
    wft2 = this_year.groupBy("nurse_id").agg(F.count(F.lit(1)).alias("count_num")).join(
        this_year.select("nurse_id", "weekstart"), "nurse_id").select(
        F.col("nurse_id").alias("_y_nurse"), F.col("weekstart").alias("_y_week"), "count_num")
    adm = c["admissions"].where(T.ci_in("facility_code", K.SKILLED_FACILITIES)).select(
        F.col("admission_number").alias("_a_adm"), F.col("nurse_id").alias("coordinator"))
    nur = c["employees"].where(~T.ci_eq("employee_profile_code", "CCT")).select(
        F.col("nurse_id").alias("_e_id"), "first_name", "last_name", "employee_profile_code")
    j = (ot.join(wft, (ot.nurse_id == wft._w_nurse) & (ot.weekstart == wft._w_week), "inner")
           .join(wft2, (ot.nurse_id == wft2._y_nurse) & (ot.weekstart == wft2._y_week), "left")
           .join(cor, (ot.weekstart == cor._c_week) & (ot.nurse_id == cor._c_nurse), "inner")
           .join(adm, F.col("_c_adm") == adm._a_adm, "inner")
           .join(nur, ot.nurse_id == nur._e_id, "inner"))
    j = O.with_user_code(j, c["employees"], c["users"], "coordinator", "co_")
    return j.select("nurse_id", "weekstart", "conf_min", "sched_min", "reportdate", "coordinator",
                    T.full_name("first_name", "last_name").alias("emp_name"), "employee_profile_code",
                    "count_num", F.col("co_user_code").alias("user_code")).distinct()


def weekly_overtime(c: Tables, as_of: datetime) -> DataFrame:
    """OT Alert weekly (Thursday, J17): one task per coordinator user."""
    if not gate(as_of, "thursday"):
        return empty_tasks(c["visits"].sparkSession)
    r = weekly_overtime_rows(c, as_of)
    line = T.concat_nn(F.col("emp_name"), " for the week of ", F.col("weekstart").cast("string"),
                       ". Scheduled hours: ", O.dec72_text(F.col("sched_min").cast("decimal(20,0)") / F.lit(60)),
                       " Confirmed hours: ", O.dec72_text(F.col("conf_min").cast("decimal(20,0)") / F.lit(60)), ", ",
                       O.dec72_text(F.col("conf_min") - F.col("sched_min")),
                       " minutes over. This employee has exceeded scheduled hours this year for ",
                       F.col("count_num").cast("string"), " week(s). ")
    g = r.withColumn("_line", line).groupBy("user_code").agg(
        T.concat_nn(OT_WEEK_PREFIX, O.ordered_listagg("_line", " -- ")).alias("notes"))
    return task_rows(g, task_code="OT Alert", due=_today(as_of), grp1_type1=3,
                     grp1_assignee1=F.col("user_code"), notes=F.col("notes"), status=K.STATUS_PENDING)


# ------------------------------------------------------------------ J18
def not_div_by_15(c: Tables, as_of: datetime, excluded_patients: list[str] | None = None) -> DataFrame:
    """NOT DIV BY 15 (day 1 or 15, J18): upcoming visits off the quarter hour."""
    if not gate(as_of, "day1_or_15"):
        return empty_tasks(c["visits"].sparkSession)
    now = D.ts_lit(as_of)
    excl = excluded_patients if excluded_patients is not None else ["[REDACTED]"]
    sch = c["visits"].select("patient_number", "admission_number", "schedule_date", "duration")
    sch = sch.where(F.col("schedule_date").cast("date").between(D.add_days(now, 1), D.add_days(now, 14))
                    & ~F.right(F.trim("duration"), F.lit(2)).isin(K.QUARTER_MINUTES)
                    & ~F.trim("patient_number").isin(excl))
    adm = c["admissions"].select(F.col("admission_number").alias("_a_adm"), "nurse_id")
    pat = c["patients"].select(F.col("patient_number").alias("_p_pat"), "first_name", "last_name")
    # Q11: the discharge-style test is applied to the admission number.
    j = (sch.join(adm, sch.admission_number == adm._a_adm, "inner").where(~T.ci_like("_a_adm", "D%"))
            .join(pat, sch.patient_number == pat._p_pat, "left"))
    vis = j.select("patient_number", "admission_number", "nurse_id",
                   T.full_name("first_name", "last_name").alias("clientname"),
                   F.col("schedule_date").cast("date").cast("string").alias("sched")).distinct()
    g = vis.groupBy("patient_number", "admission_number", "nurse_id", "clientname").agg(
        T.concat_nn(NOT_DIV_PREFIX, O.ordered_listagg("sched", "; ")).alias("notes"))
    return task_rows(g, task_code="NOT DIV BY 15", due=_today(as_of), patient_number=F.col("patient_number"),
                     admission_number=F.col("admission_number"), notes=F.col("notes"), grp1_type1=1,
                     grp1_assignee1="CaseManager", status=K.STATUS_PENDING)


# ------------------------------------------------------------------ J19/J20
def _open_admissions(adm: DataFrame) -> DataFrame:
    return adm.where(~T.ci_like("discharge_code", "D%") & ~T.ci_like("discharge_code", "%PA%")
                     & ~T.ci_like("discharge_code", "%CL%"))


def assign_coordinator(c: Tables, log: DataFrame, as_of: datetime, skilled_assignee: str = "SKMGR") -> DataFrame:
    """ASSIGN COORDINATOR: open admissions with a blank coordinator."""
    a = _open_admissions(c["admissions"]).where(T.is_blank("nurse_id"))
    a = O.status_guard(a, log, "ASSIGN COORDINATOR", "admission_number")
    unskilled = ~T.ci_in("primary_plan", K.SKILLED_PLANS)
    return task_rows(a, task_code="ASSIGN COORDINATOR", due=_today(as_of),
                     patient_number=F.col("patient_number"), admission_number=F.col("admission_number"),
                     grp1_type1=F.when(unskilled, F.lit(2)).otherwise(F.lit(3)),
                     grp1_assignee1=F.when(unskilled, F.lit("UNSMGR")).otherwise(F.lit(skilled_assignee)),
                     status=K.STATUS_PENDING)


def assign_nurse(c: Tables, log: DataFrame, as_of: datetime) -> DataFrame:
    """ASSIGN NURSE: open admissions with a blank second care manager."""
    a = _open_admissions(c["admissions"]).where(T.is_blank("nurse_id_arr7_2") & ~T.ci_eq("primary_plan", "PPC"))
    a = O.status_guard(a, log, "ASSIGN NURSE", "admission_number")
    unskilled = ~T.ci_in("primary_plan", K.SKILLED_PLANS)
    return task_rows(a, task_code="ASSIGN NURSE", due=_today(as_of),
                     patient_number=F.col("patient_number"), admission_number=F.col("admission_number"),
                     grp1_type1=3, grp1_assignee1=F.when(unskilled, F.lit("HM1")).otherwise(F.lit("HA6")),
                     status=K.STATUS_PENDING)


# ------------------------------------------------------------------ J21
def over_15_min_visits(c: Tables, as_of: datetime) -> DataFrame:
    """OVER 15 MIN VISITS (Tuesday, J21): visits confirmed > 15 min over."""
    if not gate(as_of, "tuesday"):
        return empty_tasks(c["visits"].sparkSession)
    now = D.ts_lit(as_of)
    sch = _visit_minutes(c["visits"]).withColumn("minutes_over", F.col("conf_min") - F.col("sched_min"))
    sch = sch.where(~F.trim("patient_number").isin(EXCLUDED_PATIENTS) & (F.col("minutes_over") > 15)
                    & T.ci_in("schedule_status_code", K.VISIT_STATUSES_OVER15)
                    & ~T.ci_like("schedule_status_code", "Z%")
                    & (F.col("update_date").cast("date") > D.add_days(now, -7)))
    adm = c["admissions"].where(~T.ci_in("facility_code", K.SKILLED_FACILITIES)).select(
        F.col("admission_number").alias("_a_adm"), F.col("nurse_id").alias("coordinator"))
    nur = c["employees"].where(~T.ci_like("employee_profile_code", "%CCT%")
                               & ~T.ci_like("employee_profile_code", "%RN%")
                               & ~T.ci_like("employee_profile_code", "%LPN%")).select(
        F.col("nurse_id").alias("_e_id"), "first_name", "last_name", "phone")
    j = (sch.join(adm, sch.admission_number == adm._a_adm, "inner")
            .join(nur, sch.nurse_id == nur._e_id, "inner"))
    j = O.with_user_code(j, c["employees"], c["users"], "coordinator", "co_")
    note = T.concat_nn(F.col("schedule_date").cast("date").cast("string"), ": ", D.hhmm_ampm(F.col("schedule_time")),
                       " ", " visit went over by ", F.col("minutes_over").cast("string"), " minutes")
    g = (j.withColumn("_note", note)
          .withColumn("caregiver_name", T.last_first("first_name", "last_name"))
          .groupBy("coordinator", "caregiver_name", "co_user_code", "patient_number", "admission_number", "phone")
          .agg(O.ordered_listagg("_note", "; ").alias("_notes")))
    return task_rows(g, task_code="OVER 15 MIN VISITS", due=_today(as_of),
                     patient_number=F.col("patient_number"), admission_number=F.col("admission_number"),
                     grp1_type1=3, grp1_assignee1=F.col("co_user_code"),
                     notes=T.concat_nn("Employee: ", F.col("caregiver_name"), ", phone number: ", F.col("phone"),
                                       " ", F.col("_notes")),
                     status=K.STATUS_PENDING)


# ------------------------------------------------------------------ J22
def daily_overtime(c: Tables, as_of: datetime) -> DataFrame:
    """OT Alert day/visit (Thursday, J22): > 12 h and over schedule."""
    if not gate(as_of, "thursday"):
        return empty_tasks(c["visits"].sparkSession)
    now = D.ts_lit(as_of)
    base = _visit_minutes(c["visits"]).withColumn("sched_date", F.col("schedule_date").cast("date"))
    nur = c["employees"].where(~T.ci_like("employee_profile_code", "%CCT%")).select(
        F.col("nurse_id").alias("_e_id"), "first_name", "last_name")
    sch = (base.where(~F.trim("patient_number").isin(EXCLUDED_PATIENTS)
                      & T.ci_in("schedule_status_code", K.VISIT_STATUSES_OT)
                      & F.col("sched_date").between(D.add_days(now, -10), D.add_days(now, -4)))
               .join(nur, F.col("nurse_id") == nur._e_id, "inner")
               .withColumn("employee_name", T.last_first("first_name", "last_name")))
    per_day = (sch.groupBy("nurse_id", "sched_date", "employee_name")
                  .agg(F.sum("sched_min").alias("d_min"), F.sum("conf_min").alias("c_min"))
                  .where((F.col("c_min") > 12 * 60) & (F.col("c_min") > F.col("d_min")))
                  .select("employee_name", "nurse_id", "sched_date"))
    skilled = c["admissions"].where(T.ci_in("facility_code", K.SKILLED_FACILITIES)).select(
        F.col("admission_number").alias("_s_adm"))
    per_visit = (sch.where((F.col("conf_min") > 12 * 60) & (F.col("conf_min") > F.col("sched_min")))
                    .join(skilled, F.col("admission_number") == skilled._s_adm, "left_semi")
                    .select("employee_name", "nurse_id", "sched_date"))
    otp = per_day.unionByName(per_visit).distinct()  # G3: UNION (distinct)
    # Only dates inside the reporting window can match ``otp``: cut first.
    window = F.col("sched_date").between(D.add_days(now, -10), D.add_days(now, -4))
    assign = base.where(window).select(F.col("nurse_id").alias("_v_nurse"), F.col("sched_date").alias("_v_date"),
                                       F.col("admission_number").alias("_v_adm")).distinct()
    adm = c["admissions"].select(F.col("admission_number").alias("_a_adm"), F.col("nurse_id").alias("coordinator"))
    j = (otp.join(assign, (otp.nurse_id == assign._v_nurse) & (otp.sched_date == assign._v_date), "left")
            .join(adm, F.col("_v_adm") == adm._a_adm, "left"))
    j = O.with_user_code(j, c["employees"], c["users"], "coordinator", "co_")
    g = j.select("employee_name", "nurse_id", "sched_date", "coordinator", "co_user_code").distinct()
    return task_rows(g, task_code="OT Alert", due=_today(as_of), grp1_type1=3,
                     grp1_assignee1=F.col("co_user_code"),
                     notes=T.concat_nn("Employee ", F.col("employee_name"),
                                       ": exceeded both twelve hours in a visit/day and scheduled hours on ",
                                       F.col("sched_date").cast("string")),
                     status=K.STATUS_PENDING)


def run_all(c: Tables, log: DataFrame, snapshot: DataFrame, as_of: datetime,
            excluded_patients: list[str] | None = None, util_assignees: tuple[str, str] = ("UTILMGR1", "UTILMGR2"),
            skilled_assignee: str = "SKMGR") -> DataFrame:
    """All rules of one daily run, unioned to the task schema.

    The assignees the source redacted are parameters; closed calendar gates
    contribute empty frames.
    """
    a1, a2 = util_assignees
    parts = [
        add_hold_note(c, log, as_of), denver_status_change(c, snapshot, as_of), lost_eligibility(c, log, as_of),
        over_utilization(c, log, as_of, a1, a2), under_utilization(c, log, as_of, a1, a2),
        weekly_overtime(c, as_of), not_div_by_15(c, as_of, excluded_patients),
        assign_coordinator(c, log, as_of, skilled_assignee), assign_nurse(c, log, as_of),
        over_15_min_visits(c, as_of), daily_overtime(c, as_of),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
