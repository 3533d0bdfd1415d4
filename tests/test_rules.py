"""Rule jobs on tiny care-operations fixtures (FIXTURES.md shapes)."""
from datetime import date, datetime

from opsflow.plans import compliance, triggers
from opsflow.sources.tables import Tables

THU = datetime(2026, 3, 5, 9, 30)


def adm_df(spark, rows):
    return spark.createDataFrame(rows, "patient_number string, admission_number string, facility_code string, "
                                       "discharge_code string, nurse_id string, nurse_id_arr7_2 string, primary_plan string")


def empty_log(spark):
    return spark.createDataFrame([], "task_code string, admission_number string, patient_number string, "
                                     "due date, status string, grp1_assignee1 string")


def test_gates(spark):
    assert triggers.gate(datetime(2026, 1, 15), "quarter_day15") and not triggers.gate(datetime(2026, 2, 15), "quarter_day15")
    assert triggers.gate(THU, "thursday") and not triggers.gate(THU, "tuesday")
    c = Tables.from_frames(visits=spark.createDataFrame([], "x string"))
    assert triggers.over_15_min_visits(c, THU).count() == 0     # closed gate: empty frame, task schema
    assert "task_code" in triggers.over_15_min_visits(c, THU).columns


def test_assign_coordinator_blank_id_and_guard(spark):
    adm = adm_df(spark, [
        ("1", "A1", "LUS", "A", "         ", "9", "SKILLT "),   # blank (padded) coordinator, skilled plan
        ("2", "A2", "LUS", "A", "", "9", "UNSK"),                # blank, unskilled
        ("3", "A3", "LUS", "DC", "", "9", "UNSK"),               # discharged
        ("4", "A4", "LUS", "A", None, "9", "UNSK"),              # NULL stays excluded
        ("5", "A5", "LUS", "cl", "", "9", "UNSK"),               # %CL% case-insensitive
        ("6", "A6", "LUS", "A", "", "9", "UNSK"),                # prior open task
    ])
    log = spark.createDataFrame([("ASSIGN COORDINATOR", "A6", "6", date(2026, 1, 1), "Sent", None),
                                 ("ASSIGN COORDINATOR", "A2", "2", date(2026, 1, 1), "Completed", None)],
                                empty_log(spark).schema)
    out = {r.admission_number: (r.grp1_type1, r.grp1_assignee1) for r in
           triggers.assign_coordinator(Tables.from_frames(admissions=adm), log, THU, skilled_assignee="SK").collect()}
    assert out == {"A1": (3, "SK"), "A2": (2, "UNSMGR")}


def test_compliance_check_boundaries(spark):
    as_of = datetime(2026, 3, 31, 0, 1)   # after midnight on the last certification day
    adm = adm_df(spark, [("10", "A10", "LUS", "A", "1", "2", "UNSK"), ("11", "A11", "CSU ", "A", "1", "2", "UNSK"),
                         ("154", "A154", "LUS", "A", "1", "2", "UNSK")])
    cer = spark.createDataFrame([
        ("10", "A10", "IHSS", datetime(2025, 4, 1), datetime(2026, 3, 31)),     # ends today -> excluded
        ("11", "A11", "hmk ", datetime(2025, 6, 1), datetime(2026, 6, 1)),      # padded, lower case code
        ("154", "A154", "IHSS", datetime(2025, 6, 1), datetime(2026, 6, 1)),    # patient 154 excluded
    ], "patient_number string, admission_number string, certification_code string, "
       "certification_from timestamp_ntz, certification_thru timestamp_ntz")
    wft = spark.createDataFrame([
        ("T1", "HCA 3MO SUPER", "11", "A11", datetime(2026, 4, 1), datetime(2027, 4, 1), 1, 0, 0, 0),
        ("T2", "HCA 6MO SUPER", "11", "A11", datetime(2025, 7, 1), datetime(2027, 7, 1), 2, 1, 0, 0),  # completed: Q3
        ("T3", "HCA 9MO SUPER", "11", "A11", datetime(2025, 12, 1), datetime(2026, 12, 1), 2, 0, 0, 0),  # rolled
    ], "wf_task_number string, wf_task_code string, patient_number string, admission_number string, "
       "start_date timestamp_ntz, end_date timestamp_ntz, frequency_type int, cb_completed int, cb_skipped int, "
       "cb_deleted int")
    pat = spark.createDataFrame([("11", "Ann", "Lee")], "patient_number string, first_name string, last_name string")
    rows = compliance.compliance_check(adm, cer, wft, pat, as_of).collect()
    items = {r.task_item: r for r in rows}
    assert {r.patient_number for r in rows} == {"11"}
    assert set(items) == {"HCA 3MO SUPER", "HCA 9MO SUPER", "HCA ANNUAL VISIT"}   # 6MO vanished (Q3 kept)
    assert items["HCA 9MO SUPER"].start_date == datetime(2026, 12, 1, 7, 0)      # +365 d, Denver -> UTC
    assert items["HCA 3MO SUPER"].number_of_missing_tasks == 2
    assert items["HCA ANNUAL VISIT"].wf_task_number is None and rows[0].patient_name == "Lee, Ann"


def test_padded_char_keys_join_after_normalisation(spark):
    """Fixed-width ids ('      154', 'A1   ') match like the source's char(n)."""
    adm = adm_df(spark, [("      154", "A1   ", "LUS", "A  ", "         ", "9", "UNSK   "),
                         ("     1540", "A2   ", "LUS", "A  ", "         ", "9", "SKILLT ")])
    log = spark.createDataFrame([("ASSIGN COORDINATOR", "A1", "154", date(2026, 1, 1), "Sent     ", None)],
                                empty_log(spark).schema)
    raw = Tables.from_frames(admissions=adm)
    c = raw.normalized()
    out = triggers.assign_coordinator(c, log, THU, skilled_assignee="SK").collect()
    assert [(r.admission_number, r.grp1_assignee1) for r in out] == [("A2", "SK")]   # A1 has an open task
    unnormalised = triggers.assign_coordinator(raw, log, THU, skilled_assignee="SK").count()
    assert unnormalised == 2   # without char semantics the padded key misses the prior task
