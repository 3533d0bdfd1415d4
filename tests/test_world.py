"""The driver-table care views keep the key properties the jobs rely on."""
import os

import pytest
from pyspark.sql import functions as F

from opsflow.plans.world import ALL_VIEWS, care_tables
from opsflow.sources.tables import Tables

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

UNIQUE = {
    "patients": ["patient_number"], "admissions": ["admission_number"],
    "certifications": ["admission_number"], "task_entries": ["wf_task_number"], "visits": ["visit_id"],
    "comm_logs": ["note_id"], "task_log": ["taskid"], "employees": ["nurse_id"], "users": ["user_code"],
    "responses": ["taskid"], "overtime_reports": ["nurse_id", "weekstart"], "prev_county": ["patient_number"],
}


@pytest.fixture(scope="module")
def care(spark):
    return care_tables(Tables.from_parquet_dir(spark, SF))


@pytest.mark.parametrize("view", sorted(UNIQUE))
def test_view_keys_are_unique(care, view):
    df = care[view]
    keys = UNIQUE[view]
    assert df.count() == df.select(*keys).distinct().count() > 0


def test_every_view_reads_driver_data(care):
    for name in ALL_VIEWS:
        assert care[name].limit(1).count() == 1, name


def test_coordinators_exist_as_employees(care):
    adm = care["admissions"].where(F.trim("nurse_id") != "")
    missing = adm.join(care["employees"], "nurse_id", "left_anti").count()
    assert missing == 0
