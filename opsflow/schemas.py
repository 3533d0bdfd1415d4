"""Schemas of the task log, the queue and generated task rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns a rule query may set on a generated task, in log order.
NEW_TASK_FIELDS = [
    ("task_code", "string"), ("due", "date"), ("start_date", "date"), ("end_date", "date"),
    ("patient_number", "string"), ("admission_number", "string"),
    ("clinical_note_number", "string"), ("employeeid", "string"), ("notes", "string"),
    ("grp1_type1", "int"), ("grp1_assignee1", "string"), ("grp1_type2", "int"), ("grp1_assignee2", "string"),
    ("grp2_type1", "int"), ("grp2_assignee1", "string"), ("grp2_type2", "int"), ("grp2_assignee2", "string"),
    ("status", "string"),
]
NEW_TASK_COLUMNS = [n for n, _ in NEW_TASK_FIELDS]

# The 20 columns copied from the log into the queue.
QUEUE_FIELDS = [("taskid", "bigint")] + NEW_TASK_FIELDS + [("status_note", "string")]
QUEUE_COLUMNS = [n for n, _ in QUEUE_FIELDS]

# Full log row.
LOG_FIELDS = QUEUE_FIELDS + [("ehr_task_number", "string"), ("processed_date", "timestamp_ntz")]
LOG_COLUMNS = [n for n, _ in LOG_FIELDS]

NEW_TASK_DDL = ", ".join(f"{n} {t}" for n, t in NEW_TASK_FIELDS)
LOG_DDL = ", ".join(f"{n} {t}" for n, t in LOG_FIELDS)


def task_rows(df: DataFrame, **cols: Column | str | int | None) -> DataFrame:
    """Project ``df`` to the generated-task schema; unset fields are NULL.

    Plain ``str``/``int`` values are literals; pass ``F.col`` for columns.
    """
    out = []
    for name, typ in NEW_TASK_FIELDS:
        v = cols.get(name)
        if v is None:
            c = F.lit(None)
        elif isinstance(v, Column):
            c = v
        else:
            c = F.lit(v)
        out.append(c.cast(typ).alias(name))
    return df.select(*out)


def empty_tasks(spark) -> DataFrame:
    return spark.createDataFrame([], NEW_TASK_DDL)
