"""Weekly visit minutes per employee as an event-time streaming aggregate.

The batch rule (J17) sums confirmed and scheduled minutes per employee and
Monday-based week. On a stream of visits the same sums are a tumbling
7-day window: Spark's windows start at the epoch (a Thursday), so
``startTime='4 days'`` aligns them to Mondays. The watermark bounds state:
a week's row is final (``append`` mode) once event time passes the week's
end plus the allowed lateness, and later visits for it are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from ..sources import constants as K
from ..functions import text as T


def weekly_minutes(visits: DataFrame, lateness: str = "2 days") -> DataFrame:
    """``(nurse_id, weekstart, conf_min, sched_min)`` from a visit stream.

    Works on batch frames too (the watermark is then ignored), which is how
    the tests check it against the batch rule's grouping.
    """
    # Watermarks need an instant: read the wall-clock visit time as UTC (the
    # session zone the jobs pin), so window bounds stay on local midnights.
    v = (visits.where(T.ci_in("schedule_status_code", K.VISIT_STATUSES_OT))
               .withColumn("conf_min", P.hhmm_minutes(F.col("confirmed_duration")))
               .withColumn("sched_min", P.hhmm_minutes(F.col("duration")))
               .withColumn("_event", F.col("schedule_date").cast("timestamp_ltz"))
               .withWatermark("_event", lateness))
    w = F.window("_event", "7 days", startTime="4 days")
    return (v.groupBy(w.alias("week"), "nurse_id")
             .agg(F.sum("conf_min").alias("conf_min"), F.sum("sched_min").alias("sched_min"))
             .select("nurse_id", F.col("week.start").cast("timestamp_ntz").cast("date").alias("weekstart"),
                     "conf_min", "sched_min"))


def overtime_weeks(weekly: DataFrame) -> DataFrame:
    """The J17 weekly threshold: >= 40 h confirmed, above schedule, > 15 min over."""
    return weekly.where((F.col("conf_min") >= 40 * 60) & (F.col("conf_min") > F.col("sched_min"))
                        & ((F.col("conf_min") - F.col("sched_min")) > 15))
