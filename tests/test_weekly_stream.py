"""Event-time weekly sums on a stream equal the batch Monday-week grouping."""
import os

import pytest
from pyspark.sql import functions as F

from opsflow.functions import dates as D
from opsflow.functions import parse as P
from opsflow.plans.world import care_tables
from opsflow.sources import constants as K
from opsflow.sources.tables import Tables
from opsflow.streaming.weekly_hours import overtime_weeks, weekly_minutes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stream_weeks_match_batch(spark, scratch):
    visits = care_tables(Tables.from_parquet_dir(spark, SF))["visits"]
    src = os.path.join(scratch, "visits")
    # visits arrive as files, one per ship year (the stream source)
    visits.withColumn("y", F.year("schedule_date")).write.partitionBy("y").parquet(src)
    stream = (spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 3)
              .parquet(src))
    q = (weekly_minutes(stream, lateness="3650 days").writeStream.outputMode("update")
         .format("memory").queryName("weekly_minutes_test").trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = spark.table("weekly_minutes_test")
    # update mode may emit a week more than once: keep its last (largest) sums
    got = got.groupBy("nurse_id", "weekstart").agg(F.max("conf_min").alias("conf_min"),
                                                   F.max("sched_min").alias("sched_min"))
    batch = (visits.where(F.col("schedule_status_code").isin(K.VISIT_STATUSES_OT))
                   .groupBy("nurse_id", D.week_start(F.col("schedule_date")).alias("weekstart"))
                   .agg(F.sum(P.hhmm_minutes(F.col("confirmed_duration"))).alias("conf_min"),
                        F.sum(P.hhmm_minutes(F.col("duration"))).alias("sched_min")))
    key = lambda df: sorted(tuple(r) for r in df.select("nurse_id", "weekstart", "conf_min", "sched_min").collect())
    assert key(got) == key(batch)
    assert overtime_weeks(batch).count() == overtime_weeks(got).count()
