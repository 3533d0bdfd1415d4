import os
from datetime import datetime

from opsflow.plans import ingest
from opsflow.streaming.ingest_stream import start_ingest_stream

from test_ingest import HEADER, _rows, _write

COLS = ["sale_id", "customer_name", "product", "quantity", "unit_price", "total_amount", "sale_date", "region",
        "salesperson", "source_file"]


def test_available_now_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _write(src, "sales_0301.txt", [HEADER] + _rows("A", 10, 1))
    _write(src, "sales_0302.txt", [HEADER] + _rows("A", 5, 1) + _rows("C", 4, 20))  # 5 duplicate keys
    # the stream takes files in arrival order; make it agree with name order
    os.utime(os.path.join(src, "sales_0301.txt"), (1_700_000_000, 1_700_000_000))
    os.utime(os.path.join(src, "sales_0302.txt"), (1_700_000_100, 1_700_000_100))
    batch_t, stream_t = os.path.join(scratch, "bt"), os.path.join(scratch, "st")
    ingest.run_etl(spark, src, batch_t, datetime(2026, 3, 2), do_archive=False)
    q = start_ingest_stream(spark, src, stream_t, os.path.join(scratch, "ckpt"), max_files_per_trigger=1,
                            clock=lambda: datetime(2026, 3, 2))
    q.awaitTermination(300)
    b = sorted(tuple(r) for r in spark.read.parquet(batch_t).select(*COLS).collect())
    s = sorted(tuple(r) for r in spark.read.parquet(stream_t).select(*COLS).collect())
    assert len(b) == 14 and b == s
    # a restart with the same checkpoint finds nothing new
    q2 = start_ingest_stream(spark, src, stream_t, os.path.join(scratch, "ckpt"))
    q2.awaitTermination(300)
    assert spark.read.parquet(stream_t).count() == 14
