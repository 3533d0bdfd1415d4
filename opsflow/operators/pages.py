"""Ordered text in bounded pages.

``listagg`` of an unbounded list builds one string in one task. Here a list is cut
into pages of some ``page_bytes``: a page never holds more than that plus one line. Rows are
range-sorted by (group, order) and written, so a large group spreads over many
partitions; each partition's bytes per group are summed, the running sums of those few
rows give where every partition starts in its group, and a line's page follows from
where it starts. No group is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def paged_text(df: DataFrame, group: list[str], order: list[str], line: str, sep: str = "", page_bytes: int = 1 << 20) -> DataFrame:
    """One row per page: the group, page (from 0), n_lines and text, its lines in order joined by ``sep``.

    A page holds the lines that start within its ``page_bytes`` of the group's UTF-8 text (separators included). Null
    lines are left out. Lines that are equal in ``order`` are taken by their text.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order, line]]
    rows = df.filter(F.col(line).isNotNull()).select(*dict.fromkeys([*group, *order, line]))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.octet_length(line) + F.octet_length(F.lit(sep))
    rows = staged(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
                  .withColumn("_size", size.cast("bigint")), "pages")
    # One row per group and partition that it reaches.
    parts = rows.groupBy(*group, "_part").agg(F.sum("_size").alias("_bytes"))
    starts = parts.withColumn("_start", F.coalesce(F.sum("_bytes").over(
        Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = starts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), "_start")
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    # A group's rows of one partition: at most what one task has sorted.
    before = F.coalesce(F.sum("_size").over(Window.partitionBy(*group, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("_before", before).join(starts, same)
    page = F.expr(f"(_start + _before) div {int(page_bytes)}").cast("bigint")
    lines = F.sort_array(F.collect_list(F.struct("_at", F.col(line).alias("_line"))))
    return placed.groupBy(*group, page.alias("page")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.array_join(F.transform(lines, lambda x: x["_line"]), sep).alias("text"))
