"""Failure digest (J25: B15, B16, B17)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators.pages import paged_text
from ..sources import constants as K


def failed_notes(log: DataFrame) -> DataFrame:
    """Distinct failure reasons (E5)."""
    return log.where(T.ci_eq("status", K.STATUS_FAILED)).select("status_note").distinct()


def fail_digest(log: DataFrame, as_of: datetime) -> DataFrame:
    """B15+B17: one row -- escaped HTML table rows in note order, and counts.

    Like an XML path serialiser, a NULL note yields an empty ``<tr></tr>``
    (its ``td`` element is omitted). With no failures the body is an empty
    string rather than NULL (quirk Q14 fixed).
    """
    rows = failed_notes(log).withColumn(
        "_tr", F.when(F.col("status_note").isNull(), F.lit("<tr></tr>"))
                .otherwise(F.concat(F.lit("<tr><td>"), T.html_escape(F.col("status_note")), F.lit("</td></tr>"))))
    return rows.agg(
        D.date_lit(as_of).alias("run_date"),
        F.lit("wftFailSummary").alias("report_name"),
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.coalesce(F.expr("listagg(_tr, '') WITHIN GROUP (ORDER BY status_note ASC NULLS FIRST)"),
                   F.lit("")).alias("body_rows"))


def fail_digest_rows(log: DataFrame) -> DataFrame:
    """B15, distributed form: one row per distinct reason with its escaped
    ``<tr>`` fragment, in digest order (a range-partitioned sort). Nothing is
    concatenated into one value, so it scales with the number of reasons;
    ``fail_digest`` builds the single mail body the source sends.
    """
    tr = F.when(F.col("status_note").isNull(), F.lit("<tr></tr>")) \
          .otherwise(F.concat(F.lit("<tr><td>"), T.html_escape(F.col("status_note")), F.lit("</td></tr>")))
    return failed_notes(log).select("status_note", tr.alias("row_html")) \
        .orderBy(F.col("status_note").asc_nulls_first())


def fail_digest_pages(log: DataFrame, page_bytes: int = 1 << 20) -> DataFrame:
    """B15 in bounded pages: page, n_lines and text, the ``<tr>`` fragments of ``fail_digest_rows`` in note order.

    One page is one mail body; joined in page order they are ``fail_digest``'s.
    """
    return paged_text(fail_digest_rows(log), [], ["status_note"], "row_html", "", page_bytes)


def fail_export(log: DataFrame) -> DataFrame:
    """Every failed log row, ordered by ``taskid``."""
    return log.where(T.ci_eq("status", K.STATUS_FAILED)).orderBy("taskid")


def write_fail_export(df: DataFrame, path: str) -> None:
    """Tab-separated export with a header (the mail attachment's format)."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
