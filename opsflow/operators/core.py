"""Reusable relational operators the jobs are assembled from.

All are DataFrame -> DataFrame transformations. Nothing collects to the
driver; group-wise work is expressed as aggregations or windows so Spark
partitions it and (for row_number = 1) pre-limits it map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def newest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                     rank_col: str | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under a total ``order`` (F1, F2).

    ``row_number() = 1`` lets Catalyst insert a WindowGroupLimit below the
    shuffle, so each map task forwards at most one row per key: a hot key
    costs no more shuffle volume than a cold one.
    """
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    out = out.where(F.col(rn) == 1)
    return out if rank_col else out.drop(rn)


def first_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """INSERT IGNORE inside one batch: the first row per key wins (B1).

    ``order`` names columns (ascending) that totally order the rows.
    ``row_number() = 1`` gets a map-side WindowGroupLimit, so each task
    forwards at most one row per key before the shuffle (a hot key costs no
    more than a cold one); the whole path stays in generated code.
    """
    return newest_per_group(df, [key], [F.col(c).asc() for c in order])


def insert_ignore(target_keys: DataFrame, batch: DataFrame, key: str,
                  order: Sequence[str], eligible: Column | None = None) -> DataFrame:
    """Rows of ``batch`` that an ``INSERT IGNORE`` into ``target`` would add (B1).

    First row per key wins inside the batch, then keys already present in the
    target are dropped with a left-anti join (shuffle on ``key`` only; the
    target side is projected to its key column before the exchange).

    ``eligible`` restricts the insert to rows where it holds, without a
    filter below the ranking: ineligible rows rank after eligible ones and
    ineligible winners are dropped -- exactly "first eligible row per key",
    and an expensive eligibility test is evaluated once, after the shuffle.
    """
    if eligible is not None:
        batch = batch.withColumn("_fw_skip", (~eligible).cast("int"))
        first = first_wins(batch, key, ["_fw_skip", *order])
        first = first.where(F.col("_fw_skip") == 0).drop("_fw_skip")
    else:
        first = first_wins(batch, key, order)
    keys = target_keys.select(F.col(key).alias("_tk")).distinct()
    return first.join(keys, first[key] == keys["_tk"], "left_anti")


def reopen_guard(cand: DataFrame, log: DataFrame, task_code: str, on: Sequence[tuple[str, str]],
                 bound: Column | None, mode: str = "row") -> DataFrame:
    """Emit candidates with no prior task, or a prior task older than ``bound``.

    ``mode='row'`` reproduces the source exactly (quirk Q1): the guard is
    evaluated per joined prior row, so every older prior row re-emits the
    candidate. ``mode='any'`` is the same test for jobs whose output is
    DISTINCT: the log is first reduced to one row per key (``min(due)``;
    passing iff some prior row is older), so a key with many prior tasks
    never fans out. ``mode='latest'`` compares only the newest prior task.
    ``bound`` is a column of ``cand`` or None for "no prior row at all".
    """
    keys = [f"_g_{lc}" for _, lc in on]
    prior = log.where(T.ci_eq("task_code", task_code)).select(
        *[F.col(lc).alias(f"_g_{lc}") for _, lc in on], F.col("due").alias("_g_due"))
    if mode in ("any", "latest"):
        agg = F.min("_g_due") if mode == "any" else F.max("_g_due")
        # Partial aggregation: one row per key leaves each map task. A prior
        # row without a due date passes the source's test too (due IS NULL).
        prior = prior.groupBy(*keys).agg(agg.alias("_g_due"), F.count(F.lit(1)).alias("_g_n"),
                                         F.max(F.col("_g_due").isNull().cast("int")).alias("_g_nulldue"))
    else:
        prior = prior.withColumn("_g_n", F.lit(1)).withColumn("_g_nulldue", F.col("_g_due").isNull().cast("int"))
    cond = None
    for cc, lc in on:
        c = cand[cc] == prior[f"_g_{lc}"]
        cond = c if cond is None else cond & c
    j = cand.join(prior, cond, "left")
    none = F.col("_g_n").isNull()
    keep = none if bound is None else (none | (F.col("_g_nulldue") == 1) | (F.col("_g_due") < bound))
    return j.where(keep).drop(*keys, "_g_due", "_g_n", "_g_nulldue")


def status_guard(cand: DataFrame, log: DataFrame, task_code: str, cand_col: str,
                 log_col: str = "admission_number", reopen_status: str = "Completed") -> DataFrame:
    """Emit if no prior task on the key, or once per prior ``Completed`` row.

    Row-level like the source (no DISTINCT there), but without joining the
    raw log: prior rows are first counted per key (partial aggregation, one
    row per key per map task) and a candidate is then repeated
    ``n_completed`` times -- the same multiset, with no fan-out join.
    """
    prior = log.where(T.ci_eq("task_code", task_code)).groupBy(F.col(log_col).alias("_s_key")).agg(
        F.sum(T.ci_eq("status", reopen_status).cast("int")).alias("_s_done"))
    j = cand.join(prior, cand[cand_col] == prior["_s_key"], "left")
    times = F.when(F.col("_s_key").isNull(), F.lit(1)).otherwise(F.coalesce(F.col("_s_done"), F.lit(0)))
    return (j.where(times > 0)
             .withColumn("_s_rep", F.explode(F.array_repeat(F.lit(True), times.cast("int"))))
             .drop("_s_key", "_s_done", "_s_rep"))


def snapshot_diff(new: DataFrame, old: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of ``new`` whose ``value`` differs from the snapshot's.

    Inner join: new or vanished keys emit nothing, as in the source.
    """
    o = old.select(F.col(key).alias("_o_key"), F.col(value).alias("_o_value"))
    return new.join(o, new[key] == o["_o_key"], "inner").where(F.col(value) != F.col("_o_value")).drop("_o_key")


def ordered_listagg(value: Column | str, sep: str, order_by: str | None = None) -> Column:
    """``string_agg(value, sep)`` with a total order (E7/E8, quirk Q15).

    NULL values are skipped, as in the source. Spark evaluates it as a
    partial aggregate, so only per-group buffers cross the shuffle.
    """
    v = value if isinstance(value, str) else None
    if v is None:
        raise TypeError("ordered_listagg takes a column name; alias the expression first")
    o = order_by or v
    return F.expr(f"listagg(`{v}`, '{sep}') WITHIN GROUP (ORDER BY `{o}`)")


def any_match(col: Column, pattern: str) -> Column:
    """``string_agg(code, ';') LIKE pattern`` as a boolean aggregate."""
    return F.coalesce(F.max(T.ci_like(col, pattern).cast("int")) == 1, F.lit(False))


def with_user_code(df: DataFrame, employees: DataFrame, users: DataFrame, emp_col: str,
                   prefix: str) -> DataFrame:
    """Resolve an employee id to its user code via the name key.

    ``users.user_name`` is matched to ``first + ' ' + last`` of the employee,
    both trimmed. Adds ``{prefix}first_name``, ``{prefix}last_name``,
    ``{prefix}user_code``. Both dimension joins are equi-joins; AQE/the
    planner broadcast them only when their measured size is small.
    """
    e = employees.select(F.col("nurse_id").alias(f"_{prefix}id"),
                         F.col("first_name").alias(f"{prefix}first_name"),
                         F.col("last_name").alias(f"{prefix}last_name"))
    u = users.select(T.norm(F.trim("user_name")).alias(f"_{prefix}uname"),
                     F.col("user_code").alias(f"{prefix}user_code"))
    j = df.join(e, df[emp_col] == e[f"_{prefix}id"], "left").drop(f"_{prefix}id")
    key = T.norm(T.full_name(f"{prefix}first_name", f"{prefix}last_name"))
    j = j.withColumn(f"_{prefix}key", F.when(F.col(f"{prefix}first_name").isNotNull()
                                             | F.col(f"{prefix}last_name").isNotNull(), key))
    return j.join(u, j[f"_{prefix}key"] == u[f"_{prefix}uname"], "left").drop(f"_{prefix}key", f"_{prefix}uname")


def dec72_text(x: Column) -> Column:
    """``CAST(x AS dec(7,2))`` rendered as text, sign-aware.

    Rounds half away from zero in decimal arithmetic, so 1.005 is 1.01. A double counts as its shortest decimal form.
    """
    return F.round(x.cast("decimal(38,10)"), 2).cast("decimal(38,2)").cast("string")


def _units(x: Column) -> Column:
    """A number of up to six decimals as a whole number of millionths."""
    return (x.cast("decimal(30,6)") * F.lit(1_000_000)).cast("decimal(38,0)")


def ratio_exceeds(part: Column, whole: Column, percent: int) -> Column:
    """``part / whole > percent / 100`` without a division (E2); null where ``whole`` is 0 or null."""
    p, w = _units(part) * F.lit(100), _units(whole) * F.lit(percent)
    return F.when(whole > 0, p > w).when(whole < 0, p < w)


def percent_over_text(part: Column, whole: Column) -> Column:
    """``part / whole * 100 - 100`` as dec(7,2) text, rounded once, half away from zero."""
    over, base = _units(part) - _units(whole), F.abs(_units(whole))
    hundredths = let_div(F.abs(over) * F.lit(20_000) + base, base * F.lit(2))
    signed = F.when((over < 0) != (whole < 0), -hundredths).otherwise(hundredths)
    return F.when(whole != 0, (signed.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)").cast("string"))


def let_div(a: Column, b: Column) -> Column:
    """Whole-number division of non-negative numbers, null where ``b`` is 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0).cast("decimal(38,0)")))
