r"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base candidates, leftmost and not overlapping per kind:

* ``assign``: a keyword, ``:`` or ``=``, and a value of 12 or more characters;
* ``access``: an access-key prefix, 18 or more characters in all;
* ``hex``: 16 or more lower-case hex digits.

The method adds ``bare`` candidates: runs of 20 or more key characters that
hold a digit, an upper-case and a lower-case letter. Each candidate's value is
hashed, and over the whole corpus every hash gets its number of distinct
repositories and owners (counted by (hash, owner, repository) first, so a value
copied into a third of all documents is combined before the shuffle):

* ``example``: seen with ``example_owners`` or more owners, or
  ``example_repos`` or more repositories: widely copied;
* ``live``: everything else, so a value specific to few owners.

All base spans stay, whatever their class. A ``bare`` span is added when its
value is live, has one owner and does not overlap a base span.

Positions are code points, end exclusive. A match's position is the running
length of the parts between matches (the text split by the same pattern) and of
the matches before it.

Defined cases: null text is empty; a null owner or repository is one owner or
repository of its own; repeated rows are scanned each, and count as one
repository; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsflow.llm.common import join_stats, let, written

# The candidates' patterns.
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12)
# A run is maximal, so asking for its length in the pattern drops just the short ones.
ACCESS = (r"AKIA[A-Z0-9]{14,}", 0, 18)
HEX = (r"[0-9a-f]{16,}", 0, 16)
BARE = (r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
KINDS = ("assign", "access", "hex", "bare")

SPAN = "array<struct<start:int,kind:int,stop:int,hash:string>>"


def spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """All matches of ``pattern`` whose ``group`` has ``least`` or more characters, as (start, kind, stop, hash)."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else None

    def located(m: Column) -> Column:
        # Lengths before match i: i+1 parts and i matches.
        def with_parts(parts: Column) -> Column:
            empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("out"))

            def step(acc: Column, i: Column) -> Column:
                start = acc["at"] + F.length(parts[i])
                stop = start + F.length(m[i])
                return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), stop.alias("stop")))).alias("out"))

            return F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), empty, step, lambda acc: acc["out"])

        def with_values(v: Column) -> Column:
            built = F.zip_with(let(F.split(text, pattern, -1), with_parts), v, lambda p, x: F.struct(
                p["start"].alias("start"), F.lit(kind).alias("kind"), p["stop"].alias("stop"), x.alias("value")))
            kept = F.filter(built, lambda s: F.length(s["value"]) >= least)
            return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"),
                                                        F.sha2(s["value"].cast("binary"), 256).alias("hash")))

        return with_values(m) if value is None else let(value, with_values)

    # Texts without a match, nearly all, cost one search.
    return F.when(F.regexp_like(text, F.lit(pattern)), let(whole, located)).otherwise(F.array().cast(SPAN))


def bare_spans(text: Column) -> Column:
    pattern, group, least = BARE
    mixed = r"(?=[^\s]*[0-9])(?=[^\s]*[A-Z])(?=[^\s]*[a-z])"
    found = spans(text, 3, pattern, group, least)
    shaped = F.filter(found, lambda s: F.regexp_like(F.substring(text, s["start"] + 1, s["stop"] - s["start"]), F.lit(mixed)))
    return F.when(F.regexp_like(text, F.lit(pattern)), shaped).otherwise(F.array().cast(SPAN))


def listed(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")


def candidates(docs: DataFrame, repo_col: str, owner_col: str) -> DataFrame:
    """One row per input row: rid, doc_id, repo, owner, base and bare spans; written, so texts are scanned once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(repo_col).cast("string").alias("repo"),
                        F.col(owner_col).cast("string").alias("owner"), text.alias("text"))
    base = F.array_sort(F.concat(spans(F.col("text"), 0, *ASSIGN), spans(F.col("text"), 1, *ACCESS), spans(F.col("text"), 2, *HEX)))
    found = (found.withColumn("base", base).withColumn("bare", bare_spans(F.col("text"))).drop("text")
             .withColumn("rid", F.monotonically_increasing_id()))
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    return written(found.withColumn("bare", F.filter("bare", apart)), "candidates")


def ownership(found: DataFrame, example_owners: int, example_repos: int) -> DataFrame:
    """hash, uses, repos, owners and example, over the whole corpus."""
    each = found.select("owner", "repo", F.explode(F.concat("base", "bare")).alias("s")).select("owner", "repo", "s.hash")
    by_repo = each.groupBy("hash", "owner", "repo").agg(F.count("*").alias("uses"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.sum("uses").alias("uses"), F.count("*").alias("repos"))
    by_hash = by_owner.groupBy("hash").agg(F.sum("uses").alias("uses"), F.sum("repos").alias("repos"), F.count("*").alias("owners"))
    return by_hash.withColumn("example", (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos))


def scan(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source",
         example_owners: int = 3, example_repos: int = 50) -> DataFrame:
    """One row per input row: doc_id, base, added (spans), n_live, n_example (of its base spans)."""
    found = candidates(docs, repo_col, owner_col)
    each = found.select("rid", F.explode(F.concat("base", "bare")).alias("s")).select("rid", "s", F.col("s.hash").alias("hash"))
    stats = written(ownership(found, example_owners, example_repos), "ownership")
    n = stats.agg(F.sum("uses")).first()[0] or 0
    judged = join_stats(each, stats, "hash", "uses", n)
    is_bare = F.col("s.kind") == 3
    verdicts = judged.groupBy("rid").agg(
        F.count_if(~is_bare & ~F.col("example")).alias("n_live"), F.count_if(~is_bare & F.col("example")).alias("n_example"),
        F.collect_list(F.when(is_bare & ~F.col("example") & (F.col("owners") == 1), F.col("s"))).alias("added"))
    zero = F.lit(0).cast("long")
    return (found.drop("bare").join(verdicts, "rid", "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example")))


def digest_columns(scanned: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"), "n_live", "n_example")
