r"""Cheapest repair of conversation structure, a run-length dynamic program over role and fault symbols.

A conversation is its rows by turn (nulls first; rows of one turn by role, then by
the SHA-256 of the text). A row's first fault counts: ``blank`` (only white space),
``duplicate`` (role and text seen earlier), ``truncated`` (the last character that is
not white space is none of ``.!?``). Edits: Keep 0, Rerole to user or assistant 1,
Delete 2 (the only one for blank and duplicate rows), Insert an empty user or
assistant row 5; truncated rows that stay cost 5 more. The repaired roles' initials
form ``(s?(ua)+)?``; of the cheapest audits (initials of the edits in order) the ASCII-least
counts.

Method. The grammar has four states (nothing yet, after s, after u, after a), so a row
is a 4 x 4 min-plus matrix (inserts before it, then its edit) that depends on its
symbol only. Equal consecutive symbols are collapsed to runs, and a run of length r is
advanced by the binary powers of its symbol's matrix, cached per worker. Matrices compose
associatively, so nothing needs a whole conversation in one task:

1. Rows are range-sorted by (conversation, turn, ...), which splits large conversations;
   each partition cuts its part into segments of at most ``SEGMENT_ROWS`` rows and
   writes their symbols and matrix.
2. Per conversation the few matrices (one per segment) are multiplied from the right: cost
   to go after each segment, and the total cost.
3. Each segment unrolls its choices forward from every state that it may start in (the
   first only from none), taking the ASCII-least edit that keeps the total. Long
   runs are halved by the cached powers, so only short pieces are walked row by row.
4. Per conversation the segments' end states are chained and the matching unrolls kept.

The audit is one string and the SHA-256 one sequential stream per conversation. The stream is
read in Arrow batches from a sorted partition and never held: its memory is bounded, its time
for a single huge conversation is not shortened by more machines.

Defined cases: null roles and texts are one blank, an empty role counts as a blank in
the initials; initials other than s, u, a can't be kept; a null id is one
conversation; null turns come first; repeated rows are duplicates of their first; a
conversation without rows has zeros, an empty audit and the hash of the empty string; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsflow.llm.common import written

BLANKS = " \t\n\x0b\x0c\r"
SEGMENT_ROWS = 1 << 20
LEAF_ROWS = 256
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
NEVER = 1 << 50

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. A conversation may end in 0 or 3.
STATES, ENDS = range(4), (0, 3)
TURN = (2, 2, 3, 2)  # the state after the one role of user and assistant that may follow
ROLE = {2: "user", 3: "assistant"}
# Symbols of rows: 0 must go; else 1 + 2 * initial (s, u, a, other) + truncated.
GONE = 0

Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]


def symbol(initial: str, must_go: bool, truncated: bool) -> int:
    return GONE if must_go else 1 + 2 * ("sua".find(initial) % 4) + truncated


def kept_state(sym: int, q: int) -> int | None:
    """The state after keeping a row in state q, None if its role may not stand there."""
    initial = (sym - 1) // 2
    if initial == 0:
        return 1 if q == 0 else None
    return TURN[q] if TURN[q] == initial + 1 else None


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(NEVER, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def ahead(m: Matrix, after: Costs) -> Costs:
    return tuple(min(NEVER, *(m[q][k] + after[k] for k in STATES)) for q in STATES)


def inserts() -> Matrix:
    m = [[0 if i == j else NEVER for j in STATES] for i in STATES]
    for q in STATES:
        at, cost = q, 0
        for _ in range(2):  # a third insert only repeats a state
            at, cost = TURN[at], cost + INSERT
            m[q][at] = min(m[q][at], cost)
    return tuple(map(tuple, m))


END: Costs = tuple(min(inserts()[q][e] for e in ENDS) for q in STATES)


@lru_cache(maxsize=None)
def power(sym: int, k: int) -> Matrix:
    """The matrix of 2^k rows of one symbol."""
    if k:
        return times(power(sym, k - 1), power(sym, k - 1))
    row = [[NEVER] * 4 for _ in STATES]
    for q in STATES:
        row[q][q] = DELETE
        if sym != GONE:
            late = CUT * ((sym - 1) % 2)
            row[q][TURN[q]] = min(row[q][TURN[q]], REROLE + late)
            if (to := kept_state(sym, q)) is not None:
                row[q][to] = min(row[q][to], KEEP + late)
    return times(inserts(), tuple(map(tuple, row)))


def bits(n: int) -> Iterator[int]:
    return (k for k in range(n.bit_length()) if n >> k & 1)


def segment_matrix(runs: list[tuple[int, int]]) -> Matrix:
    out = tuple(tuple(0 if i == j else NEVER for j in STATES) for i in STATES)
    for sym, n in runs:
        for k in bits(n):
            out = times(out, power(sym, k))
    return out


def before_run(sym: int, n: int, after: Costs) -> Costs:
    for k in bits(n):
        after = ahead(power(sym, k), after)
    return after


class Unroll:
    """Edits of one segment from one state: the audit, and of each row that stays its index, inserts before it and new role."""

    def __init__(self, runs: list[tuple[int, int]], start: int, after: Costs, last: bool):
        self.q, self.row, self.lead = start, 0, ""
        self.audit: list[str] = []
        self.index: list[int] = []
        self.leads: list[str] = []
        self.roles: list[str | None] = []
        costs = [after]
        for sym, n in reversed(runs):
            costs.append(before_run(sym, n, costs[-1]))
        for (sym, n), after_run in zip(runs, costs[-2::-1]):
            self.run(sym, n, after_run)
        while last and END[self.q]:
            self.insert()
        # Inserts before the next segment's first row are made there, so only the last segment has a tail.
        self.tail = self.lead[:-1]

    def insert(self) -> None:
        self.q = TURN[self.q]
        self.audit.append("I")
        self.lead += ROLE[self.q] + ":\n"

    def run(self, sym: int, n: int, after: Costs) -> None:
        if n > LEAF_ROWS:
            half = n // 2
            self.run(sym, half, before_run(sym, n - half, after))
            self.run(sym, n - half, after)
            return
        costs = [after]
        for _ in range(n):
            costs.append(ahead(power(sym, 0), costs[-1]))
        for j in range(n, 0, -1):
            self.edit(sym, costs[j], costs[j - 1])

    def edit(self, sym: int, here: Costs, after: Costs) -> None:
        """The ASCII-least edits of one row that keep the cost to go: D, I, K, R in this order."""
        late = CUT * ((sym - 1) % 2) if sym != GONE else 0
        while here[self.q] != DELETE + after[self.q]:
            q = self.q
            if here[q] == INSERT + here[TURN[q]]:
                self.insert()
                continue
            to = kept_state(sym, q)
            if to is not None and here[q] == KEEP + late + after[to]:
                self.stay("K", to, None)
            else:
                self.stay("R", TURN[q], ROLE[TURN[q]])
            break
        else:
            self.audit.append("D")
        self.row += 1

    def stay(self, edit: str, to: int, role: str | None) -> None:
        self.audit.append(edit)
        self.index.append(self.row)
        self.leads.append(self.lead)
        self.roles.append(role)
        self.q, self.lead = to, ""


def runs_of(syms: bytes) -> list[tuple[int, int]]:
    return [(sym, sum(1 for _ in same)) for sym, same in groupby(syms)]


def numbered_rows(turns: DataFrame) -> DataFrame:
    """Rows with a number, the hash of their text and what can be told from the row alone; written, so texts are looked at once."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")).alias("conv"),
                        F.col("turn").cast("long").alias("turn"), some("role").alias("role"), some("text").alias("text"))
    return written(rows.select(
        F.monotonically_increasing_id().alias("rid"), "*", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"),
        F.coalesce(F.nullif(F.left(F.col("role"), F.lit(1)), F.lit("")), F.lit(" ")).alias("initial"),
        (F.btrim("text", F.lit(BLANKS)) == "").alias("blank"),
        (~F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1)).isin(".", "!", "?")).alias("cut")), "turns")


def marked_rows(rows: DataFrame) -> DataFrame:
    """Rows without their texts: conv, turn, role, sha, rid, initial and fault (b, d, t or none)."""
    facts = rows.drop("text")
    # Equal rows are combined before the shuffle; the joins meet on row numbers, which are distinct.
    first = facts.groupBy("conv", "role", "sha").agg(F.min(F.struct("turn", "rid")).alias("f")).select(F.col("f.rid").alias("first_rid"))
    fault = F.when(F.col("blank"), "b").when(F.col("first_rid").isNull(), "d").when(F.col("cut"), "t").otherwise("")
    return (facts.join(first, F.col("rid") == F.col("first_rid"), "left")
            .select("conv", "turn", "role", "sha", "rid", "initial", fault.alias("fault")))


SEGMENT_SCHEMA = ("conv string, seg long, rids array<long>, syms binary, matrix array<long>, low long, high long, n_turns long, "
                  "blank long, duplicate long, truncated long, illegal long, head string, last string")
LEGAL = {"su", "ua", "au"}


def segments(marked: DataFrame) -> DataFrame:
    """The parts of conversations that lie in one range partition, in order, with their matrix and counts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n_seg = TaskContext.get().partitionId() << 32, 0
        open_: dict | None = None
        done: list[dict] = []
        n_done = 0

        def close() -> None:
            nonlocal open_, n_done
            if open_ is not None:
                open_["syms"] = bytes(open_["syms"])
                open_["matrix"] = [x for r in segment_matrix(runs_of(open_["syms"])) for x in r]
                done.append(open_)
                n_done += len(open_["rids"])
            open_ = None

        def flush() -> pa.RecordBatch:
            nonlocal n_done
            n_done = 0
            batch = pa.RecordBatch.from_pylist(done, schema=arrow_schema)
            done.clear()
            return batch

        for b in batches:
            for conv, turn, rid, initial, fault in zip(*[b.column(i).to_pylist() for i in range(5)]):
                if open_ is None or open_["conv"] != conv or len(open_["rids"]) >= SEGMENT_ROWS:
                    close()
                    open_ = {"conv": conv, "seg": base + n_seg, "rids": [], "syms": bytearray(), "low": None, "high": None, "n_turns": 0,
                             "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "head": initial, "last": None}
                    n_seg += 1
                    if n_done >= SEGMENT_ROWS // 8:
                        yield flush()
                s = open_
                s["rids"].append(rid)
                s["syms"].append(symbol(initial, fault in ("b", "d"), fault == "t"))
                if fault:
                    s[{"b": "blank", "d": "duplicate", "t": "truncated"}[fault]] += 1
                if s["last"] is not None and s["last"] + initial not in LEGAL:
                    s["illegal"] += 1
                s["last"] = initial
                if turn is not None:
                    s["n_turns"] += turn != s["high"]
                    s["low"], s["high"] = turn if s["low"] is None else s["low"], turn
        close()
        if done:
            yield flush()

    arrow_schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}[t])
                              for n, t in (x.split() for x in SEGMENT_SCHEMA.split(", "))])
    order = ["conv", "turn", "role", "sha", "rid"]
    n = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = marked.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return written(ordered.select("conv", "turn", "rid", "initial", "fault").mapInArrow(cut, SEGMENT_SCHEMA), "segments")


CHAIN_SCHEMA = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                "segs array<struct<seg:long,place:int,last:boolean,after:array<long>>>")


def chains(segs: DataFrame) -> DataFrame:
    """One row per conversation: its counts, cost, and for each segment the costs to go after it."""
    parts = F.sort_array(F.collect_list(F.struct("seg", "matrix", "low", "high", "n_turns", "blank", "duplicate", "truncated",
                                                 "illegal", "head", F.col("last").alias("tail"))))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                after, segs_out = END, []
                for i in range(len(own) - 1, -1, -1):
                    segs_out.append({"seg": own[i]["seg"], "place": i, "last": i == len(own) - 1, "after": list(after)})
                    m = own[i]["matrix"]
                    after = ahead(tuple(tuple(m[4 * q:4 * q + 4]) for q in STATES), after)
                total = {k: sum(s[k] for s in own) for k in ("blank", "duplicate", "truncated", "illegal")}
                total["illegal"] += sum(x["tail"] + y["head"] not in LEGAL for x, y in zip(own, own[1:]))
                turned = [s for s in own if s["low"] is not None]
                n_turns = sum(s["n_turns"] for s in turned) - sum(x["high"] == y["low"] for x, y in zip(turned, turned[1:]))
                gaps = turned[-1]["high"] - turned[0]["low"] + 1 - n_turns if turned else 0
                out.append({"conv": conv, "gaps": gaps, **total, "cost": after[0], "segs": segs_out})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    part = pa.struct([("seg", pa.int64()), ("place", pa.int32()), ("last", pa.bool_()), ("after", pa.list_(pa.int64()))])
    schema = pa.schema([("conv", pa.string()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        ("segs", pa.list_(part))])
    return written(segs.groupBy("conv").agg(parts.alias("parts")).mapInArrow(chain, CHAIN_SCHEMA), "chains")


UNROLL_SCHEMA = ("conv string, seg long, place int, last boolean, start int, stop int, audit string, rids array<long>, leads array<string>, "
                 "roles array<string>, tail string")


def unrolled(segs: DataFrame, chained: DataFrame) -> DataFrame:
    """Each segment's edits from every state that it may start in, and the state it ends in."""
    plan = chained.select(F.col("conv").alias("c"), F.explode("segs").alias("p")).select(
        "c", F.col("p.seg").alias("p_seg"), "p.place", F.col("p.last").alias("is_last"), "p.after")
    # seg is distinct over all conversations.
    tasks = segs.select("conv", "seg", "rids", "syms").join(plan, (F.col("seg") == F.col("p_seg")) & (F.col("conv") == F.col("c")))

    def unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, seg, rids, syms, place, last, after in zip(*[b.column(i).to_pylist() for i in range(7)]):
                runs, after = runs_of(syms), tuple(after)
                for start in STATES if place else (0,):
                    if ahead(segment_matrix(runs), after)[start] < NEVER:
                        u = Unroll(runs, start, after, last)
                        out.append({"conv": conv, "seg": seg, "place": place, "last": last, "start": start, "stop": u.q, "audit": "".join(u.audit),
                                    "rids": [rids[i] for i in u.index], "leads": u.leads, "roles": u.roles, "tail": u.tail})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in UNROLL_SCHEMA.split(", "))])
    return written(tasks.select("conv", "seg", "rids", "syms", "place", "is_last", "after").mapInArrow(unroll, UNROLL_SCHEMA), "unrolled")


def chosen(every: DataFrame) -> DataFrame:
    """The unrolls that fit together: each segment starts in the state that the one before it ended in."""
    whole = every.filter((F.col("place") == 0) & F.col("last"))
    parts = every.filter(~((F.col("place") == 0) & F.col("last")))
    steps = F.sort_array(F.collect_list(F.struct("place", "start", "stop", "seg")))
    none = F.struct(F.lit(0).alias("state"), F.lit(0).alias("next"), F.array().cast("array<struct<seg:bigint,start:int>>").alias("picks"))

    def step(acc: Column, x: Column) -> Column:
        fits = (x["place"] == acc["next"]) & (x["start"] == acc["state"])
        pick = F.array(F.struct(x["seg"].alias("seg"), x["start"].alias("start")))
        return F.struct(F.when(fits, x["stop"]).otherwise(acc["state"]).alias("state"), F.when(fits, acc["next"] + 1).otherwise(acc["next"]).alias("next"),
                        F.when(fits, F.concat(acc["picks"], pick)).otherwise(acc["picks"]).alias("picks"))

    picks = parts.groupBy("conv").agg(F.aggregate(steps, none, step, lambda acc: acc["picks"]).alias("picks")).select(F.explode("picks").alias("p"))
    picked = picks.select(F.col("p.seg").alias("seg"), F.col("p.start").alias("start"))
    return whole.unionByName(parts.join(picked, ["seg", "start"], "left_semi"))


def digests(edits: DataFrame, rows: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its repaired rows, each ``role:text``, joined by line ends; streamed in order."""
    stay = edits.select("conv", "seg", F.posexplode(F.arrays_zip("rids", "leads", "roles")).alias("at", "e")).select(
        "conv", "seg", "at", F.col("e.rids").alias("e_rid"), F.col("e.leads").alias("lead"), F.col("e.roles").alias("new_role"))
    texts = rows.select("rid", F.col("role").alias("old_role"), "text")
    lines = stay.join(texts, F.col("e_rid") == F.col("rid")).select(
        "conv", "seg", "at", F.concat("lead", F.coalesce("new_role", "old_role"), F.lit(":"), "text").alias("line"))
    tails = edits.filter("tail <> ''").select("conv", "seg", F.lit(2**31 - 1).alias("at"), F.col("tail").alias("line"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha = None, None
        for b in batches:
            names, out = b.column(0).to_pylist(), []
            for name, line in zip(names, b.column(1)):
                if name != conv:
                    if conv is not None:
                        out.append((conv, sha.hexdigest()))
                    conv, sha = name, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(line.as_buffer())
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], ["conv", "sha256"])
        if conv is not None:
            yield pa.record_batch([[conv], [sha.hexdigest()]], ["conv", "sha256"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.unionByName(tails).repartition(n, "conv").sortWithinPartitions("conv", "seg", "at")
    return ordered.select("conv", "line").mapInArrow(stream, "conv string, sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The test damage: crc32 of ``conv_id:turn`` modulo 20 drops, empties, cuts, repeats or reroles a row; nulls are one blank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"),
                        (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20).alias("crc"))
    text = F.when(F.col("crc") == 1, "").when(F.col("crc") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("crc") == 4, "user").otherwise(F.col("role"))
    times_ = F.explode(F.array_repeat(F.lit(0), F.when(F.col("crc") == 3, 2).otherwise(1)))
    return rows.filter("crc <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times_.alias("copy")).drop("copy")


def repair(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct ``conv_id`` of ``ids``: faults, cost, audit and digest of the repaired conversation.

    ``turns`` has conv_id, turn, role and text; ``ids`` may name conversations that have no rows there.
    """
    rows = numbered_rows(turns)
    segs = segments(marked_rows(rows))
    chained = chains(segs)
    edits = written(chosen(unrolled(segs, chained)), "edits")
    audits = edits.groupBy("conv").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    all_ids = ids.select("conv_id").distinct().withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")))
    out = (all_ids.join(chained.drop("segs"), "conv", "left").join(audits, "conv", "left").join(digests(edits, rows), "conv", "left"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
