"""Sending tasks to the vendor so that none is sent twice.

The source sends one task, records its answer, and goes on to the next, so a
crash can repeat at most the one call that was under way. Here a run sends in
*waves*, each a Spark job, and keeps a log of intents beside the task log:

    ROOT/run=R/intents      taskid, payload, wave       written before any call
    ROOT/run=R/_intents     commit of the intents
    ROOT/run=R/_wave-K      wave K is about to be sent
    ROOT/run=R/answers-K    taskid, response            answers of wave K
    ROOT/run=R/_answers-K   commit of those answers
    ROOT/run=R/settled-K    what a restart made of a wave without that commit, and its commit _settled-K
    ROOT/run=R/_applied     log and queue hold the answers

A restart takes up the run that was not applied. Waves with committed answers are
not sent again: their answers are read. Waves never begun are sent. Of a wave
that was begun but not committed, the answers that did get written are kept; its other
tasks may or may not have reached the vendor: by default (``unanswered="hold"``) they
get the answer ``UNKNOWN``, a failure that names the doubt, and stay for a person to
settle, while ``"resend"`` sends them again (for vendors that ignore repeats).

Spark may run a task again after a lost executor. ``row_sender`` makes a sender
from a function of one payload that does not call it again in a repeated task:
rows of such a task get ``UNKNOWN`` too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Files, literal

UNKNOWN = '{"statusCode":0,"detailedMessage":"Sending began but no answer is on record; check with the vendor"}'
ANSWER_DDL = "taskid bigint, response string"


def row_sender(call: Callable[[str], str]) -> Callable[[DataFrame], DataFrame]:
    """A sender that calls ``call(payload) -> response`` once per row, never in a repeated task."""
    unknown = UNKNOWN

    def send(payloads: DataFrame) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            context = TaskContext.get()
            again = context.attemptNumber() > 0
            for b in batches:
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([unknown if again else call(t) for t in texts], pa.string())],
                                      ["taskid", "response"])

        return payloads.select("taskid", "payload").mapInArrow(rows, ANSWER_DDL)

    return send


class Outbox:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def _runs(self) -> list[int]:
        return sorted(int(n[4:]) for n, is_dir in self.files.listing(self.root) if is_dir and n.startswith("run=") and n[4:].isdigit())

    def open_run(self) -> int | None:
        """The run whose intents are committed but whose answers are not applied; there is one at most."""
        return next((r for r in self._runs() if self._has(r, "_intents") and not self._has(r, "_applied")), None)

    def _has(self, run: int, name: str) -> bool:
        return self.files.exists(f"{self.root}/run={run}/{name}")

    def begin(self, payloads: DataFrame, waves: int) -> int:
        """Commit the intents of a new run: every payload and the wave that will send it. Nothing is sent yet."""
        if self.open_run() is not None:
            raise RuntimeError(f"{self.root}: run {self.open_run()} is not applied yet")
        run = max(self._runs(), default=0) + 1
        wave = F.pmod(F.col("taskid"), F.lit(waves)).cast("int")
        payloads.select("taskid", "payload", wave.alias("wave")).write.partitionBy("wave").parquet(f"{self.root}/run={run}/intents")
        self.files.create(f"{self.root}/run={run}/_intents")
        return run

    def intents(self, run: int) -> DataFrame:
        """taskid, payload and wave of a run."""
        schema = "taskid bigint, payload string, wave int"
        return self.spark.read.schema(schema).parquet(literal(f"{self.root}/run={run}/intents"))

    def waves(self, run: int) -> list[int]:
        names = [n for n, is_dir in self.files.listing(f"{self.root}/run={run}/intents") if is_dir and n.startswith("wave=")]
        return sorted(int(n[5:]) for n in names)

    def send(self, run: int, sender: Callable[[DataFrame], DataFrame], unanswered: str = "hold") -> DataFrame:
        """Bring every wave to committed answers, sending only what was never begun; all answers of the run."""
        if unanswered not in ("hold", "resend"):
            raise ValueError(f"unanswered is hold or resend, not {unanswered}")
        for k in self.waves(run):
            if self._kept(run, k):
                continue
            own = self.intents(run).filter(F.col("wave") == k).select("taskid", "payload")
            if not self._has(run, f"_wave-{k}"):
                self.files.create(f"{self.root}/run={run}/_wave-{k}")
                self._commit(sender(own), run, "answers", k)
                continue
            written = self._answers(run, [f"answers-{k}"] if self._has(run, f"answers-{k}") else [])
            open_ = own.join(written, "taskid", "left_anti")
            rest = sender(open_) if unanswered == "resend" else open_.select("taskid", F.lit(UNKNOWN).alias("response"))
            self._commit(written.unionByName(rest.select("taskid", "response")), run, "settled", k)
        return self.answers(run)

    def _commit(self, answers: DataFrame, run: int, kind: str, k: int) -> None:
        answers.select(F.col("taskid").cast("bigint"), F.col("response").cast("string")).write.mode("overwrite").parquet(
            f"{self.root}/run={run}/{kind}-{k}")
        self.files.create(f"{self.root}/run={run}/_{kind}-{k}")

    def _kept(self, run: int, k: int) -> str | None:
        """The folder with the wave's committed answers."""
        return next((f"{kind}-{k}" for kind in ("answers", "settled") if self._has(run, f"_{kind}-{k}")), None)

    def _answers(self, run: int, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], ANSWER_DDL)
        return self.spark.read.schema(ANSWER_DDL).parquet(*[literal(f"{self.root}/run={run}/{n}") for n in names])

    def answers(self, run: int) -> DataFrame:
        """Committed answers of a run."""
        return self._answers(run, [n for k in self.waves(run) if (n := self._kept(run, k))])

    def applied(self, run: int) -> None:
        self.files.create(f"{self.root}/run={run}/_applied")
