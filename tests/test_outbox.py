"""Send once: crashes at every write of the task manager, repeated tasks, versions without their marker."""
import os
import uuid
from collections import Counter
from datetime import datetime

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from opsflow.plans import jobs, outbox
from opsflow.schemas import LOG_DDL
from opsflow.sources.tables import Tables
from opsflow.sources.versioned import VersionedTable

AS_OF = datetime(2024, 5, 6, 7, 8, 9)
N = 40


class Crash(Exception):
    pass


def counting(folder):
    """A vendor that notes every payload it is handed in a folder of its own."""
    os.makedirs(folder)

    def call(payload):
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(payload)
        return '{"statusCode":200,"data":"Task \'7\' ok"}'

    def calls():
        return Counter(open(os.path.join(folder, n)).read() for n in os.listdir(folder))

    return outbox.row_sender(call), calls


@pytest.fixture()
def state(spark, scratch):
    rows = spark.range(1, N + 1).select(F.col("id").alias("taskid"), F.lit("ADD HOLD NOTE").alias("task_code"),
                                        F.lit("Pending").alias("status"), F.concat(F.lit("note "), "id").alias("notes"), F.lit(1).alias("grp1_type1"))
    log = VersionedTable(spark, scratch + "/log")
    log.write_next(spark.createDataFrame([], LOG_DDL).unionByName(rows, allowMissingColumns=True))
    types = spark.createDataFrame([(1, "Role")], "id int, type string")
    return Tables.from_frames(assignee_types=types), log, VersionedTable(spark, scratch + "/queue")


def outcome(log):
    return Counter((r.status, r.ehr_task_number) for r in log.read().collect())


@pytest.mark.parametrize("where", ["intents", "first wave", "answers commit", "log", "queue", "applied"])
def test_each_payload_is_sent_once(spark, scratch, state, monkeypatch, where):
    t, log, queue = state
    send, calls = counting(scratch + "/calls")
    create, write_next = outbox.Files.create, VersionedTable.write_next

    def crash_at_marker(part):
        def broken(self, path):
            if path.endswith(part):
                raise Crash
            return create(self, path)
        return broken

    with monkeypatch.context() as m:
        if where == "intents":
            m.setattr(outbox.Files, "create", crash_at_marker("/_intents"))
        elif where == "first wave":
            m.setattr(outbox.Files, "create", crash_at_marker("/_wave-0"))
        elif where == "answers commit":
            m.setattr(outbox.Files, "create", crash_at_marker("/_answers-1"))
        elif where == "applied":
            m.setattr(outbox.Files, "create", crash_at_marker("/_applied"))
        else:
            def broken(self, df):
                if self.root.endswith("/" + where):
                    raise Crash
                return write_next(self, df)
            m.setattr(VersionedTable, "write_next", broken)
        with pytest.raises(Crash):
            jobs.run_manager(t, log, queue, AS_OF, send, waves=4)
    jobs.run_manager(t, log, queue, AS_OF, send, waves=4)
    assert len(calls()) == N and set(calls().values()) == {1} and outcome(log) == {("Sent", "7"): N} and queue.read().count() == 0
    jobs.run_manager(t, log, queue, AS_OF, send, waves=4)  # nothing is left to send
    assert sum(calls().values()) == N


def test_wave_cut_off_while_sending(spark, scratch, state):
    t, log, queue = state
    send, calls = counting(scratch + "/calls")
    sent = []

    def dying(payloads):
        sent.append(1)
        if len(sent) == 2:
            raise Crash
        return send(payloads)

    with pytest.raises(Crash):
        jobs.run_manager(t, log, queue, AS_OF, dying, waves=4)
    assert sum(calls().values()) == N // 4
    jobs.run_manager(t, log, queue, AS_OF, send, waves=4)
    held = log.read().filter("status = 'Failed'")
    assert set(calls().values()) == {1} and held.count() == N // 4 and outcome(log)[("Sent", "7")] == 3 * N // 4
    assert "check with the vendor" in held.first().status_note and {r.taskid % 4 for r in held.collect()} == {1}


def test_resend_covers_only_what_has_no_answer(spark, scratch, state):
    t, log, queue = state
    box = outbox.Outbox(spark, log.root + "-outbox")
    run = box.begin(log.read().select("taskid", F.concat(F.lit("p"), "taskid").alias("payload")), 4)
    assert box.open_run() == run and box.waves(run) == [0, 1, 2, 3]
    with pytest.raises(RuntimeError):
        box.begin(log.read().select("taskid", F.lit("p").alias("payload")), 4)
    # Wave 2 was begun; the answer of task 2 got written, the commit did not.
    box.files.create(f"{box.root}/run={run}/_wave-2")
    spark.createDataFrame([(2, "stored")], outbox.ANSWER_DDL).write.parquet(f"{box.root}/run={run}/answers-2")
    send, calls = counting(scratch + "/calls")
    got = {r.taskid: r.response for r in box.send(run, send, unanswered="resend").collect()}
    assert got[2] == "stored" and "p2" not in calls() and len(got) == N and set(calls().values()) == {1}


def test_a_repeated_task_does_not_call_again(spark, scratch):
    send, calls = counting(scratch + "/calls")
    payloads = spark.range(20).select(F.col("id").alias("taskid"), F.col("id").cast("string").alias("payload")).repartition(2)

    def lost(batches):
        yield from batches
        if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("injected loss after sending")

    answers = send(payloads).mapInArrow(lost, outbox.ANSWER_DDL).collect()
    assert len(answers) == 20 and set(calls().values()) == {1} and len(calls()) == 20
    unknown = [r for r in answers if r.response == outbox.UNKNOWN]
    assert 0 < len(unknown) < 20


def test_versions_do_not_depend_on_sparks_marker(spark, scratch):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        table = VersionedTable(spark, scratch + "/t[1]{a,b}*")
        assert table.write_next(spark.range(3)) == 1 and table.write_next(spark.range(5)) == 2
        assert table.current_version() == 2 and table.read().count() == 5 and table.read(1).count() == 3
    finally:
        conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")


def test_data_without_any_commit_is_not_overwritten(spark, scratch):
    table = VersionedTable(spark, scratch + "/t")
    spark.range(4).write.parquet(scratch + "/t/v=1")
    for use in (table.current_version, lambda: table.write_next(spark.range(9)), table.read):
        with pytest.raises(RuntimeError):
            use()
    table.adopt(1)
    assert table.read().count() == 4 and table.write_next(spark.range(9)) == 2


def test_crash_of_the_first_write_is_replaced(spark, scratch):
    table = VersionedTable(spark, scratch + "/t")
    broken = spark.range(4).select(F.raise_error(F.lit("lost")))
    with pytest.raises(Exception):
        table.write_next(broken)
    assert table.current_version() is None and table.write_next(spark.range(2)) == 1 and table.read().count() == 2
