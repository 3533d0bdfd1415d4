"""opsflow: operations-analytics jobs (sales file ingest, care-task rules,
task-log lifecycle, compliance checks) as Spark DataFrame plans.

Entry points:
- ``opsflow.plans.jobs``: the scheduled procedures over versioned state
  (``run_rules``, ``run_manager``, ``run_fail_summary``, ``run_compliance``);
- ``opsflow.plans.ingest.run_etl`` / ``opsflow.streaming.ingest_stream.start_ingest_stream``:
  the sales-file load, batch or streaming;
- ``opsflow.plans.{triggers,compliance,tasklog,reports}``: the individual jobs,
  each ``(DataFrames..., as_of) -> DataFrame``;
- ``python -m opsflow``: the command line.
"""

__version__ = "0.1.0"
