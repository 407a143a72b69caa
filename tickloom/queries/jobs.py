"""Job quality over runs derived from events: five jobs, an error event is a failed run."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.plans import monitor
from tickloom.queries import base
from tickloom.queries.base import query, rounded, sql_r6
from tickloom.schemas import JOB_RUNS, conform

_RUNS = """runs AS (
  SELECT user_id % 5 AS job_id, 'job ' || (user_id % 5) AS job_name, event_id AS run_id, epoch_ms(ts) AS start_time,
         CAST(floor(value * 60000) AS BIGINT) AS execution_duration,
         CASE WHEN value > 150 THEN 'RUNNING' ELSE 'TERMINATED' END AS life_cycle_state,
         CASE WHEN value > 150 THEN NULL WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS result_state
  FROM events)"""


def runs(spark, sf):
    """Two tasks per run: the first carries the run's result, the second always succeeds."""
    e = base.table(spark, sf, "events")
    running = F.col("value") > 150
    result = F.when(~running, F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS"))
    state = F.struct(
        F.when(running, "RUNNING").otherwise("TERMINATED").alias("life_cycle_state"),
        result.alias("result_state"),
        F.col("event_type").alias("state_message"),
    )
    task = lambda key, shift, s: F.struct(F.lit(key).alias("task_key"), (F.col("event_id") * 2 + shift).alias("run_id"), s.alias("state"))
    done = F.struct(F.lit("TERMINATED").alias("life_cycle_state"), F.lit("SUCCESS").alias("result_state"), F.lit("").alias("state_message"))
    job = F.col("user_id") % 5
    rows = e.select(
        job.alias("job_id"),
        F.concat(F.lit("job "), job.cast("string")).alias("job_name"),
        F.col("event_id").alias("run_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("start_time"),
        F.floor(F.col("value") * 60000).alias("execution_duration"),
        state.alias("state"),
        F.array(task("load", 0, state), task("score", 1, done)).alias("tasks"),
    )
    return conform(rows, JOB_RUNS)


_RECENT = f"""{_RUNS}, recent AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY start_time DESC, run_id DESC) <= 20),
latest AS (SELECT * FROM recent QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY life_cycle_state = 'TERMINATED' DESC, start_time DESC, run_id DESC) = 1),
counts AS (SELECT job_id, count(*) AS run_count, count(*) FILTER (life_cycle_state = 'TERMINATED') AS terminal_runs,
  count(*) FILTER (life_cycle_state = 'TERMINATED' AND result_state = 'SUCCESS') AS successful_runs,
  count(*) FILTER (life_cycle_state = 'TERMINATED' AND coalesce(result_state, '') <> 'SUCCESS') AS failed_runs FROM recent GROUP BY 1),
jobs AS (SELECT c.*, successful_runs / nullif(terminal_runs, 0) AS success_rate, l.run_id AS latest_run_id, l.execution_duration / 60000 AS latest_duration_minutes,
  CASE WHEN l.life_cycle_state = 'TERMINATED' THEN CAST(coalesce(l.result_state = 'SUCCESS', false) AS INTEGER) END AS latest_success,
  CASE WHEN coalesce(l.result_state, '') <> 'SUCCESS' THEN 1 ELSE 0 END AS failed_task_count FROM counts c JOIN latest l USING (job_id))"""


@query(
    "job_quality",
    f"""WITH {_RECENT} SELECT job_id, run_count, terminal_runs, successful_runs, failed_runs, {sql_r6('success_rate', 'success_rate')}, latest_run_id,
    {sql_r6('latest_duration_minutes', 'latest_duration_minutes')}, latest_success, failed_task_count FROM jobs""",
)
def job_quality(spark, sf):
    out = monitor.job_quality(runs(spark, sf)).withColumn("failed_task_count", F.size("failed_tasks"))
    columns = ["job_id", "run_count", "terminal_runs", "successful_runs", "failed_runs", "success_rate", "latest_run_id", "latest_duration_minutes", "latest_success", "failed_task_count"]
    return rounded(out.select(*columns))


_METRICS = f"""{_RECENT}, rows AS (
  SELECT 'job_quality_matching_job_count' AS metric_name, count(*)::DOUBLE AS v, 'ok' AS status FROM jobs
  UNION ALL SELECT 'job_quality_success_rate_' || job_id, success_rate, CASE WHEN success_rate IS NULL THEN 'warn' WHEN success_rate < 0.8 THEN 'alert' ELSE 'ok' END FROM jobs
  UNION ALL SELECT 'job_quality_failed_run_count_' || job_id, failed_runs, CASE WHEN failed_runs = 0 THEN 'ok' ELSE 'alert' END FROM jobs
  UNION ALL SELECT 'job_quality_latest_duration_minutes_' || job_id, latest_duration_minutes, CASE WHEN latest_duration_minutes IS NULL THEN 'warn' WHEN latest_duration_minutes > 60 THEN 'alert' ELSE 'ok' END FROM jobs
  UNION ALL SELECT 'job_quality_latest_success_' || job_id, latest_success, CASE WHEN latest_success = 1 THEN 'ok' WHEN latest_success IS NULL THEN 'warn' ELSE 'alert' END FROM jobs
  UNION ALL SELECT 'job_quality_latest_failed_task_count_' || job_id, failed_task_count, CASE WHEN failed_task_count = 0 THEN 'ok' ELSE 'alert' END FROM jobs)"""


@query("job_quality_metrics", f"WITH {_METRICS} SELECT metric_name, {sql_r6('v', 'metric_value')}, status FROM rows")
def job_quality_metrics(spark, sf):
    out = monitor.job_quality_metrics(runs(spark, sf), base.newest_event(spark, sf))
    return rounded(out.select("metric_name", "metric_value", "status"))


@query(
    "job_trace",
    f"""WITH {_METRICS} SELECT 'job_quality_latest_failed_task_count_' || job_id AS metric_name, job_id, latest_run_id AS run_id,
    '/#job/' || job_id || '/run/' || latest_run_id AS run_url, CASE WHEN failed_task_count > 0 THEN 'load' END AS failed_task FROM jobs""",
)
def job_trace(spark, sf):
    """The trace JSON written by the metrics, read back into nested columns."""
    decoded = monitor.decode_trace(monitor.job_quality_metrics(runs(spark, sf), base.newest_event(spark, sf)))
    rows = decoded.where(F.col("metric_name").startswith("job_quality_latest_failed_task_count_"))
    return rows.select("metric_name", "trace.job_id", "trace.run_id", "trace.run_url", F.get("trace.failed_tasks", F.lit(0))["task_key"].alias("failed_task"))
