"""The two logged jobs (J1-J3) and their log."""

import json
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souqframe.operators.reports import system_counts
from souqframe.plans.views import refresh_all_materialized_views
from souqframe.plans.warehouse import Warehouse
from souqframe.schemas import JOB_LOG_SCHEMA

SUCCESS, FAILED = "SUCCESS", "FAILED"


def _iso(seconds: float) -> str:
    return datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None).isoformat()


def log_job_execution(
    warehouse: Warehouse,
    job_name: str,
    start_time: float,
    end_time: float,
    status: str,
    details: dict | None = None,
    error: str | None = None,
) -> dict:
    """K7: adds one run to the job log; times are UTC."""
    run = {
        "job_name": job_name,
        "start_time": _iso(start_time),
        "end_time": _iso(end_time),
        "duration_seconds": round(end_time - start_time, 4),
        "status": status,
        "details": json.dumps(details or {}, ensure_ascii=False),
        "error": error,
        "created_at": time.time(),
    }
    warehouse.spark.createDataFrame([run], JOB_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(
        warehouse.job_log_path
    )
    return run


def _run_logged(warehouse: Warehouse, job_name: str, work: Callable[[Warehouse], dict]) -> dict:
    started = time.time()
    try:
        details = work(warehouse)
    except Exception as problem:
        log = log_job_execution(
            warehouse, job_name, started, time.time(), FAILED, error=str(problem)
        )
        return {"status": FAILED, "job_name": job_name, "error": str(problem), "log": log}
    log = log_job_execution(warehouse, job_name, started, time.time(), SUCCESS, details)
    return {"status": SUCCESS, "job_name": job_name, "log": log}


def run_refresh_mv_job(warehouse: Warehouse) -> dict:
    """Brings the summary tables up to date."""
    return _run_logged(warehouse, "refresh_materialized_views_job", refresh_all_materialized_views)


def _audit(warehouse: Warehouse) -> dict:
    counts = system_counts(warehouse.validated.read(), warehouse.quarantine.read())
    return counts.first().asDict()


def run_periodic_audit_job(warehouse: Warehouse) -> dict:
    """Counts the stored orders."""
    return _run_logged(warehouse, "periodic_system_audit_job", _audit)


JOBS_REGISTRY: dict[str, Callable[[Warehouse], dict]] = {
    "refresh_materialized_views_job": run_refresh_mv_job,
    "periodic_system_audit_job": run_periodic_audit_job,
}


def run_job_by_name(warehouse: Warehouse, job_name: str) -> dict:
    """A job by its name."""
    if job_name not in JOBS_REGISTRY:
        raise ValueError(f"no job '{job_name}'; there are {', '.join(JOBS_REGISTRY)}")
    return JOBS_REGISTRY[job_name](warehouse)


def get_job_logs(warehouse: Warehouse, limit: int = 20) -> DataFrame:
    """The last runs, latest first."""
    return warehouse.job_logs().orderBy(F.desc("created_at"), "job_name").limit(limit)
