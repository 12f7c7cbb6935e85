"""Run reports, publish their results and record every run."""

from __future__ import annotations

import logging
import time
import traceback
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from threading import Event

from py4j.protocol import Py4JError
from pyspark import InheritableThread, StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from farelane.functions.calendar import Span
from farelane.operators import load, partitions, publishing
from farelane.operators.runlog import append_log, log_entry
from farelane.sources.star import Star


@dataclass(frozen=True)
class Job:
    """A named report and where its results go; no path means it is not published there.

    ``csv_path`` is the folder that holds all published reports. ``definition``, ``job_type`` and the ``delete`` fields are
    the registry's, for the run log.
    """

    name: str
    report: Callable[[Star, Span], DataFrame]
    csv_path: str | None = None
    mart_path: str | None = None
    keep_days: int | None = None
    definition: str | None = None
    job_type: str | None = None
    delete_column: str | None = None
    delete_condition: str | None = None


STATUS_SCHEMA = "job_name string, period string, status string, rows_inserted bigint, published string, message string"
Logger = Callable[[tuple, int, str | None], None]


def run_job(star: Star, span: Span, job: Job) -> tuple:
    """Compute a report once, publish it, return its status row.

    The result is held while it is looked at and published, and released after. One row decides whether it is empty; an
    empty result takes the place of what its periods had before. Expired periods go after each run, also an empty one; a
    fault there is a warning, as the rows are out.
    """
    period = f"{span.level} {span.first}..{span.last}"
    result = job.report(star, span)
    to_mart = bool(job.mart_path) and not load.missing_partitions(result)
    if not (job.csv_path or to_mart):
        rows = result.count()
        return (job.name, period, "success", rows, "", "") if rows else (job.name, period, "empty", 0, "", "no rows")
    result = result.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        empty, rows, done = result.isEmpty(), 0, []
        if job.csv_path:
            rows = publishing.publish(result, job.csv_path, job.name, span)
            done.append("csv")
        if to_mart:
            partitions.replace_days(result, job.mart_path, span.first, span.last)
            done.append("mart")
        if empty:
            row = job.name, period, "empty", 0, "", "no rows"
        else:
            row = job.name, period, "success", rows or result.count(), ",".join(done), ""
    finally:
        result.unpersist()
    if job.csv_path and job.keep_days is not None:
        try:
            publishing.expire(star.spark, job.csv_path, job.name, span.last, job.keep_days, spare=span)
        except (PySparkException, Py4JError, OSError):
            logging.getLogger(__name__).warning("expired periods of %s could not be removed", job.name, exc_info=True)
    return row


def _at_fault_alone(fault: Exception) -> bool:
    """Whether a fault is the job's own (its query, its data), so that other jobs can go on."""
    return isinstance(fault, (PySparkException, ValueError, KeyError))


class Batch:
    """All jobs for all spans. ``cancel`` keeps jobs from starting and ends those that run.

    With several ``workers`` as many jobs run at once, each in a fair-scheduler pool of its own; a status row is the
    same as in a sequential run, and the rows come in the same order. Every job carries an operation tag of the batch.
    """

    def __init__(self, star: Star, spans: list[Span], jobs: list[Job], log: Logger | None = None, workers: int = 1):
        self.star, self.log, self.workers = star, log, workers
        self.work = [(span, job) for span in spans for job in jobs]
        self.tag = f"farelane-batch-{id(self)}"
        self._stop = Event()

    def cancel(self) -> None:
        """Stop: jobs that run are interrupted, the others are recorded as cancelled."""
        self._stop.set()
        self.star.spark.interruptTag(self.tag)

    def _one(self, span: Span, job: Job, pool: str | None) -> tuple[tuple, Exception | None]:
        spark, period = self.star.spark, f"{span.level} {span.first}..{span.last}"
        began, stop, trace = time.monotonic(), None, None
        if self._stop.is_set():
            row = (job.name, period, "cancelled", 0, "", "the batch was cancelled")
        else:
            spark.addTag(self.tag)
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
            try:
                row = run_job(self.star, span, job)
            except Exception as fault:  # noqa: BLE001 - recorded, and raised again unless the job alone is at fault
                cancelled = self._stop.is_set()
                row = (job.name, period, "cancelled" if cancelled else "error", 0, "", str(fault) or type(fault).__name__)
                trace = traceback.format_exc()
                stop = None if cancelled or _at_fault_alone(fault) else fault
            finally:
                spark.removeTag(self.tag)
        if self.log:
            try:
                self.log(row, int((time.monotonic() - began) * 1000), trace)
            except Exception:  # noqa: BLE001
                logging.getLogger(__name__).warning("the run of %s could not be logged", job.name, exc_info=True)
        if stop:
            self._stop.set()
        return row, stop

    def run(self) -> DataFrame:
        """One status row for each job and span.

        A job that fails on its own is recorded and the others run. Any other error (a dead context, a fault of the
        program) is recorded too, stops the batch and is raised. What the star held is released at the end.
        """
        spark = self.star.spark
        try:
            if self.workers <= 1:
                done = []
                for span, job in self.work:
                    done.append(self._one(span, job, None))
                    if done[-1][1]:
                        break
            else:
                done = self._at_once(spark)
        finally:
            self.star.release()
        for _, stop in done:
            if stop:
                raise stop
        return spark.createDataFrame([row for row, _ in done], STATUS_SCHEMA)

    def _at_once(self, spark: SparkSession) -> list[tuple[tuple, Exception | None]]:
        done: list = [None] * len(self.work)

        def one(number: int) -> None:
            def body() -> None:
                done[number] = self._one(*self.work[number], f"report-{number % self.workers}")

            # A thread that Spark knows keeps tags and pool of this job apart from those of its neighbours.
            thread = InheritableThread(target=body, session=spark)
            thread.start()
            thread.join()

        with ThreadPoolExecutor(self.workers) as pool:
            list(pool.map(one, range(len(self.work))))
        return done


def run_batch(star: Star, spans: list[Span], jobs: list[Job], log: Logger | None = None, workers: int = 1) -> DataFrame:
    """All jobs for all spans, one status row each."""
    return Batch(star, spans, jobs, log, workers).run()


def log_to(spark: SparkSession, path: str, jobs: list[Job] = ()) -> Logger:
    """A logger for ``run_batch`` that appends one row per run, with the fields of the job's registry row."""
    known = {job.name: job for job in jobs}

    def write(row: tuple, elapsed_ms: int, trace: str | None = None) -> None:
        name, period, status, inserted, _, message = row
        job = known.get(name)
        year, month, day = period.rpartition(" ")[2].partition("..")[0].split("-")
        failed = status == "error"
        entry = log_entry(
            spark, datetime.now(), job_name=name, table_name=name, operation_type="RUN",
            error_level="ERROR" if failed else "WARNING" if status == "cancelled" else "INFO",
            message=f"{period}: {status} {message}".strip(), error_code=error_code(message) if failed else None,
            error_traceback=trace, rows_inserted=inserted, execution_time_ms=elapsed_ms, year=year, month=month, day=day,
            sql_path=job and job.definition, job_type=job and job.job_type,
            delete_column=job and job.delete_column, delete_condition=job and job.delete_condition,
        )
        append_log(entry, path)

    return write


def error_code(message: str) -> str:
    """Spark's error class at the front of a message, else UNKNOWN."""
    head, close, _ = message.removeprefix("[").partition("]")
    return head if close and message.startswith("[") and head.replace("_", "").replace(".", "").isalnum() else "UNKNOWN"
