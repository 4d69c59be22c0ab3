"""Job suite (PL-21): jobs with the jobs they need, run in dependency order. A failed job does not stop the others, but
those that need it are skipped and reported; each published table is reported with its rows, counted while written."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.lake import Lake

#: (layer, table) -> rows, as a job gives them.
Tables = dict[tuple[str, str], DataFrame]


@dataclass(frozen=True)
class Job:
    """``build(lake)`` returns the tables to publish; ``needs`` names jobs whose tables it reads from the lake."""

    name: str
    build: Callable[[Lake], Tables]
    needs: tuple[str, ...] = ()


def in_order(jobs: list[Job]) -> list[Job]:
    """Each job after those it needs, otherwise in the order given."""
    known = {j.name: j for j in jobs}
    if len(known) != len(jobs):
        raise ValueError("two jobs have one name")
    if unknown := {n for j in jobs for n in j.needs} - known.keys():
        raise ValueError(f"needed jobs are not there: {sorted(unknown)}")
    out: dict[str, Job] = {}
    left = list(jobs)
    while left:
        ready = next((j for j in left if all(n in out for n in j.needs)), None)
        if ready is None:
            raise ValueError(f"jobs need each other: {[j.name for j in left]}")
        out[ready.name] = ready
        left.remove(ready)
    return list(out.values())


def run_suite(spark: SparkSession, lake: Lake, jobs: list[Job]) -> DataFrame:
    """(job, estado, tabla, filas, segundos, error): a row for each published table (``ok``, or ``vacía`` where the job
    gave no rows and the table stays as it was), one for a job that failed (``error``) or was skipped (``omitida``)."""
    status, failed = [], set()
    for job in in_order(jobs):
        t0 = time.time()
        if missing := [n for n in job.needs if n in failed]:
            failed.add(job.name)
            status.append((job.name, "omitida", None, None, 0.0, f"needs {', '.join(missing)}"))
            continue
        try:
            for (layer, table), df in job.build(lake).items():
                done = lake.save(df, layer, table, audit=True)
                status.append((job.name, "ok" if done["written"] else "vacía", table, done.get("rows", 0), round(time.time() - t0, 3), None))
                t0 = time.time()
        except Exception as e:  # noqa: BLE001 - reported, the suite goes on
            failed.add(job.name)
            status.append((job.name, "error", None, None, round(time.time() - t0, 3), f"{type(e).__name__}: {e}\n{traceback.format_exc(limit=3)}"))
    return spark.createDataFrame(status, "job string, estado string, tabla string, filas long, segundos double, error string")
