"""One cycle: catalog and pointings against the state of the last one, three jobs, new state."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.digests import context_digest, path_fingerprint
from skyledger.operators import ranges as R
from skyledger.operators import relational as Q
from skyledger.operators.convert import ORBIT_COLUMNS, job_inputs
from skyledger.sources import catalog as C
from skyledger.sources import storage
from skyledger.sources.sqlite import extent, read_sqlite, write_sqlite

from .job import Options, run_job
from .state import State, snapshot

MJD = "observationStartMJD"


@dataclass
class Cycle:
    database: str | Path
    catalog: str | Path
    config: str | Path
    options: Options
    comets: bool = False
    filter_orbits: bool = True
    ignore_path: str | None = None
    ignore_ids: Iterable[str] = ()
    state_folder: Path = Path(".")
    work: Path = Path("work")
    lookback: float | None = None


def objects_of(spark: SparkSession, c: Cycle) -> DataFrame:
    """catalog_row, obj, object_id, element_hash of the objects that aren't ignored and are worth it."""
    objects = Q.identified(C.read_catalog(spark, str(c.catalog), Path(c.work).resolve()))
    ignored = C.ignore_ids(spark, c.ignore_path, c.ignore_ids)
    ids = {f"__{name}": F.try_variant_get("obj", F.lit(f"$.{name}"), "string") for name in C.IGNORE_COLUMNS}
    objects = Q.drop_ignored(objects.withColumns(ids), ignored, "object_id", *ids).drop(*ids)
    return Q.keep_objects(objects, c.comets) if c.filter_orbits else objects


def run_cycle(spark: SparkSession, c: Cycle, say: Callable[[str], None] = print) -> bool:
    """True if the state advanced. Unchanged objects meet only new pointings, and are skipped without any;
    new and updated ones meet all. State is saved after all three jobs are combined."""
    c.options.check()
    for name in ("database", "catalog", "config"):
        if getattr(c, name) is None:
            raise ValueError(f"{name} is needed")
    time = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    results = Path(c.options.results)
    kept = snapshot(c.catalog, results, time)
    state = State(c.state_folder, c.database, c.comets)
    current = state.diff(objects_of(spark, c)).persist()
    counts = {r["status"]: r["n"] for r in Q.status_counts(current).collect()}
    most, total = extent(c.database, MJD)
    most = most or 0.0
    # the increment alone is read: SQLite carries out both bounds. Written once, so that what is counted is what is simulated
    at = storage.fresh(spark, "pointings")
    Q.since(read_sqlite(spark, c.database), MJD, state.watermark, c.lookback).where(F.col(MJD) <= most).write.parquet(at)
    fresh = spark.read.parquet(at)
    n_fresh = fresh.count()
    say(f"[{time}] objects {counts}; pointings: {n_fresh} new of {total}")
    facts = {"mode": "comets" if c.comets else "asteroids", "db": path_fingerprint(c.database), "config": path_fingerprint(c.config), "db_max_mjd": most, "db_row_count": total}
    contexts = {"full": context_digest(pointing_scope="full", **facts), "new": context_digest(pointing_scope="new", previous_last_mjd=state.watermark, **facts)}
    new_only = Path(c.work) / "new_pointings.db"
    done = True
    for status in ("unchanged", "new", "updated"):
        if not counts.get(status) or status == "unchanged" and not n_fresh:
            continue
        scope = "new" if status == "unchanged" else "full"
        if scope == "new":
            write_sqlite(fresh, new_only)
        rows = R.number_rows(job_inputs(current, status, c.comets), "catalog_row").persist()
        if not rows.isEmpty():
            own = dataclasses.replace(c.options, database=str(new_only if scope == "new" else c.database), config=str(c.config), snapshot=str(kept), context=contexts[scope], orbit_columns=ORBIT_COLUMNS["COM" if c.comets else "KEP"])
            done = run_job(rows, status, time, own, say) and done
        rows.unpersist()
    if done:
        state.save(float(most), current)
    else:
        say("  a diagnostic run; the state stays as it was")
    current.unpersist()
    storage.remove(spark, at)
    return done
