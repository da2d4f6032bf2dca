"""State between cycles, catalog snapshots, and small files that appear whole or not at all."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from skyledger.functions.digests import safe_token
from skyledger.operators import relational as Q
from skyledger.sources import baseline as B
from skyledger.sources import storage
from skyledger.sources.catalog import copy_stream, read_json

BASELINE = "object_id string, element_hash string"


def write_json(path: str | Path, value: object) -> Path:
    """Written beside its place, then renamed into it."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    with os.fdopen(handle, "w") as f:
        json.dump(value, f, indent=2)
    os.replace(name, path)
    return path


def snapshot(catalog: str | Path, folder: str | Path, time: str) -> Path:
    """A gzipped copy of a catalog under its date, name and content digest; an equal one is left as it is.
    The digest is of the unpacked bytes, which are read in blocks."""
    catalog, folder = Path(catalog), Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    name = catalog.name.removesuffix(".gz").removesuffix(".json")
    digest, handle = hashlib.sha256(), tempfile.NamedTemporaryFile(dir=folder, delete=False)
    opened = gzip.open(catalog, "rb") if catalog.suffix == ".gz" else catalog.open("rb")

    class Both:
        def write(self, block: bytes) -> int:
            digest.update(block)
            return packed.write(block)

    with handle, opened as source, gzip.GzipFile(filename="", fileobj=handle, mode="wb", mtime=0) as packed:
        copy_stream(source, Both())
    target = folder / f"{time[:10]}_{safe_token(name, 'catalog')}_{digest.hexdigest()[:12]}.json.gz"
    if target.exists():
        os.unlink(handle.name)
    else:
        os.replace(handle.name, target)
    return target


class State:
    """Watermark and baseline of one pointing database and mode. The baseline is a bucketed table, of which the state file
    names the folder and each bucket's version, so replacing that file changes watermark and baseline at once. States
    that name a plain Parquet folder, as older ones do, are read too; their next baseline is bucketed."""

    def __init__(self, folder: str | Path, database: str | Path, comets: bool):
        mode, path = "comets" if comets else "asteroids", Path(database).expanduser().resolve()
        digest = hashlib.sha256(f"{path}|{mode}".encode()).hexdigest()[:12]
        self.folder = Path(folder).resolve()
        self.name = f"{safe_token(path.stem, 'pointings')}_{mode}_{digest}"
        self.file = self.folder / f"state_{self.name}.json"

    def _read(self) -> dict:
        return read_json(self.file)

    @property
    def watermark(self) -> float:
        return float(self._read().get("last_mjd", 0.0))

    @property
    def has_baseline(self) -> bool:
        return bool(self._read().get("baseline"))

    @property
    def buckets(self) -> B.Held | None:
        """The bucketed baseline, if there is one."""
        held = self._read()
        return B.Held(storage.uri(self.folder / held["baseline"]), tuple(held["buckets"])) if held.get("baseline") and held.get("buckets") else None

    def baseline(self, spark: SparkSession) -> DataFrame:
        if self.buckets:
            return B.read(spark, self.buckets)
        plain = self._read().get("baseline")
        return spark.read.schema(BASELINE).parquet(storage.uri(self.folder / plain)) if plain else spark.createDataFrame([], BASELINE)

    def diff(self, current: DataFrame) -> DataFrame:
        """current (object_id, element_hash, ..) with status new, updated or unchanged."""
        if self.buckets or not self.has_baseline:
            return B.diff(current, self.buckets)
        return Q.diff(current, self.baseline(current.sparkSession))

    def save(self, watermark: float, current: DataFrame) -> None:
        """A new watermark and the baseline after a catalog (object_id, element_hash, catalog_row). Files that the state before this one
        no longer named are deleted; those that it names stay until the next call, for whoever still reads them."""
        spark, before, held = current.sparkSession, self._read(), self.buckets
        version = int(before.get("version", 0)) + 1
        now = B.save(current, held, storage.uri(self.folder / f"baseline_{self.name}_v{version}"), version)
        if held:
            B.forget(spark, held)
        write_json(self.file, {"last_mjd": watermark, "baseline": Path(now.at).name, "buckets": list(now.versions), "version": version})
        if before.get("baseline") and before["baseline"] != Path(now.at).name:
            storage.remove(spark, storage.uri(self.folder / before["baseline"]))
