"""Reading catalogs, ignore lists, simulator outputs and small JSON files."""

from __future__ import annotations

import csv
import gzip
import io
import json
import os
import shutil
import urllib.request
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import BinaryIO, TextIO

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from . import storage

#: Where the current catalogs are published.
ASTEROID_URL = "https://www.minorplanetcenter.net/Extended_Files/mpcorb_extended.json.gz"
COMET_URL = "https://www.minorplanetcenter.net/Extended_Files/allcometels.json.gz"
#: Columns that an id may have in an ignore list, in order.
IGNORE_COLUMNS = ["ObjID", "Principal_desig", "Provisional_packed_desig", "Designation_and_name"]


#: Bytes of a catalog file, plain and gzipped, that one task parses as a whole.
WHOLE_BYTES, WHOLE_GZ_BYTES = 16 << 20, 1 << 20


def elements(stream: TextIO, block: int = 1 << 20) -> Iterator[tuple[object, str]]:
    """The elements of a JSON array in a text stream with the text of each, one after another, without holding the array."""
    decode, text, at, more = json.JSONDecoder().raw_decode, stream.read(block).lstrip(), 0, True
    if not text.startswith("["):
        raise ValueError("a catalog is a JSON array")
    at = 1
    while True:
        while at < len(text) and text[at] in " \t\r\n,":
            at += 1
        if at < len(text) and text[at] == "]":
            return
        try:
            value, end = decode(text, at)
            if end == len(text) and more:  # a number may go on in the next block
                raise json.JSONDecodeError("cut", text, end)
        except json.JSONDecodeError:
            if not more:
                raise
            extra = stream.read(block)
            more = bool(extra)
            text, at = text[at:] + extra, 0
            continue
        yield value, text[at:end]
        at = end


def split_catalog(path: str | Path, folder: str | Path, rows: int = 50_000) -> Path:
    """A catalog as JSON lines {"catalog_row": .., "obj": ..} in files of so many objects, so that Spark
    reads it in parallel. Streams in blocks; objects keep the catalog's own text, so numbers keep their spelling."""
    path, folder = Path(path), Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    out, n = None, 0
    with gzip.open(path, "rt", encoding="utf-8") if path.suffix == ".gz" else path.open(encoding="utf-8") as stream:
        for row, (value, spelled) in enumerate(elements(stream)):
            if not isinstance(value, dict):
                continue
            if n % rows == 0:
                if out:
                    out.close()
                out = (folder / f"objects-{n // rows:06d}.json").open("w", encoding="utf-8")
            own = spelled.replace("\r", " ").replace("\n", " ")  # line breaks only stand between tokens
            out.write(f'{{"catalog_row": {row}, "obj": {own}}}\n')
            n += 1
    (out or (folder / "objects-000000.json").open("w")).close()
    return folder


def read_catalog(spark: SparkSession, path: str, work: str | Path | None = None) -> DataFrame:
    """catalog_row (position in the array, from 0) and obj (variant) of a JSON array, gzipped or not.
    Elements that aren't objects are left out, and keep their position's number. A large file is first
    split into lines below `work`, which all executors must reach."""
    size = Path(path).stat().st_size
    if work is not None and size > (WHOLE_GZ_BYTES if str(path).endswith(".gz") else WHOLE_BYTES):
        return read_catalog_lines(spark, str(split_catalog(path, Path(work) / f"catalog-{uuid.uuid4().hex}")))
    whole = spark.read.text(storage.uri(path), wholetext=True).select(F.parse_json("value").alias("v"))
    whole.createOrReplaceTempView("__catalog")
    each = spark.sql("SELECT CAST(e.pos AS BIGINT) AS catalog_row, e.value AS obj FROM __catalog, LATERAL variant_explode(v) e")
    return each.where(F.schema_of_variant("obj").startswith("OBJECT"))


def read_catalog_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same from JSON lines as split_catalog() writes them."""
    v = spark.read.text(storage.uri(path)).select(F.parse_json("value").alias("v"))
    return v.select(*(F.try_variant_get("v", F.lit(f"$.{c}"), kind).alias(c) for c, kind in (("catalog_row", "bigint"), ("obj", "variant"))))


def _fetch(url: str) -> BinaryIO:
    reply = urllib.request.urlopen(url)
    if reply.status != 200:
        reply.close()
        raise RuntimeError(f"{url} answered {reply.status}")
    return reply


def download_catalog(date: str, folder: str | Path, comets: bool = False, fetch: Callable[[str], BinaryIO | bytes] = _fetch) -> Path:
    """Fetches the current catalog and writes it unpacked, block by block, under a name that appears when all of it is there; the path."""
    url = COMET_URL if comets else ASTEROID_URL
    target = Path(folder) / f"{date}_{'comets' if comets else 'asteroids'}.json"
    target.parent.mkdir(parents=True, exist_ok=True)
    reply, part = fetch(url), target.with_name(f".{target.name}-{uuid.uuid4().hex}")
    try:
        with reply if hasattr(reply, "read") else io.BytesIO(reply) as packed, gzip.open(packed) as plain, part.open("wb") as out:
            copy_stream(plain, out)
        os.replace(part, target)
    finally:
        part.unlink(missing_ok=True)
    return target


def ignore_ids(spark: SparkSession, path: str | None = None, ids: Iterable[str] = ()) -> DataFrame:
    """object_id, distinct: from a CSV (first known id column, else the first), a text file (comma
    separated, # begins a comment), and single ids."""
    found = spark.createDataFrame([(i.strip(),) for i in ids if i and i.strip()], "object_id string")
    if path and str(path).lower().endswith(".csv"):
        rows = spark.read.option("header", True).csv(storage.uri(path))
        column = next((c for c in IGNORE_COLUMNS if c in rows.columns), rows.columns[0])
        found = found.union(rows.select(F.trim(F.col(f"`{column}`"))))
    elif path:
        lines = spark.read.text(storage.uri(path))
        found = found.union(lines.select(F.explode(F.split(F.substring_index("value", "#", 1), ",")).alias("i")).select(F.trim("i")))
    return found.where("object_id is not null and object_id <> ''").distinct()


def columns_of(path: str | Path) -> list[tuple[str, str]]:
    """The columns of an output file and their types; none if it is missing or empty."""
    p = Path(path)
    if p.is_dir():  # a folder of Parquet files
        p = next((f for f in sorted(p.glob("*.parquet")) if f.stat().st_size), p / "none")
    if not p.exists() or not p.stat().st_size:
        return []
    if p.suffix == ".parquet":
        return [(f.name, from_arrow_type(f.type, prefer_timestamp_ntz=f.type == pa.timestamp("us")).simpleString()) for f in pq.read_schema(p)]
    with p.open(encoding="utf-8", newline="") as f:
        return [(name, "string") for name in next(csv.reader(f), [])]


Header = tuple[str, tuple[tuple[str, str], ...]]


def headers(spark: SparkSession, paths: Iterable[str | Path]) -> dict[Header, list[str]]:
    """Output files by suffix and columns (names and types), in their order; missing and empty ones are left out. Files are opened by
    tasks, so executors must reach them."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [columns_of(p) for p in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(0), *(pa.array([[c[k] for c in f] for f in found], pa.list_(pa.string())) for k in (0, 1))], ["path", "names", "kinds"])

    paths = list(map(str, paths))
    asked = spark.createDataFrame([(p,) for p in dict.fromkeys(paths)], "path string")
    found = {r["path"]: tuple(zip(r["names"], r["kinds"], strict=True)) for r in asked.repartition(max(1, min(len(paths), 200))).mapInArrow(probe, "path string, names array<string>, kinds array<string>").collect()} if paths else {}
    out: dict[Header, list[str]] = {}
    for path in paths:
        if found[path]:
            out.setdefault((Path(path).suffix, found[path]), []).append(path)
    return out


def _one_csv_scan(spark: SparkSession, files: dict[tuple[str, ...], list[str]], names: list[str]) -> DataFrame:
    """CSV files of several headers by one scan: cells by their place, of which each file's header tells the names. All text."""
    width = max(map(len, files))
    cells = [f"c{k}" for k in range(width)]
    scan = spark.read.option("header", True).schema(", ".join(f"{c} string" for c in cells)).csv([storage.uri(p) for own in files.values() for p in own])
    lower = [[h.lower() for h in header] for header in files]
    places = [[own.index(n.lower()) if n.lower() in own else None for n in names] for own in lower]
    if len(files) == 1:
        return scan.select(*(F.lit(None).cast("string").alias(n) if k is None else F.col(cells[k]).alias(n) for n, k in zip(names, places[0], strict=True)))
    # Spark gives the path as a URI, in which + stands for itself
    path = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    known = spark.createDataFrame([(os.path.abspath(p), place) for place, own in zip(places, files.values(), strict=True) for p in own], "__path string, __place array<int>")
    placed = scan.withColumn("__path", path).join(F.broadcast(known), "__path")
    return placed.select(*(F.get(F.array(*cells), F.get("__place", k)).alias(n) for k, n in enumerate(names)))


def read_outputs(spark: SparkSession, paths: Iterable[str | Path], schema: dict[str, str] | None = None) -> DataFrame | None:
    """Union by name of output files, CSV or Parquet; missing and empty files are skipped, absent columns
    are null, names that differ in case are one column. Columns are text unless `schema` names their type, so ids such as 00123 stay as they are.
    However many files and headers there are, CSV is one scan, and so are Parquet files whose columns don't contradict each other in type."""
    tables: dict[tuple[str, ...], list[str]] = {}
    typed: list[tuple[dict[str, str], list[str]]] = []
    names: dict[str, str] = {}
    for (suffix, columns), files in headers(spark, paths).items():
        for n, _ in columns:
            names.setdefault(n.lower(), n)
        if suffix != ".parquet":
            tables.setdefault(tuple(n for n, _ in columns), []).extend(files)
            continue
        kinds = {n.lower(): kind for n, kind in columns}
        known, own = next((g for g in typed if all(g[0].get(n, kind) == kind for n, kind in kinds.items())), (None, None))
        if known is None:
            known, own = {}, []
            typed.append((known, own))
        known.update(kinds)
        own.extend(files)
    if not names:
        return None
    spelled, kind_of = list(names.values()), {k.lower(): v for k, v in (schema or {}).items()}
    cast = lambda c, n: c.cast(kind_of.get(n.lower(), "string")).alias(n)
    frames = [_one_csv_scan(spark, tables, spelled)] if tables else []
    for known, own in typed:
        scan = spark.read.schema(", ".join(f"`{names[n]}` {kind}" for n, kind in known.items())).parquet(*map(storage.uri, own))
        frames.append(scan.select(*((F.col(f"`{n}`") if n.lower() in known else F.lit(None).cast("string")).alias(n) for n in spelled)))
    frames = [f.select(*(cast(F.col(f"`{n}`"), n) for n in spelled)) for f in frames]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_json(path: str | Path) -> dict:
    """A small JSON file; {} if it is missing or malformed."""
    try:
        value = json.loads(Path(path).read_text())
    except (OSError, ValueError):
        return {}
    return value if isinstance(value, dict) else {}


def copy_stream(source, target) -> None:
    shutil.copyfileobj(source, target, 1 << 20)
