"""SQLite tables and views as Spark data sources, at rest and as a stream, with filters pushed into SQLite, and export."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

TABLE = "observations"
#: Declared types by SQLite's rules of affinity, in order; any other declared type is a number.
_KINDS = {"INT": "bigint", "CHAR": "string", "TEXT": "string", "CLOB": "string", "BLOB": "binary", "REAL": "double", "FLOA": "double", "DOUB": "double"}
_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _name(x: str) -> str:
    return '"' + x.replace('"', '""') + '"'


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


@dataclass
class Layout:
    """How a table's rows can be cut into ranges: by a rowid (its name), by the first column of a primary key, or not at all."""

    columns: list[tuple[str, str]]
    rowid: str | None
    key: str | None


def layout(db: sqlite3.Connection, table: str) -> Layout:
    found = db.execute(f"PRAGMA table_info({_name(table)})").fetchall()
    if not found:
        raise ValueError(f"no table or view {table}")
    names = {c[1].lower() for c in found}
    kind = db.execute("SELECT type, sql FROM sqlite_master WHERE lower(name) = lower(?)", (table,)).fetchone()
    rowid = None
    if kind and kind[0] == "table":
        for alias in ("rowid", "oid", "_rowid_"):
            if alias in names:
                continue
            try:
                db.execute(f"SELECT {alias} FROM {_name(table)} LIMIT 1")
            except sqlite3.OperationalError:  # a table without rowid
                break
            rowid = alias
            break
    key = min((c for c in found if c[5]), key=lambda c: c[5], default=None)
    return Layout([(c[1], c[2] or "") for c in found], rowid, key[1] if key and kind and kind[0] == "table" else None)


def _kind(db: sqlite3.Connection, table: str, column: str, declared: str) -> str:
    """A column's Spark type. Columns without a declared type (those of a view's expressions) have that of their values."""
    if declared:
        return next((k for part, k in _KINDS.items() if part in declared.upper()), "double")
    kinds = {r[0] for r in db.execute(f"SELECT DISTINCT typeof({_name(column)}) FROM {_name(table)}")} - {"null"}
    if "text" in kinds or not kinds:
        return "string"
    return "binary" if "blob" in kinds else "double" if "real" in kinds else "bigint"


@dataclass
class Range(InputPartition):
    """Rows whose column is at least `low` and below `high` (None: without a bound); all rows if column is None."""

    column: str | None = None
    low: object = None
    high: object = None

    def where(self) -> tuple[list[str], list]:
        column = self.column if self.column in ("rowid", "oid", "_rowid_") else _name(self.column or "")
        bounds = [(f"{column} {sign} ?", v) for sign, v in ((">=", self.low), ("<", self.high)) if self.column and v is not None]
        return [b[0] for b in bounds], [b[1] for b in bounds]


def _numbers(column: str, low: int, high: int, parts: int) -> list[Range]:
    """Ranges of whole numbers from low to high, both included."""
    step = max(1, -(-(high - low + 1) // parts))
    return [Range(column, k, min(k + step, high + 1)) for k in range(low, high + 1, step)]


def _rows(path: str, table: str, schema: StructType, part: Range, where: list[str], values: list) -> Iterator[tuple]:
    """Rows of a range that meet conditions. Text columns give text whatever SQLite holds in them."""
    conditions, bounds = part.where()
    conditions = [*conditions, *where]
    text = [k for k, f in enumerate(schema.fields) if f.dataType.simpleString() == "string"]
    real = [k for k, f in enumerate(schema.fields) if f.dataType.simpleString() == "double"]
    with closing(_open(path)) as db:
        found = db.execute(f"SELECT {', '.join(map(_name, schema.names))} FROM {_name(table)}" + (f" WHERE {' AND '.join(conditions)}" if conditions else ""), (*bounds, *values))
        for row in found:
            row = list(row)
            for k in text:
                row[k] = row[k] if row[k] is None or isinstance(row[k], str) else str(row[k])
            for k in real:
                row[k] = float(row[k]) if isinstance(row[k], int) else row[k]
            yield tuple(row)


class SqliteReader(DataSourceReader):
    """Reads ranges of rowid, or of the primary key of a table that has none, one for each partition; a view by one."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.asked = options["path"], options.get("table", TABLE), schema
        self.parts, self.where, self.values = int(options.get("partitions", 8)), [], []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in _SIGNS and len(f.attribute) == 1 and isinstance(f.value, (int, float, str)):
                self.where.append(f"{_name(f.attribute[0])} {_SIGNS[type(f)]} ?")
                self.values.append(f.value)
            elif type(f) is IsNotNull and len(f.attribute) == 1:
                self.where.append(f"{_name(f.attribute[0])} IS NOT NULL")
            else:
                yield f

    def partitions(self) -> list[Range]:
        with closing(_open(self.path)) as db:
            own = layout(db, self.table)
            if own.rowid:
                low, high = db.execute(f"SELECT MIN({own.rowid}), MAX({own.rowid}) FROM {_name(self.table)}").fetchone()
                return [Range(own.rowid, 0, 0)] if low is None else _numbers(own.rowid, low, high, self.parts)
            if not own.key:
                return [Range()]
            key, (n,) = _name(own.key), db.execute(f"SELECT COUNT(*) FROM {_name(self.table)}").fetchone()
            points = [db.execute(f"SELECT {key} FROM {_name(self.table)} ORDER BY {key} LIMIT 1 OFFSET ?", (n * k // self.parts,)).fetchone()[0] for k in range(1, self.parts)] if n >= self.parts else []
        points = list(dict.fromkeys(points))
        return [Range(own.key, a, b) for a, b in zip([None, *points], [*points, None], strict=True)]

    def read(self, partition: Range) -> Iterator[tuple]:
        return _rows(self.path, self.table, self.asked, partition, self.where, self.values)


class SqliteStream(DataSourceStreamReader):
    """Rows in the order of their insertion. The offset is the greatest rowid taken (or value of the whole-number column
    `offset`, which a view needs), so each row is delivered by one batch, however late its time is; Spark keeps offsets in the checkpoint and
    repeats a failed batch with the same two. Rows that are changed or deleted in place aren't seen."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.asked = options["path"], options.get("table", TABLE), schema
        self.parts, self.column = int(options.get("partitions", 8)), options.get("offset")

    def _column(self, db: sqlite3.Connection) -> str:
        own = self.column or layout(db, self.table).rowid
        if not own:
            raise ValueError(f"{self.table} has no rowid; name a whole-number column that grows as the option `offset`")
        return own

    def _most(self, which: str) -> int | None:
        with closing(_open(self.path)) as db:
            column = self._column(db)
            return db.execute(f"SELECT {which}({_name(column) if self.column else column}) FROM {_name(self.table)}").fetchone()[0]

    def initialOffset(self) -> dict:
        least = self._most("MIN")
        return {"last": min(0, least) - 1 if least is not None else -1}

    def latestOffset(self) -> dict:
        most = self._most("MAX")
        return {"last": most} if most is not None else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        with closing(_open(self.path)) as db:
            column = self._column(db)
        return _numbers(column, start["last"] + 1, end["last"], self.parts)

    def read(self, partition: Range) -> Iterator[tuple]:
        return _rows(self.path, self.table, self.asked, partition, [], [])

    def commit(self, end: dict) -> None:
        pass


class SqliteSource(DataSource):
    """Options: path, table (observations), partitions (8); of a stream also offset."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        table = self.options.get("table", TABLE)
        with closing(_open(self.options["path"])) as db:
            return ", ".join(f"`{c}` {_kind(db, table, c, declared)}" for c, declared in layout(db, table).columns)

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(self.options, schema)

    def streamReader(self, schema: StructType) -> SqliteStream:
        return SqliteStream(self.options, schema)


def read_sqlite(spark: SparkSession, path: str | Path, table: str = TABLE, partitions: int = 8) -> DataFrame:
    """A table or view, whose rows tasks read by ranges. Comparisons with constants are carried out by SQLite; the session keeps the
    setting that lets Spark push them, as plans are made when the caller runs them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_table").option("path", str(path)).option("table", table).option("partitions", partitions).load()


def stream_sqlite(spark: SparkSession, path: str | Path, table: str = TABLE, partitions: int = 8, offset: str | None = None) -> DataFrame:
    """A table's rows as a stream, each delivered once, in batches that end at the greatest rowid (or value of `offset`) there is."""
    spark.dataSource.register(SqliteSource)
    stream = spark.readStream.format("sqlite_table").option("path", str(path)).option("table", table).option("partitions", partitions)
    return (stream.option("offset", offset) if offset else stream).load()


def extent(path: str | Path, column: str, table: str = TABLE) -> tuple[float | None, int]:
    """The greatest value of a column and the number of rows, by one statement: of one state of the table."""
    with closing(_open(str(path))) as db:
        return db.execute(f"SELECT MAX({_name(column)}), COUNT(*) FROM {_name(table)}").fetchone()


def write_sqlite(df: DataFrame, path: str | Path, table: str = TABLE) -> int:
    """Replaces a SQLite file by one table of df's rows, streamed through the driver, for programs that read
    nothing else; the number of rows. An empty result still makes the table."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.unlink(missing_ok=True)
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "float": "REAL", "binary": "BLOB"}
    db, n = sqlite3.connect(path), 0
    db.execute(f"CREATE TABLE {_name(table)} ({', '.join(f'{_name(c)} {kinds.get(k, "TEXT")}' for c, k in df.dtypes)})")
    put = f"INSERT INTO {_name(table)} VALUES ({', '.join('?' * len(df.columns))})"
    for row in df.toLocalIterator(prefetchPartitions=True):
        db.execute(put, tuple(row))
        n += 1
    db.commit()
    db.close()
    return n
