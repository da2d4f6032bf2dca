"""Secret scans judged by corpus-wide ownership frequency. DataFrame functions only.

Candidates are found by pattern in every whole text. The hash of each candidate's value is counted
by distinct owners and repositories over the whole corpus: a value that COPIED_OWNERS or more owners have, or two
or more owners in COPIED_REPOSITORIES or more repositories, is a widely copied example; any other one is
owner-specific and looks live, however many repositories one owner keeps it in. Base candidates
(assign, access, hex) are always kept, with that verdict. Opaque strings (20 or more characters of
a base-64 alphabet with upper case, lower case and digits, outside base spans) are too weak to
report by themselves: they are added only where the verdict is owner-specific.

Counting goes through (value, owner, repository) groups with partial sums, so a value that a third
of all rows hold costs one row for each task, owner and repository, and the join back is left to skew handling.

Defined results: a null text counts as empty and has no spans; a null owner or repository is one
unknown owner or repository. Repeated rows are reported one by one, and count once for their owner and
repository. A very long text is scanned as a whole. Spans of one start are in the order of their kinds. An empty
table gives no rows; extra columns are ignored by scan() and kept by redact(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

KINDS = ("assign", "access", "hex", "opaque")
#: Fixed patterns. Runs are maximal, so a minimum length in the pattern finds the same hex and access spans as a later filter.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
OPAQUE = "[A-Za-z0-9+/_-]{20,}"
LEAST_VALUE = 6
COPIED_OWNERS, COPIED_REPOSITORIES = 3, 4
MARK = "[SECRET]"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def _found(text: Column, pattern: str, kind: int, value: Callable[[Column], Column]) -> Column:
    """Leftmost non-overlapping matches as structs (start, kind, end, value, byte, last): positions in characters,
    and in bytes. The text between matches gives them, and is only split where there is a match."""
    kinds = "array<struct<start:int,kind:int,end:int,value:string,byte:int,last:int>>"
    none = F.lit(None).cast(kinds)

    def place(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        steps = F.zip_with(gaps, matches, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size"), F.octet_length(gap).alias("gap_bytes"), F.octet_length(m).alias("bytes"), m.alias("m")))

        def step(acc: Column, x: Column) -> Column:
            begin, byte = acc["at"] + x["gap"], acc["byte"] + x["gap_bytes"]
            end, last = begin + x["size"], byte + x["bytes"]
            one = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value(x["m"]).alias("value"), byte.alias("byte"), last.alias("last"))
            return F.struct(end.alias("at"), last.alias("byte"), F.concat(acc["out"], F.array(one)).alias("out"))

        def moved(acc: Column, x: Column) -> Column:
            return F.struct((acc["at"] + x["gap"] + x["size"]).alias("at"), (acc["byte"] + x["gap_bytes"] + x["bytes"]).alias("byte"))

        def added(acc: Column, x: Column) -> Column:
            return F.struct((acc["at"] + x["at"]).alias("at"), (acc["byte"] + x["byte"]).alias("byte"))

        def spread(steps: Column) -> Column:
            """Arrays only grow one by one within runs of about the root of their number, so many matches take little more than few."""
            zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("byte"))
            run = F.ceil(F.sqrt(F.size(steps))).cast("int")
            numbers = F.sequence(F.lit(0), F.ceil(F.size(steps) / run).cast("int") - 1)
            totals = F.transform(numbers, lambda k: F.aggregate(F.slice(steps, k * run + 1, run), zero, moved))

            def one_run(totals: Column, k: Column) -> Column:
                begin = F.aggregate(F.slice(totals, F.lit(1), k), zero, added, lambda acc: F.struct(acc["at"], acc["byte"], F.array().cast(kinds).alias("out")))
                return F.aggregate(F.slice(steps, k * run + 1, run), begin, step, lambda acc: acc["out"])

            return _let(totals, lambda t: F.flatten(F.transform(numbers, lambda k: one_run(t, k))))

        return _let(steps, spread)

    return F.coalesce(_let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, place(m)).otherwise(none)), F.array().cast(kinds))


def candidates(text: Column) -> Column:
    """All candidate spans of a text by start, then kind: structs (start, kind, end, value, byte, last)."""
    text = F.coalesce(text, F.lit(""))
    assign = F.filter(_found(text, ASSIGN, 0, lambda m: F.regexp_extract(m, ASSIGN, 1)), lambda x: F.length(x["value"]) >= LEAST_VALUE)
    base = F.concat(assign, _found(text, ACCESS, 1, lambda m: m), _found(text, HEX, 2, lambda m: m))

    def mixed(x: Column) -> Column:
        return x["value"].rlike("[A-Z]") & x["value"].rlike("[a-z]") & x["value"].rlike("[0-9]")

    opaque = F.filter(_found(text, OPAQUE, 3, lambda m: m), mixed)
    both = _let(base, lambda b: F.concat(b, F.filter(opaque, lambda x: ~F.exists(b, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))))
    return F.transform(F.array_sort(both), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.xxhash64(x["kind"] == 3, x["value"]).alias("value"), x["byte"].alias("byte"), x["last"].alias("last")))


def ownership(found: DataFrame) -> DataFrame:
    """value, owners, repositories, rows over all candidates of found (owner, repo, spans)."""
    each = found.select(F.explode("spans.value").alias("value"), F.coalesce(F.col("owner").cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col("repo").cast("string"), F.lit("")).alias("repo"))
    by_repo = each.groupBy("value", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
    return by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repositories"), F.sum("n").alias("rows"))


def copied(owners: Column, repositories: Column, copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES) -> Column:
    """Whether a value is a widely copied example, by the owners and repositories that have it."""
    return (owners >= copied_owners) | ((owners >= 2) & (repositories >= copied_repositories))


def judge(found: DataFrame, copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """row, span (a candidate's struct), live of all candidates of found (row, owner, repo, spans) but copied opaque strings."""
    verdicts = ownership(found).select("value", (~copied(F.col("owners"), F.col("repositories"), copied_owners, copied_repositories)).alias("live"))
    each = found.select("row", F.explode("spans").alias("span")).withColumn("value", F.col("span.value"))
    return each.join(verdicts, "value").where((F.col("span.kind") < 3) | F.col("live")).select("row", "span", "live")


def _repository(repo: tuple[str, ...]) -> Column:
    return F.concat_ws("/", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in repo))


def scan(docs: DataFrame, owner: str = "source", repo: tuple[str, ...] = ("source", "lang"), copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """doc_id and spans (start, kind, end, live) of every document row; positions in characters, ends exclusive."""
    docs = shared.carried(docs, *dict.fromkeys(["doc_id", "text", owner, *repo]))
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{owner}`").alias("owner"), _repository(repo).alias("repo"), candidates(F.col("text")).alias("spans"))
    found = shared.materialize(found, "secrets")
    some = found.where(F.size("spans") > 0)
    one = F.struct("span.start", "span.kind", "span.end", "live")
    spans = judge(some, copied_owners, copied_repositories).groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean>>")
    with_any = some.select("row", "doc_id").join(spans, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
    return with_any.unionByName(found.where(F.size("spans") == 0).select("doc_id", none.alias("spans")))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(test: Callable[[Column], Column]) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(k: int) -> Column:
        return F.filter("spans", lambda x: x["kind"] == k)

    return scan(shared.read(spark, sf_dir, "documents")).select(
        "doc_id",
        *(F.size(of_kind(k)).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(_joined(F.filter("spans", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        count(lambda x: x["live"]).alias("n_live"),
        count(lambda x: ~x["live"]).alias("n_copied"),
    )


def _without(text: Column, ranges: Column, mark: str) -> Column:
    """text with a mark for each byte range, put together once."""
    raw = text.cast("binary")
    begin = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(ranges, 2 * k - 1))
    end = lambda k: F.coalesce(F.get(ranges, 2 * k), F.octet_length(text))
    pieces = F.transform(F.sequence(F.lit(0), F.expr("size(ranges) div 2").cast("int")), lambda k: F.substring(raw, begin(k) + 1, end(k) - begin(k)).cast("string"))
    return F.array_join(pieces, mark)


def redact(docs: DataFrame, owner: str = "source", repo: tuple[str, ...] = ("source", "lang"), mark: str = MARK) -> DataFrame:
    """docs with every reported span of the texts replaced by mark, overlapping ones together; n_chars,
    where there is one, follows the new text. Spans are judged and joined by number, without the texts."""
    needed = [c for c in dict.fromkeys(["text", owner, *repo, "n_chars"]) if c != "n_chars" or c in docs.columns]
    own, restored = shared.renamed(docs, *needed)
    columns = own.columns
    own = own.withColumns({"own_row": F.monotonically_increasing_id(), "own_spans": candidates(F.col("text"))})
    kept = shared.materialize(own, "redact")
    some = kept.where(F.size("own_spans") > 0)
    found = some.select(F.col("own_row").alias("row"), F.col(f"`{owner}`").alias("owner"), _repository(repo).alias("repo"), F.col("own_spans").alias("spans"))
    judged = judge(found).select("row", F.col("span.byte").alias("byte"), F.col("span.last").alias("last"))
    flat = F.flatten(F.transform("ranges", lambda x: F.array(x["byte"], x["last"])))
    ranges = shared.islands(judged, "row", "byte", "last", False).select(F.col("row").alias("own_row"), flat.alias("ranges"))
    out = some.select("own_row", *(F.col(f"`{c}`") for c in columns)).join(ranges, "own_row", "left")
    changed = F.col("ranges").isNotNull()
    out = out.withColumn("text", F.when(changed, _without(F.col("text"), F.col("ranges"), mark)).otherwise(F.col("text")))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    rest = kept.where(F.size("own_spans") == 0)
    return restored(out).unionAll(restored(rest))
