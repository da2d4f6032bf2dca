"""Column functions over dynamically typed catalog values, identifiers, hashes and dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The catalog fields that identify an object, in order, and those whose change means new elements.
ID_FIELDS = ["Provisional_packed_desig", "Designation_and_name", "Principal_desig"]
ELEMENT_FIELDS = ["e", "Peri", "Node", "i", "Perihelion_dist", "Year_of_perihelion", "Month_of_perihelion", "Day_of_perihelion", "Epoch_year", "Epoch_month", "Epoch_day"]
#: Fixed values of the orbit-quality rule.
DISTANT_AU, CERTAIN_CODE, LONG_ARC_DAYS = 30.0, 6, 3.0
#: Modified Julian Date of 1970-01-01, and the Julian Date that MJD counts from.
UNIX_EPOCH_MJD, MJD_ZERO_JD = 40587, 2400000.5

#: White space, as the catalogs' texts are stripped of it.
BLANKS = " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_PLAIN = r"^-?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?$"
_NUMBER = r"^[+-]?([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"


def typed(df: DataFrame, obj: str, texts: Iterable[str], variants: Iterable[str] = (), out: str = "__fields") -> DataFrame:
    """df with members of a variant object in one struct, found in one pass over each object: as texts, or as they are. Missing and
    null texts are null. The struct is a generated row, which filters on it don't work out again."""
    members = ", ".join(f"`{name}`: {kind}" for names, kind in ((texts, "string"), (variants, "variant")) for name in names)
    return generated(df, F.try_variant_get(F.col(obj), F.lit("$"), f"struct<{members}>"), out)


def generated(df: DataFrame, value: Column, out: str) -> DataFrame:
    """df with a column that is worked out once a row, however many filters and columns use it."""
    return df.select("*", F.explode(F.array(value)).alias(out))


def field(obj: str | Column, name: str) -> Column:
    """A member of a variant object; SQL NULL if it isn't there, variant null if it is null."""
    obj = F.col(obj) if isinstance(obj, str) else obj
    return F.try_variant_get(obj, F.lit(f"$.{name}"), "variant")


def is_text(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def text_of(v: Column) -> Column:
    """A variant as text; null for a missing or null value."""
    return v.cast("string")


def bare(text: Column) -> Column:
    """A text without white space at its ends."""
    return F.trim(text, F.lit(BLANKS))


def missing(text: Column) -> Column:
    """Null, blank, or any spelling of nan."""
    return text.isNull() | F.lower(bare(text)).isin("", "nan")


def lenient_double(text: Column) -> Column:
    """The number that a text spells, or null; infinities count, nan doesn't. Plain numbers take the first way, which looks at the text once."""
    own = bare(text)
    small = F.lower(F.regexp_replace(own, "^[+]", ""))
    return (
        F.when(text.isNull(), F.lit(None))
        .when(text.rlike(_PLAIN), text.try_cast("double"))
        .when(own.rlike(_NUMBER), F.replace(own, F.lit("_"), F.lit("")).try_cast("double"))
        .when(small.isin("inf", "infinity"), F.lit(float("inf")))
        .when(small.isin("-inf", "-infinity"), F.lit(float("-inf")))
    )


def first_number(text: Column) -> Column:
    """The first unsigned number in a text."""
    return F.nullif(F.regexp_extract(text, r"[0-9]+(?:\.[0-9]+)?", 0), F.lit("")).try_cast("double")


def truthy_text(v: Column) -> Column:
    """A variant as text, or null where it is missing, null, empty, zero or false."""
    t = text_of(v)
    return F.when(is_text(v), F.nullif(t, F.lit(""))).when(~F.coalesce(t.try_cast("double") == 0, F.lit(False)) & (t != "false"), t)


def object_id(obj: str | Column = "obj") -> Column:
    return F.coalesce(*(truthy_text(field(obj, name)) for name in ID_FIELDS))


def _spelled(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return F.when(v.isNull(), F.lit("")).when(kind == "VOID", F.lit("None")).when(kind == "STRING", text_of(v)).when(kind == "BOOLEAN", F.initcap(text_of(v))).otherwise(F.to_json(v))


def element_hash(obj: str | Column = "obj", fields: list[str] = ELEMENT_FIELDS) -> Column:
    """md5 of the fields' texts; a missing field is an empty slot, a null one the text None."""
    return hash_of(*(_spelled(field(obj, name)) for name in fields))


def hash_of(*texts: Column) -> Column:
    """md5 of texts joined by |; nulls keep their slot."""
    return F.md5(F.concat_ws("|", *(F.coalesce(t, F.lit("")) for t in texts)))


def mjd_of_jd(jd: Column) -> Column:
    return jd - F.lit(MJD_ZERO_JD)


def mjd_of_calendar(year: Column, month: Column, day: Column) -> Column:
    """Whole-day MJD of a proleptic Gregorian date of the years 0 to 9999; the fraction of the day is dropped. Null where it isn't a date."""
    y, m, d = (c.try_cast("int") for c in (year, month, day))
    last = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    days = F.when((d <= 28) | (d <= last), F.unix_date(F.make_date(y, m, F.least(d, last))) + UNIX_EPOCH_MJD)
    return F.when(y.between(0, 9999) & m.between(1, 12) & d.between(1, 31), days).cast("double")


def mjd_of_calendar_fraction(year: Column, month: Column, day: Column) -> Column:
    return mjd_of_calendar(year, month, day) + (day - day.try_cast("int"))
