"""Catalog objects as simulator inputs: element and physical columns under the simulator's names."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import values as V

#: Fixed value: the colour that every object is given.
COLOUR = 0.5
#: Input columns by orbit format.
ORBIT_COLUMNS = {
    "KEP": ["ObjID", "a", "e", "inc", "node", "argPeri", "ma", "epochMJD_TDB", "FORMAT"],
    "COM": ["ObjID", "FORMAT", "q", "e", "inc", "argPeri", "node", "t_p_MJD_TDB", "epochMJD_TDB"],
}
PHYSICAL_COLUMNS = ["ObjID", "H_r", "g-r"]
EPOCH_FIELDS = ["Epoch_year", "Epoch_month", "Epoch_day", "Year_of_perihelion", "Month_of_perihelion", "Day_of_perihelion"]


def _numbers(names: Iterable[str], fields: str) -> dict[str, Column]:
    """The numbers that fields of a struct of texts spell."""
    return {c: V.lenient_double(F.col(f"{fields}.{c}")) for c in names}


def constants(format_name: str) -> dict[str, Column]:
    return {"FORMAT": F.lit(format_name), "g-r": F.lit(COLOUR)}


def asteroid_inputs(objects: DataFrame, obj: str = "obj") -> DataFrame:
    """objects with the KEP orbit and physical columns; the simulator's id is the principal designation."""
    names = {"a": "a", "e": "e", "inc": "i", "node": "Node", "argPeri": "Peri", "ma": "M", "H_r": "H"}
    own = "Principal_desig"
    known = V.typed(objects, obj, [*names.values(), "Epoch", own])
    number = _numbers([*names.values(), "Epoch"], "__fields")
    columns = {new: number[old] for new, old in names.items()}
    columns |= {"ObjID": F.col(f"__fields.{own}"), "epochMJD_TDB": V.mjd_of_jd(number["Epoch"]), **constants("KEP")}
    return known.withColumns(columns).drop("__fields")


def comet_inputs(objects: DataFrame, obj: str = "obj") -> DataFrame:
    """objects with the COM orbit and physical columns, without those that lack a date field. The epoch is
    a whole day, the perihelion keeps its fraction. The simulator's id is the designation and name."""
    names = {"q": "Perihelion_dist", "e": "e", "inc": "i", "argPeri": "Peri", "node": "Node", "H_r": "H"}
    own = "Designation_and_name"
    known = V.typed(objects, obj, [*names.values(), *EPOCH_FIELDS, own])
    dates = V.generated(known, F.struct(*(v.alias(c) for c, v in _numbers(EPOCH_FIELDS, "__fields").items())), "__dates")
    epoch, perihelion = ([F.col(f"__dates.{c}") for c in EPOCH_FIELDS[k : k + 3]] for k in (0, 3))
    dated = dates.where(reduce(and_, (c.isNotNull() for c in (*epoch, *perihelion))))
    columns = {new: n for new, n in zip(names, _numbers(names.values(), "__fields").values(), strict=True)}
    columns |= {"ObjID": F.col(f"__fields.{own}"), "epochMJD_TDB": V.mjd_of_calendar(*epoch), "t_p_MJD_TDB": V.mjd_of_calendar_fraction(*perihelion), **constants("COM")}
    return dated.withColumns(columns).drop("__fields", "__dates")


def job_inputs(objects: DataFrame, status: str, comets: bool = False) -> DataFrame:
    """The wide input frame of one job: the objects of a status with their simulator columns, catalog_row
    and payload (the catalog object as JSON). Elements, physics and catalog data stay one row."""
    convert = comet_inputs if comets else asteroid_inputs
    return convert(objects.where(F.col("status") == status)).withColumn("payload", F.to_json("obj")).drop("obj")
