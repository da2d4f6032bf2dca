import json

import pytest
from pyspark.sql import functions as F

from skyledger.functions import digests, values as V
from skyledger.operators import convert
from skyledger.operators import relational as Q
from skyledger.sources import catalog as C


def read(spark, tmp_path, objects, name="catalog.json"):
    path = tmp_path / name
    path.write_text(json.dumps(objects))
    return C.read_catalog(spark, str(path))


#: Objects on both sides of each limit, and values that are none.
POOR = {"a": 1.7, "U": "8", "Arc_length": 0.5}
KEEP = [
    (POOR, False),
    (POOR | {"a": 30.000001}, True),
    (POOR | {"a": 30.0}, False),
    (POOR | {"a": " 4_5.5 "}, True),
    (POOR | {"a": "+Infinity"}, True),
    (POOR | {"a": "3e1f"}, False),
    (POOR | {"U": 6.0}, True),
    (POOR | {"U": 6.01}, False),
    (POOR | {"U": "\t-2 "}, True),
    (POOR | {"U": "D"}, False),
    (POOR | {"Arc_length": 2.999}, False),
    (POOR | {"Arc_length": 3}, True),
    (POOR | {"Arc_length": "about 12.5 nights"}, True),
    (POOR | {"Arc_length": "2.9 days"}, False),
    (POOR | {"Arc_length": "1998 - 2003"}, True),
    (POOR | {"Arc_length": " NaN "}, False),
    (POOR | {"Arc_years": "1987-1988"}, True),
    (POOR | {"Arc_years": "   "}, False),
    (POOR | {"Arc_years": "nan"}, False),
    (POOR | {"Arc_length": {"days": 9}}, False),
    ({"a": None, "U": None, "Arc_length": None, "Arc_years": None}, False),
    ({"name": "nothing that counts"}, False),
]


def test_keep(spark, tmp_path):
    rows = read(spark, tmp_path, [o for o, _ in KEEP])
    kept = {r["catalog_row"] for r in Q.keep_objects(rows).collect()}
    assert kept == {k for k, (_, keep) in enumerate(KEEP) if keep}
    assert Q.keep_objects(rows, comets=True).count() == len(KEEP)


def test_rows_and_ids(spark, tmp_path):
    objects = [{"Principal_desig": "A"}, 5, {"Provisional_packed_desig": "", "Designation_and_name": "B/c"}, {"Provisional_packed_desig": "P", "Principal_desig": "Q"}, {"Principal_desig": None}, {"Principal_desig": 7}]
    got = Q.identified(read(spark, tmp_path, objects)).orderBy("catalog_row").collect()
    assert [(r["catalog_row"], r["object_id"]) for r in got] == [(0, "A"), (2, "B/c"), (3, "P"), (4, None), (5, "7")]


def test_hash_tells_missing_null_and_types_apart(spark, tmp_path):
    objects = [{}, {"e": None}, {"e": ""}, {"e": 1}, {"e": "1"}, {"i": 1}]
    h = [r["element_hash"] for r in Q.identified(read(spark, tmp_path, objects)).orderBy("catalog_row").collect()]
    assert h[0] == h[2] and h[3] == h[4] and len({h[0], h[1], h[3], h[5]}) == 4


def test_diff_statuses(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "2"), ("c", "3"), (None, "4")], "object_id string, element_hash string")
    base = spark.createDataFrame([("a", "1"), ("b", "x"), ("z", "9")], "object_id string, element_hash string")
    got = sorted((r["object_id"] or "", r["status"]) for r in Q.diff(now, base).collect())
    assert got == [("", "new"), ("a", "unchanged"), ("b", "updated"), ("b", "updated"), ("c", "new")]
    assert [r["object_id"] for r in Q.removed(now, base).collect()] == ["z"]


def test_baseline_takes_the_last(spark):
    rows = spark.createDataFrame([("a", "1", 0), ("a", "2", 5), (None, "3", 6)], "object_id string, element_hash string, catalog_row long")
    assert [(r[0], r[1]) for r in Q.new_baseline(rows).collect()] == [("a", "2")]


def test_ignore_lists(spark, tmp_path):
    (tmp_path / "leave.txt").write_text("# satellites first\nK07Tf8X , 2007 TX8\n\nJ99R36Q# lost, never seen again\n , \n2007 TX8\n")
    (tmp_path / "leave.csv").write_text("why,Principal_desig,ObjID\nlost,1999 RQ36,  J99R36Q \ntwice,1999 RQ36,J99R36Q\nempty,x,\n")
    ids = lambda *a: {r[0] for r in C.ignore_ids(spark, *a).collect()}
    assert ids(str(tmp_path / "leave.txt"), ["Bennu", "", "\t"]) == {"K07Tf8X", "2007 TX8", "J99R36Q", "Bennu"}
    assert ids(str(tmp_path / "leave.csv")) == {"J99R36Q"}  # the id column that comes first in order, not in the file
    rows = spark.createDataFrame([("Ceres",), ("2007 TX8",), ("Bennu",), (None,)], "object_id string")
    left = Q.drop_ignored(rows, C.ignore_ids(spark, str(tmp_path / "leave.txt"), ["Bennu"]))
    assert {r[0] for r in left.collect()} == {"Ceres", None}


def test_dates(spark):
    row = spark.createDataFrame([(2000, 1, 1.25), (240, 1, 1.0), (2024, 2, 30.0), (None, 1, 1.0)], "y int, m int, d double")
    got = row.select(V.mjd_of_calendar(F.col("y"), F.col("m"), F.col("d")), V.mjd_of_calendar_fraction(F.col("y"), F.col("m"), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(51544.0, 51544.25), (-591283.0, -591283.0), (None, None), (None, None)]


def test_conversions(spark, tmp_path):
    a = read(spark, tmp_path, [{"Principal_desig": "A", "a": 2.0, "e": 0.1, "i": 1.0, "Node": 2.0, "Peri": 3.0, "M": 4.0, "Epoch": 2461000.5, "H": 15.0}])
    r = convert.asteroid_inputs(a).first()
    assert [r[c] for c in convert.ORBIT_COLUMNS["KEP"]] == ["A", 2.0, 0.1, 1.0, 2.0, 3.0, 4.0, 61000.0, "KEP"] and (r["H_r"], r["g-r"]) == (15.0, 0.5)
    comet = {"Designation_and_name": "C/1", "e": 1, "i": 2, "Peri": 3, "Node": 4, "Perihelion_dist": 5, "H": 6, "Epoch_year": 2000, "Epoch_month": 1, "Epoch_day": 1.9, "Year_of_perihelion": 2000, "Month_of_perihelion": 1, "Day_of_perihelion": 2.5}
    c = read(spark, tmp_path, [comet, {**comet, "Epoch_month": None}], "c.json")
    got = convert.comet_inputs(c).collect()
    assert len(got) == 1 and [got[0][x] for x in convert.ORBIT_COLUMNS["COM"]] == ["C/1", "COM", 5.0, 1.0, 2.0, 3.0, 4.0, 51545.5, 51544.0]


def test_digest_ignores_partitions_and_minds_order(spark):
    df = spark.range(2500).select(F.col("id").alias("input_row"), (F.col("id") % 7).alias("x"))
    assert digests.frame_digest(df) == digests.frame_digest(df.repartition(7))
    assert digests.frame_digest(df) != digests.frame_digest(df.withColumn("x", F.col("x") + F.when(F.col("input_row") == 9, 1).otherwise(0)))
    assert digests.context_digest(b=1, a=2) == digests.context_digest(a=2, b=1) != digests.context_digest(a=2, b=3)
    assert digests.safe_token("a b/c" * 30, "x") == ("a_b_c" * 30)[:80] and digests.safe_token("", "x") == "x"


def test_path_fingerprint(tmp_path):
    f = tmp_path / "f"
    assert digests.path_fingerprint(f).endswith(":missing")
    f.write_text("abc")
    assert ":3:" in digests.path_fingerprint(f)


def test_download(tmp_path):
    import gzip

    catalog = json.dumps([{"Principal_desig": "2007 TX8", "a": 2.25}])
    asked = []

    def served(url):
        asked.append(url)
        return gzip.compress(catalog.encode())

    for comets in (False, True):
        at = C.download_catalog("2031-12-05", tmp_path / "new", comets, fetch=served)
        assert json.loads(at.read_text()) == json.loads(catalog) and at.name.startswith("2031-12-05")
    assert asked == [C.ASTEROID_URL, C.COMET_URL]

    def broken(url):
        raise OSError("connection reset")

    with pytest.raises(OSError, match="reset"):
        C.download_catalog("2031-12-05", tmp_path, fetch=broken)
