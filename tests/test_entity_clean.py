"""Hand-made raw log with the edge cases of FIXTURES.md §1."""
import csv
import datetime as dt
import os

from plumbline.operators.clean import clean_raw
from plumbline.operators.entity import build_entity_table
from plumbline.sources.files import read_entity_table, read_raw_csv, run_build_job, write_table

HEADER = ["CAMIS", "DBA", "BORO", "BUILDING", "STREET", "PHONE", "CUISINE DESCRIPTION",
          "INSPECTION DATE", "ACTION", "VIOLATION CODE", "CRITICAL FLAG", "SCORE", "GRADE",
          "GRADE DATE", "INSPECTION TYPE", "Latitude", "Longitude", "EXTRA COLUMN"]
ROWS = [
    ["1", "  Cafe One ", "manhattan", "10", "Main St", "555", "Pizza", "01/05/2020", "A1", "02A",
     "critical", "12", "a", "01/05/2020", "Cycle", "40.7", "-73.9", "x"],
    ["1", "Cafe One", "MANHATTAN", "10", "", "NA", "Pizza", "1/5/2020", "A1", "04B",
     "not critical", "13", "", "", "Cycle", "40.7", "-73.9", "x"],
    ["1", "Cafe One", "manhattan", "", "  ", "", "Pizza", "3/2/2021", "A2", "", "", "", "b",
     "3/2/2021", "Re", "40.7", "-73.9", "x"],
    ["1", "Cafe One", "manhattan", "", "", "", "Pizza", "not a date", "A3", "10F",
     "Not Applicable", "abc", "", "", "Re", "nan", "-73.9", "x"],
    ["2", "Never Inspected", "0", "1", "A St", "", "Thai", "01/01/1900", "", "", "", "", "", "",
     "", "", "", "x"],
    ["3", "No Letter", "queens", "2", "B St", "", "Thai", "1/1/2020", "B1", "05C", "Critical",
     "20", "N", "", "Cycle", "40.8", "-73.8", "x"],
    ["3", "No Letter", "queens", "2", "B St", "", "Thai", "6/1/2020", "B2", "", "", "25", "Z", "",
     "Cycle", "40.8", "-73.8", "x"],
    ["5", 'JOE "THE BEST" PIZZA, INC', "staten-island", "9", "Line one\nLine two", "", 'Pizza, "thin"', "2/2/2020", "Q", "", "",
     "4", "A", "2/2/2020", "Cycle", "40.6", "-74.1", "x"],
    ["4", "Tie", "bronx", "3", "C St", "", "Deli", "2/2/2020", "X", "", "", "5", "C", "2/2/2020",
     "Cycle", "40.85", "-73.85", "x"],
    ["4", "Tie", "bronx", "3", "C St", "", "Deli", "2/2/2020", "Y", "", "", "7", "C", "2/2/2020",
     "Cycle", "40.85", "-73.85", "x"],
    ["", "No Key", "bronx", "", "", "", "Deli", "2/2/2020", "Z", "", "", "9", "A", "", "", "", "",
     "x"],
]


def _write_csv(path):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        w.writerows(ROWS)


def test_clean_and_build(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "raw.csv")
    _write_csv(path)
    raw = read_raw_csv(spark, path)
    log = clean_raw(raw, keep=["rid"])
    assert "extra_column" not in log.columns
    got = {r["camis"]: r for r in build_entity_table(log, "2022-01-01").collect()}
    assert set(got) == {1, 2, 3, 4, 5}  # missing key dropped
    e1 = got[1]
    assert e1["dba"] == "Cafe One" and e1["boro"] == "Manhattan"
    assert e1["phone"] == "555" and e1["street"] == "Main St" and e1["building"] == "10"
    assert e1["latest_inspection_date"] == dt.date(2021, 3, 2)
    assert e1["latest_score"] is None and e1["latest_action"] == "A2"
    assert e1["latest_grade"] == "B" and e1["latest_grade_encoded"] == 2.0
    assert e1["latest_grade_date"] == dt.date(2021, 3, 2)
    assert e1["inspection_count"] == 2
    assert (e1["mean_score"], e1["min_score"], e1["max_score"]) == (12.0, 12.0, 12.0)
    assert (e1["total_violations"], e1["critical_violations"],
            e1["non_critical_violations"]) == (3, 1, 1)
    assert e1["unique_violation_codes"] == "02A,04B,10F"
    assert e1["days_since_last_inspection"] == 305
    assert e1["latitude"] == 40.7
    e2 = got[2]
    assert e2["inspection_count"] == 0 and e2["latest_inspection_date"] is None
    assert e2["latest_grade"] is None and e2["total_violations"] == 0
    assert e2["unique_violation_codes"] is None and e2["boro"] == "0"
    e3 = got[3]
    assert e3["latest_grade"] == "Z" and e3["latest_grade_encoded"] is None
    e5 = got[5]
    assert e5["dba"] == 'JOE "THE BEST" PIZZA, INC' and e5["boro"] == "Staten-Island"
    assert e5["street"] == "Line one\nLine two" and e5["cuisine"] == 'Pizza, "thin"'
    assert e5["latest_grade"] == "A" and e5["longitude"] == -74.1
    e4 = got[4]
    assert e4["latest_action"] == "X" and e4["latest_score"] == 5.0 and e4["mean_score"] == 5.0


def test_csv_round_trip_and_job(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "raw.csv")
    _write_csv(path)
    out = os.path.join(tmpdir_path, "entities_csv")
    stats = run_build_job(spark, path, out, "2022-01-01", out_fmt="csv")
    assert stats["rows"] == len(ROWS) and stats["entities"] == 5 and stats["written"] == 5
    back = read_entity_table(spark, out, fmt="csv")
    r = {x["camis"]: x for x in back.collect()}
    assert r[5]["dba"] == 'JOE "THE BEST" PIZZA, INC' and r[5]["street"] == "Line one\nLine two"
    assert r[1]["latest_inspection_date"] == dt.date(2021, 3, 2)
    pq = os.path.join(tmpdir_path, "entities_pq")
    log = clean_raw(read_raw_csv(spark, path), keep=["rid"])
    write_table(build_entity_table(log, "2022-01-01"), pq)
    assert read_entity_table(spark, pq).count() == 5


def test_clean_text_searches_only_texts_with_odd_ends(spark):
    """One step gives what the three steps give, for every kind of white space, and plain
    texts take the short way."""
    from plumbline.functions import columns as C
    ends = ["", "a", "x y", "\u0085", "\u2003", "\x1f", "\x84", "é", "日", "\U0001f600", *C.WHITE_SPACE]
    texts = [None, "NA", " NA", "n/a", "none"] + [a + m + b for a in ends for b in ends for m in ("", "q", " ")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old = C.blank_to_null(C.trim_all_space(C.na_text_to_null("t")))
    assert df.select(C.clean_text("t").alias("v")).collect() == df.select(old.alias("v")).collect()
    got = spark.createDataFrame([("nan",), ("1e3",), ("x",), (None,), ("-Infinity",)], "t string").select(C.to_double("t").alias("v"))
    assert [r.v for r in got.collect()] == [None, 1000.0, None, None, float("-inf")]
    raw = spark.createDataFrame([("1", " A ")], "CAMIS string, DBA string")
    assert "ascii" in clean_raw(raw)._jdf.queryExecution().analyzed().toString()
