"""Splittable CSV records, reject quarantine, ordered tables, all-or-nothing replacement, scratch folders."""

import csv
import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from lendlens.plans import export, quarantine
from lendlens.plans.staging import stage_loans
from lendlens.session import materialize, scratch, shared_dir
from lendlens.sources.ordered import read_ordered, write_ordered
from lendlens.sources.records import csv_records, n_fields, read_csv_records


# ---------------------------------------------------------------- CSV records
def test_records_are_parsed_once(spark, tmp_path):
    """filters and uses of many columns leave one parser in the plan."""
    (tmp_path / "f.csv").write_text('a,b,c\n1,2,x\n3,,"y,z"\n5\n')
    rows = read_csv_records(spark, str(tmp_path), keep_record=True)
    assert [tuple(r) for r in rows.orderBy("a").collect()] == [("1", "2", "x", "1,2,x", 3), ("3", None, "y,z", '3,,"y,z"', 3), ("5", None, None, "5", 1)]
    used = rows.filter("try_cast(a AS double) > 1 OR b = '2'").selectExpr("a || coalesce(b, '') || coalesce(c, '') AS t", "a", "c")
    assert used._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    assert sorted(r["t"] for r in used.collect()) == ["12x", "3y,z", "5"]


def random_rows(seed, n):
    rnd = random.Random(seed)
    words = ["a", "b c", 'say "hi"', "line one\nline two", "\n", ",", '"', 'x,"y"\nz', "ü€", "", "1.5", "\n\n", "end\n"]
    return [[rnd.choice(words) + (str(rnd.randint(0, 99)) if rnd.random() < 0.5 else "") for _ in range(3)] for _ in range(n)]


@pytest.mark.parametrize("size", [37, 200, 1 << 20])
def test_records_of_split_files(spark, tmp_path, size):
    """Byte ranges far shorter than some records; two files; equal to a sequential CSV parser."""
    want = []
    for k in range(2):
        rows = random_rows(k, 70)
        want += [[c or None for c in r] for r in rows]
        with open(tmp_path / f"f{k}.csv", "w", newline="") as f:
            w = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_MINIMAL if k else csv.QUOTE_ALL)
            w.writerow(["id", "two\nlines", "c"])
            w.writerows(rows)
    keep = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        df = read_csv_records(spark, str(tmp_path))
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        assert df.columns == ["id", "two\nlines", "c"] and (size > 1000 or tasks > 10)
        got = [list(r) for r in df.collect()]
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    key = lambda r: [x or "" for x in r]
    # a row of three empty fields is a blank line or ",,"; both parsers agree on everything else
    assert sorted(got, key=key) == sorted(want, key=key)


def test_odd_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"never closed\n2,x\n')
    assert [tuple(r) for r in read_csv_records(spark, str(tmp_path / "open.csv"), keep_record=True).select("a", "_record").collect()] == [
        ("1", '1,"never closed\n2,x')]
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write('a,b\n\n1,"x\ny"\n\n2,\n')
    got = {tuple(r) for r in read_csv_records(spark, str(tmp_path / "z.csv.gz")).collect()}
    assert got == {("1", "x\ny"), ("2", None)}
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError):
        read_csv_records(spark, str(tmp_path / "none.csv"))
    (tmp_path / "head.csv").write_text("a,b\n")
    assert read_csv_records(spark, str(tmp_path / "head.csv")).count() == 0
    assert csv_records(spark, str(tmp_path / "head.csv")).count() == 1
    texts = ['a,b,c', '"a,b",c', '"a""b,""",c,,', "", '"x\n,y"']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r["n"] for r in df.select(n_fields(F.col("t")).alias("n")).collect()] == [len(next(csv.reader(io.StringIO(t)), [""])) for t in texts]


# ---------------------------------------------------------------- quarantine
RAW = ("id loan_status loan_amnt term int_rate installment grade sub_grade purpose emp_length home_ownership annual_inc verification_status dti "
       "fico_range_low fico_range_high open_acc pub_rec revol_bal revol_util total_acc mort_acc delinq_2yrs inq_last_6mths addr_state application_type "
       "issue_d last_pymnt_d total_pymnt recoveries").split()


def raw_line(i, **values):
    row = {**{c: "1" for c in RAW}, "id": f"L{i}", "loan_status": "Fully Paid", "term": " 36 months", "emp_length": "2 years", "issue_d": "Jan-2015",
           "last_pymnt_d": "Mar-2016", "addr_state": "two\nlines", **values}
    return [row[c] for c in RAW]


def test_quarantine(spark, tmp_path):
    rows = [raw_line(0), raw_line(1, loan_amnt="n/a"), raw_line(2, annual_inc=""), raw_line(3, issue_d=""), raw_line(4, issue_d="2015-01"),
            raw_line(5, last_pymnt_d="Foo-2016"), raw_line(6, last_pymnt_d=""), raw_line(7, loan_status="Current", loan_amnt="n/a"),
            raw_line(8, loan_amnt="1d", annual_inc="x", last_pymnt_d="?"), raw_line(9)[:-2], raw_line(10) + ["more"], ["L11"]]
    path = tmp_path / "raw.csv"
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(RAW)
        w.writerows(rows)
    book, rejects = quarantine.land_with_quarantine(read_csv_records(spark, str(path), keep_record=True), str(tmp_path / "book"), str(tmp_path / "rejects"))
    got = {r["loan_id"]: (r["reasons"], r["fatal"]) for r in rejects.collect()}
    assert got == {
        "L1": (["bad_amount"], True), "L2": (["bad_income"], True), "L3": (["no_issue_month"], True), "L4": (["bad_issue_month"], True),
        "L5": (["bad_payment_month"], False), "L8": (["bad_amount", "bad_income", "bad_payment_month"], True), "L9": (["short_row"], False),
        "L10": (["extra_fields"], False), "L11": (["short_row", "bad_amount", "bad_income", "no_issue_month"], True)}
    records = {r["loan_id"]: r["record"] for r in rejects.collect()}
    assert next(csv.reader(io.StringIO(records["L10"], newline=""))) == rows[10]
    assert {r["id"] for r in book.select("id").collect()} == {f"L{i}" for i in range(9)}
    assert {r["loan_id"] for r in stage_loans(book, strict_dates=False).filter("issue_date IS NOT NULL").collect()} == {"L0", "L5", "L6"}
    counts = {r["reason"]: (r["n_rows"], r["n_fatal"]) for r in quarantine.reason_counts(rejects).collect()}
    assert counts["short_row"] == (2, 1) and counts["bad_payment_month"] == (2, 1) and counts["bad_amount"] == (3, 3)
    plain = quarantine.quarantine(book)                     # without the raw text the row itself is told
    assert plain.filter("loan_id = 'L1'").first()["record"].startswith('{"id":"L1"')
    assert quarantine.quarantine(book.limit(0)).count() == 0


# ---------------------------------------------------------------- ordered tables
@pytest.mark.parametrize("ranges", [1, 4, 13])
def test_ordered_table(spark, tmp_path, ranges):
    rnd = random.Random(ranges)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, rnd.randint(0, 50)]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(6)
    write_ordered(df, str(tmp_path / "t"), ["a", "-b", "c"], ranges=ranges)
    got = read_ordered(spark, str(tmp_path / "t"))
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, -(r[1] or 0), r[2]))
    assert [tuple(r)[:3] for r in got.orderBy("position").collect()] == order
    assert [r["position"] for r in got.select("position").orderBy("position").collect()] == list(range(1, 701))
    write_ordered(df.limit(0), str(tmp_path / "e"), ["a"])
    assert read_ordered(spark, str(tmp_path / "e")).count() == 0


# ---------------------------------------------------------------- tables and folders
def test_failing_write_leaves_the_old_table(spark, tmp_path):
    name = f"t{os.getpid()}_replace"
    export.save_table(spark.range(5), name, folder=str(tmp_path))
    first = export.table_folder(spark, name)
    bad = spark.range(3).select(F.when(F.col("id") > 1, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        export.save_table(bad, name, folder=str(tmp_path))
    assert spark.table(name).count() == 5 and export.table_folder(spark, name) == first
    held = spark.table(name)
    assert os.listdir(tmp_path / name) == [os.path.basename(first)]                  # nothing of the failed version is left
    export.save_table(spark.range(9), name, folder=str(tmp_path))
    assert spark.table(name).count() == 9 and len(os.listdir(tmp_path / name)) == 1
    assert held.schema == spark.table(name).schema
    export.save_table(spark.range(2).select(F.col("id").cast("string").alias("other")), name, folder=str(tmp_path))      # another schema
    assert spark.table(name).columns == ["other"] and spark.table(name).count() == 2 and len(os.listdir(tmp_path / name)) == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "__")]
    spark.sql(f"DROP TABLE {name}")


def test_scratch_folders_go(spark):
    top = os.path.join(shared_dir(spark).removeprefix("file:"), "tables")
    outer = materialize(spark.range(3), "scratch-outer")
    before = set(os.listdir(top))
    with pytest.raises(RuntimeError):
        with scratch(spark):
            with scratch(spark):
                materialize(spark.range(3), "scratch-inner")
                assert len(set(os.listdir(top)) - before) == 1
            assert set(os.listdir(top)) == before
            materialize(spark.range(3), "scratch-middle")
            raise RuntimeError
    assert set(os.listdir(top)) == before and outer.count() == 3
