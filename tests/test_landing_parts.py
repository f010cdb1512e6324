"""CSV landings in parts: as many rows, at no time the text of more than one part."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lendlens import catalog_io
from lendlens.catalog import REGISTRY
from lendlens.session import shared_dir
from lendlens.sources.fixture import raw_loan_parts, raw_loans


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Tables of 600 loans; some orders are null or repeated."""
    rnd, top = random.Random(4), tmp_path_factory.mktemp("tables")
    day = 24 * 3600 * 10 ** 6
    orders = [*range(1, 120), 7, 7, None]
    lines = [rnd.choice([*range(1, 130), None]) for _ in range(600)]
    tables = {
        "nation": {"n_nationkey": pa.array([0, 1]), "n_name": ["PERU", "CHINA"]},
        "customer": {"c_custkey": list(range(1, 21)), "c_nationkey": [k % 2 for k in range(20)], "c_mktsegment": ["AUTOMOBILE", "MACHINERY"] * 10},
        "part": {"p_partkey": list(range(1, 41)), "p_size": list(range(1, 41))},
        "orders": {"o_orderkey": orders, "o_custkey": [rnd.randint(1, 20) for _ in orders], "o_orderstatus": [rnd.choice("PF") for _ in orders],
                   "o_totalprice": [rnd.randint(1, 9) * 1e4 for _ in orders], "o_orderdate": pa.array([rnd.randint(8000, 9000) * day for _ in orders], pa.timestamp("us"))},
        "lineitem": {"l_orderkey": lines, "l_linenumber": [rnd.randint(1, 7) for _ in lines], "l_partkey": [rnd.randint(1, 40) for _ in lines],
                     "l_suppkey": [rnd.randint(1, 30) for _ in lines], "l_linestatus": [rnd.choice("OF") for _ in lines], "l_returnflag": [rnd.choice("RAN") for _ in lines],
                     "l_extendedprice": [rnd.randint(1, 9) * 1e3 for _ in lines], "l_discount": [0.05 for _ in lines], "l_tax": [0.02 for _ in lines],
                     "l_quantity": [float(rnd.randint(1, 50)) for _ in lines], "l_shipdate": pa.array([rnd.randint(8500, 9500) * day for _ in lines], pa.timestamp("us"))},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), top / f"{name}.parquet")
    return str(top)


def counted(df):
    return sorted(map(repr, df.collect()))


def test_parts_are_the_whole_view(spark, folder):
    parts = raw_loan_parts(spark, folder, 150)
    sizes = [p.count() for p in parts]
    assert len(parts) == 4 and min(sizes) > 0
    assert sorted(sum((counted(p) for p in parts), [])) == counted(raw_loans(spark, folder))
    assert len(raw_loan_parts(spark, folder, 600)) == 1


@pytest.mark.parametrize("name", ["staging_from_csv", "staging_quarantine"])
def test_text_of_one_part_at_a_time(spark, folder, monkeypatch, name):
    """neither the landed text nor the CSV files and records of all parts are on disk, at the end nothing of them; no book is built."""
    top, texts = shared_dir(spark).removeprefix("file:"), []

    def held(*words):
        return [d for below in ("exports", "tables") if os.path.isdir(f"{top}/{below}") for d in os.listdir(f"{top}/{below}") if d.startswith(words)]

    def told(spark, path, f=catalog_io.read_csv_records, **kw):
        texts.append(len(held("raw.csv")))
        return f(spark, path, **kw)

    before = held("raw.csv", "lines", "csv-", "loans_raw", "loan_features")
    whole = counted(REGISTRY[name].run(spark, folder))
    monkeypatch.setattr(catalog_io, "read_csv_records", told)
    monkeypatch.setattr(catalog_io, "CSV_ROWS", 150)
    assert counted(REGISTRY[name].run(spark, folder)) == whole and whole
    assert texts == [1 + len([d for d in before if d.startswith("raw.csv")])] * 4
    assert held("raw.csv", "lines", "csv-", "loans_raw", "loan_features") == before
