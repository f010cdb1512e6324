"""Loan-shaped raw text view over the driver's TPC-H-like tables.

One ``lineitem`` row is one loan application; every column is text so that
staging's cleanup and casts run in full.  The same SQL text feeds Spark and
the DuckDB oracle; only three spellings differ.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "customer", "part", "nation")

_GRADE = ("CASE WHEN p_size<=8 THEN 'A' WHEN p_size<=22 THEN 'B' WHEN p_size<=35 THEN 'C' "
          "WHEN p_size<=43 THEN 'D' WHEN p_size<=47 THEN 'E' WHEN p_size<=49 THEN 'F' ELSE 'G' END")

# The raw view defined for the test fixtures (text columns of the loan file).
RAW_VIEW_TEMPLATE = f"""
SELECT concat(CAST(l_orderkey AS <STR>),'-',CAST(l_linenumber AS <STR>),'-',CAST(l_partkey AS <STR>),'-',CAST(l_suppkey AS <STR>)) AS id,
 CASE WHEN o_orderstatus='P' AND l_linestatus='O' THEN 'Current'
      WHEN l_linenumber=7 AND l_returnflag='R' THEN 'Does not meet the credit policy. Status:Charged Off'
      WHEN l_linenumber=7 THEN 'Does not meet the credit policy. Status:Fully Paid'
      WHEN l_returnflag='R' THEN 'Charged Off' ELSE 'Fully Paid' END AS loan_status,
 CASE WHEN l_partkey%97=0 THEN 'n/a' ELSE CAST(l_extendedprice AS <STR>) END AS loan_amnt,
 CASE WHEN l_linenumber%3=0 THEN ' 60 months' ELSE ' 36 months' END AS term,
 concat(CAST(5+CAST(round(l_discount*100) AS INT)+CAST(round(l_tax*100) AS INT) AS <STR>),'.',CAST(l_partkey%10 AS <STR>),'%') AS int_rate,
 CAST(l_quantity*25 AS <STR>) AS installment,
 {_GRADE} AS grade,
 concat({_GRADE}, CAST(l_partkey%5+1 AS <STR>)) AS sub_grade,
 CASE WHEN c_mktsegment='AUTOMOBILE' THEN 'car' WHEN c_mktsegment='BUILDING' THEN 'home_improvement' WHEN c_mktsegment='MACHINERY' THEN 'small_business' ELSE 'debt_consolidation' END AS purpose,
 CASE WHEN l_linenumber=1 THEN '10+ years' WHEN l_linenumber=2 THEN '< 1 year' WHEN l_linenumber=3 THEN 'n/a' WHEN l_linenumber=4 THEN NULL ELSE concat(CAST(l_linenumber AS <STR>),' years') END AS emp_length,
 CASE WHEN l_suppkey%3=0 THEN 'RENT' WHEN l_suppkey%3=1 THEN 'MORTGAGE' ELSE 'OWN' END AS home_ownership,
 CASE WHEN o_orderkey%101=0 THEN NULL WHEN o_orderkey%103=0 THEN '0' ELSE CAST(o_totalprice AS <STR>) END AS annual_inc,
 CASE WHEN l_linenumber%3=0 THEN 'Verified' WHEN l_linenumber%3=1 THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status,
 CASE WHEN l_suppkey%19=0 THEN NULL ELSE concat(CAST(l_partkey%70 AS <STR>),'.',CAST(l_suppkey%10 AS <STR>)) END AS dti,
 CASE WHEN o_custkey%53=0 THEN NULL ELSE CAST(620+(o_custkey%46)*5 AS <STR>) END AS fico_range_low,
 CASE WHEN o_custkey%53=0 THEN NULL ELSE CAST(624+(o_custkey%46)*5 AS <STR>) END AS fico_range_high,
 CAST(l_suppkey%30 AS <STR>) AS open_acc, CAST(l_partkey%2 AS <STR>) AS pub_rec, CAST(l_quantity*100 AS <STR>) AS revol_bal,
 concat(CAST(l_partkey%131 AS <STR>),'%') AS revol_util, CAST(l_linenumber*5 AS <STR>) AS total_acc, CAST(l_linenumber%6 AS <STR>) AS mort_acc,
 CAST(l_suppkey%3 AS <STR>) AS delinq_2yrs, CAST(l_linenumber%4 AS <STR>) AS inq_last_6mths,
 n_name AS addr_state, CASE WHEN l_suppkey%10=0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
 <FMT>(o_orderdate,'<PAT>') AS issue_d,
 CASE WHEN l_partkey%41=0 THEN '' ELSE <FMT>(l_shipdate,'<PAT>') END AS last_pymnt_d,
 CAST(l_quantity*800 AS <STR>) AS total_pymnt, CASE WHEN l_returnflag='R' THEN CAST(l_quantity*10 AS <STR>) ELSE '0.0' END AS recoveries
FROM <lineitem> JOIN <orders> ON l_orderkey=o_orderkey JOIN <customer> ON o_custkey=c_custkey
 JOIN <part> ON l_partkey=p_partkey JOIN <nation> ON c_nationkey=n_nationkey
"""

_DIALECT = {
    "spark": {"<STR>": "STRING", "<FMT>": "date_format", "<PAT>": "MMM-yyyy"},
    "duckdb": {"<STR>": "VARCHAR", "<FMT>": "strftime", "<PAT>": "%b-%Y"},
}


def raw_view_sql(dialect: str) -> str:
    text = RAW_VIEW_TEMPLATE
    for k, v in _DIALECT[dialect].items():
        text = text.replace(k, v)
    for t in TABLES:
        text = text.replace(f"<{t}>", "{" + t + "}" if dialect == "spark" else t)
    return text


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")) for t in TABLES}


def raw_loans(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None) -> DataFrame:
    """The raw (all-text) loan file as a DataFrame over the driver tables.

    The other tables are broadcast into the ``lineitem`` scan, so the view has
    ``lineitem``'s splits.  A file with fewer row groups than the session has
    cores (the small driver files hold one) is spread round-robin first;
    a large input keeps its own splits and gets no extra shuffle.

    ``part`` = (k, n): the k-th of n parts by the hash of the order, which the join hands on to ``orders``.
    """
    tables = read_tables(spark, sf_dir)
    cores = spark.sparkContext.defaultParallelism
    few = tables["lineitem"].rdd.getNumPartitions() < cores
    if part is not None:
        tables["lineitem"] = tables["lineitem"].filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(part[1])) == part[0])
    if few:
        tables["lineitem"] = tables["lineitem"].repartition(cores)
    return spark.sql(raw_view_sql("spark"), **tables)


def raw_loan_parts(spark: SparkSession, sf_dir: str, rows: int) -> list[DataFrame]:
    """The view in parts of about ``rows`` applications, for readers whose files of the whole would be too large."""
    n = max(1, -(-read_tables(spark, sf_dir)["lineitem"].count() // rows))
    return [raw_loans(spark, sf_dir, (k, n) if n > 1 else None) for k in range(n)]
