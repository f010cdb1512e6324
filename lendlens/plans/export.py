"""The star of dashboard tables, as Parquet (and CSV for the small ones)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame

from lendlens.session import remove_folder, shared_dir
from lendlens.sources.ordered import sort_keys, write_ordered


# The loan-level fact table's columns.
FACT_COLUMNS = ("loan_id", "is_default", "loan_amnt", "term_months", "int_rate", "grade", "sub_grade",
                "purpose", "home_ownership", "annual_inc", "dti", "fico", "income_decile", "fico_quintile",
                "loan_to_income", "vintage_quarter", "issue_date", "addr_state")


# Order of the stored report tables (a minus sign: descending); ties by the keys.
REPORT_ORDER = {"vintage_curves": ["vintage_quarter", "mob"], "grade_loss": ["grade"],
                "segment_expected_loss": ["-el_rate", "grade", "purpose", "income_decile"]}


def fact_loans(features: DataFrame) -> DataFrame:
    """S3: the narrow loan-level fact (all rows, 18 columns)."""
    return features.select(*FACT_COLUMNS)


def write_parquet(df: DataFrame, path: str, partition_by: tuple = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_small_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One CSV file with header, written by one task without passing the driver, in ``order`` if given."""
    one = df.coalesce(1)
    one = one.sortWithinPartitions(*sort_keys(order)) if order else one
    one.write.mode("overwrite").option("header", True).csv(path)


def export_star(out_dir: str, features: DataFrame, seg_risk: DataFrame, curves: DataFrame,
                grades: DataFrame, seg_el: DataFrame, fact_partition_by: tuple = ("vintage_quarter",)) -> dict:
    """Fact table (partitioned by issue quarter so slicers prune files),
    four aggregate tables as Parquet, CSV copies of the two loss tables.  O2: the
    curves, grades and expected losses are written in their report order."""
    paths = {
        "fact_loans": os.path.join(out_dir, "fact_loans.parquet"),
        "segment_risk": os.path.join(out_dir, "segment_risk.parquet"),
        "vintage_curves": os.path.join(out_dir, "vintage_curves.parquet"),
        "grade_loss": os.path.join(out_dir, "grade_loss.parquet"),
        "segment_expected_loss": os.path.join(out_dir, "segment_expected_loss.parquet"),
        "grade_loss_csv": os.path.join(out_dir, "grade_loss.csv"),
        "segment_expected_loss_csv": os.path.join(out_dir, "segment_expected_loss.csv"),
    }
    write_parquet(fact_loans(features), paths["fact_loans"], fact_partition_by)
    write_parquet(seg_risk, paths["segment_risk"])
    for name, table in (("vintage_curves", curves), ("grade_loss", grades), ("segment_expected_loss", seg_el)):
        write_ordered(table, paths[name], REPORT_ORDER[name])
    write_small_csv(grades, paths["grade_loss_csv"], REPORT_ORDER["grade_loss"])
    write_small_csv(seg_el, paths["segment_expected_loss_csv"], REPORT_ORDER["segment_expected_loss"])
    return paths


def save_table(df: DataFrame, name: str, database: str | None = None, folder: str | None = None) -> str:
    """Create or replace the catalog table ``database.name`` from a query, all or nothing.

    Every version is written to a folder of its own first (under ``folder``, else the
    session's shared folder).  Only when that is done does one catalog statement point
    the table to it, so a failing or stopped write leaves the old version in place,
    and readers see one version or the other.  The old folder is then removed.  A new
    schema takes a new table under the name: the old one is renamed away, and back when that fails.
    """
    spark = df.sparkSession
    full = f"{database}.{name}" if database else name
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    path = os.path.join(folder or os.path.join(shared_dir(spark), "warehouse"), full, f"v-{uuid.uuid4().hex[:12]}")
    try:
        df.write.mode("error").parquet(path)
    except Exception:
        remove_folder(spark, path)
        raise
    if not spark.catalog.tableExists(full):
        spark.catalog.createTable(full, path=path, source="parquet")
        return full
    old = table_folder(spark, full)
    if spark.table(full).schema.simpleString() == spark.read.parquet(path).schema.simpleString():
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
    else:
        aside = f"{full}__{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {full} RENAME TO {aside}")
        try:
            spark.catalog.createTable(full, path=path, source="parquet")
        except Exception:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {full}")
            remove_folder(spark, path)
            raise
        spark.sql(f"DROP TABLE {aside}")
    spark.catalog.refreshTable(full)
    if old and os.path.basename(old).startswith("v-"):           # only folders written here
        remove_folder(spark, old)
    return full


def name_layer(spark, database: str, name: str, path: str) -> str:
    """The catalog name of a layer already written to ``path`` (nothing is copied)."""
    full = f"{database}.{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if spark.catalog.tableExists(full):
        spark.sql(f"DROP TABLE {full}")                          # the name only: the files belong to the layer
    spark.catalog.createTable(full, path=path, source="parquet")
    return full


def table_folder(spark, full: str) -> str | None:
    """Folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def write_scores(scores: DataFrame, path: str) -> None:
    """Scored test set as Parquet."""
    scores.write.mode("overwrite").parquet(path)


def read_scores(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_cutoff_csv(table: DataFrame, path: str) -> None:
    """The cutoff table (tens of rows) as one CSV file with header."""
    write_small_csv(table, path, ["pd_cutoff"])


def read_cutoff_csv(spark, path: str) -> DataFrame:
    schema = ("pd_cutoff double, approval_rate double, default_rate double, disbursed_share double, "
              "loss_per_100cr_inr double")
    return spark.read.option("header", True).schema(schema).csv(path)
