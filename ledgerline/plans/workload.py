"""The whole workload over a folder of student files: prepare, profile, join, aggregate, analyse, reconcile.

    python -m ledgerline.plans.workload <folder of CSV files> <output folder> [<folder of streamed totals>]

Every report is written as JSON or CSV below the output folder.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import messages
from ledgerline.operators import lookups, metrics, partitioning, prepare, profile, validate
from ledgerline.operators.joins import Hop, checked_join
from ledgerline.session import build_session
from ledgerline.sources import files
from ledgerline.sources.catalog import ENTITY, EVENT, LOOKUP, RAW, Catalog, Table

REGION, SCORE, CUSTOMER, ASSESSMENT, DAY = "region", "score", "id_student", "id_assessment", "date_submitted"

# The files and columns of the data set.
RAW_TABLES = [
    Table("student_info", RAW, "code_module string, code_presentation string, id_student bigint, gender string, "
          "region string, highest_education string, imd_band string, age_band string, num_of_prev_attempts int, "
          "studied_credits int, disability string, final_result string", "studentInfo.csv", "csv"),
    Table("student_registration", RAW, "code_module string, code_presentation string, id_student bigint, "
          "date_registration double, date_unregistration double", "studentRegistration.csv", "csv"),
    Table("raw_assessments", RAW, "code_module string, code_presentation string, id_assessment bigint, "
          "assessment_type string, date double, weight double", "assessments.csv", "csv"),
    Table("assessments", EVENT, "id_assessment bigint, id_student bigint, date_submitted bigint, is_banked int, "
          "score double", "studentAssessment.csv", "csv"),
]
PREPARED = [
    Table("customers", ENTITY, "id_student bigint, gender string, region string, highest_education string, "
          "imd_band string, disability string", "customers_dim"),
    Table("entitlements", ENTITY, "id_student bigint, date_registration double, date_unregistration double",
          "entitlements_dim"),
    Table("assessment_configs", LOOKUP, "id_assessment bigint, assessment_type string, date double, weight double",
          "assessment_defs"),
]
PERSONAL = ["gender", "region", "highest_education", "imd_band", "age_band", "disability"]


def prepare_tables(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Write the dimension tables, one row per key, and return the preparation report."""
    raw = Catalog(folder, RAW_TABLES)
    info, registration = raw.read(spark, "student_info"), raw.read(spark, "student_registration")
    order = ["code_presentation", "code_module"]
    prepared = Catalog(target, PREPARED)
    customers = prepare.first_per_key(info, CUSTOMER, order, [c for c in PERSONAL if c != "age_band"])
    spans = prepare.first_per_key(registration, CUSTOMER, order, ["date_registration", "date_unregistration"])
    defs = prepare.keep_columns(raw.read(spark, "raw_assessments"), ["id_assessment", "assessment_type", "date", "weight"])
    for name, rows in (("customers", customers), ("entitlements", spans), ("assessment_configs", defs)):
        files.write_parquet(rows, prepared.path_for(name))
    reports = [
        prepare.prep_report(info, CUSTOMER, PERSONAL).withColumn("table_name", F.lit("customers")),
        prepare.prep_report(registration, CUSTOMER, ["date_registration", "date_unregistration"]).withColumn(
            "table_name", F.lit("entitlements")),
    ]
    return profile.union(reports)


class Workload:
    """The prepared tables and the results over them."""

    def __init__(self, spark: SparkSession, folder: str, target: str):
        raw, prepared = Catalog(folder, RAW_TABLES), Catalog(target, PREPARED)
        self.spark = spark
        self.events = raw.read(spark, "assessments")
        self.customers = prepared.read(spark, "customers")
        self.entitlements = prepared.read(spark, "entitlements")
        self.configs = prepared.read(spark, "assessment_configs")
        self.to_customer = Hop(self.customers, CUSTOMER, CUSTOMER, "customers")
        self.to_entitlement = Hop(self.entitlements, CUSTOMER, CUSTOMER, "entitlements")
        self.to_config = Hop(self.configs, ASSESSMENT, ASSESSMENT, "assessment_configs")
        self.hops = [self.to_customer, self.to_config, self.to_entitlement]
        self.tables = {"assessments": (self.events, EVENT), "customers": (self.customers, ENTITY),
                       "entitlements": (self.entitlements, ENTITY), "assessment_configs": (self.configs, LOOKUP)}
        self.columns = {name: rows.columns for name, (rows, _) in self.tables.items()}

    def column_profile(self) -> DataFrame:
        return profile.column_profile({name: rows for name, (rows, _) in self.tables.items()})

    def conditions(self) -> DataFrame:
        relations = {
            "assessments.id_student -> customers": (self.events, self.to_customer),
            "assessments.id_assessment -> assessment_configs": (self.events, self.to_config),
            "entitlements.id_student -> customers": (self.entitlements, self.to_customer),
        }
        return profile.conditions(self.tables, relations, self.events, CUSTOMER, DAY)

    def working_set(self) -> DataFrame:
        """The joined rows; raises if a parent key repeats."""
        return checked_join(self.events, self.hops)

    def join_report(self) -> DataFrame:
        return validate.join_report(self.events, self.hops)

    def candidates(self) -> DataFrame:
        counted = profile.joined_value_counts(self.events, self.hops)
        return partitioning.score_candidates(counted, self.columns, [ASSESSMENT, CUSTOMER, SCORE])

    def region_counts(self) -> DataFrame:
        counted = metrics.roll_up(self.events, [self.to_customer], [REGION], {"n": F.count(F.lit(1))})
        return counted.withColumnRenamed(REGION, "value").filter("value IS NOT NULL")

    def workload(self, definition: str = metrics.NON_NULL, partitions: int | None = None) -> DataFrame:
        return metrics.group_metric(self.events, REGION, SCORE, definition, [self.to_customer], partitions=partitions)

    def composed(self) -> DataFrame:
        return metrics.service_names(self.workload(metrics.ALL_ROWS))

    def mechanisms(self) -> DataFrame:
        return metrics.mechanism_breakdown(self.events, [self.to_entitlement], SCORE, DAY, "date_unregistration")

    def transactions(self, **options) -> DataFrame:
        return lookups.transactions(self.events, self.to_customer, self.to_config, [DAY, CUSTOMER, ASSESSMENT, SCORE],
                                    **options)

    def transaction_messages(self) -> DataFrame:
        joined = checked_join(self.events, [self.to_customer], validate=False)
        rows = checked_join(joined, [self.to_config], how="left", validate=False)
        source = {f.name: F.col(DAY if f.name == "timestamp" else f.name) for f in messages.fields_of("Transaction")}
        return lookups.message_rows(rows, {
            f.name: (source[f.name], f.spark_type) for f in messages.fields_of("Transaction")})

    def reconciliation(self, streamed: str, format: str = "csv") -> DataFrame:
        """Composed totals against the batch result and against stored totals of a stream, if there are any."""
        return validate.reconcile(self.workload(metrics.ALL_ROWS), {
            "batch": self.workload(), "stream": files.load_result(self.spark, streamed, REGION, format)}, REGION)


def run(spark: SparkSession, folder: str, target: str, streamed: str = "") -> None:
    """Run everything and write the results below `target`."""
    files.write_json(prepare_tables(spark, folder, target), f"{target}/results/prep_report")
    work = Workload(spark, folder, target)
    validate.require_lossless(work.events, work.hops)
    files.write_parquet(work.working_set(), f"{target}/results/working_dataset")
    reports = {
        "column_profile": work.column_profile(),
        "eligibility": work.conditions(),
        "join_report": work.join_report(),
        "candidate_keys": work.candidates(),
        "key_distribution": partitioning.key_distribution(work.region_counts()),
        "partition_balance": partitioning.partition_balance(partitioning.predicted_partitions(work.region_counts())),
        "validation": validate.compare_results(work.workload(partitions=4), work.workload(), REGION),
        "mechanism_breakdown": work.mechanisms(),
        "payload_sizes": messages.payload_sizes(work.transaction_messages(), "Transaction"),
        "reconciliation": work.reconciliation(streamed or f"{target}/results/streamed_regional_revenue"),
    }
    for name, report in reports.items():
        files.write_json(report, f"{target}/results/{name}")
    files.write_csv(work.workload(), f"{target}/results/regional_workload", [REGION])
    files.write_csv(work.composed(), f"{target}/results/service_regional_revenue", [REGION],
                    {"revenue_total": 2, "revenue_mean": 4})
    files.write_csv(partitioning.size_table(work.region_counts(), REGION), f"{target}/results/partition_sizes",
                    ["level", "setting", "identifier"])


if __name__ == "__main__":
    run(build_session("student workload"), *sys.argv[1:])
