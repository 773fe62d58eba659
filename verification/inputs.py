"""Claims, dimensions, rejects and run logs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans import claims as c
from millrace.session import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def birth_date() -> Column:
    known = F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 400)
    return F.when(F.col("c_mktsegment") != "MACHINERY", known)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with the natural key of a patient."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            "c_acctbal",
            F.col("c_name").alias("FirstName"),
            F.col("n_name").alias("LastName"),
            birth_date().alias("BirthDate"),
            F.col("c_mktsegment").alias("Gender"),
        )
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier with the natural key of a provider."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "s_suppkey",
            "s_acctbal",
            F.col("s_name").alias("Name"),
            F.col("n_name").alias("Region"),
            F.col("r_name").alias("Specialty"),
        )
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients on file: the customers without debt, under the customer's own key."""
    return (
        customers(spark, sf_dir)
        .filter("c_acctbal >= 0")
        .select(F.col("c_custkey").alias("PatientID"), "FirstName", "LastName", "BirthDate", "Gender")
    )


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers on file, as a table: Spark takes a join for as large as the product of its sides."""
    rows = (
        suppliers(spark, sf_dir)
        .filter("s_acctbal >= 0")
        .select(F.col("s_suppkey").alias("ProviderID"), "Name", "Region", "Specialty")
    )
    return Scratch(spark).write(rows, codec=None)[0]


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim per order line, with natural keys only."""
    price = money(F.col("l_extendedprice")) - F.lit(2000).cast("decimal(18,2)")
    discount = 1 - F.col("l_discount").cast("decimal(5,2)")
    tax = 1 + F.col("l_tax").cast("decimal(5,2)")
    is_open = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    status = (
        F.when(F.col("o_orderstatus") == "O", "Submitted")
        .when(F.col("o_orderstatus") == "F", "paid")
        .when(F.col("o_orderpriority") == "5-LOW", "Complete")
        .otherwise("REJECTED")
    )
    nation = table(spark, sf_dir, "nation")
    patient_nation = nation.select(
        F.col("n_nationkey").alias("pn_key"), F.col("n_name").alias("PatientLastName")
    )
    provider_nation = nation.select(
        F.col("n_nationkey").alias("rn_key"), F.col("n_name").alias("ProviderRegion")
    )
    # What follows from a line alone is computed before it moves.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        price.cast("decimal(18,2)").alias("AmountBilled"),
        F.when(~is_open, (price * discount * tax).cast("decimal(18,2)")).alias("AmountPaid"),
        F.when(~is_open, F.to_date("l_shipdate")).alias("DatePaid"),
    )
    # Orders get their customers before they meet the lines, of which there are several for each:
    # the lines are shuffled once, and then without any text.
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(patient_nation, F.col("c_nationkey") == F.col("pn_key"))
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(provider_nation, F.col("s_nationkey") == F.col("rn_key"))
        .select(
            F.col("c_name").alias("PatientFirstName"),
            "PatientLastName",
            birth_date().alias("PatientBirthDate"),
            F.col("s_name").alias("ProviderName"),
            "ProviderRegion",
            "AmountBilled",
            "AmountPaid",
            status.alias("Status"),
            F.to_date("o_orderdate").alias("DateSubmitted"),
            "DatePaid",
        )
    )


def resolved_claims(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    return c.resolve_claims(
        claims(spark, sf_dir), patients(spark, sf_dir), providers(spark, sf_dir), how
    )


def evaluated_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.evaluate_claims(resolved_claims(spark, sf_dir))


def hour_number(at: Column) -> Column:
    """Hours since 1970; the events of an hour play the part of a run."""
    return F.floor(F.unix_timestamp(at) / 3600).cast("bigint")


def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a reject: its time, its type as the rule, its hour as the run."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("RejectID"),
        F.col("ts").alias("IngestedAt"),
        F.upper("event_type").alias("RuleCode"),
        hour_number(F.col("ts")).alias("RunID"),
    )


def event_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an entry of the run log of its hour."""
    kind = F.col("event_type")
    event = (
        F.when(kind.isin("signup", "view"), "START")
        .when(kind.isin("click", "purchase"), "COUNTS")
        .otherwise("FINISH")
    )
    counted = F.when(event == "COUNTS", F.col("user_id"))
    return table(spark, sf_dir, "events").select(
        hour_number(F.col("ts")).alias("RunID"),
        event.alias("Event"),
        F.col("event_id").alias("Sequence"),
        F.col("ts").alias("At"),
        F.when(event == "FINISH", F.when(F.col("value") > 20, "FAILED").otherwise("SUCCESS")).alias(
            "Status"
        ),
        *[
            (counted + i).alias(name)
            for i, name in enumerate(
                [
                    "StgProviderCount", "StgPatientCount", "StgClaimCount",
                    "ProviderCount", "PatientCount", "ClaimCount", "RejectTotal",
                ]
            )
        ],
    )


def portable(df: DataFrame) -> DataFrame:
    """Types that hash alike in every engine: decimals as doubles, dates and times as text."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind == "decimal":
            column = column.cast("double")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(f.name))
    return df.select(*columns)
