"""Shared inputs of the plans, staged as Parquet, and the output convention."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rules import risk_tier
from tidemark.operators import clean, panel, rfm, star
from tidemark.session import is_staged, one_query, staged, tune
from tidemark.sources import tables


def publish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain result types: fractions rounded, decimals as doubles, dates as text."""

    def plain(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), digits)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        return column.alias(field.name)

    return df.select(*[plain(field) for field in df.schema])


Query = Callable[[SparkSession, str], DataFrame]


def registrar(queries: dict[str, Query]) -> Callable[[Query], Query]:
    """A decorator that registers a query by name, with the output convention applied."""

    def query(make: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            with one_query():
                return publish(make(tune(spark), folder))

        queries[make.__name__] = run
        return make

    return query


def flat(spark: SparkSession, folder: str) -> DataFrame:
    return tables.sales_flat(tune(spark), folder)


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return staged(tune(spark), folder, "sales_clean", lambda: clean.clean_sales(flat(spark, folder), tables.order_of_line()))


def segments(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        return rfm.with_segment(rfm.rfm_scores(rfm.rfm_base(sales(spark, folder), unique_orders=True)))

    return staged(tune(spark), folder, "rfm_segments", build)


def customer_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the customers; their names are taken from the segments, one row each, once those are there."""
    named = segments if is_staged(spark, folder, "rfm_segments") else sales
    return staged(spark, folder, "customer_keys", lambda: star.customer_keys(named(spark, folder)))


def customer_star(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Fact and dimension for reports by customer, with only the columns these read.

    Once the whole tables are there they are read instead.
    """
    built = star_tables(spark, folder)
    scored = segments(spark, folder)
    keys = customer_keys(spark, folder)
    fact = built["fact_sales"] if is_staged(spark, folder, "fact_sales") else star.customer_sales(sales(spark, folder), keys)
    customers = built["dim_customer"] if is_staged(spark, folder, "dim_customer") else star.customer_segments(keys, scored)
    return fact, customers


class StarTables(Mapping):
    """The star's tables by name; each is built when it is first asked for, so a
    report waits only for the tables it reads."""

    NAMES = ("dim_region", "dim_customer", "dim_product", "dim_date", "fact_sales")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def __getitem__(self, name: str) -> DataFrame:
        spark, folder = self.spark, self.folder
        lines = sales(spark, folder)
        builders = {
            "dim_region": lambda: star.dim_region(lines),
            "dim_customer": lambda: star.dim_customer(
                lines, segments(spark, folder), customer_keys(spark, folder)
            ),
            "dim_product": lambda: star.dim_product(lines),
            "dim_date": lambda: star.dim_date(lines),
            "fact_sales": lambda: star.fact_sales(
                lines, customer_keys(spark, folder), self["dim_product"], self["dim_region"]
            ),
        }
        return staged(spark, folder, name, builders[name])


def star_tables(spark: SparkSession, folder: str) -> StarTables:
    return StarTables(tune(spark), folder)


def entity_panel(spark: SparkSession, folder: str) -> DataFrame:
    return staged(tune(spark), folder, "panel", lambda: tables.panel(spark, folder))


def entities(spark: SparkSession, folder: str) -> DataFrame:
    return staged(tune(spark), folder, "master", lambda: tables.master(entity_panel(spark, folder)))


def features(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        rows = panel.panel_features(entity_panel(spark, folder), position="month_index")
        return panel.attach_static(rows, entities(spark, folder))

    return staged(tune(spark), folder, "features", build)


def rule_score() -> Column:
    """A fixed rule-of-thumb score in [0, 1]; reports can be checked with it
    without fitting a model."""
    run = F.least(F.col("consecutive_low_runway_months"), F.lit(10))
    return (F.col("composite_risk_index") + run) / 110.0


def rule_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows with the rule score and its tier."""
    return (
        features(spark, folder)
        .withColumn("risk_score", rule_score())
        .withColumn("risk_tier", risk_tier(F.col("risk_score")))
    )


def risk_fact(spark: SparkSession, folder: str) -> DataFrame:
    return star.scored_fact(rule_scored(spark, folder))


def companies(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_company(entities(spark, folder))


def survey(spark: SparkSession, folder: str) -> DataFrame:
    return staged(tune(spark), folder, "survey", lambda: tables.survey_long(spark, folder))


def records(spark: SparkSession, folder: str) -> DataFrame:
    return staged(tune(spark), folder, "records", lambda: tables.records(spark, folder))
