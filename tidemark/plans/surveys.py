"""Survey queries and table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clean, profile, survey
from tidemark.plans import bases
from tidemark.plans.bases import Query, flat, registrar, sales
from tidemark.session import measured

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)


def _all_rows(spark, folder):
    return survey.with_totals(bases.survey(spark, folder))


def _latest(spark, folder):
    return survey.latest_year(bases.survey(spark, folder))


def _latest_totals(spark, folder):
    return survey.latest_year(survey.only_totals(_all_rows(spark, folder)))


@query
def op_group_mean_round(spark, folder):
    return survey.group_mean_round(bases.survey(spark, folder), ["year", "level"], "rate")


@query
def op_totals_rows(spark, folder):
    return _all_rows(spark, folder)


@query
def op_pivot_year(spark, folder):
    return survey.pivot_years(measured(survey.only_totals(_all_rows(spark, folder)), "totals"))


@query
def op_pivot_gender(spark, folder):
    return survey.pivot_gap(_latest(spark, folder), "gender", ("Male", "Female"))


@query
def op_pivot_region(spark, folder):
    return survey.pivot_gap(_latest(spark, folder), "region", ("Rural", "Urban"))


@query
def op_cell_ratio(spark, folder):
    return survey.cell_ratio(_latest_totals(spark, folder), "1-URGENT", "5-LOW")


@query
def op_latest_extremes(spark, folder):
    return survey.extremes(_latest_totals(spark, folder))


@query
def op_trend_by_level(spark, folder):
    return survey.trend_by_level(_all_rows(spark, folder))


@query
def op_yoy_change(spark, folder):
    """Change per level, and the years in which the gender gap changed sign."""
    changes = survey.yearly_change(survey.trend_by_level(_all_rows(spark, folder)), "level")
    flips = survey.gap_reversals(bases.survey(spark, folder)).select("year", "gap", "reversed")
    return changes.join(flips, "year")


@query
def op_complement_pct(spark, folder):
    return survey.complement_pct(bases.survey(spark, folder), "rate", "rest")


@query
def op_sort_category(spark, folder):
    return survey.sort_category(_latest_totals(spark, folder), "level", survey.LEVEL_ORDER).select(
        "level", "rate", "category_rank"
    )


# --- profiles ---------------------------------------------------------------------


@query
def op_drop_columns(spark, folder):
    return bases.records(spark, folder).drop("toxic", "zeros", "marks")


@query
def op_zero_as_missing(spark, folder):
    columns = ["length", "spaces", "periods", "marks", "zeros"]
    return clean.zero_as_missing(bases.records(spark, folder), columns)


@query
def op_describe(spark, folder):
    return profile.describe(sales(spark, folder), ["ram_gb", "rom_gb", "price", "quantity_sold", "revenue", "dispatch_delay_days"])


@query
def op_null_counts(spark, folder):
    return profile.null_counts(flat(spark, folder))


@query
def op_stage_audit(spark, folder):
    """Rows left after each cleaning step, counted while the cleaning runs."""
    audit = profile.Audit()
    raw = audit.step("raw", flat(spark, folder))
    lines = measured(audit.step("deduplicated", clean.repair_text(clean.dedupe_sales(raw))), "audit_lines")
    edges = measured(clean.trim_edges(clean.usable_lines(lines), "price"), "edges")
    known = audit.step("critical columns known", clean.drop_null_critical(lines))
    positive = audit.step("positive price", clean.keep_positive(known, "price"))
    trimmed = audit.step("price trimmed", clean.between_edges(positive, "price", edges))
    return audit.table(trimmed)


@query
def op_shape_range(spark, folder):
    return profile.shape_range(sales(spark, folder))
