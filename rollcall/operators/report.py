"""The figures of given report documents as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.schemas import REPORT_FIGURE, UNREADABLE


def report_total(report: DataFrame) -> DataFrame:
    """Number of records a report covers, zero if it does not say."""
    return report.select(F.coalesce("total_records", F.lit(0)).alias("total_records"))


def report_cities(report: DataFrame) -> DataFrame:
    return report.select(F.inline("city_statistics"))


def report_age_groups(report: DataFrame) -> DataFrame:
    return report.select(F.inline("age_groups"))


def report_statuses(report: DataFrame) -> DataFrame:
    return report.select(F.explode("status_distribution").alias("status", "count"))


def report_domains(report: DataFrame) -> DataFrame:
    return report.select(F.explode("email_domains").alias("domain", "count"))


def report_figures(reports: DataFrame) -> DataFrame:
    """Every figure of many report documents, one row each, beside the document it comes from.

    Takes the rows of `read_reports` and unfolds all five parts in one pass, in the columns that a
    written report has.  A document that cannot be read gives one row of section `unreadable`; a
    part that a document lacks gives no rows.
    """

    def figure(section: str, key: Column, count: Column, **more: Column) -> Column:
        values = {"section": F.lit(section), "key": key, "count": count} | more
        columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REPORT_FIGURE]
        return F.struct(*columns)

    def of_map(section: str, column: str) -> Column:
        return F.transform(F.map_entries(column), lambda e: figure(section, e["key"], e["value"]))

    def of_city(row: Column) -> Column:
        return figure("city", row["city"], row["total_people"], **{c: row[c] for c in ("avg_age", "min_age", "max_age")})

    def of_group(row: Column) -> Column:
        return figure("age_group", row["age_group"], row["count"], percentage=row["percentage"])

    nothing = F.lit(None).cast("string")
    parts = [
        F.array(figure("total", nothing, F.coalesce("total_records", F.lit(0)))),
        F.transform("city_statistics", of_city),
        F.transform("age_groups", of_group),
        of_map("status", "status_distribution"),
        of_map("domain", "email_domains"),
    ]
    none = F.array(figure("total", nothing, nothing))
    whole = F.concat(*[F.coalesce(p, F.slice(none, 1, 0)) for p in parts])
    bad = F.array(figure("unreadable", nothing, nothing))
    unfolded = F.when(F.col(UNREADABLE).isNull(), whole).otherwise(bad)
    return reports.select("source", "generated_at", F.inline(unfolded))
