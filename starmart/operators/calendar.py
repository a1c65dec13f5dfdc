"""The date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.functions.audit import with_loaded_at
from starmart.params import UNKNOWN_DATE, MartParams


def dim_date(spark: SparkSession, params: MartParams) -> DataFrame:
    """One row per calendar day and one for dates outside the calendar; its size is set by ``params``."""
    calendar = f"sequence(DATE'{params.calendar_start}', DATE'{params.calendar_end}')"
    days = spark.range(0, 1, 1, 1).selectExpr(f"explode(concat({calendar}, array(DATE'{UNKNOWN_DATE}'))) AS date_key")
    as_of = f"DATE'{params.as_of}'" if params.as_of else "current_date()"
    table = days.selectExpr(
        "date_key",
        "date_format(date_key, 'yyyyMMdd') AS date_id",
        "bigint(day(date_key)) AS day_of_month",
        "bigint(dayofweek(date_key)) AS day_of_week",
        "date_format(date_key, 'EEEE') AS day_name",
        "date_format(date_key, 'EEE') AS day_name_short",
        "bigint(dayofyear(date_key)) AS day_of_year",
        "bigint(weekofyear(date_key)) AS week_of_year",
        "trunc(date_key, 'week') AS week_start_date",
        "date_add(trunc(date_key, 'week'), 6) AS week_end_date",
        # Calendar year with ISO week, as it is: the first days of January can read W53.
        "format_string('%d-W%02d', year(date_key), weekofyear(date_key)) AS year_week",
        "bigint(month(date_key)) AS month_number",
        "date_format(date_key, 'MMMM') AS month_name",
        "date_format(date_key, 'MMM') AS month_name_short",
        "trunc(date_key, 'month') AS month_start_date",
        "last_day(date_key) AS month_end_date",
        "date_format(date_key, 'yyyy-MM') AS year_month_key",
        "date_format(date_key, 'MMM yyyy') AS year_month",
        "bigint(quarter(date_key)) AS quarter_number",
        "format_string('Q%d', quarter(date_key)) AS quarter_name",
        "trunc(date_key, 'quarter') AS quarter_start_date",
        "last_day(add_months(trunc(date_key, 'quarter'), 2)) AS quarter_end_date",
        "format_string('%d Q%d', year(date_key), quarter(date_key)) AS year_quarter",
        "bigint(year(date_key)) AS year_value",
        "trunc(date_key, 'year') AS year_start_date",
        "make_date(year(date_key), 12, 31) AS year_end_date",
        "dayofweek(date_key) IN (1, 7) AS is_weekend",
        f"date_key = {as_of} AS is_today",
        f"date_key = date_sub({as_of}, 1) AS is_yesterday",
        "bigint(month(date_key)) AS month_sort",
        "bigint(quarter(date_key)) AS quarter_sort",
        "bigint(year(date_key) * 100 + month(date_key)) AS year_month_sort",
        "bigint(year(date_key) * 10 + quarter(date_key)) AS year_quarter_sort",
    )
    return with_loaded_at(table, params)


def resolved_date_sql(column: str, params: MartParams) -> str:
    """The calendar member of a date, as SQL: itself inside the calendar, else the unknown date.

    The calendar has no gaps, so a range test finds the same member as a join with it would.
    """
    inside = f"{column} BETWEEN DATE'{params.calendar_start}' AND DATE'{params.calendar_end}'"
    return f"CASE WHEN {inside} THEN {column} ELSE DATE'{UNKNOWN_DATE}' END"
