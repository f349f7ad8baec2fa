"""All registered queries and their SQL."""

from __future__ import annotations

from gristmill.plans import (
    document_store,
    message_models,
    model_checks,
    quality_checks,
    report_facts,
    round_trips,
    sales_reports,
    segment_models,
    series_reports,
    text_jobs,
    trend_reports,
)
from gristmill.plans.registry import Query

REGISTERS = [
    module.query
    for module in (
        sales_reports,
        quality_checks,
        series_reports,
        trend_reports,
        text_jobs,
        document_store,
        segment_models,
        message_models,
        model_checks,
        round_trips,
        report_facts,
    )
]


def queries() -> dict[str, Query]:
    return {name: function for register in REGISTERS for name, function in register.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for register in REGISTERS for name, sql in register.sql.items()}
