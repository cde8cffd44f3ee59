"""Imports every query module so that its queries are registered."""

from catalog import (  # noqa: F401
    contract_checks,
    drift_checks,
    evaluation,
    feedback_checks,
    model_checks,
    operations,
    profiles,
    sql_texts,
    streams,
)
