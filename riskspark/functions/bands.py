"""Analytical bands and small recodes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tenure_band(tenure: Column) -> Column:
    """Months of tenure in four bands; a null falls into the open last band."""
    return (
        F.when(tenure <= 12, F.lit("0-12 months"))
        .when(tenure <= 24, F.lit("13-24 months"))
        .when(tenure <= 48, F.lit("25-48 months"))
        .otherwise(F.lit("49+ months"))
    )


def charge_band(charges: Column) -> Column:
    """Monthly charges in three bands; a null falls into the open last band."""
    return (
        F.when(charges < 35.0, F.lit("< $35"))
        .when(charges <= 70.0, F.lit("$35 - $70"))
        .otherwise(F.lit("> $70"))
    )


def charge_discrepancy(tenure: Column, monthly: Column, total: Column) -> Column:
    """Absolute gap between the billed total and tenure times the monthly charge."""
    return F.abs(total - tenure * monthly)


def flag_label(flag: Column, zero: str, one: str) -> Column:
    """0/1 flag to its chart label; other values keep their own text."""
    return F.when(flag == 0, F.lit(zero)).when(flag == 1, F.lit(one)).otherwise(flag.cast("string"))
