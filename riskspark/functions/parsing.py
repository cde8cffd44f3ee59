"""Text to value rules: charges, targets, outcomes, treatment arms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number text, outcome words and treatment-arm words.
NUMERAL_PATTERN = r"^[+-]?((\d+(_\d+)*(\.(\d+(_\d+)*)?)?)|(\.\d+(_\d+)*))([eE][+-]?\d+)?$"
POSITIVE_OUTCOME_WORDS = ("yes", "1", "true", "churn")
TREATMENT_WORDS = ("treatment", "treated", "1", "true", "targeted")
CONTROL_WORDS = ("control", "holdout", "0", "false", "untargeted")
OUTCOME_COLUMNS = ("observed_churn", "Churn", "churn", "target")
# Every character that counts as white space, not only the blank.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(text: Column) -> Column:
    """Text without white space at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def is_numeral(text: Column) -> Column:
    """True for decimal number text; type suffixes such as ``1.0d`` are not numbers."""
    return stripped(text).rlike(NUMERAL_PATTERN)


def to_number(text: Column) -> Column:
    """Number text to double; anything else becomes null without failing the job."""
    trimmed = stripped(text.cast("string"))
    return F.when(
        trimmed.rlike(NUMERAL_PATTERN),
        F.regexp_replace(trimmed, "_", "").try_cast("double"),
    )


def charge_value(text: Column) -> Column:
    """Charge text to double: null and blank stay null, other text becomes null too."""
    return to_number(text)


def charge_is_bad(text: Column) -> Column:
    """True where charge text is neither blank nor a number (an error, not a missing value)."""
    trimmed = stripped(text.cast("string"))
    return F.coalesce((trimmed != "") & ~trimmed.rlike(NUMERAL_PATTERN), F.lit(False))


def binary_target(column: Column, positive: str = "Yes") -> Column:
    """1 where the target equals the positive value, else 0 (null counts as 0)."""
    return F.coalesce((column == F.lit(positive)).cast("int"), F.lit(0))


def binary_outcome(column: Column, data_type: str) -> Column:
    """Observed outcome to 0/1: words for text columns, truncation for numbers."""
    if data_type == "string":
        return F.coalesce(
            F.lower(stripped(column)).isin(*POSITIVE_OUTCOME_WORDS).cast("int"), F.lit(0)
        )
    return column.cast("int")


def outcome_column(columns: Sequence[str]) -> str:
    """First known outcome column present, or an error naming the candidates."""
    for candidate in OUTCOME_COLUMNS:
        if candidate in columns:
            return candidate
    raise ValueError(f"no outcome column found; expected one of {list(OUTCOME_COLUMNS)}")


def treatment_arm(column: Column) -> Column:
    """'treatment', 'control', or null for any other text."""
    word = F.lower(stripped(column.cast("string")))
    return F.when(word.isin(*TREATMENT_WORDS), F.lit("treatment")).when(
        word.isin(*CONTROL_WORDS), F.lit("control")
    )
