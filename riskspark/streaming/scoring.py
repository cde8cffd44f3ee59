"""Scoring and validation of records as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.models.scoring import LogisticFormula, score_batch
from riskspark.operators.contract import (
    Contract,
    ContractViolation,
    check_counts,
    require_valid,
    typed,
    validation_errors,
    validation_report,
    violation_list,
)
from riskspark.sources.sinks import quarantine_batch, write_scored


def correlation_id(key: str, *more: str) -> Column:
    """Stable request identity, equal on every retry of the same record."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in (key, *more)]), 256)


def score_stream(
    stream: DataFrame,
    scorer: LogisticFormula | Column,
    key: str,
    threshold: float = 0.5,
    model_version: str = "1.0.0",
    batch_id: str = "stream",
) -> DataFrame:
    """Stateless scoring; the scoring time is that of the micro-batch."""
    scored = score_batch(stream, scorer, key, threshold, model_version, batch_id)
    return scored.withColumn("scoring_timestamp", F.current_timestamp()).withColumn(
        "correlation_id", correlation_id(key, "model_version")
    )


def judge_stream(
    stream: DataFrame, contract: Contract, training: bool = False
) -> DataFrame:
    """Rows with their violations and a verdict column to partition the sink by.

    One query then feeds accepted and rejected rows to two folders of one sink.
    """
    found = violation_list(stream, contract, training)
    return stream.withColumn("violations", found).withColumn(
        "verdict", F.when(F.size("violations") == 0, "accepted").otherwise("rejected")
    )


def gate_and_score(
    contract: Contract,
    scorer: LogisticFormula | Column,
    output: str,
    quarantine: str,
    threshold: float = 0.5,
    model_version: str = "1.0.0",
    prefix: str = "epoch",
) -> Callable[[DataFrame, int], None]:
    """Handler that scores a micro-batch whole or quarantines it whole.

    The batch id follows from the micro-batch number, so a repeated micro-batch
    replaces its own output.
    """
    def handle(batch: DataFrame, number: int) -> None:
        batch_id = f"{prefix}-{number}"
        counts = check_counts(batch, contract, training=False)
        errors = validation_errors(batch, contract, False, counts)
        report = validation_report(batch, contract, False, errors, counts)
        try:
            require_valid(report)
        except ContractViolation:
            quarantine_batch(report, errors, batch, quarantine, batch_id)
            return
        rows = typed(batch, contract, training=False)
        write_scored(
            score_batch(rows, scorer, contract.primary_key, threshold, model_version, batch_id), output
        )

    return handle
