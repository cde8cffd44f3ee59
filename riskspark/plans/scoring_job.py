"""Batch scoring from a source to a sink, behind the whole-batch gate."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession

from riskspark.functions.decisions import new_batch_id
from riskspark.models.scoring import LogisticFormula, load_version, score_batch
from riskspark.operators.contract import (
    CUSTOMER_CONTRACT,
    Contract,
    ContractViolation,
    require_valid,
    typed,
    validation_errors,
    validation_report,
    written_counts,
)
from riskspark.session import written
from riskspark.sources.sinks import quarantine_batch, read_scored, write_scored
from riskspark.sources.tables import load_scoring_batch


@dataclass(frozen=True)
class ScoringJob:
    """Where a job writes and how it decides."""

    output: str
    quarantine: str
    contract: Contract = CUSTOMER_CONTRACT
    threshold: float = 0.5
    model_version: str = "1.0.0"
    batch_prefix: str = "batch"


def run_batch_scoring(
    spark: SparkSession,
    source: str | DataFrame,
    scorer: PipelineModel | LogisticFormula | Column,
    job: ScoringJob,
    batch_id: str | None = None,
    fmt: str = "csv",
    scored_at: datetime | None = None,
) -> DataFrame:
    """Validate, gate, score, write; returns the written batch as read back.

    A batch with any error writes nothing but its quarantine folder and raises.
    Three passes read the input: row checks, duplicate keys, and the write.
    """
    batch_id = batch_id or new_batch_id(job.batch_prefix)
    raw = load_scoring_batch(spark, source, job.contract, fmt)
    counts = written_counts(raw, job.contract, training=False)
    errors = written(validation_errors(raw, job.contract, False, counts), "validation-errors")
    report = validation_report(raw, job.contract, False, errors, counts)
    try:
        require_valid(report, errors)
    except ContractViolation as failure:
        folder = quarantine_batch(report, errors, raw, job.quarantine, batch_id)
        raise ContractViolation(f"batch '{batch_id}' quarantined under {folder}", failure.report) from failure
    scored = score_batch(
        typed(raw, job.contract, training=False),
        scorer,
        job.contract.primary_key,
        job.threshold,
        job.model_version,
        batch_id,
        scored_at,
    )
    write_scored(scored, job.output)
    return read_scored(spark, job.output, batch_id)


def score_with_version(
    spark: SparkSession,
    rows: DataFrame,
    root: str,
    version: int | str | None = None,
    key: str = "customerID",
    threshold: float = 0.5,
) -> DataFrame:
    """Score with a stored model version, the latest unless one is named."""
    model = load_version(spark, root, version)
    return score_batch(rows, model, key, threshold, str(version or "latest"), "registered")
