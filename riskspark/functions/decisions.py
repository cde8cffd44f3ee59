"""Decision and batch-stamp columns."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def check_threshold(threshold: float) -> float:
    """A decision threshold must lie in [0, 1]."""
    if not 0.0 <= float(threshold) <= 1.0:
        raise ValueError(f"decision threshold must lie in [0, 1], got {threshold}")
    return float(threshold)


def decide(probability: Column, threshold: float) -> Column:
    """1 where the unrounded probability reaches the threshold, else 0."""
    return (probability >= F.lit(check_threshold(threshold))).cast("int")


def new_batch_id(prefix: str = "batch") -> str:
    """``<prefix>_<UTC date>_<UTC time>_<6 hex digits>``."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"{prefix}_{stamp}_{uuid.uuid4().hex[:6]}"


def batch_stamp(
    threshold: float, model_version: str, batch_id: str, scored_at: datetime | None = None
) -> list[Column]:
    """Constant columns every row of one scored batch carries; the time is taken once."""
    moment = scored_at or datetime.now(timezone.utc)
    return [
        F.lit(check_threshold(threshold)).alias("decision_threshold"),
        F.lit(model_version).alias("model_version"),
        F.lit(moment.isoformat()).cast("timestamp").alias("scoring_timestamp"),
        F.lit(batch_id).alias("batch_id"),
    ]
