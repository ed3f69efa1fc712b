"""Scored streams joined with a stream of later confirmations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens.operators.labels import HORIZON, with_outcomes


def outcome_stream(
    scored: DataFrame, confirmations: DataFrame, horizon: str = HORIZON, delay: str = "10 minutes", label_delay: str = "10 minutes"
) -> DataFrame:
    """Scored transactions with their outcome, each once, in append mode.

    A confirmed or refuted transaction comes out as soon as both sides are
    there, an unconfirmed one when the watermark has passed its horizon; then it
    leaves the state. A confirmation waits in the state for as long as its
    transaction may still arrive. Repeated confirmations are let through once.
    """
    once = confirmations.withWatermark("confirmed_at", label_delay).dropDuplicatesWithinWatermark(["transaction_id"])
    return with_outcomes(scored.withWatermark("timestamp", delay), once, horizon)
