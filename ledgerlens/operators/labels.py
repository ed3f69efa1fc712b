"""Labels that arrive after the score: chargebacks and all-clears.

A confirmation names a transaction and says, some time later, whether it was a
fraud. Scored transactions are joined with the confirmations that come within a
horizon; what nobody confirms by then stays unconfirmed and counts neither for
nor against the detector.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.features import add
from ledgerlens.functions.rules import confusion_flags

HORIZON = "7 days"
CONFIRMED, REFUTED, UNCONFIRMED = "confirmed", "refuted", "unconfirmed"


def first_confirmations(confirmations: DataFrame) -> DataFrame:
    """The earliest confirmation of each transaction; at the same time, fraud counts."""
    first = F.min(F.struct("confirmed_at", (-F.col("label")).alias("against"))).alias("first")
    firsts = confirmations.filter(F.col("transaction_id").isNotNull()).groupBy("transaction_id").agg(first)
    return firsts.select("transaction_id", (-F.col("first.against")).alias("label"), F.col("first.confirmed_at").alias("confirmed_at"))


def outcome(label: Column) -> Column:
    return F.when(label == 1, CONFIRMED).when(label == 0, REFUTED).otherwise(UNCONFIRMED)


def with_outcomes(scored: DataFrame, confirmations: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """Scored transactions with outcome, confirmed_label, confirmed_at and the cells of the confusion matrix.

    Serves batch and streams: on a stream both sides need a watermark
    (``streaming.labels``), and the range of times lets either side's state go.
    """
    said = confirmations.select(F.col("transaction_id").alias("said_of"), F.col("label").alias("confirmed_label"), "confirmed_at")
    latest = F.col("timestamp") + F.expr(f"INTERVAL {horizon}")
    same = (F.col("said_of") == F.col("transaction_id")) & (F.col("confirmed_at") >= F.col("timestamp")) & (F.col("confirmed_at") <= latest)
    joined = scored.join(said, same, "left").drop("said_of", "is_fraud")
    told = confusion_flags(add(joined, {"is_fraud": F.col("confirmed_label"), "outcome": outcome(F.col("confirmed_label"))}))
    return told.drop("is_fraud")


def confirmed_outcomes(scored: DataFrame, confirmations: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """The batch form: the first confirmation of each transaction decides."""
    return with_outcomes(scored, first_confirmations(confirmations), horizon)


def outcome_report(told: DataFrame) -> DataFrame:
    """Transactions, amount and mean delay in hours by prediction and outcome."""
    delay = (F.unix_timestamp("confirmed_at") - F.unix_timestamp("timestamp")) / 3600.0
    return told.groupBy("predicted_fraud", "outcome").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("total_amount"), F.avg(delay).alias("avg_delay_hours")
    )
