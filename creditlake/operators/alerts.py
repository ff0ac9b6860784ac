"""Transaction alerts as a batch query.

Every alert a customer already has raises the score of the customer's next
transactions by five points, up to twenty. Scoring is therefore sequential per
customer, but the bonus has only five values, so the sequence is given by at
most four turning points: the first transaction that alerts unaided, the first
after it that alerts with one earlier alert, and so on. A transaction's bonus is
the number of turning points before it. Each turning point is one minimum.

Each minimum is a grouped aggregate with partial sums, joined back, so that no
customer's transactions are gathered in one task, and all sizes take one way.

An event id that comes again alerts at its first occurrence that reaches the
threshold; later occurrences neither alert nor count. An event belongs to one
customer: under several, each counts it, and the earliest alert is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    MAX_ALERT_POINTS,
    MAX_SCORE,
    POINTS_PER_ALERT,
    alert_rule,
    now,
    parse_decimal,
    unaided_score,
)
from .keys import first_per_key
from .skew import lookup_join, stage

MAX_STATE = MAX_ALERT_POINTS // POINTS_PER_ALERT
THRESHOLD = 75
ALERT_COLUMNS = (
    "alert_id",
    "transaction_id",
    "customer_id",
    "alert_time",
    "rule_name",
    "risk_score",
    "alert_status",
)

_MOMENT = ("event_time", "event_id", "transaction_id", "_base", "rule_name")


def alert_id(event_id: Column | str) -> Column:
    return F.concat(F.lit("STREAM-"), F.col(event_id) if isinstance(event_id, str) else event_id)


def scored_events(events: DataFrame, threshold: int, *keep: Column | str) -> DataFrame:
    """Events with their unaided score, the earlier alerts they need, and whether they could alert at all."""
    amount = parse_decimal("amount")
    base = unaided_score(amount, "transaction_type")
    need = F.greatest(F.lit(0), F.ceil((F.lit(threshold) - base) / POINTS_PER_ALERT)).cast("int")
    return events.select(
        "event_id",
        "event_time",
        "transaction_id",
        F.coalesce("customer_id", F.lit("")).alias("customer_id"),
        alert_rule(amount, "transaction_type").alias("rule_name"),
        base.alias("_base"),
        need.alias("_need"),
        (F.lit(threshold <= MAX_SCORE) & (need <= MAX_STATE)).alias("possible"),
        *keep,
    )


def candidates(events: DataFrame, threshold: int) -> DataFrame:
    """Transactions that could alert at all, with the earlier alerts they need."""
    return scored_events(events, threshold).filter("possible").drop("possible")


def _with_turning_points(rows: DataFrame) -> DataFrame:
    """Add ``_turn1`` to ``_turn4``, the alerts at which the customer's state grows.

    ``rows`` is read five times, so it is staged. Every alert of a new event up to
    the fourth is a turning point, so an event that alerted before is one of them.
    """
    moment = F.struct(*_MOMENT)
    marked = rows
    for k in range(MAX_STATE):
        earlier = [f"_turn{i}" for i in range(1, k + 1)]
        grows = F.col("_need") <= F.least(F.col("_prior") + k, F.lit(MAX_STATE))
        if k:
            grows &= moment > F.col(f"_turn{k}")
        for turn in earlier:
            grows &= F.col("event_id") != F.col(f"{turn}.event_id")
        turns = marked.groupBy("customer_id").agg(
            *[F.first(c).alias(c) for c in earlier], F.min(F.when(grows, moment)).alias(f"_turn{k + 1}")
        )
        marked = lookup_join(rows, turns, "customer_id")
    return marked


def score_alerts(
    events: DataFrame,
    threshold: int = THRESHOLD,
    known: DataFrame | None = None,
    prior: DataFrame | None = None,
) -> DataFrame:
    """Alerts raised by ``events``, in the order of (event_time, event_id).

    ``known`` holds the ``alert_id`` of alerts raised before: those events are
    skipped and do not count. ``prior`` holds ``customer_id`` and ``alerts``, the
    number of alerts each customer starts with (none without it). A repeated
    event id alerts once, at its first occurrence that reaches the threshold.
    """
    rows = candidates(events, threshold)
    if known is not None:
        rows = rows.withColumn("alert_id", alert_id("event_id")).join(
            known.select("alert_id"), "alert_id", "left_anti"
        ).drop("alert_id")
    if prior is not None:
        start = prior.select("customer_id", F.least("alerts", F.lit(MAX_STATE)).cast("int").alias("_prior"))
        rows = lookup_join(rows, start, "customer_id").withColumn("_prior", F.coalesce("_prior", F.lit(0)))
    else:
        rows = rows.withColumn("_prior", F.lit(0))

    marked = _with_turning_points(stage(rows))
    moment = F.struct(*_MOMENT)
    passed = [F.when(F.col(f"_turn{k}") < moment, 1).otherwise(0) for k in range(1, MAX_STATE + 1)]
    state = F.least(sum(passed, F.col("_prior")), F.lit(MAX_STATE))
    raised = marked.withColumn("_state", state).filter(F.col("_need") <= F.col("_state"))
    return (
        first_per_key(raised, "event_id", *_MOMENT, "customer_id")
        .select(
            alert_id("event_id").alias("alert_id"),
            "transaction_id",
            "customer_id",
            now().alias("alert_time"),
            "rule_name",
            F.least(F.col("_base") + F.col("_state") * POINTS_PER_ALERT, F.lit(MAX_SCORE))
            .cast("int")
            .alias("risk_score"),
            F.lit("OPEN").alias("alert_status"),
        )
    )
