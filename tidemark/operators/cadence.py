"""Delivery cadence: gaps between messages, their summary, and the verdict.

Works on captured messages: ``topic, arrival_seq, arrival_ns, seq, sent_mono_ns``.
Arrival order decides everywhere. Deltas are whole nanoseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .distribution import distribution
from .ordered import previous_values

# Expected interval, tolerance, share required to pass, sample length.
EXPECTED_S = 0.1
TOLERANCE_S = 0.02
REQUIRED_SHARE = 0.95
SAMPLE_SECONDS = 70
ORDER = ["arrival_seq"]
SENDER, ARRIVAL, TOPIC = "sender", "arrival", "topic"
QUANTILES = {"p50": 0.50, "p90": 0.90, "p95": 0.95, "p99": 0.99}


def sample_window(captured: DataFrame, seconds: float = SAMPLE_SECONDS) -> DataFrame:
    """The first ``seconds`` of the capture."""
    begin = captured.agg(F.min("arrival_ns")).scalar()
    return captured.filter(F.col("arrival_ns") < begin + F.lit(int(seconds * 1_000_000_000)))


def _deltas(captured: DataFrame, column: str, by=()) -> DataFrame:
    with_previous = previous_values(captured, ORDER, {"_previous": column}, by)
    return with_previous.filter(F.col("_previous").isNotNull()).select(
        "arrival_seq", "topic", (F.col(column) - F.col("_previous")).alias("delta_ns")
    )


def global_deltas(captured: DataFrame) -> DataFrame:
    return _deltas(captured.select("topic", "arrival_seq", "arrival_ns"), "arrival_ns")


def sender_deltas(captured: DataFrame) -> DataFrame:
    """Differences of the sender's clock between messages that carry it; may be negative."""
    stamped = captured.select("topic", "arrival_seq", "sent_mono_ns")
    return _deltas(stamped.filter(F.col("sent_mono_ns").isNotNull()), "sent_mono_ns")


def topic_deltas(captured: DataFrame) -> DataFrame:
    return _deltas(captured.select("topic", "arrival_seq", "arrival_ns"), "arrival_ns", ["topic"])


def sequence_gaps(captured: DataFrame) -> DataFrame:
    """Messages whose sequence number does not follow the one before: gaps, repeats, restarts."""
    numbered = captured.select("arrival_seq", "seq").filter(F.col("seq").isNotNull())
    pairs = previous_values(numbered, ORDER, {"previous_seq": "seq"})
    return pairs.filter(F.col("seq") != F.col("previous_seq") + 1)


def _limits(expected_s: float, tolerance_s: float) -> tuple[int, int]:
    low, high = expected_s - tolerance_s, expected_s + tolerance_s
    return round(low * 1e9), round(high * 1e9)


def clock_deltas(captured: DataFrame) -> DataFrame:
    """``scope, delta_ns`` by the sender's and by the arrival clock.

    Both follow the arrival order, so one pass finds the message before and the
    last message that carries a sender time.
    """
    rows = captured.select("arrival_seq", "arrival_ns", "sent_mono_ns")
    pairs = previous_values(
        rows, ORDER, {"_arrived": "arrival_ns", "_sent": "sent_mono_ns"}, known=("_sent",)
    )
    both = F.array(
        F.struct(F.lit(SENDER).alias("scope"), (F.col("sent_mono_ns") - F.col("_sent")).alias("delta_ns")),
        F.struct(F.lit(ARRIVAL).alias("scope"), (F.col("arrival_ns") - F.col("_arrived")).alias("delta_ns")),
    )
    return pairs.select(F.inline(both)).filter(F.col("delta_ns").isNotNull())


def all_deltas(captured: DataFrame) -> DataFrame:
    """``scope, topic, delta_ns`` of all three kinds; topic is NULL for the global ones."""
    clocks = clock_deltas(captured).select("scope", F.lit(None).cast("string").alias("topic"), "delta_ns")
    topics = topic_deltas(captured).select(F.lit(TOPIC).alias("scope"), "topic", "delta_ns")
    return clocks.unionByName(topics)


def cadence_report(
    captured: DataFrame,
    expected_s: float = EXPECTED_S,
    tolerance_s: float = TOLERANCE_S,
    seconds: float | None = None,
) -> DataFrame:
    """Per scope: count, mean, extremes and percentiles in seconds, share within tolerance.

    ``seconds``: look at the start of the capture only, as long as a live check runs.
    """
    if seconds is not None:
        captured = sample_window(captured, seconds)
    deltas = settle(all_deltas(captured), "deltas")
    return summarize_deltas(deltas, ["scope", "topic"], expected_s, tolerance_s)


def summarize_deltas(deltas: DataFrame, by, expected_s: float, tolerance_s: float) -> DataFrame:
    low, high = _limits(expected_s, tolerance_s)
    extra = {
        "_total": lambda v, n: F.sum(v.cast("decimal(20,0)") * n),
        "_min": lambda v, n: F.min(v),
        "_max": lambda v, n: F.max(v),
        "_within": lambda v, n: F.coalesce(F.sum(F.when(v.between(low, high), n)), F.lit(0)),
    }
    found = distribution(deltas, "delta_ns", QUANTILES, by, extra)
    return found.select(
        *by,
        "n",
        (F.col("_total").cast("double") / F.col("n") / 1e9).alias("mean_s"),
        (F.col("_min") / 1e9).alias("min_s"),
        (F.col("_max") / 1e9).alias("max_s"),
        *((F.col(name) / 1e9).alias(f"{name}_s") for name in QUANTILES),
        (F.col("_within") * 100.0 / F.col("n")).alias("within_pct"),
    )


def cadence_verdict(
    captured: DataFrame, expected_s: float = EXPECTED_S, tolerance_s: float = TOLERANCE_S
) -> DataFrame:
    """PASS, FAIL or INDETERMINATE, over sender deltas if there are any, else arrival deltas."""
    low, high = _limits(expected_s, tolerance_s)
    inside = F.count_if(F.col("delta_ns").between(low, high))
    both = clock_deltas(captured).groupBy("scope").agg(F.count(F.lit(1)).alias("n"), inside.alias("within"))
    both = both.withColumn("rank", F.when(F.col("scope") == SENDER, 0).otherwise(1))
    chosen = both.agg(F.min_by(F.struct("scope", "n", "within"), "rank").alias("c")).select("c.*")
    verdict = (
        F.when(F.col("n").isNull(), "INDETERMINATE")
        .when(F.col("within") >= REQUIRED_SHARE * F.col("n"), "PASS")
        .otherwise("FAIL")
    )
    return chosen.select("scope", "n", "within", verdict.alias("verdict"))
