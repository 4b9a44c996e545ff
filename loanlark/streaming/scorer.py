"""Scoring of applications as they arrive in a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanlark.operators import scoring


def read_applications(
    spark: SparkSession, folder: str, fmt: str = "json", files: int = 10_000, max_bytes: int | None = None
) -> DataFrame:
    """Application records as an unbounded table; a backlog is read ``files`` at a time, or by
    ``max_bytes`` of files where that is given."""
    reader = spark.readStream.format(fmt).schema(scoring.REQUEST_SCHEMA)
    limit = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", files)
    return reader.option(*limit).load(folder)


def _start(df: DataFrame, sink: str, checkpoint: str, by: tuple[str, ...] = ()) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .partitionBy(*by)
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def score_stream(
    arriving: DataFrame, model: scoring.RiskModel, sink: str, checkpoint: str
) -> StreamingQuery:
    """Score valid records into a Parquet sink; stateless, so nothing is kept between batches.

    The source log and the sink log in ``checkpoint`` make a restart continue exactly
    where it stopped.
    """
    return _start(model.score(scoring.valid_rows(arriving), keep=("id",)), sink, checkpoint)


def reject_stream(arriving: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Records that break a range rule, with the names of the rules."""
    return _start(scoring.rejected_rows(arriving), sink, checkpoint)


def routed(arriving: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Every record once: ``accepted``, ``broken_rules`` and, of accepted ones, what ``score`` adds.

    ``score`` maps rows to rows, one each, and keeps the column ``routing``.
    """
    checked = scoring.validated(arriving)
    routing = F.struct("id", "broken_rules").alias("routing")
    scored = score(checked.withColumn("routing", routing).drop("broken_rules"))
    accepted = F.size("routing.broken_rules") == 0
    added = [c for c in scored.columns if c != "routing"]
    return scored.select(
        "routing.id", accepted.alias("accepted"), "routing.broken_rules", *[F.when(accepted, F.col(c)).alias(c) for c in added if c != "id"]
    )


def route_stream(
    arriving: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str
) -> StreamingQuery:
    """Accepted and rejected records from one pass, parted by ``accepted`` in one sink.

    The sink's log names the files of a batch, so a batch that is replayed after a failure
    replaces its first attempt and no record is there twice.
    """
    return _start(routed(arriving, score), sink, checkpoint, by=("accepted",))


def read_routed(spark: SparkSession, sink: str) -> DataFrame:
    """The sink of ``route_stream``; the names of folders carry no types."""
    return spark.read.parquet(sink).withColumn("accepted", F.col("accepted").cast("boolean"))
