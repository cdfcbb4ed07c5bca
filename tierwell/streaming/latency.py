"""How late the live tables are: a histogram of what they wrote, and the times of their micro-batches."""

from __future__ import annotations

from collections import deque
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tierwell.functions.temporal import latency_step, sla_class

#: Rows of a class whose delay is at most ``up_to_seconds`` and above half of that.
HISTOGRAM = T.StructType(
    [
        T.StructField("sla", T.StringType()),
        T.StructField("up_to_seconds", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)


def histogram(written: DataFrame) -> DataFrame:
    """Counts by class and step of rows with ``transaction_timestamp`` and ``updated_at``.

    Steps are powers of two, so a histogram has some forty rows, however many it counts, and two of
    them are merged by adding up."""
    return written.groupBy(
        sla_class("transaction_timestamp", "updated_at").alias("sla"),
        latency_step("transaction_timestamp", "updated_at").alias("up_to_seconds"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def merged(histograms: DataFrame) -> DataFrame:
    """One histogram of many; ``batch``, where there, is the newest."""
    newest = [F.max("batch").alias("batch")] if "batch" in histograms.columns else []
    return histograms.groupBy("sla", "up_to_seconds").agg(F.sum("rows").alias("rows"), *newest)


class BatchTime(NamedTuple):
    name: str | None
    batch: int
    started: datetime
    rows: int
    seconds: float
    state_rows: int


class BatchTimes(StreamingQueryListener):
    """The last micro-batches of the queries of a session, as their progress reports them."""

    def __init__(self, keep: int = 1000):
        self.seen: deque[BatchTime] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        state = sum(o.numRowsTotal for o in p.stateOperators)
        self.seen.append(BatchTime(p.name, p.batchId, started, p.numInputRows, p.batchDuration / 1000, state))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
