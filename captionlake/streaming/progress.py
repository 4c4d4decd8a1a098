"""Counts and time left of a running stream, observed as its rows pass, without a second pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Adds up what ``watched`` observes. Time left is what is missing times the mean time so far, null before the first file.

    A batch that is run again after a failure is counted once: batches are told apart by query and number, so what is kept
    is four numbers and the last batch of each query.
    """

    def __init__(self, total: int, name: str = "progress"):
        self.total, self.name = total, name
        self.good = self.bad = self.elapsed_ms = 0
        self.last: dict[str, int] = {}

    @property
    def done(self) -> int:
        return self.good + self.bad

    @property
    def eta_ms(self) -> int | None:
        return max(0, self.total - self.done) * self.elapsed_ms // self.done if self.done else None

    def watched(self, files: DataFrame, ok: Column) -> DataFrame:
        """files, of whose rows each is one that succeeded or failed, with both counted as they pass."""
        return files.observe(self.name, F.count_if(ok).alias("good"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("bad"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = (p.observedMetrics or {}).get(self.name)
        if seen is None or p.batchId <= self.last.get(str(p.id), -1):
            return
        self.last[str(p.id)] = p.batchId
        self.good += seen["good"] or 0
        self.bad += seen["bad"] or 0
        self.elapsed_ms += p.batchDuration

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
