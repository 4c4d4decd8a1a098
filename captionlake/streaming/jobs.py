"""Streams: stages of running jobs from their logs, energies of audio samples."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from captionlake.operators.manifest import log_stage

STATUS = "job long, status string, stage string, lines long"


def job_status(log: DataFrame) -> DataFrame:
    """Status of each job from a stream (job, ord, line): stop wins over a return code, the first failing step ends the job.

    The state of a job is three values, so that it doesn't grow with its log.
    """

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, stage, lines = state.get if state.exists else ("running", None, 0)
        for pdf in batches:
            pdf = pdf.sort_values("ord")
            for line, named in zip(pdf["line"], pdf["stage"]):
                lines += 1
                stage = named if isinstance(named, str) else stage
                if line == "[stop]":
                    status = "stopped"
                elif status == "running" and line.startswith("[exit "):
                    status = "done" if line == "[exit 0]" else "error"
        state.update((status, stage, lines))
        yield pd.DataFrame([(key[0], status, stage, lines)], columns=["job", "status", "stage", "lines"])

    d = log.select("job", "ord", "line", log_stage(F.col("line")).alias("stage"))
    return d.groupBy("job").applyInPandasWithState(fold, STATUS, "status string, stage string, lines long", "update", GroupStateTimeout.NoTimeout)


def sample_energy(samples: DataFrame, late: str = "10 seconds") -> DataFrame:
    """Energies of one-second windows of a stream (file_id, ts, l, r); late samples are dropped after `late`."""
    square = lambda x: F.avg(x * x)
    l, r = F.col("l"), F.col("r")  # noqa: E741
    return samples.withWatermark("ts", late).groupBy("file_id", F.window("ts", "1 second").alias("w")).agg(
        square(l).alias("l"), square(r).alias("r"), square((l + r) / 2).alias("mix"), square((l - r) / 2).alias("diff")
    )


def replay_then_live(log: DataFrame, live: DataFrame) -> DataFrame:
    """Lines (job, ord, line) of the log, then of live (a stream or a table) that the log doesn't have; a job whose log has ended gets none."""
    known = log.select("job", "ord").distinct()
    ended = log.where(F.startswith("line", F.lit("[exit ")) | (F.col("line") == "[stop]")).select("job").distinct()
    new = live.join(ended, "job", "left_anti").join(known, ["job", "ord"], "left_anti")
    return log.select("job", "ord", "line").union(new.select("job", "ord", "line"))
