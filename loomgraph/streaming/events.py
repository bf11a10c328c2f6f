"""The state of runs, folded from their events.

The fold keeps the last value of each field, so it is associative: the batch
form aggregates a table, the stream form folds each micro-batch and merges it
with the state so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomgraph.storage import drop_settled, settle

EVENTS = "run_id string, seq long, type string, stage string, index int, total int, message string"
_KEPT = {
    "current_stage": ["stage_start", "complete", "error", "cancelled"],
    "progress_index": ["stage_start", "stage_done"],
    "progress_total": ["stage_start", "stage_done"],
    "last_summary": ["complete"],
    "last_error": ["error"],
}


def _marks(events: DataFrame) -> DataFrame:
    """run_id and a (seq, value) struct for each field that an event sets."""
    value = {"current_stage": F.when(F.col("type") == "stage_start", F.col("stage")), "progress_index": F.col("index").cast("string"), "progress_total": F.col("total").cast("string"), "last_summary": F.col("message"), "last_error": F.col("message")}
    return events.select("run_id", F.col("seq").alias("last_seq"), *[F.when(F.col("type").isin(kinds), F.struct("seq", value[c].alias("value"))).alias(c) for c, kinds in _KEPT.items()])


def _fold(marks: DataFrame) -> DataFrame:
    return marks.groupBy("run_id").agg(F.max("last_seq").alias("last_seq"), *[F.max(c).alias(c) for c in _KEPT])


def _shown(folded: DataFrame) -> DataFrame:
    kind = {"progress_index": "int", "progress_total": "int"}
    return folded.select("run_id", "last_seq", *[F.col(f"{c}.value").cast(kind.get(c, "string")).alias(c) for c in _KEPT])


def run_states(events: DataFrame) -> DataFrame:
    """run_id, last_seq, current_stage, progress_index, progress_total, last_summary, last_error.

    A run that is complete, failed or cancelled has no current stage.
    """
    return _shown(_fold(_marks(events)))


def latest_by(events: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """key and the columns of its last row in that order; ties by order's later columns."""
    best = events.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    return best.select(key, "_last.*")


class StateFold:
    """Keeps run states as a settled table while a stream of events goes by; a repeated batch changes nothing."""

    def __init__(self):
        self._state: DataFrame | None = None

    def add(self, batch: DataFrame, epoch: int) -> None:
        new = _fold(_marks(batch))
        old = self._state
        self._state = settle(new if old is None else _fold(old.unionByName(new)))
        if old is not None:
            drop_settled(old)

    @property
    def states(self) -> DataFrame | None:
        return _shown(self._state) if self._state is not None else None

    def start(self, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Fold a streaming DataFrame of events; trigger is as for writeStream.trigger."""
        return events.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
