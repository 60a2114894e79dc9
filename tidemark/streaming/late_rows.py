"""Late rows counted over the whole life of a stream.

Spark drops rows behind the watermark and tells their number in each
micro-batch's progress, of which a query keeps the last hundred.  ``LateRowLedger``
listens to every progress report and writes one entry per batch below the
stream's checkpoint folder (``late_rows/``), so the count survives restarts and covers
all batches.  A batch that is run again replaces its entry; older entries are folded
into one, so the folder holds at most ``FOLD`` + 1 of them.

The unit is Spark's: rows as the stateful operator meets them.  The session
aggregate combines a task's events of one key and instant before that, so
such events count as one.

Entries are empty files whose names hold the numbers: ``batch-<id>-<rows>`` and
``upto-<id>-<rows>-<batches>``.
"""

from __future__ import annotations

import threading
import time
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.upsert import hadoop_path, path_exists

FOLD = 50
#: Seconds to wait for reports that are still on their way when a query has ended.
SETTLE = 20.0


class LateRows(NamedTuple):
    rows: int        # dropped behind the watermark
    batches: int     # batches counted
    last_batch: int  # newest of them (-1: none)


def _names(spark: SparkSession, folder: str) -> list[str]:
    if not path_exists(spark, folder):
        return []
    fs, p = hadoop_path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)]


def _entries(names: list[str]) -> tuple[tuple[int, int, int], dict[int, tuple[int, str]]]:
    """The newest fold (id, rows, batches) and the batches after it: id -> (rows, file name)."""
    fold, batches = (-1, 0, 0), {}
    for name in names:
        kind, *numbers = name.split("-")
        if kind == "upto":
            fold = max(fold, tuple(map(int, numbers)))
        elif kind == "batch":
            batches[int(numbers[0])] = (int(numbers[1]), name)
    return fold, {i: v for i, v in batches.items() if i > fold[0]}


def late_rows(spark: SparkSession, checkpoint: str) -> LateRows:
    """What the ledger of a stream's checkpoint holds."""
    fold, batches = _entries(_names(spark, f"{checkpoint}/late_rows"))
    return LateRows(fold[1] + sum(r for r, _ in batches.values()), fold[2] + len(batches), max([fold[0], *batches]))


class LateRowLedger(StreamingQueryListener):
    """Writes the ledger of one query; ``name`` is the query's name, unique in the session."""

    def __init__(self, spark: SparkSession, checkpoint: str, name: str) -> None:
        self.spark, self.folder, self.name = spark, f"{checkpoint}/late_rows", name
        self.seen, self.ended, self._lock = -1, threading.Event(), threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's interface
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if progress.name == self.name:
            dropped = sum(int(s.numRowsDroppedByWatermark) for s in progress.stateOperators)
            with self._lock:
                self.write(int(progress.batchId), dropped)
                self.seen = max(self.seen, int(progress.batchId))

    def _touch(self, name: str) -> None:
        fs, p = hadoop_path(self.spark, f"{self.folder}/{name}")
        fs.create(p, True).close()

    def _remove(self, name: str) -> None:
        fs, p = hadoop_path(self.spark, f"{self.folder}/{name}")
        fs.delete(p, False)

    def write(self, batch: int, rows: int) -> None:
        """Enter a batch, or replace its entry.  An idle query reports its last batch again, without
        rows: such a report changes nothing."""
        fold, batches = _entries(_names(self.spark, self.folder))
        if batch <= fold[0]:
            return
        old = batches.get(batch)
        if old is not None and old[0] >= rows:
            return
        self._touch(f"batch-{batch}-{rows}")
        if old is not None:
            self._remove(old[1])
        batches[batch] = (rows, f"batch-{batch}-{rows}")
        if len(batches) > FOLD:
            # entries before the newest; the fold is written before they go, and hides them from then on
            gone = sorted(batches)[:-1]
            self._touch(f"upto-{gone[-1]}-{fold[1] + sum(batches[i][0] for i in gone)}-{fold[2] + len(gone)}")
            for i in gone:
                self._remove(batches[i][1])
            if fold[0] >= 0:
                self._remove(f"upto-{fold[0]}-{fold[1]}-{fold[2]}")

    def settle(self, query: StreamingQuery, seconds: float = SETTLE) -> None:
        """Wait until the last report of an ended query has been entered, then stop listening."""
        until = time.monotonic() + seconds
        last = query.lastProgress
        while last is not None and self.seen < int(last["batchId"]) and time.monotonic() < until:
            time.sleep(0.05)
        self.spark.streams.removeListener(self)
