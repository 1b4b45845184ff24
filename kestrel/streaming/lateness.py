"""Rows that stateful stream operators drop behind the watermark, counted over all batches of a query."""

from __future__ import annotations

import threading
from collections import Counter, defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_MESSAGE = "{} rows came behind the watermark and were not counted; raise its delay"


class LateRowsError(RuntimeError):
    def __init__(self, dropped: int):
        super().__init__(_MESSAGE.format(dropped))


class _Listener(StreamingQueryListener):
    def __init__(self):
        self.dropped: Counter = Counter()
        self.ended: dict = defaultdict(threading.Event)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        if late:
            self.dropped[str(event.progress.runId)] += late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended[str(event.runId)].set()


_LISTENERS: dict[str, _Listener] = {}


def listener(spark: SparkSession) -> _Listener:
    """The session's counter; attached on first use, it keeps one number per run and no progress reports."""
    key = spark._jsparkSession.toString()
    if key not in _LISTENERS:
        _LISTENERS[key] = _Listener()
        spark.streams.addListener(_LISTENERS[key])
    return _LISTENERS[key]


class LateGuard:
    """Fails a query whose operators dropped late rows: a running one with its next batch, a finished one in :meth:`finish`."""

    def __init__(self, spark: SparkSession):
        self.counted, self.run = listener(spark), None

    def watch(self, query: StreamingQuery) -> StreamingQuery:
        self.run = str(query.runId)
        return query

    def check(self) -> None:
        if self.run is not None and (late := self.counted.dropped[self.run]):
            raise LateRowsError(late)

    def guarded(self, fn):
        """The ``foreachBatch`` body ``fn``, refused once rows have been dropped."""
        def body(batch, batch_id):
            self.check()
            fn(batch, batch_id)
        return body

    def finish(self, seconds: float = 60.0) -> None:
        """After the query ended: wait until its last report has come, then check."""
        if not self.counted.ended[self.run].wait(seconds):
            raise RuntimeError(f"the end of stream run {self.run} was not reported within {seconds:g} seconds")
        self.counted.ended.pop(self.run)
        self.check()
