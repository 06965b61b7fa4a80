"""Keeps an index store in step with a streaming change feed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from foldex.operators.fold import allow_collections
from foldex.plans import files
from foldex.plans.rebuild import Action
from foldex.plans.store import IndexStore


class IndexService:
    """Runs a feed into a store and pauses it for actions.

    ``feed`` returns a streaming DataFrame of change rows. The stream only projects and appends: each
    micro-batch is a batch of the log, named by its number, so one that is repeated after a failure
    replaces itself. Paused time costs nothing, as unread events wait in the source. The log is folded whenever
    ``compact_after`` batches lie above the newest version (None: never).
    """

    def __init__(self, store: IndexStore, feed: Callable[[], DataFrame], collections: Sequence[str] | None = None,
                 commit_delay: str = "1 second", files_per_index: int = 1, compact_after: int | None = 256):
        self.store = store
        self.feed = feed
        self.collections = collections
        self.commit_delay = commit_delay
        self.files_per_index = files_per_index
        self.compact_after = compact_after
        self.query: StreamingQuery | None = None

    @property
    def checkpoint(self) -> str:
        return f"{self.store.root}/checkpoint"

    def _feed_id(self) -> str:
        """Tells batches of this checkpoint from those of an earlier one that was removed."""
        path = f"{self.checkpoint}/feed-id"
        files.publish(self.store.spark, path, uuid.uuid4().hex)
        return files.read_text(self.store.spark, path)

    def _writer(self):
        changes, name = self.feed(), self._feed_id()
        if self.collections is not None:
            changes = allow_collections(changes, list(self.collections))

        def append(rows: DataFrame, number: int) -> None:
            self.store.append(rows, f"stream-{name}-{number:012d}", files_per_index=self.files_per_index)
            if self.compact_after and len(self.store.cut().batches) >= self.compact_after:
                self.store.compact()
                self.store.vacuum()

        return changes.writeStream.foreachBatch(append).option("checkpointLocation", self.checkpoint)

    def open(self) -> StreamingQuery:
        """Starts (or resumes) applying; changes become visible every ``commit_delay``."""
        if self.query is None:
            self.query = self._writer().trigger(processingTime=self.commit_delay).start()
        return self.query

    def drain(self) -> None:
        """Applies everything the feed holds now, then stops."""
        if self.query is not None:
            self.query.processAllAvailable()
            return
        query = self._writer().trigger(availableNow=True).start()
        query.awaitTermination()

    def pause(self) -> None:
        """Stops applying; the checkpoint remembers the position."""
        if self.query is not None:
            self.query.stop()
            self.query = None

    def execute(self, action: Action) -> object:
        """Runs an action on the store while the feed is paused; the feed resumes in any case."""
        running = self.query is not None
        self.pause()
        try:
            return action(self.store)
        finally:
            if running:
                self.open()

    def close(self) -> None:
        self.pause()

    def __enter__(self) -> IndexService:
        self.open()
        return self

    def __exit__(self, *exc) -> None:
        self.close()
