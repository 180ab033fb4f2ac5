"""A table's appends as a stream of micro-batches.

Structured Streaming has no source for these tables without a JVM connector,
so the driver walks the snapshots: a batch is the incremental scan of the
snapshots since the last one, and where it ended is claimed in a checkpoint
folder, one document a batch, before the batch runs and again when it is done.
A batch that failed half-way runs again over the same snapshots.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import Files
from ..sources.table import Table


class AppendStream:
    """Batches of appended rows of a table's main branch, for a handler (rows, batch number). max_snapshots: most snapshots of a batch; a longer backlog makes more batches, none is left out."""

    def __init__(self, spark: SparkSession, root: str, checkpoint: str, start: int | None = None, max_snapshots: int = 100) -> None:
        self.table, self.files, self.start, self.most = Table.load(spark, root), Files(spark, checkpoint), start, max_snapshots

    def _known(self) -> tuple[int, dict | None, bool]:
        """Number of the last batch, what it covers, and whether it is done."""
        names = set(self.files.names("batches"))
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return -1, None, True
        last = max(numbers)
        return last, json.loads(self.files.read(f"batches/{last}.json")), f"{last}.done" in names

    def available(self, handler: Callable[[DataFrame, int], None]) -> int:
        """Handles all that is there; how many batches that took."""
        ran = 0
        while True:
            number, plan, done = self._known()
            if done:
                self.table.refresh()
                after = plan["upto"] if plan else self.start
                span = self.table.span(after, None)
                if not span:
                    return ran
                number, plan = number + 1, {"after": after, "upto": span[: self.most][-1]["id"]}
                if not self.files.claim(f"batches/{number}.json", json.dumps(plan)):
                    raise RuntimeError("another run handles this stream")
            handler(self.table.appended(plan["after"], plan["upto"]), number)
            self.files.write(f"batches/{number}.done", "")
            ran += 1
