"""Daily update files as a stream: each new file is validated and appended once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfline.plans.loading import daily_update
from shelfline.schemas import FACTS, PROJECT_START
from shelfline.sources.files import read_csv
from shelfline.sources.store import Store

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_updates(spark: SparkSession, store: Store, table: str | None, folder: str, work: str,
                   start: dt.date = PROJECT_START, as_of: dt.date | None = None,
                   days_from: dt.date | None = None, files_per_batch: int = 100) -> StreamingQuery:
    """Reads the CSV files that are new in `folder` and stops when none are left.

    Without a `table` the files lie in one subfolder per fact, named after it, and what a micro-batch holds
    of all facts becomes one commit. A batch that is replayed after a failure is known by its number and
    adds nothing; a file that is sent again finds its keys taken.
    """
    files = (spark.readStream.format("binaryFile").schema(_FILES)
             .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
             .option("maxFilesPerTrigger", files_per_batch).load(folder).select("path"))
    target = table or "facts"

    def append(batch: DataFrame, batch_id: int) -> None:
        # at most `files_per_batch` names; the files are then read like any extract, by header and charset
        paths: dict[str, list[str]] = {}
        for row in batch.collect():
            paths.setdefault(table or row.path.rsplit("/", 2)[1], []).append(row.path)
        raw = {name: read_csv(spark, sorted(own), flag_overlong=True) for name, own in paths.items() if name in FACTS}
        if raw:
            daily_update(spark, store, raw, f"{work}/{target}/batch={batch_id}", start, as_of, days_from,
                         batch=f"{work}/{target}/{batch_id}")

    return (files.writeStream.foreachBatch(append).option("checkpointLocation", f"{work}/{target}/progress")
            .trigger(availableNow=True).start())
