"""The queue of manual submissions as a file stream: each file is drained once, then moved to an archive."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import normalise_doi
from ..operators import enrich
from ..sources.files import Store

#: Labels of the two lookups in the records that they know.
NAMES = ("Crossref", "OpenAlex")


def drained(spark: SparkSession, queue_dir: str, checkpoint: str, known: Callable[[], DataFrame], ask: Callable[[DataFrame], tuple[DataFrame, DataFrame]], accept: Callable[[DataFrame, int], None], reject: Callable[[DataFrame, int], None], archive: str | None = None) -> None:
    """Looks up what is new in queue_dir (JSON arrays of {doi}); unknown identifiers go to ``reject``, none is lost.

    ``ask`` gets the keys of the batch that are not known yet, and no others. What was found is written beside the checkpoint before
    ``accept`` may rewrite the tables that it came from, so lookups are asked once; the batch's own folder is overwritten if the
    batch runs again, with the same number. Files that were there at the start go to ``archive`` once all batches are committed, so
    the queue's folder holds what is still to do. No folder, or files that hold no such arrays: nothing to do.
    """

    def upsert(batch: DataFrame, nth: int) -> None:
        rows = batch.where("doi is not null").select(normalise_doi(F.col("doi")).alias("key"), "doi")
        path = f"{checkpoint.rstrip('/')}-found/{nth}"
        wanted = enrich.pending(rows, known(), [F.col("doi")])
        wanted.write.mode("overwrite").parquet(f"{path}/wanted")
        wanted = spark.read.schema(wanted.schema).parquet(f"{path}/wanted")
        enrich.assemble(wanted, *ask(wanted.select("key")), NAMES).write.mode("overwrite").parquet(f"{path}/found")
        found = spark.read.parquet(f"{path}/found")
        accept(found.where("not rejected").drop("rejected"), nth)
        reject(found.where("rejected").select("key", "doi"), nth)

    store = Store(spark, queue_dir)
    if not store.exists(queue_dir):
        return
    there = store.files(queue_dir) if archive else []  # all of them are drained when the stream has ended
    stream = spark.readStream.schema("doi string").option("multiLine", True).json(queue_dir)
    stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    for name in there:  # the stream's own cleanSource clears a batch only when it plans the next one
        store.make(archive)
        store.move(f"{queue_dir.rstrip('/')}/{name}", f"{archive.rstrip('/')}/{uuid.uuid4().hex[:12]}-{name}")


def drain(spark: SparkSession, queue_dir: str, checkpoint: str, known: Callable[[], DataFrame], lookups: Callable[[], tuple[DataFrame, DataFrame]], accept: Callable[[DataFrame], None], reject: Callable[[DataFrame], None]) -> None:
    """drained() with lookup tables that do not depend on the batch; files stay where they are."""
    drained(spark, queue_dir, checkpoint, known, lambda keys: lookups(), lambda df, nth: accept(df.drop("sources")), lambda df, nth: reject(df))
