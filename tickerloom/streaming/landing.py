"""Silver, and gold behind it, kept up to date from newly landed price documents only.

Structured Streaming remembers which files it has seen; each micro-batch goes through the same rule,
typing, as-of join, checks and upsert as the batch job. A repeated micro-batch changes nothing, because
only rows that differ from the stored ones are upserted. With a ledger, what a micro-batch changes is on
record before the table is touched, and the features follow from there: one that dies at any point is
made up for by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans import quality
from ..plans.pipeline import follow_revisions, run_gold, store_on_record
from ..plans.silver import price_with_macro
from ..session import Staging
from ..settings import Universe
from ..sources import bronze
from ..sources.ledger import Ledger
from ..sources.tables import DAILY, Layout, changed_rows, table_exists


def follow_prices(
    spark: SparkSession,
    prices_path: str,
    observations: DataFrame,
    silver_path: str,
    checkpoint: str,
    universe: Universe = Universe(),
    layout: Layout = DAILY,
    lines: bool = False,
    files_per_batch: int = 1000,
    rejected_path: str | None = None,
    ledger_path: str | None = None,
    gold_paths: tuple[str, str] | None = None,
    max_file_age: str = "3650d",
) -> StreamingQuery:
    """Process all documents not seen before, in bounded micro-batches, then stop.

    Within a micro-batch the newest landing of every (symbol, date) counts; across micro-batches,
    which follow landing time, the later one does. So how many files make a micro-batch changes
    nothing. Rejected documents are written to ``rejected_path``, by default beside silver, in one folder
    per micro-batch. So are its quality report (``<silver>_quality``) and the rows that fail a check
    (``<silver>_set_aside``), which do not reach silver; the stream goes on.

    With ``ledger_path``, stored rows are first joined anew where the macro ``observations`` have been revised
    since the last run. With ``gold_paths``, of features and snapshot, these follow every micro-batch.

    The stream's checkpoint forgets files that are ``max_file_age`` older than the newest one, and passes over
    any that turn up so late.
    """
    if gold_paths and not ledger_path:
        raise ValueError("gold follows silver by a ledger: name ledger_path as well")
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", max_file_age)
    landed = bronze.raw_price_documents(reader, prices_path, lines).drop(schemas.CORRUPT)
    beside = silver_path.rstrip("/")
    refused = rejected_path or f"{beside}_rejected"

    def follow_gold(session: SparkSession) -> None:
        if gold_paths:
            run_gold(session, silver_path, *gold_paths, universe, layout, ledger_path=ledger_path)

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        with Staging(session) as stage:
            documents = bronze.split(stage(batch, "landed"))
            documents.rejected.write.mode("overwrite").parquet(f"{refused}/batch={number}")
            typed = bronze.newest_prices(documents.good, universe.symbols)
            silver = stage(price_with_macro(typed, observations, universe.series), "silver")
            quality.silver_quality(silver).write.mode("overwrite").parquet(f"{beside}_quality/batch={number}")
            judged = stage(quality.judged(silver), "judged")
            fine = F.size("failed_checks") == 0
            judged.filter(~fine).write.mode("overwrite").parquet(f"{beside}_set_aside/batch={number}")
            changed = stage(changed_rows(judged.filter(fine).drop("failed_checks"), silver_path, layout), "changed")
            entry = Ledger(session, ledger_path).begin() if ledger_path else None
            store_on_record(changed, silver_path, layout, entry, observations)
        follow_gold(session)

    if ledger_path and table_exists(spark, silver_path):
        follow_revisions(spark, silver_path, observations, universe, layout, ledger_path)
        follow_gold(spark)   # also what a run that died has left
    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
