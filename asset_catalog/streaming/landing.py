"""Import of what landed since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from asset_catalog.config import Config
from asset_catalog.plans.lifecycles import Choice, Mappings, import_lines
from asset_catalog.schemas import Kind, kind_of
from asset_catalog.sources.landed import line_rows


def import_new(
    spark: SparkSession,
    config: Config,
    kind: str | Kind,
    checkpoint: str,
    choice: Choice = Choice(),
    mappings: Mappings = Mappings(),
) -> StreamingQuery:
    """Upsert newly landed lines into the catalog, then stop.

    ``checkpoint`` remembers which files were taken in; it must be in a shared folder. A batch
    that is repeated after a failure puts the same rows in again, which changes nothing.
    """
    kind = kind_of(kind)
    files = spark.readStream.format("text").load(f"{config.landing}/{kind.collection}")

    def put(batch: DataFrame, _: int) -> None:
        import_lines(batch, config, kind, choice, mappings)

    return (
        line_rows(files)
        .writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
