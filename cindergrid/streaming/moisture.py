"""The hourly moisture fold over a stream: states by cell go from batch to batch as tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import moisture


def write_evolved(hours: DataFrame, keys: list[str], order: str, path: str, checkpoint: str, start: Column | None = None) -> StreamingQuery:
    """Folds a stream of hours with the step of the batch fold. Each batch reads the states that the batch before left (a row a
    cell, under path/states), writes its hours with state and codes (path/hours) and the states after them. Hours that are
    not after their cell's last one come too late for a fold; they are kept apart, under path/late. Of a batch that is run
    again after a failure, all that it wrote is written again from the same states."""
    first = moisture.start_state() if start is None else start
    state = F.struct(*moisture.STATE)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            before = spark.read.parquet(f"{path}/states").filter(F.col("batch") < batch_id)
            newest = before.agg(F.max("batch")).first()[0]  # of the folders' names
            before = before.filter(F.col("batch") == newest).drop("batch")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            before = batch.select(*keys, F.col(order).alias("_last"), first.alias("_start")).limit(0)
        rows = batch.join(before, keys, "left")
        late = F.coalesce(F.col(order) <= F.col("_last"), F.lit(False))
        rows.filter(late).select(*batch.columns).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        good = rows.filter(~late).withColumn("_start", F.coalesce("_start", first)).drop("_last")
        evolved = moisture.evolve(good, [*keys, "_start"], order, F.col("_start")).drop("_start")
        evolved.write.mode("overwrite").parquet(f"{path}/hours/batch={batch_id}")
        after = spark.read.parquet(f"{path}/hours/batch={batch_id}").groupBy(*keys).agg(F.max(order).alias("_last"), F.max_by(state, order).alias("_start"))
        kept = before.join(after.select(*keys), keys, "left_anti")
        after.unionByName(kept.select(*after.columns)).write.mode("overwrite").parquet(f"{path}/states/batch={batch_id}")

    return hours.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
