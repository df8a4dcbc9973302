"""Inner joins of two streams that keep both sides for good.

Spark's own stream–stream join puts every row of either side into a state store
under its key, row by row, and keeps a hot key in one store. Here the rows of a
micro-batch are written to a history (parquet, below the query's checkpoint),
and joined as tables are: new left rows with all right rows, and earlier left
rows with new right rows. So every pair comes out once, in the batch of its
later row, however the rows fall into batches, and the engine spills, sorts and
splits skewed keys as in any join.

A batch shuffles or scans the history of both sides, so its cost grows with the
history, not with the batch alone: for streams of many small batches, bound the
join by time (``joins.join`` with watermarks) instead. History and output of a
batch are written under its id, so a replayed batch replaces its own. A stream
that follows the output folder can see the files of a replayed batch anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventloom.operators.joins import join
from eventloom.session import _fs
from eventloom.streaming.runner import checkpoint_for, run_available


def history_of(spark, query_name: str) -> str:
    """Where a query keeps its rows; it goes with the query's checkpoint."""
    return f"{checkpoint_for(spark, query_name)}/history"


def join_streams(left: DataFrame, right: DataFrame, on: Column, query_name: str, path: str,
                 finish: Callable[[DataFrame], DataFrame] = lambda df: df,
                 partition_by: Sequence[str] = (), **kw) -> tuple[str, list]:
    """Run the inner join of two streams over all available input into parquet
    files below ``path``; ``finish`` makes the rows to write from the joined
    ones. Returns the path and all progress reports. A run under the same name
    goes on where the last one ended."""
    spark, history = left.sparkSession, history_of(left.sparkSession, query_name)
    row = StructType([StructField("left", left.schema), StructField("right", right.schema)])
    stored = StructType([*row.fields, StructField("side", StringType()), StructField("batch_id", LongType())])
    for folder in (path, history):
        p, fs = _fs(spark, folder)
        fs.mkdirs(p)

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(*[(F.struct(*[F.col(f"`{c}`") for c in df.columns]) if f.name == side
                            else F.lit(None).cast(f.dataType)).alias(f.name) for f in row.fields],
                         F.lit(side).alias("side"))

    def kept(side: str, batches: Column) -> DataFrame:
        return spark.read.schema(stored).parquet(history).filter((F.col("side") == side) & batches).select(f"{side}.*")

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("side").parquet(f"{history}/batch_id={batch_id}")
        at = F.col("batch_id")
        pairs = join(kept("left", at == batch_id), kept("right", at <= batch_id), on, "inner")
        if batch_id:
            pairs = pairs.unionByName(join(kept("left", at < batch_id), kept("right", at == batch_id), on, "inner"))
        (finish(pairs).withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by, "batch_id").parquet(path))

    return run_available(tagged(left, "left").union(tagged(right, "right")), query_name, path=path,
                         foreach_batch=step, **kw)
