"""Cluster assignment of edges arriving as a stream of files.

The original pipeline is batch only; this runs the same operator
(:func:`flowstrata.operators.membership.edge_clusters`) on a file stream:
a stream-static left join of the incoming edges with the member table,
appended to a parquet sink.  Progress and exactly-once bookkeeping live in
a checkpoint location under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.membership import edge_clusters
from ..session import staging_path

EDGE_SCHEMA = "source BIGINT, target BIGINT"


def edge_clusters_stream(spark: SparkSession, edge_dir: str, members: DataFrame,
                         out_dir: str, checkpoint: str | None = None,
                         schema: str = EDGE_SCHEMA, max_files_per_trigger: int = 64,
                         available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes every file
    present at start (in bounded micro-batches) and stops."""
    edges = (spark.readStream.schema(schema)
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .parquet(edge_dir))
    out = edge_clusters(edges, members)
    writer = (out.writeStream.format("parquet")
              .option("path", out_dir)
              .option("checkpointLocation", checkpoint or staging_path(spark, "stream_ckpt"))
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
