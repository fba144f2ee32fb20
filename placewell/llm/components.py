"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.session import scratch_dir


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again; cuts the lineage."""
    spark = frame.sparkSession
    place = scratch_dir(spark, label)
    frame.write.parquet(place)
    found = spark.read.parquet(place)
    found.stored_at = place
    return found


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: all that was made of them is stored itself."""
    for frame in frames:
        path = frame.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(frame.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``edges`` (src, dst).

    Each round hooks every node's root to the smallest root among its neighbours', then
    shortens the way to the root; the number of rounds grows with the logarithm of the
    longest way. The groupings are pre-aggregated before their shuffles. The joins bring
    one row per node to its edges; a node with very many of them, or the root of very many
    nodes, is split by adaptive execution. Nulls and loops are left out, repeated edges count once. No edges give no rows.
    """
    links = edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select("src", "dst").distinct()
    links = stored(links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), "edges")
    # The smallest neighbour first: most stars and pairs are done by that alone.
    roots = stored(links.groupBy("src").agg(F.min("dst").alias("low")).select(
        F.col("src").alias("node"), F.least("src", "low").alias("root")), "roots")
    before = roots
    while True:
        near = links.join(roots.select(F.col("node").alias("dst"), "root"), "dst").groupBy("src").agg(
            F.min("root").alias("near"))
        # A root learns of the smallest root next to any of its nodes, and of that one's own.
        best = roots.join(near.withColumnRenamed("src", "node"), "node").groupBy("root").agg(
            F.min(F.least("root", "near")).alias("low"))
        above = best.select(F.col("root").alias("low"), F.col("low").alias("lower"))
        moves = best.join(above, "low", "left").select("root", F.least("low", "lower").alias("next"))
        next_ = stored(roots.join(moves, "root").select(
            "node", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("moved")), "roots")
        discard(before)
        if next_.where("moved").isEmpty():
            discard(links)
            return next_.select("node", F.col("root").alias("component"))
        before, roots = next_, next_.drop("moved")
