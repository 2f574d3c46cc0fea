"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkit.session import scratch_folder


#: Narrow rows that one task joins and groups in a moment.
SHORT = 100_000


def stored(df: DataFrame, label: str, slim: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts its lineage in a place that outlives executors. A ``slim`` table, of a few numbers a
    row, is written by two tasks a core at most, so that many shuffle partitions don't make as many small files."""
    folder = scratch_folder(df.sparkSession, label)
    if slim:
        df = df.coalesce(2 * max(1, df.sparkSession.sparkContext.defaultParallelism))
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def gathered(table: DataFrame) -> DataFrame:
    """A stored table as one partition if it counts at most SHORT rows, else as it is: joins and groups among such partitions
    need no shuffle. Only the plan differs, never the rows."""
    return table.coalesce(1) if table.count() <= SHORT else table


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) for every node of ``edges`` (a, b: bigint, a != b).

    Alternates two steps on the edge list until it no longer changes: each node ties its larger neighbours to its smallest
    neighbour, then its smaller neighbours to it. Both keep components as they are and turn them into stars;
    the rounds grow with the logarithm of the longest path. The list never grows and stays distributed; a node with very many neighbours
    is only ever aggregated to its minimum, which is combined before the shuffle. A list of at most SHORT edges is one
    partition (:func:`gathered`), where Spark needs no shuffle for the same steps.
    """
    links = stored(edges.select("a", "b").filter("a != b").distinct(), "edges", slim=True)
    before = None
    while True:
        links = gathered(links)
        links = stored(_tie(_tie(links, larger=True), larger=False), "edges", slim=True)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now == before:
            break
        before = now
    stars = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("label"))
    roots = stars.select(F.col("label").alias("node"), "label").distinct()
    return stars.unionByName(roots)


def _tie(links: DataFrame, larger: bool) -> DataFrame:
    low, high = F.least("a", "b"), F.greatest("a", "b")
    if larger:
        pairs = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"))
        pairs = pairs.select("p.a", "p.b")
    else:
        pairs = links.select(high.alias("a"), low.alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = pairs.join(least, "a")
    if larger:
        tied = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        # the node itself is tied to its smallest neighbour too
        tied = tied.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return tied.filter("a != b").distinct()
