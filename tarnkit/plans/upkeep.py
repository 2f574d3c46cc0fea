"""Statistics of a dataset's files that keep up with it: only new files are read, and those of files that are gone are dropped."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.operators.percentiles import merge_sketches, quantiles, sketch_of
from tarnkit.operators.quality import Suite, values_not_null
from tarnkit.operators.zones import _plain, zone_map
from tarnkit.plans.versions import VersionedTable
from tarnkit.session import local_rows

FILE = "file"
_FILES = T.StructType().add(FILE, T.StringType()).add("path", T.StringType())
QUARTILES = (0.25, 0.5, 0.75)


class FileStatistics:
    """Rows about each file of a Parquet dataset, kept as a versioned table under ``store``.

    ``measure`` turns rows of the dataset, with the file's name in column ``file``, into rows that have that column: some for each file. A refresh compares the files that
    are there with those that are known. New ones are measured, rows of gone ones are left out, all others are taken over as they are. The result is published like any other
    snapshot: written, audited (every row names its file), and only then seen; a refresh that dies leaves the earlier state. A file
    rewritten under its old name would go unnoticed; Spark's writers never do that. Names of files go through the driver, as whenever Spark lists a folder.
    """

    def __init__(self, spark: SparkSession, path: str, store: str, measure: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.measure = spark, path, measure
        self.table = VersionedTable(spark, store)

    def refresh(self, at: datetime) -> int:
        """Bring the statistics up to date; returns how many files were read. Nothing is published when no file came or went."""
        whole = self.spark.read.parquet(self.path)
        files = whole.inputFiles()
        here = local_rows(self.spark, [{FILE: _plain(f), "path": unquote(f)} for f in files], _FILES)
        old = self.table.read() if self.table.exists() else None
        new = here if old is None else here.join(old.select(FILE).distinct(), FILE, "left_anti")
        paths = [r.path for r in new.select("path").toLocalIterator()]
        parts = []
        if old is not None:
            kept = old.join(F.broadcast(here.select(FILE)), FILE, "left_semi")
            if not paths and old.select(FILE).distinct().count() == len(files):
                return 0
            parts.append(kept)
        if paths or old is None:
            rows = self.spark.read.schema(whole.schema).option("basePath", self.path).parquet(*paths) if paths else whole.limit(0)
            parts.append(self.measure(rows.withColumn(FILE, self._name())))
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        self.table.publish(out, Suite("file_statistics", (values_not_null(FILE),)), at)
        return len(paths)

    @staticmethod
    def _name():
        """The name of a row's file, written as :func:`_plain` writes it."""
        return F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), r"^(\w+):/+", "$1:/")

    def read(self) -> DataFrame:
        """The rows of the last refresh."""
        return self.table.read()


def zone_statistics(spark: SparkSession, path: str, store: str, columns: Sequence[str]) -> FileStatistics:
    """A zone map by file that keeps up with its dataset (see :func:`~tarnkit.operators.zones.file_zone_map`)."""
    return FileStatistics(spark, path, store, lambda rows: zone_map(rows, columns, [FILE]))


def profile_statistics(spark: SparkSession, path: str, store: str, columns: Sequence[str], by: Sequence[str] = ()) -> FileStatistics:
    """The profile of number columns by file, and by the columns ``by``, as parts that can be merged (:func:`merged_profile`)."""
    return FileStatistics(spark, path, store, lambda rows: profile_parts(rows, columns, [FILE, *by]))


def profile_parts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """A row for each group of ``by`` and number column: counts, moments, extremes, and sketches of quantiles (KLL) and of distinct values (HLL).

    A group is reduced in the map tasks, so a group with most rows costs a task no more than another.
    """
    measures, cells = [], []
    for i, name in enumerate(columns):
        if not isinstance(df.schema[name].dataType, T.NumericType):
            raise ValueError(f"not a number column: {name}")
        value = F.col(f"`{name}`").cast("double")
        made = {
            "n": F.count(value),
            "n_null": F.count_if(value.isNull()),
            "mean": F.avg(value),
            # squared distances from the group's own mean
            "spread": F.var_pop(value) * F.count(value),
            "min": F.min(value),
            "max": F.max(value),
            "sketch": sketch_of(value),
            "kinds": F.hll_sketch_agg(value.cast("string"), F.lit(14)),
        }
        measures += [m.alias(f"{alias}_{i}") for alias, m in made.items()]
        cells.append(F.struct(F.lit(name).alias("column"), *(F.col(f"{alias}_{i}").alias(alias) for alias in made)))
    return df.groupBy(*by).agg(*measures).select(*by, F.inline(F.array(*cells)))


def merged_profile(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One profile of each column (and group of ``by``) from the parts of any files or groups: column, n, n_null, mean, stddev, min, p25, p50, p75, max, n_distinct.

    Counts, mean, deviation and extremes are those of the rows; quartiles are within about a thousandth of the rows in rank, distinct counts within about two percent. No row of the
    dataset is read.
    """
    totals = parts.groupBy(*by, "column").agg(
        F.sum("n").alias("n"),
        F.sum("n_null").alias("n_null"),
        (F.sum(F.col("mean") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
        # squared distances of the rows from their own part's mean
        F.sum("spread").alias("_within"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        merge_sketches("sketch").alias("_sketch"),
        F.hll_union_agg("kinds").alias("_kinds"),
    )
    # and of the parts' means from the mean of all
    keys = [*by, "column"]
    named = totals.select(*[F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)], F.col("mean").alias("_all"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_{i}"))
    apart = F.sum(F.col("n") * F.pow(F.col("mean") - F.col("_all"), F.lit(2)))
    between = parts.select(*keys, "n", "mean").join(named, same).groupBy(*[f"_{i}" for i in range(len(keys))]).agg(apart.alias("_between"))
    at = lambda k: F.get(quantiles(F.col("_sketch"), QUARTILES), F.lit(k))
    spread = F.sqrt((F.col("_within") + F.col("_between")) / F.nullif(F.col("n") - 1, F.lit(0)))
    return totals.join(between, same).select(
        *keys, "n", "n_null", "mean", spread.alias("stddev"), "min", at(0).alias("p25"), at(1).alias("p50"), at(2).alias("p75"), "max",
        F.hll_sketch_estimate("_kinds").alias("n_distinct"),
    )
