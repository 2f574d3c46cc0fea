"""Registered queries: what each operator gives on the test tables, with the SQL it must equal.

Stand-ins for the trip columns: passenger count = l_quantity, pickup = l_shipdate or events.ts,
longitude and latitude = l_extendedprice and l_quantity. ``events`` serves as a snapshot log
(table = user_id, snapshot = event_id, committed_at = ts) and as an object inventory.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkit.functions import with_time_parts, with_zorder
from tarnkit.operators.asof import asof_join
from tarnkit.operators.changes import apply_changes
from tarnkit.operators.difference import with_copies
from tarnkit.operators.intervals import interval_join
from tarnkit.operators import quality
from tarnkit.operators.layout import gather_partitions, zorder_layout
from tarnkit.operators.merge import append_rows, merge
from tarnkit.operators.percentiles import to_long
from tarnkit.operators.profile import profile as profile_columns
from tarnkit.operators.records import keep_positive, with_bucket
from tarnkit.operators.retention import (
    cleanup_history as history_rows,
    expired_snapshots as find_expired,
    list_snapshots,
    snapshot_stats as count_snapshots,
    without_snapshots,
)
from tarnkit.operators.zones import file_zone_map, read_matching, zone_map as map_zones, zones_matching
from tarnkit.plans.transform import TripColumns, clean_trips, partition_range
from tarnkit.plans.transform import transform_trips as write_trips
from tarnkit.plans.upkeep import merged_profile, profile_statistics, zone_statistics
from tarnkit.plans.versions import VersionedTable, list_tables
from tarnkit.plans.versions import preview as first_rows
from tarnkit.session import scratch_folder
from tarnkit.sources.formats import DataFormat, convert_format, read_data, write_data
from tarnkit.sources.landing import describe_sources, land_datasets, stored_size, with_tier
from tarnkit.streaming.landing import land_stream, read_landed, stream_manifest
from tarnkit.streaming.late import LateSplit

AS_OF = datetime(2024, 1, 31)
LINEITEM_TRIPS = TripColumns("l_quantity", "l_shipdate", "l_extendedprice", "l_quantity")
LANDED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
FILE_FORMATS = (DataFormat.PARQUET, DataFormat.ORC, DataFormat.CSV, DataFormat.JSON)


def _path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, table))


# -- filters, derived columns, layout ---------------------------------------------------------


def filter_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_positive(_read(spark, sf_dir, "customer"), "c_acctbal")


def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_time_parts(_read(spark, sf_dir, "events"), "ts").select(
        "event_id", "pickup_date", "year", "month", "day", "hour"
    )


def bucket_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_bucket(_read(spark, sf_dir, "orders"), "o_custkey", 16).select("o_orderkey", "bucket")


def zorder_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_zorder(_read(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity").select(
        "l_extendedprice", "l_quantity", "z_order_col"
    )


def zorder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Z-order layout moves rows and keeps every one of them."""
    coded = with_zorder(_read(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity")
    return zorder_layout(coded, row_key=["l_orderkey", "l_partkey", "l_suppkey"])


def transform_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(_read(spark, sf_dir, "lineitem"), LINEITEM_TRIPS)


def transform_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole transform, written partitioned and read back."""
    out = scratch_folder(spark, "trips")
    done = write_trips(
        spark, _path(sf_dir, "lineitem"), out, partition_by=["year", "month"], columns=LINEITEM_TRIPS
    )
    return done.table


def partitioned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned write with gathered partitions, and a time range read through partition pruning."""
    out = scratch_folder(spark, "events")
    parts = ["year", "month", "day"]
    stamped = with_time_parts(_read(spark, sf_dir, "events"), "ts").drop("pickup_date")
    write_data(gather_partitions(stamped, parts), out, partition_by=parts)
    span = partition_range("ts", datetime(2024, 1, 5), datetime(2024, 1, 20))
    return spark.read.parquet(out).filter(span).drop("hour")


def partitioned_rows_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time range given in another zone; folders are those of UTC days."""
    out = scratch_folder(spark, "events-zoned")
    parts = ["year", "month", "day"]
    write_data(with_time_parts(_read(spark, sf_dir, "events"), "ts").drop("pickup_date"), out, partition_by=parts)
    tokyo = timezone(timedelta(hours=9))
    span = partition_range("ts", datetime(2024, 1, 5, 4, tzinfo=tokyo), datetime(2024, 1, 20, 4, tzinfo=tokyo))
    return spark.read.parquet(out).filter(span).drop("hour")


def transform_nothing_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transform whose every row is filtered out leaves an empty table of the right types."""
    source = scratch_folder(spark, "no-trips")
    write_data(_read(spark, sf_dir, "lineitem").withColumn("l_quantity", F.lit(-1.0)), source)
    out = scratch_folder(spark, "trips-empty")
    return write_trips(spark, source, out, partition_by=["year", "month"], columns=LINEITEM_TRIPS).table


def transform_overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second transform of one year's lines, at half the quantity, replaces that year's partitions alone."""
    lines = _read(spark, sf_dir, "lineitem")
    again = scratch_folder(spark, "lines-again")
    in_year = lines.filter(F.year("l_shipdate") == 1995)
    write_data(in_year.withColumn("l_quantity", F.col("l_quantity") / 2), again)
    out = scratch_folder(spark, "trips-again")
    common = {"partition_by": ["year", "month"], "columns": LINEITEM_TRIPS, "bounds": (0.0, 110_000.0, 0.0, 60.0)}
    write_trips(spark, _path(sf_dir, "lineitem"), out, **common)
    done = write_trips(spark, again, out, overwrite_partitions_only=True, **common)
    return done.table.drop("z_order_col")


def transform_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a transform observes of the rows it writes, and how many range parts a target file size gives."""
    size = stored_size(spark, _path(sf_dir, "lineitem"))[1]
    out = scratch_folder(spark, "trips-metrics")
    done = write_trips(
        spark, _path(sf_dir, "lineitem"), out, partition_by=[], columns=LINEITEM_TRIPS, target_file_bytes=-(-size // 5)
    )
    seen = done.metrics.get
    files = done.table.select(F.col("_metadata.file_path").alias("file")).distinct()
    return files.agg(F.count(F.lit(1)).alias("n_files")).select(
        F.lit(seen["n_rows"]).cast("bigint").alias("n_rows"), F.lit(seen["l_shipdate_nulls"]).cast("bigint").alias("no_date"), "n_files"
    )


# -- zone maps and statistics -----------------------------------------------------------------


def _monthly_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = with_time_parts(_read(spark, sf_dir, "lineitem"), "l_shipdate")
    return map_zones(stamped, ["l_extendedprice", "l_quantity", "l_shipdate"], ["year", "month"])


def zone_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly_zones(spark, sf_dir)


def zone_map_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = {"l_extendedprice": (104_000.0, None), "l_quantity": (10.0, 50.0)}
    return zones_matching(_monthly_zones(spark, sf_dir), ranges)


def zone_map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone map of a table's files, reduced to what does not depend on how they were cut."""
    zones = file_zone_map(spark, _path(sf_dir, "lineitem"), ["l_extendedprice"])
    return zones.agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("l_extendedprice_min").alias("l_extendedprice_min"),
        F.max("l_extendedprice_max").alias("l_extendedprice_max"),
    )


def read_matching_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that came after the zone map was made are read too."""
    orders = _read(spark, sf_dir, "orders")
    out = scratch_folder(spark, "orders-zones")
    early = F.col("o_orderkey") % 3 == 0
    orders.filter(early).repartitionByRange(4, "o_totalprice").write.parquet(out)
    zones = file_zone_map(spark, out, ["o_totalprice"])
    kept = scratch_folder(spark, "zones")
    write_data(zones, kept)
    orders.filter(~early).write.mode("append").parquet(out)
    return read_matching(spark, out, read_data(spark, kept, DataFormat.PARQUET), {"o_totalprice": (100_000.0, 150_000.0)})


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile_columns(_read(spark, sf_dir, "orders"), exact=True)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "p25", "p50", "p75")})


def profile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics in one pass, quartiles from sketches."""
    return profile_columns(_read(spark, sf_dir, "lineitem"))


def profile_sketch_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sketched quartiles of each column stand at their rank, give or take two thousandths of the rows."""
    lines = _read(spark, sf_dir, "lineitem")
    stats = profile_columns(lines).filter("p50 IS NOT NULL").select("column", "p25", "p50", "p75")
    cells = to_long(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_orderkey"]).filter("value IS NOT NULL")
    ranked = cells.join(F.broadcast(stats), "column").groupBy("column").agg(
        *[F.avg((F.col("value") < F.col(p)).cast("double")).alias(f"{p}_below") for p in ("p25", "p50", "p75")],
        *[F.avg((F.col("value") <= F.col(p)).cast("double")).alias(f"{p}_upto") for p in ("p25", "p50", "p75")],
    )
    near = lambda p, share: (F.col(f"{p}_below") <= share + 0.002) & (F.col(f"{p}_upto") >= share - 0.002)
    return ranked.select("column", (near("p25", 0.25) & near("p50", 0.5) & near("p75", 0.75)).alias("within"))


# -- quality ----------------------------------------------------------------------------------


def _suite() -> quality.Suite:
    return quality.trip_suite("l_quantity", "l_shipdate", "l_receiptdate")


def validate_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_suite(_read(spark, sf_dir, "lineitem"), _suite())


def validate_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overall(quality.run_suite(_read(spark, sf_dir, "lineitem"), _suite()))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quality.quarantine(_read(spark, sf_dir, "lineitem"), _suite())
    return bad.withColumn("reasons", F.array_join("reasons", ";"))


def gate_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate says of lines that break the suite."""
    try:
        quality.gate(quality.run_suite(_read(spark, sf_dir, "lineitem"), _suite()))
        passed = True
    except quality.QualityError:
        passed = False
    return _read(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("passed", F.lit(passed))


def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted(_read(spark, sf_dir, "lineitem"), _suite())


# -- formats and landing ----------------------------------------------------------------------


def read_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written in every format of this installation and read back with its schema."""
    orders = _read(spark, sf_dir, "orders")
    out = scratch_folder(spark, "formats")
    back = []
    for format in FILE_FORMATS:
        write_data(orders, f"{out}/{format.value}", format)
        rows = read_data(spark, f"{out}/{format.value}", format, orders.schema)
        back.append(rows.withColumn("format", F.lit(format.value)))
    union = back[0]
    for rows in back[1:]:
        union = union.unionByName(rows)
    return union


def convert_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet to CSV to ORC to JSON and back to Parquet."""
    schema = _read(spark, sf_dir, "orders").schema
    out = scratch_folder(spark, "convert")
    steps = [DataFormat.PARQUET, DataFormat.CSV, DataFormat.ORC, DataFormat.JSON, DataFormat.PARQUET]
    here = _path(sf_dir, "orders")
    for i, (before, after) in enumerate(zip(steps, steps[1:])):
        convert_format(spark, here, f"{out}/{i}", before, after, schema)
        here = f"{out}/{i}"
    return read_data(spark, here, DataFormat.PARQUET)


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_sources({f"raw/{t}.parquet": _read(spark, sf_dir, t) for t in LANDED})


def landed_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets landed under a prefix, with their manifest."""
    sources = [_path(sf_dir, t) for t in LANDED]
    manifest = land_datasets(spark, sources, scratch_folder(spark, "landing"), AS_OF)
    return manifest.select("object_name", "content_type", "ingestion_time", "n_rows")


def landing_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = _read(spark, sf_dir, "events").select(
        F.concat(F.when(F.col("event_type") == "error", "logs/").otherwise("raw/"), "event_type").alias("path"),
        "event_id",
        F.col("ts").alias("stored_at"),
    )
    return with_tier(objects, "path", "stored_at", AS_OF)


# -- merge ------------------------------------------------------------------------------------


def _moved_orders(orders: DataFrame) -> DataFrame:
    """Changes for orders: every order under a key 5,000 higher, at twice its price."""
    return orders.select(
        (F.col("o_orderkey") + 5000).alias("o_orderkey"),
        "o_custkey",
        "o_orderdate",
        (F.col("o_totalprice") * 2).alias("price"),
    )


UPDATE = {"o_totalprice": "source.price", "o_orderstatus": "concat('was ', target.o_orderstatus)"}
INSERT = {
    "o_orderkey": "source.o_orderkey",
    "o_custkey": "source.o_custkey",
    "o_totalprice": "price",
    "o_orderdate": "source.o_orderdate",
}


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    return merge(orders, _moved_orders(orders), ["o_orderkey"], UPDATE, INSERT)


def merge_upsert_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge with a source taken to be too large to broadcast."""
    orders = _read(spark, sf_dir, "orders")
    return merge(orders, _moved_orders(orders), ["o_orderkey"], UPDATE, INSERT, broadcast_source=False)


def merge_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match is a condition with more than key equality."""
    orders = _read(spark, sf_dir, "orders")
    condition = "target.o_orderkey = source.o_orderkey AND source.price > target.o_totalprice"
    return merge(orders, _moved_orders(orders), condition, UPDATE, INSERT)


def merge_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals replaced by the quantity on their lines; many target rows per source key."""
    lines = _read(spark, sf_dir, "lineitem")
    per_part = lines.groupBy("l_partkey").agg(F.sum("l_quantity").alias("sold"))
    return merge(lines, per_part, ["l_partkey"], when_matched={"l_quantity": "source.sold"})


def _hot_lines(lines: DataFrame) -> DataFrame:
    """Lines under an INT key, of which one holds two fifths of all rows."""
    key = F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_partkey")).cast("int")
    return lines.select("l_orderkey", "l_linenumber", key.alias("key"), "l_extendedprice")


HOT = {"broadcast_source": False, "pieces": 10, "min_rows": 10}


def merge_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hot target key of another type than the source's (INT and BIGINT), split over tasks."""
    parts = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), "p_retailprice")
    return merge(
        _hot_lines(_read(spark, sf_dir, "lineitem")),
        parts,
        ["key"],
        when_matched={"l_extendedprice": "source.p_retailprice"},
        when_not_matched={"key": "source.key", "l_extendedprice": "source.p_retailprice"},
        **HOT,
    )


def merge_hot_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hot source key of another type than the target's: nothing it matches is inserted."""
    parts = _read(spark, sf_dir, "part").filter(F.col("p_size") <= 25).select(F.col("p_partkey").alias("key"), "p_size")
    lines = _hot_lines(_read(spark, sf_dir, "lineitem"))
    return merge(parts, lines, ["key"], when_not_matched={"key": "source.key", "p_size": "source.l_linenumber"}, **HOT)


def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers joined by suppliers under keys no customer has yet; shared keys are left alone."""
    customers = _read(spark, sf_dir, "customer")
    suppliers = _read(spark, sf_dir, "supplier").withColumn("key", F.col("s_suppkey") * 20)
    return merge(
        customers,
        suppliers,
        {"c_custkey": "key"},
        when_not_matched={
            "c_custkey": "key",
            "c_name": "s_name",
            "c_nationkey": "source.s_nationkey",
            "c_acctbal": "source.s_acctbal",
        },
    )


def append_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _read(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal")
    )
    customers = _read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    return append_rows(suppliers, customers)


# -- versions and retention -------------------------------------------------------------------


def _orders_by_year(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Snapshot 1 holds the orders up to 1997, snapshot 2 all of them."""
    orders = _read(spark, sf_dir, "orders")
    table = VersionedTable(spark, scratch_folder(spark, "orders"))
    table.commit(orders.filter(F.year("o_orderdate") <= 1997), datetime(2024, 1, 1), snapshot_id=1)
    table.commit(orders, datetime(2024, 1, 2), snapshot_id=2)
    return table


def read_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_year(spark, sf_dir).read()


def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_year(spark, sf_dir).read(1)


def table_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_year(spark, sf_dir).log()


def published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, audit, publish, then read what was published."""
    suite = quality.Suite("orders").add(quality.column_exists("o_orderkey")).add(quality.values_not_null("o_orderdate"))
    table = VersionedTable(spark, scratch_folder(spark, "published"))
    table.publish(_read(spark, sf_dir, "orders"), suite, AS_OF)
    return table.read()


def published_after_rejection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that fail the audit, then good ones at the same time: these are published."""
    suite = quality.Suite("orders").add(quality.values_not_null("o_custkey"))
    table = VersionedTable(spark, scratch_folder(spark, "republished"))
    orders = _read(spark, sf_dir, "orders")
    try:
        table.publish(orders.withColumn("o_custkey", F.lit(None).cast("bigint")), suite, AS_OF)
    except quality.QualityError:
        table.publish(orders, suite, AS_OF)
    return table.read()


def time_travel_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition columns come back as written: text with leading zeros, BIGINT."""
    orders = _read(spark, sf_dir, "orders").select(
        F.lpad((F.col("o_custkey") % 7).cast("string"), 3, "0").alias("code"),
        (F.col("o_orderkey") % 3).alias("third"),
        "o_orderkey",
        "o_totalprice",
    )
    table = VersionedTable(spark, scratch_folder(spark, "by-code"))
    table.commit(orders, datetime(2024, 1, 1), snapshot_id=1, partition_by=["code", "third"])
    table.commit(orders.limit(0), datetime(2024, 1, 2), snapshot_id=2, partition_by=["code", "third"])
    return table.read(1).unionAll(table.read())


def expired_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of a table of whose six snapshots the oldest have expired."""
    table = VersionedTable(spark, scratch_folder(spark, "expiring"))
    nation = _read(spark, sf_dir, "nation")
    for day in range(1, 7):
        table.commit(nation, datetime(2024, 1, day))
    removed = table.expire(AS_OF)
    return table.history().withColumn("removed", F.lit(removed))


def listed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of the session's catalog."""
    for name in ("nation", "region"):
        _read(spark, sf_dir, name).createOrReplaceTempView(f"listed_{name}")
    return list_tables(spark).filter(F.col("name").startswith("listed_")).select("name", "table_type", "is_temporary")


def upserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge committed as a new snapshot of a versioned table."""
    orders = _read(spark, sf_dir, "orders")
    table = VersionedTable(spark, scratch_folder(spark, "upserted"))
    table.upsert(orders, ["o_orderkey"], datetime(2024, 1, 1))
    table.upsert(_moved_orders(orders), ["o_orderkey"], datetime(2024, 1, 2), UPDATE, INSERT)
    return table.read()


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(_read(spark, sf_dir, "orders"), ["o_orderkey"], 5)


EVENT_LOG = {"table": ["user_id"], "id": "event_id", "at": "ts"}


def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_snapshots(_read(spark, sf_dir, "events"), **EVENT_LOG)


def expired_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = list_snapshots(_read(spark, sf_dir, "events"), **EVENT_LOG)
    return find_expired(log, AS_OF, **EVENT_LOG)


def expired_null_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null table name is a table like any other."""
    log = _read(spark, sf_dir, "events").withColumn("user_id", F.nullif(F.col("user_id") % 5, F.lit(0)))
    return find_expired(list_snapshots(log, **EVENT_LOG), AS_OF, **EVENT_LOG)


def snapshot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_snapshots(_read(spark, sf_dir, "events"), AS_OF, **EVENT_LOG)


def snapshot_stats_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log taken as that of one table."""
    return count_snapshots(_read(spark, sf_dir, "events"), AS_OF, id="event_id", at="ts")


def retained_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    gone = find_expired(list_snapshots(events, **EVENT_LOG), AS_OF, **EVENT_LOG)
    return without_snapshots(events, gone, ["user_id", "event_id"])


def cleanup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = find_expired(_read(spark, sf_dir, "events"), AS_OF, **EVENT_LOG)
    return history_rows(gone, AS_OF, **EVENT_LOG)


# -- streams, change logs, as-of joins --------------------------------------------------------

ARRIVALS = 4


def _arrivals(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    """Events with the number of the ``arrival`` they come with: a quarter of the ids each; some come one or two quarters ``late``."""
    events = _read(spark, sf_dir, "events")
    ends = events.agg(F.max("event_id").alias("last"))
    quarter = F.floor(F.col("event_id") * ARRIVALS / (F.col("last") + 1)).cast("int")
    if late:
        quarter = F.least(quarter + F.when(F.col("event_id") % 17 == 0, 2).when(F.col("event_id") % 11 == 0, 1).otherwise(0), F.lit(ARRIVALS - 1))
    # one row
    return events.crossJoin(F.broadcast(ends)).withColumn("arrival", quarter).drop("last")


def _arrive(spark: SparkSession, sf_dir: str, late: bool, handle: Callable[[str], None]) -> str:
    """Put one arrival after the other in a folder and have each handled before the next comes."""
    folder = scratch_folder(spark, "arriving")
    rows = _arrivals(spark, sf_dir, late)
    for number in range(ARRIVALS):
        rows.filter(F.col("arrival") == number).drop("arrival").write.parquet(f"{folder}/part{number}")
        handle(f"{folder}/part*")
    return f"{folder}/part*"


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """Events landed as they arrive; then once more by a stream that knows nothing of the first, as when a checkpoint is lost."""
    lake, schema = scratch_folder(spark, "streamed"), _read(spark, sf_dir, "events").schema

    def land(arriving: str, checkpoint: str) -> None:
        land_stream(spark, arriving, schema, lake, "events", checkpoint, clock=lambda: AS_OF).awaitTermination()

    first, second = scratch_folder(spark, "checkpoint"), scratch_folder(spark, "checkpoint")
    land(_arrive(spark, sf_dir, False, lambda arriving: land(arriving, first)), second)
    return lake


def streamed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What has landed after four arrivals and a second stream over the same files."""
    return read_landed(spark, _streamed(spark, sf_dir), "events", _read(spark, sf_dir, "events").schema)


def streamed_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of that stream, by arrival."""
    manifest = stream_manifest(spark, _streamed(spark, sf_dir), "events")
    part = F.regexp_extract("source_url", r"/part(\d+)/", 1).cast("int")
    return manifest.groupBy(part.alias("arrival"), "object_name", "content_type", "ingestion_time").agg(F.sum("n_rows").alias("n_rows"))


def _late_split(spark: SparkSession, sf_dir: str) -> tuple[LateSplit, DataFrame]:
    """Events that arrive out of order, parted by day with a delay of a day."""
    events = _read(spark, sf_dir, "events")
    split = LateSplit(spark, scratch_folder(spark, "late"), "ts", timedelta(days=1), timedelta(days=1))
    checkpoint = scratch_folder(spark, "checkpoint")

    def part(arriving: str) -> None:
        split.start(spark.readStream.schema(events.schema).parquet(arriving), checkpoint).awaitTermination()

    _arrive(spark, sf_dir, True, part)
    return split, events


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events whose day was over when they came, with the batch that brought them."""
    split, events = _late_split(spark, sf_dir)
    return split.late(events.schema)


def in_time_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in time by day, after two arrivals and after all four."""
    split, events = _late_split(spark, sf_dir)
    rows = split.in_time(events.schema).select(F.to_date("ts").alias("day"), "batch")
    cuts = rows.select("day", F.explode(F.array(F.lit(2), F.lit(4))).alias("cut"), "batch").filter("batch < cut")
    return cuts.groupBy("cut", "day").agg(F.count(F.lit(1)).alias("n_rows"))


def _change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of customers, two in five of them of customer 1; an error deletes."""
    key = F.when(F.col("event_id") % 5 < 2, F.lit(1)).otherwise(F.col("user_id")).cast("bigint")
    return _read(spark, sf_dir, "events").withColumn("key", key)


CHANGED = {"c_custkey": "source.key", "c_name": "source.event_type", "c_acctbal": "source.value"}


def changed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after all events, in order of time and id."""
    return apply_changes(
        _read(spark, sf_dir, "customer"), _change_log(spark, sf_dir), {"c_custkey": "key"}, ["ts", "event_id"], "source.event_type = 'error'", CHANGED
    )


def changed_customers_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with nothing broadcast and hot keys split."""
    return apply_changes(
        _read(spark, sf_dir, "customer"), _change_log(spark, sf_dir), {"c_custkey": "key"}, ["ts", "event_id"], "source.event_type = 'error'", CHANGED,
        broadcast_changes=False, min_rows=10,
    )


def changed_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target with many rows for each key, a third of them under one: changes by part reach every row, and old ones none."""
    items = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") <= 2, 1).otherwise(F.col("l_partkey")).cast("bigint").alias("part"), "l_extendedprice",
        F.col("l_shipdate").cast("timestamp_ntz").alias("since"),
    )
    changes = _read(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_retailprice", (F.lit("1992-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(p_size * 50)")).alias("moment")
    )
    return apply_changes(
        items, changes, {"part": "p_partkey"}, ["moment"], "source.p_size % 10 = 0", {"part": "source.p_partkey", "l_extendedprice": "source.p_retailprice", "since": "source.moment"},
        target_sequence=["since"], broadcast_changes=False, min_rows=100,
    )


def changed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A versioned table that takes the events in two parts, the second one holding the first again."""
    table = VersionedTable(spark, scratch_folder(spark, "changed"))
    customers = _read(spark, sf_dir, "customer").withColumns({"ts": F.lit(None).cast("timestamp_ntz"), "event_id": F.lit(None).cast("bigint")})
    table.commit(customers, AS_OF)
    log = _change_log(spark, sf_dir).filter("event_type <> 'error'")
    values = CHANGED | {"ts": "source.ts", "event_id": "source.event_id"}
    for day, part in ((1, log.filter("event_id % 2 = 0")), (2, log)):
        table.apply(part, {"c_custkey": "key"}, ["ts", "event_id"], AS_OF + timedelta(days=day), "false", values, target_sequence=["ts", "event_id"])
    return table.read()


def asof_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the newest purchase of its user at or before it."""
    events = _read(spark, sf_dir, "events")
    bought = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    return asof_join(events.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "ts", "p_")


def asof_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with half of all events under one key, whose rows are cut into ranges of time."""
    hot = F.when(F.col("event_id") % 2 == 0, F.lit(-1)).otherwise(F.col("user_id")).cast("bigint")
    events = _read(spark, sf_dir, "events").withColumn("user_id", hot)
    bought = events.filter("event_type = 'purchase' AND event_id % 7 = 0").select("user_id", "ts", "event_id", "value")
    return asof_join(events.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "ts", "p_", pieces=20, min_rows=10)


# -- intervals, differences, statistics that keep up, checks over rows ------------------------


def _spans(events: DataFrame, kind: str, hours: int) -> DataFrame:
    """Events of a kind as spans of time that begin with them, of up to ``hours`` hours times their value."""
    length = F.expr(f"make_dt_interval(0, {hours} * int(value))")
    return events.filter(F.col("event_type") == kind).select("event_id", "user_id", F.col("ts").alias("since"), (F.col("ts") + length).alias("till"))


def overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of one user's views and purchases that overlap."""
    events = _read(spark, sf_dir, "events")
    return interval_join(_spans(events, "view", 2), _spans(events, "purchase", 1), ("since", "till"), ("since", "till"), ["user_id"], "p_")


def overlapping_hot_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors, as points of time, within the spans of purchases, whoever's; bins with many errors are split."""
    events = _read(spark, sf_dir, "events")
    points = events.filter("event_type = 'error'").select("event_id", "ts")
    spans = _spans(events, "purchase", 1).drop("user_id")
    return interval_join(points, spans, ("ts", "ts"), ("since", "till"), prefix="p_", pieces=50, min_rows=3).select("event_id", "p_event_id")


def snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that one of two snapshots has more often than the other; some rows are repeated, some keys null."""
    orders = _read(spark, sf_dir, "orders").withColumn("o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderkey")))
    before = orders.filter("o_custkey % 10 <> 0").unionByName(orders.filter("o_custkey % 7 = 0"))
    doubled = F.when(F.col("o_custkey") % 5 == 0, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    after = orders.filter("o_custkey % 11 <> 0").withColumn("o_totalprice", doubled)
    after = after.unionByName(orders.filter("o_custkey % 14 = 0")).unionByName(orders.filter("o_custkey % 14 = 0"))
    table = VersionedTable(spark, scratch_folder(spark, "compared"))
    table.commit(before, AS_OF)
    table.commit(after, AS_OF + timedelta(days=1))
    return with_copies(table.difference(1, 2, ["o_orderkey"]))


def _growing(spark: SparkSession, sf_dir: str, refresh: Callable[[str, int], None]) -> None:
    """Orders in three partitions, of which one is added and one written again between two refreshes."""
    path = scratch_folder(spark, "growing")
    orders = _read(spark, sf_dir, "orders").withColumn("third", F.col("o_orderkey") % 3)
    orders.filter("third < 2").write.partitionBy("third").parquet(path)
    refresh(path, 0)
    orders.filter("third = 2").write.mode("append").partitionBy("third").parquet(path)
    again = orders.filter("third = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("third").parquet(path)
    refresh(path, 1)


def zones_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone map after an append and an overwritten partition, put together by partition."""
    store = scratch_folder(spark, "zones")
    kept = []

    def refresh(path: str, day: int) -> None:
        kept.append(zone_statistics(spark, path, store, ["o_totalprice"]))
        kept[-1].refresh(AS_OF + timedelta(days=day))

    _growing(spark, sf_dir, refresh)
    third = F.regexp_extract("file", "third=([0-9])", 1).cast("int")
    low, high = F.min("o_totalprice_min").alias("o_totalprice_min"), F.max("o_totalprice_max").alias("o_totalprice_max")
    return kept[-1].read().groupBy(third.alias("third")).agg(F.sum("n_rows").alias("n_rows"), low, high)


def profile_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile merged from stored parts after the same changes; ``within``: quartiles are within half a percent of the rows in rank."""
    store = scratch_folder(spark, "profile")
    paths, kept = [], []

    def refresh(path: str, day: int) -> None:
        paths.append(path)
        kept.append(profile_statistics(spark, path, store, ["o_totalprice", "o_custkey"]))
        kept[-1].refresh(AS_OF + timedelta(days=day))

    _growing(spark, sf_dir, refresh)
    merged = merged_profile(kept[-1].read())
    quartiles = [(k, f"p{25 * k}") for k in (1, 2, 3)]
    # a row for each column
    ranks = to_long(spark.read.parquet(paths[-1]), ["o_totalprice", "o_custkey"]).join(F.broadcast(merged.select("column", "n", "p25", "p50", "p75")), "column")
    ranks = ranks.groupBy("column", "n").agg(*[x.alias(f"{name}_{p}") for _, p in quartiles for name, x in (("under", F.count_if(F.col("value") < F.col(p))), ("upto", F.count_if(F.col("value") <= F.col(p))))])
    within = F.lit(True)
    for k, p in quartiles:
        within = within & (F.col(f"under_{p}") <= F.col("n") * (k / 4 + 0.005)) & (F.col(f"upto_{p}") >= F.col("n") * (k / 4 - 0.005))
    return merged.join(ranks.select("column", within.alias("within")), "column").select(
        "column", "n", "n_null", F.round("mean", 6).alias("mean"), F.round("stddev", 4).alias("stddev"), "min", "max", "within"
    )


ROWS_SUITE = quality.Suite(
    "rows",
    (
        quality.values_unique("o_orderkey"),
        quality.values_not_null("o_custkey"),
        quality.values_unique("o_custkey"),
        quality.values_in_table("o_custkey", "customer", "c_custkey"),
        quality.values_in_table("o_custkey", "supplier", "s_suppkey"),
    ),
)


def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that must be unique, or those of another table; some are null."""
    orders = _read(spark, sf_dir, "orders").withColumn("o_custkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")))
    return quality.run_suite(orders, ROWS_SUITE, {name: _read(spark, sf_dir, name) for name in ("customer", "supplier")})


def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose key is not unique; a third of all share one."""
    items = _read(spark, sf_dir, "lineitem").withColumn("key", F.when(F.col("l_linenumber") <= 2, 1).otherwise(F.col("l_orderkey") * 7 + F.col("l_linenumber")))
    return quality.unexpected_rows(items, quality.values_unique("key"), min_rows=100).select("l_orderkey", "l_linenumber", "l_partkey", "key")


def validate_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip checks by year and month, by year, and in all."""
    items = with_time_parts(_read(spark, sf_dir, "lineitem"), "l_shipdate")
    return quality.run_suite_by(items, quality.trip_suite("l_quantity", "l_shipdate", "l_receiptdate"), ["year", "month"])


def entry(spark: SparkSession) -> DataFrame:
    """The trip transform on the smallest tables."""
    return transform_trips(spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators and their pipeline, where these are installed."""
    if find_spec("tarnkit.llm") is None:
        return {}, {}
    from tarnkit.llm import queries as llm

    built, sql = dict(llm.QUERIES), dict(llm.ORACLE_SQL)
    if find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        built["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return built, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _training_data()[0] | {
        build.__name__: build
        for build in (
            filter_positive,
            time_parts,
            bucket_column,
            zorder_code,
            zorder_rows,
            transform_trips,
            transform_written,
            partitioned_rows,
            partitioned_rows_zoned,
            transform_nothing_left,
            transform_overwrite_partitions,
            transform_metrics,
            zone_map,
            zone_map_prune,
            zone_map_files,
            read_matching_appended,
            profile,
            profile_sketch,
            profile_sketch_error,
            validate_suite,
            validate_overall,
            quarantine_rows,
            accepted_rows,
            gate_result,
            read_formats,
            convert_roundtrip,
            landing_manifest,
            landed_datasets,
            landing_tiers,
            merge_upsert,
            merge_upsert_large,
            merge_condition,
            merge_hot_key,
            merge_hot_source,
            merge_update_only,
            merge_insert_only,
            append_merge_schema,
            read_latest,
            time_travel,
            table_log,
            published_orders,
            upserted_orders,
            published_after_rejection,
            time_travel_partitioned,
            expired_table,
            listed_tables,
            preview,
            snapshot_log,
            expired_snapshots,
            expired_null_table,
            snapshot_stats,
            snapshot_stats_single,
            retained_rows,
            cleanup_history,
            streamed_rows,
            streamed_manifest,
            late_rows,
            in_time_counts,
            changed_customers,
            changed_customers_large,
            changed_lineitems,
            changed_table,
            asof_purchases,
            asof_hot_key,
            overlapping_spans,
            overlapping_hot_bins,
            snapshot_difference,
            zones_kept_up,
            profile_kept_up,
            validate_rows,
            repeated_keys,
            validate_by_month,
        )
    }


# -- the same results in SQL ------------------------------------------------------------------


def _spread_sql(axis: str) -> str:
    """The 16 bits of a scaled axis moved to every second place, as a sum of powers of four."""
    return " + ".join(f"(({axis} >> {bit}) & 1) * {4**bit}" for bit in range(16))


def _zorder_sql(x: str, y: str, table: str) -> str:
    """Rows of a table with their ``z_order_col``."""
    scale = "CAST(floor(({0} - {1}0) / ({1}1 - {1}0) * 65535) AS BIGINT)"
    return (
        f"SELECT * EXCLUDE (sx, sy), CAST(({_spread_sql('sx')}) + 2 * ({_spread_sql('sy')}) AS BIGINT) AS z_order_col "
        f"FROM (SELECT t.*, {scale.format(x, 'x')} AS sx, {scale.format(y, 'y')} AS sy "
        f"FROM {table} t, (SELECT min({x}) x0, max({x}) x1, min({y}) y0, max({y}) y1 FROM {table}) b) s"
    )


def _profile_sql(table: str, numbers: list[str], texts: list[str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_null,
                round(avg({c}::DOUBLE), 6) AS mean, round(stddev_samp({c}::DOUBLE), 6) AS stddev,
                min({c})::DOUBLE AS "min",
                round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25,
                round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
                round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, max({c})::DOUBLE AS "max",
                NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM {table}"""
        for c in numbers
    ]
    parts += [
        f"""SELECT '{c}', count({c}), count(*) - count({c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
                min({c})::VARCHAR, max({c})::VARCHAR FROM {table}"""
        for c in texts
    ]
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    parts_of = lambda c: (
        f"year({c})::INT AS year, month({c})::INT AS month, day({c})::INT AS day, hour({c})::INT AS hour"
    )
    coded = _zorder_sql("l_extendedprice", "l_quantity", "lineitem")
    trips = _zorder_sql(
        "l_extendedprice",
        "l_quantity",
        f"(SELECT *, l_shipdate AS pickup_date, {parts_of('l_shipdate')} FROM lineitem WHERE l_quantity > 0)",
    )
    zones = f"""
        SELECT year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month, count(*) AS n_rows,
               min(l_extendedprice) AS l_extendedprice_min, max(l_extendedprice) AS l_extendedprice_max,
               count(*) FILTER (l_extendedprice IS NULL) AS l_extendedprice_nulls,
               min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max,
               count(*) FILTER (l_quantity IS NULL) AS l_quantity_nulls,
               min(l_shipdate) AS l_shipdate_min, max(l_shipdate) AS l_shipdate_max,
               count(*) FILTER (l_shipdate IS NULL) AS l_shipdate_nulls
        FROM lineitem GROUP BY 1, 2"""
    suite = f"""
        WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_quantity IS NULL) AS no_quantity,
                          count(*) FILTER (l_quantity < 1 OR l_quantity > 8) AS out_of_range,
                          count(*) FILTER (l_shipdate IS NULL) AS no_date FROM lineitem)
        SELECT 0::INT AS position, '{quality.COLUMN_EXISTS}' AS expectation, 'l_quantity' AS column_name,
               NULL::BIGINT AS element_count, NULL::BIGINT AS null_count, NULL::BIGINT AS unexpected_count,
               true AS success
        UNION ALL SELECT 1, '{quality.VALUES_BETWEEN}', 'l_quantity', n, no_quantity, out_of_range,
                         out_of_range = 0 FROM c
        UNION ALL SELECT 2, '{quality.COLUMN_EXISTS}', 'l_shipdate', NULL, NULL, NULL, true
        UNION ALL SELECT 3, '{quality.COLUMN_EXISTS}', 'l_receiptdate', NULL, NULL, NULL, false
        UNION ALL SELECT 4, '{quality.VALUES_NOT_NULL}', 'l_shipdate', n, no_date, no_date, no_date = 0 FROM c"""
    changes = """(SELECT o_orderkey + 5000 AS o_orderkey, o_custkey, o_orderdate, o_totalprice * 2 AS price
                  FROM orders)"""

    def upsert(more: str = "") -> str:
        match = f"t.o_orderkey = s.o_orderkey {more}"
        return f"""
            SELECT t.o_orderkey, t.o_custkey,
                   CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE 'was ' || t.o_orderstatus END
                       AS o_orderstatus,
                   coalesce(s.price, t.o_totalprice) AS o_totalprice, t.o_orderdate, t.o_orderpriority
            FROM orders t LEFT JOIN {changes} s ON {match}
            UNION ALL
            SELECT s.o_orderkey, s.o_custkey, NULL, s.price, s.o_orderdate, NULL
            FROM {changes} s WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE {match})"""

    ranked = """
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) > 3
                  AND ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY AS expired
        FROM events"""
    quarter = "floor(event_id * 4 / ((SELECT max(event_id) FROM events) + 1))::INT"
    arriving = f"""
        WITH e AS (SELECT *, least({quarter} + CASE WHEN event_id % 17 = 0 THEN 2 WHEN event_id % 11 = 0 THEN 1 ELSE 0 END, 3) AS batch FROM events),
             m AS (SELECT b.batch, date_trunc('day', max(ts) - INTERVAL 1 DAY) AS boundary FROM e, (SELECT DISTINCT batch FROM e) b WHERE e.batch < b.batch GROUP BY 1),
             a AS (SELECT e.*, coalesce(ts < boundary, false) AS late FROM e LEFT JOIN m ON m.batch = e.batch)"""
    change_log = "(SELECT *, CASE WHEN event_id % 5 < 2 THEN 1 ELSE user_id END AS key FROM events)"
    last_change = f"(SELECT * FROM {change_log} e QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) = 1)"
    changed = f"""
        SELECT c_custkey, coalesce(l.event_type, c_name) AS c_name, c_nationkey, coalesce(l.value, c_acctbal) AS c_acctbal, c_mktsegment
        FROM customer LEFT JOIN {last_change} l ON l.key = c_custkey WHERE l.event_type IS DISTINCT FROM 'error'
        UNION ALL
        SELECT key, event_type, NULL, value, NULL FROM {last_change} l WHERE event_type <> 'error' AND key NOT IN (SELECT c_custkey FROM customer)"""

    def asof(key: str, bought: str) -> str:
        events = f"(SELECT event_id, {key} AS user_id, ts, value, event_type FROM events)"
        return f"""
            SELECT e.event_id, e.user_id, e.ts, p.ts AS p_ts, p.event_id AS p_event_id, p.value AS p_value
            FROM {events} e ASOF LEFT JOIN (SELECT * FROM {events} b WHERE event_type = 'purchase' AND {bought}) p
            ON e.user_id = p.user_id AND e.ts >= p.ts"""


    def spans(kind: str, hours: int) -> str:
        return f"""(SELECT event_id, user_id, ts AS since, ts + INTERVAL 1 HOUR * ({hours} * trunc(value)::INT) AS till, value
                    FROM events WHERE event_type = '{kind}')"""

    grown = "(SELECT o_orderkey % 3 AS third, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_custkey FROM orders)"

    def kept_up(c: str) -> str:
        return f"""
        SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_null, round(avg({c}::DOUBLE), 6) AS mean,
               round(stddev_samp({c}::DOUBLE), 4) AS stddev, min({c})::DOUBLE AS "min", max({c})::DOUBLE AS "max", true AS within FROM {grown} g"""

    row_checks = [
        (quality.VALUES_UNIQUE, "o_orderkey", "o_orderkey IN (SELECT o_orderkey FROM o GROUP BY 1 HAVING count(*) > 1)"),
        (quality.VALUES_NOT_NULL, "o_custkey", "o_custkey IS NULL"),
        (quality.VALUES_UNIQUE, "o_custkey", "o_custkey IN (SELECT o_custkey FROM o GROUP BY 1 HAVING count(*) > 1)"),
        (quality.VALUES_IN_TABLE, "o_custkey", "o_custkey NOT IN (SELECT c_custkey FROM customer)"),
        (quality.VALUES_IN_TABLE, "o_custkey", "o_custkey NOT IN (SELECT s_suppkey FROM supplier)"),
    ]
    months = [
        (quality.COLUMN_EXISTS, "l_quantity", "NULL", "NULL", "NULL", "true"),
        (quality.VALUES_BETWEEN, "l_quantity", "count(*)", "count(*) - count(l_quantity)", "count(*) FILTER (l_quantity < 1 OR l_quantity > 8)", "count(*) FILTER (l_quantity < 1 OR l_quantity > 8) = 0"),
        (quality.COLUMN_EXISTS, "l_shipdate", "NULL", "NULL", "NULL", "true"),
        (quality.COLUMN_EXISTS, "l_receiptdate", "NULL", "NULL", "NULL", "false"),
        (quality.VALUES_NOT_NULL, "l_shipdate", "count(*)", *["count(*) FILTER (l_shipdate IS NULL)"] * 2, "count(*) FILTER (l_shipdate IS NULL) = 0"),
    ]
    stats = "count(*) AS total, count(*) FILTER (expired) AS expired, count(*) FILTER (NOT expired) AS active"
    return _training_data()[1] | {
        "filter_positive": "SELECT * FROM customer WHERE c_acctbal > 0",
        "time_parts": f"SELECT event_id, ts AS pickup_date, {parts_of('ts')} FROM events",
        "bucket_column": "SELECT o_orderkey, (o_custkey % 16)::INT AS bucket FROM orders",
        "zorder_code": f"SELECT l_extendedprice, l_quantity, z_order_col FROM ({coded}) q",
        "zorder_rows": coded,
        "transform_trips": trips,
        "transform_written": trips,
        "partitioned_rows": f"""
            SELECT * EXCLUDE (hour) FROM (SELECT *, {parts_of('ts')} FROM events) e
            WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""",
        "partitioned_rows_zoned": f"""
            SELECT * EXCLUDE (hour) FROM (SELECT *, {parts_of('ts')} FROM events) e
            WHERE ts BETWEEN TIMESTAMP '2024-01-04 19:00:00' AND TIMESTAMP '2024-01-19 19:00:00'""",
        "transform_nothing_left": f"SELECT * FROM ({trips}) t WHERE false",
        "transform_overwrite_partitions": f"""
            SELECT * EXCLUDE (l_quantity), CASE WHEN year = 1995 THEN l_quantity / 2 ELSE l_quantity END AS l_quantity
            FROM (SELECT *, l_shipdate AS pickup_date, {parts_of('l_shipdate')} FROM lineitem WHERE l_quantity > 0) t""",
        "transform_metrics": """
            SELECT count(*) AS n_rows, count(*) FILTER (l_shipdate IS NULL) AS no_date, 5::BIGINT AS n_files
            FROM lineitem WHERE l_quantity > 0""",
        "read_matching_appended": "SELECT * FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000",
        "gate_result": f"SELECT count(*) AS n_rows, (SELECT bool_and(success) FROM ({suite}) s) AS passed FROM lineitem",
        "merge_hot_key": """
            WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey END::INT AS key,
                              l_extendedprice FROM lineitem)
            SELECT l_orderkey, l_linenumber, key, coalesce(p_retailprice, l_extendedprice) AS l_extendedprice
            FROM t LEFT JOIN part ON key = p_partkey
            UNION ALL SELECT NULL, NULL, p_partkey::INT, p_retailprice FROM part
            WHERE p_partkey NOT IN (SELECT key FROM t WHERE key IS NOT NULL)""",
        "merge_hot_source": """
            WITH s AS (SELECT l_linenumber, CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey END AS key FROM lineitem),
                 t AS (SELECT p_partkey AS key, p_size FROM part WHERE p_size <= 25)
            SELECT * FROM t
            UNION ALL SELECT key::BIGINT, l_linenumber FROM s WHERE key NOT IN (SELECT key FROM t)""",
        "published_after_rejection": "SELECT * FROM orders",
        "time_travel_partitioned": """
            SELECT lpad((o_custkey % 7)::VARCHAR, 3, '0') AS code, o_orderkey % 3 AS third, o_orderkey, o_totalprice FROM orders""",
        "expired_table": """
            SELECT TIMESTAMP '2024-01-31' AS run_at, d::BIGINT AS snapshot_id,
                   TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (d - 1) AS created_at, 3::INT AS removed
            FROM range(1, 4) r(d)""",
        "streamed_rows": "SELECT * FROM events",
        "streamed_manifest": f"""
            SELECT {quarter} AS arrival, 'raw/events' AS object_name, 'application/parquet' AS content_type,
                   TIMESTAMP '2024-01-31' AS ingestion_time, count(*) AS n_rows FROM events GROUP BY 1""",
        "late_rows": f"{arriving} SELECT * EXCLUDE (late, batch), batch::BIGINT AS batch FROM a WHERE late",
        "in_time_counts": f"""{arriving}
            SELECT cut::INT AS cut, ts::DATE AS day, count(*) AS n_rows FROM a, (VALUES (2), (4)) c(cut) WHERE NOT late AND batch < cut GROUP BY ALL""",
        "changed_customers": changed,
        "changed_customers_large": changed,
        "changed_lineitems": """
            WITH i AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey END AS part, l_extendedprice, l_shipdate AS since FROM lineitem),
                 c AS (SELECT *, TIMESTAMP '1992-01-01' + INTERVAL 1 DAY * (p_size * 50) AS moment, p_size % 10 = 0 AS gone FROM part)
            SELECT l_orderkey, l_linenumber, part, CASE WHEN moment > since THEN p_retailprice ELSE l_extendedprice END AS l_extendedprice,
                   CASE WHEN moment > since THEN moment ELSE since END AS since
            FROM i LEFT JOIN c ON part = p_partkey WHERE NOT coalesce(gone AND moment > since, false)
            UNION ALL SELECT NULL, NULL, p_partkey, p_retailprice, moment FROM c WHERE NOT gone AND p_partkey NOT IN (SELECT part FROM i)""",
        "changed_table": f"""
            WITH l AS (SELECT * FROM {change_log} e WHERE event_type <> 'error'
                       QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) = 1)
            SELECT coalesce(c_custkey, key) AS c_custkey, coalesce(event_type, c_name) AS c_name, c_nationkey, coalesce(value, c_acctbal) AS c_acctbal,
                   c_mktsegment, ts, event_id
            FROM customer FULL JOIN l ON key = c_custkey""",
        "asof_purchases": asof("user_id", "true"),
        "asof_hot_key": asof("CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END", "event_id % 7 = 0"),
        "overlapping_spans": f"""
            SELECT v.event_id, v.user_id, v.since, v.till, p.event_id AS p_event_id, p.since AS p_since, p.till AS p_till
            FROM {spans("view", 2)} v JOIN {spans("purchase", 1)} p
            ON v.user_id = p.user_id AND v.since <= p.till AND p.since <= v.till""",
        "overlapping_hot_bins": f"""
            SELECT e.event_id, p.event_id AS p_event_id FROM (SELECT * FROM events WHERE event_type = 'error') e
            JOIN {spans("purchase", 1)} p ON e.ts BETWEEN p.since AND p.till""",
        "snapshot_difference": """
            WITH o AS (SELECT * REPLACE (CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS o_orderkey) FROM orders),
                 b AS (SELECT * FROM o WHERE o_custkey % 10 <> 0 UNION ALL SELECT * FROM o WHERE o_custkey % 7 = 0),
                 a AS (SELECT * REPLACE (CASE WHEN o_custkey % 5 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice) FROM o WHERE o_custkey % 11 <> 0
                       UNION ALL SELECT * FROM o WHERE o_custkey % 14 = 0 UNION ALL SELECT * FROM o WHERE o_custkey % 14 = 0),
                 d AS (SELECT 'before' AS side, * FROM (FROM b EXCEPT ALL FROM a) UNION ALL SELECT 'after', * FROM (FROM a EXCEPT ALL FROM b)),
                 k AS (SELECT o_orderkey, count(DISTINCT side) AS sides FROM d GROUP BY 1)
            SELECT CASE WHEN sides = 2 THEN 'changed' WHEN side = 'before' THEN 'deleted' ELSE 'inserted' END AS change, d.*
            FROM d JOIN k ON k.o_orderkey IS NOT DISTINCT FROM d.o_orderkey""",
        "zones_kept_up": f"""
            SELECT third::INT AS third, count(*) AS n_rows, min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max FROM {grown} g GROUP BY 1""",
        "profile_kept_up": f"{kept_up('o_totalprice')} UNION ALL {kept_up('o_custkey')}",
        "validate_rows": "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS o_custkey FROM orders) " + " UNION ALL ".join(
            f"""SELECT {k}::INT AS position, '{kind}' AS expectation, '{c}' AS column_name, count(*) AS element_count, count(*) - count({c}) AS null_count,
                       count(*) FILTER ({bad}) AS unexpected_count, count(*) FILTER ({bad}) = 0 AS success FROM o"""
            for k, (kind, c, bad) in enumerate(row_checks)
        ),
        "repeated_keys": """
            SELECT l_orderkey, l_linenumber, l_partkey, key FROM (
                SELECT *, CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_orderkey * 7 + l_linenumber END AS key FROM lineitem) t
            QUALIFY count(*) OVER (PARTITION BY key) > 1""",
        "validate_by_month": "WITH t AS (SELECT *, year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month FROM lineitem) " + " UNION ALL ".join(
            f"""SELECT year, month, (2 - grouping(year) - grouping(month))::INT AS level, {k}::INT AS position, '{kind}' AS expectation, '{c}' AS column_name,
                       {n}::BIGINT AS element_count, {nulls}::BIGINT AS null_count, {bad}::BIGINT AS unexpected_count, {ok} AS success
                FROM t GROUP BY ROLLUP (year, month)"""
            for k, (kind, c, n, nulls, bad, ok) in enumerate(months)
        ),
        "listed_tables": """
            SELECT name, 'TEMPORARY' AS table_type, true AS is_temporary
            FROM (VALUES ('listed_nation'), ('listed_region')) v(name)""",
        "expired_null_table": """
            SELECT user_id, event_id, ts FROM (
                SELECT nullif(user_id % 5, 0) AS user_id, event_id, ts,
                       row_number() OVER (PARTITION BY user_id % 5 ORDER BY ts DESC, event_id DESC) > 3
                       AND ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY AS expired FROM events) e WHERE expired""",
        "zone_map": zones,
        "zone_map_prune": f"""
            SELECT * FROM ({zones}) z
            WHERE l_extendedprice_max >= 104000 AND l_quantity_max >= 10 AND l_quantity_min <= 50""",
        "zone_map_files": """
            SELECT count(*)::BIGINT AS n_rows, min(l_extendedprice) AS l_extendedprice_min,
                   max(l_extendedprice) AS l_extendedprice_max FROM lineitem""",
        "profile": _profile_sql(
            "orders", ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderdate", "o_orderpriority"]
        ),
        "profile_sketch_error": """
            SELECT "column", count(*) > 0 AS within
            FROM lineitem, (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_orderkey')) v("column") GROUP BY 1""",
        "validate_suite": suite,
        "validate_overall": f"""
            SELECT count(*) AS evaluated, count(*) FILTER (NOT success) AS failed, bool_and(success) AS success
            FROM ({suite}) r""",
        "quarantine_rows": f"""
            SELECT *, concat_ws(';',
                CASE WHEN l_quantity < 1 OR l_quantity > 8 THEN '{quality.VALUES_BETWEEN}(l_quantity)' END,
                CASE WHEN l_shipdate IS NULL THEN '{quality.VALUES_NOT_NULL}(l_shipdate)' END) AS reasons
            FROM lineitem WHERE l_quantity < 1 OR l_quantity > 8 OR l_shipdate IS NULL""",
        "accepted_rows": """
            SELECT * FROM lineitem
            WHERE (l_quantity BETWEEN 1 AND 8 OR l_quantity IS NULL) AND l_shipdate IS NOT NULL""",
        "read_formats": """
            SELECT o.*, f.format FROM orders o,
                   (VALUES ('parquet'), ('orc'), ('csv'), ('json')) f(format)""",
        "convert_roundtrip": "SELECT * FROM orders",
        "landing_manifest": " UNION ALL ".join(
            f"SELECT 'raw/{t}.parquet' AS object_name, 'application/parquet' AS content_type, count(*) AS n_rows FROM {t}"
            for t in LANDED
        ),
        "landed_datasets": " UNION ALL ".join(
            f"""SELECT 'raw/{t}.parquet' AS object_name, 'application/parquet' AS content_type,
                       TIMESTAMP '2024-01-31' AS ingestion_time, count(*) AS n_rows FROM {t}"""
            for t in LANDED
        ),
        "landing_tiers": """
            SELECT path, event_id, ts AS stored_at,
                   CASE WHEN starts_with(path, 'raw/') AND date_diff('day', ts::DATE, DATE '2024-01-31') >= 30
                        THEN 'GLACIER' ELSE 'STANDARD' END AS tier
            FROM (SELECT *, CASE WHEN event_type = 'error' THEN 'logs/' ELSE 'raw/' END || event_type AS path
                  FROM events) o""",
        "merge_upsert": upsert(),
        "merge_upsert_large": upsert(),
        "merge_condition": upsert("AND s.price > t.o_totalprice"),
        "merge_update_only": """
            SELECT l.* REPLACE (s.sold AS l_quantity)
            FROM lineitem l JOIN (SELECT l_partkey, sum(l_quantity) AS sold FROM lineitem GROUP BY 1) s USING (l_partkey)""",
        "merge_insert_only": """
            SELECT * FROM customer
            UNION ALL
            SELECT s_suppkey * 20, s_name, s_nationkey, s_acctbal, NULL FROM supplier
            WHERE s_suppkey * 20 NOT IN (SELECT c_custkey FROM customer)""",
        "append_merge_schema": """
            SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, NULL::VARCHAR AS segment FROM supplier
            UNION ALL SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
        "read_latest": "SELECT * FROM orders",
        "time_travel": "SELECT * FROM orders WHERE year(o_orderdate) <= 1997",
        "table_log": """
            SELECT 1::BIGINT AS snapshot_id, TIMESTAMP '2024-01-01' AS committed_at, 'overwrite' AS operation,
                   count(*) FILTER (year(o_orderdate) <= 1997) AS n_rows FROM orders
            UNION ALL SELECT 2, TIMESTAMP '2024-01-02', 'overwrite', count(*) FROM orders""",
        "published_orders": "SELECT * FROM orders",
        "upserted_orders": upsert(),
        "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
        "snapshot_log": "SELECT user_id, event_id, ts FROM events",
        "expired_snapshots": f"SELECT user_id, event_id, ts FROM ({ranked}) r WHERE expired",
        "snapshot_stats": f"SELECT user_id, {stats} FROM ({ranked}) r GROUP BY user_id",
        "snapshot_stats_single": f"""
            SELECT {stats} FROM (
                SELECT row_number() OVER (ORDER BY ts DESC, event_id DESC) > 3
                       AND ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY AS expired FROM events) r""",
        "retained_rows": f"SELECT * EXCLUDE (expired) FROM ({ranked}) r WHERE NOT expired",
        "cleanup_history": f"""
            SELECT TIMESTAMP '2024-01-31' AS run_at, user_id, event_id AS snapshot_id, ts AS created_at
            FROM ({ranked}) r WHERE expired""",
    }
