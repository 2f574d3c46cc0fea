from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarnkit.sources import paths
from tarnkit.sources.formats import DataFormat
from tarnkit.streaming.landing import land_stream, read_landed, stream_manifest
from tarnkit.streaming.late import LateSplit

ROWS = "id bigint, ts timestamp_ntz, note string"
DAY = timedelta(days=1)


def _write(spark, folder, rows, format="parquet"):
    writer = spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append")
    (writer.option("header", "true") if format == "csv" else writer).format(format).save(folder)


def _rows(first, n, day=1):
    return [(k, datetime(2024, 1, day, k % 24), f"n{k}") for k in range(first, first + n)]


def _land(spark, folder, checkpoint="c", **more):
    query = land_stream(spark, f"{folder}/in", ROWS, f"{folder}/lake", "t", f"{folder}/{checkpoint}", **more)
    query.awaitTermination()
    return query


def _landed(spark, folder):
    return sorted(r.id for r in read_landed(spark, f"{folder}/lake", "t", ROWS).collect())


def test_files_land_once_as_they_arrive(spark, folder):
    _write(spark, f"{folder}/in", _rows(0, 5))
    _land(spark, folder)
    assert _landed(spark, folder) == list(range(5))
    _land(spark, folder)
    _write(spark, f"{folder}/in", _rows(5, 3))
    _land(spark, folder)
    assert _landed(spark, folder) == list(range(8))
    manifest = stream_manifest(spark, f"{folder}/lake", "t").collect()
    assert sorted((r.object_name, r.content_type, r.n_rows, r.n_files, r.batch) for r in manifest) == [
        ("raw/t", "application/parquet", 3, 1, 1),
        ("raw/t", "application/parquet", 5, 1, 0),
    ]
    assert all(r.n_bytes > 0 and r.ingestion_time is not None for r in manifest)


def test_a_lost_checkpoint_lands_nothing_again(spark, folder):
    _write(spark, f"{folder}/in", _rows(0, 5))
    _land(spark, folder)
    _write(spark, f"{folder}/in", _rows(5, 2))
    _land(spark, folder, "other")
    assert _landed(spark, folder) == list(range(7))
    assert sorted(r.n_rows for r in stream_manifest(spark, f"{folder}/lake", "t").collect()) == [2, 5]


def test_a_batch_that_died_is_not_seen_and_is_written_again(spark, folder, monkeypatch):
    from tarnkit.streaming.batches import BatchStore

    _write(spark, f"{folder}/in", _rows(0, 5))
    plain = BatchStore.record

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(BatchStore, "record", dies)
    with pytest.raises(Exception, match="lost"):
        _land(spark, folder)
    assert paths.exists(spark, f"{folder}/lake/raw/t/data")
    assert _landed(spark, folder) == []
    monkeypatch.setattr(BatchStore, "record", plain)
    _write(spark, f"{folder}/in", _rows(5, 1))
    _land(spark, folder)
    assert _landed(spark, folder) == list(range(6))


def test_a_replayed_batch_is_left_as_it_is(spark, folder):
    _write(spark, f"{folder}/in", _rows(0, 5))
    _land(spark, folder)
    # as if the stream had died after the batch's log row, before its own commit
    assert paths.delete(spark, f"{folder}/c/commits/0")
    paths.delete(spark, f"{folder}/c/commits/.0.crc")
    _land(spark, folder)
    assert _landed(spark, folder) == list(range(5))
    assert stream_manifest(spark, f"{folder}/lake", "t").count() == 1


def test_batches_are_bounded_and_other_formats_land(spark, folder):
    for k in range(3):
        _write(spark, f"{folder}/in", _rows(10 * k, 2), "csv")
    _land(spark, folder, format=DataFormat.CSV, files_a_batch=1)
    assert _landed(spark, folder) == [0, 1, 10, 11, 20, 21]
    manifest = stream_manifest(spark, f"{folder}/lake", "t")
    assert sorted(r.batch for r in manifest.collect()) == [0, 1, 2] and manifest.first().content_type == "text/csv"


def test_nothing_landed_is_an_empty_table(spark, folder):
    assert read_landed(spark, f"{folder}/lake", "t", ROWS).count() == 0
    assert stream_manifest(spark, f"{folder}/lake", "t").count() == 0


# -- late rows --------------------------------------------------------------------------------


def _split(spark, folder, arrivals, window=None, delay=timedelta(hours=2), name="late"):
    split = LateSplit(spark, f"{folder}/{name}", "ts", delay, window)
    for rows in arrivals:
        _write(spark, f"{folder}/in", rows)
        schema = spark.createDataFrame([], ROWS).schema
        split.start(spark.readStream.schema(schema).parquet(f"{folder}/in"), f"{folder}/c-{name}").awaitTermination()
    return split, schema


def _plain_split(arrivals, window, delay):
    """(id, batch, late) of rows in arrival order, row by row."""
    out, latest = [], None
    for batch, rows in enumerate(arrivals):
        mark = None if latest is None else latest - delay
        for id_, ts, _ in rows:
            start = None if ts is None else ts if window is None else datetime(1970, 1, 1) + (ts - datetime(1970, 1, 1)) // window * window
            ended = start is None or (mark is not None and (start < mark if window is None else start + window <= mark))
            out.append((id_, batch, ended))
        latest = max([t for _, t, _ in rows if t is not None] + ([latest] if latest else []), default=None)
    return sorted(out)


@pytest.mark.parametrize("window", [None, DAY, timedelta(hours=6)])
def test_split_is_that_of_a_plain_walk(spark, folder, window):
    at = lambda *a: datetime(2024, 1, *a)
    arrivals = [
        [(1, at(1, 5), "a"), (2, at(2, 23, 59), "b"), (3, None, "c")],
        [(4, at(1, 5), "late"), (5, at(2, 21, 59), "edge"), (6, at(2, 20), "d"), (7, at(3, 12), "e")],
        [(8, at(2, 23), "f"), (9, at(3, 10), "g"), (10, at(3, 9, 59, 59), "h"), (11, at(1, 1), None)],
        [(12, None, "no time")],
        [(13, at(3, 11), "i"), (14, at(5, 0), "j")],
    ]
    split, schema = _split(spark, folder, arrivals, window)
    found = [(r.id, r.batch, False) for r in split.in_time(schema).collect()] + [(r.id, r.batch, True) for r in split.late(schema).collect()]
    assert sorted(found) == _plain_split(arrivals, window, timedelta(hours=2))
    log = sorted((r.batch, r.n_rows, r.n_late) for r in split.log().collect())
    wanted = _plain_split(arrivals, window, timedelta(hours=2))
    assert log == [(b, len(rows), sum(late for i, k, late in wanted if k == b)) for b, rows in enumerate(arrivals)]


def test_window_counts_close_behind_the_watermark(spark, folder):
    arrivals = [_rows(0, 24, 1) + _rows(24, 10, 2), [(99, datetime(2024, 1, 1, 3), "late"), *_rows(100, 3, 4)]]
    split, schema = _split(spark, folder, arrivals, DAY)
    counts = split.window_counts(schema).orderBy("window_start").collect()
    assert [(r.n_rows, r.closed) for r in counts] == [(24, True), (10, True), (3, False)]
    assert [r.id for r in split.late(schema).collect()] == [99]


def test_split_refuses_what_it_cannot_keep(spark, folder):
    split = LateSplit(spark, folder, "ts", DAY)
    stream = spark.readStream.schema("ts timestamp_ntz, late boolean").parquet(folder)
    with pytest.raises(ValueError, match="late"):
        split.start(stream, f"{folder}/c")
    with pytest.raises(ValueError, match="timestamp"):
        split.start(spark.readStream.schema("ts string").parquet(folder), f"{folder}/c")
    with pytest.raises(ValueError, match="window"):
        split.window_counts(stream.schema)


def test_zoned_times_split_by_the_instant(spark, folder):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 3))], "id bigint, ts timestamp")
    split = LateSplit(spark, f"{folder}/z", "ts", DAY)
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        split.start(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), f"{folder}/c").awaitTermination()
    assert sorted((r.id, r.batch) for r in split.late(rows.schema).collect()) == [(1, 1)]
    assert split.in_time(rows.schema).select(F.max("ts")).first()[0] == datetime(2024, 1, 3)
