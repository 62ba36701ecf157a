import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import bind, envelope, metrics, sinks
from tidemark.operators.rows import expand
from tidemark.plans.capture import changes, read_events, run
from tidemark.schema import DELETE_ROWS, EVENT, TABLE_MAP, UPDATE_ROWS, WRITE_ROWS, WRITE_ROWS_V1
from tidemark.sources import encode
from tidemark.sources.wire import WireError
from tidemark.spec import CaptureSpec
from tidemark.streaming.follow import catch_up

COLUMNS = [(3, 0), (15, 50)]


def image(n, s):
    return encode.image([n.to_bytes(4, "little", signed=True), None if s is None else encode.varchar(s, 50)])


def statement(table, kind, images, table_id=5, at=1_700_000_000):
    return [(TABLE_MAP, encode.table_map(table_id, "shop", table, COLUMNS), at, 1), (kind, encode.rows(kind, table_id, 2, images), at, 1)]


@pytest.fixture(scope="module", params=[False, True], ids=["plain", "checksum"])
def log(tmp_path_factory, request):
    folder = tmp_path_factory.mktemp("log")
    one = [
        *statement("items", WRITE_ROWS, [image(k, f"i{k}") for k in range(3)]),
        (2, b"query", 0, 1),
        *statement("users", UPDATE_ROWS, [image(1, "a"), image(1, "b"), image(2, None), image(2, "c")], table_id=6),
        # the id is used again for another table
        *statement("noise", WRITE_ROWS_V1, [image(9, "n")], table_id=5),
    ]
    two = [*statement("items", DELETE_ROWS, [image(0, "i0")], table_id=8), (WRITE_ROWS, encode.rows(WRITE_ROWS, 99, 2, [image(7, "lost")]), 0, 1)]
    (folder / "bin.000009").write_bytes(encode.log_file(one, request.param, "bin.000010"))
    (folder / "bin.000010").write_bytes(encode.log_file(two, request.param))
    (folder / "bin.index").write_text("not a log")
    return str(folder)


SPEC = CaptureSpec(from_binlog_file="bin.000009")


def found(df):
    cols = ("binlog_file", "table_name", "dml_type", "event_row_index", "before_values", "after_values")
    return [tuple(r[c] for c in cols) for r in df.orderBy("binlog_file", "log_pos", "event_row_index").collect()]


ALL = [
    ("bin.000009", "items", "INSERT", 1, None, '{"c0":0,"c1":"i0"}'),
    ("bin.000009", "items", "INSERT", 2, None, '{"c0":1,"c1":"i1"}'),
    ("bin.000009", "items", "INSERT", 3, None, '{"c0":2,"c1":"i2"}'),
    ("bin.000009", "users", "UPDATE", 1, '{"c0":1,"c1":"a"}', '{"c0":1,"c1":"b"}'),
    ("bin.000009", "users", "UPDATE", 2, '{"c0":2,"c1":null}', '{"c0":2,"c1":"c"}'),
    ("bin.000009", "noise", "INSERT", 1, None, '{"c0":9,"c1":"n"}'),
    ("bin.000010", "items", "DELETE", 1, '{"c0":0,"c1":"i0"}', None),
]


def test_whole_log(spark, log):
    assert found(changes(read_events(spark, log, SPEC), SPEC)) == ALL


def test_rules_and_range(spark, log):
    spec = CaptureSpec(from_binlog_file="bin.000009", to_binlog_file="bin.000010", to_binlog_position=10, exclude=("shop.noise",))
    assert found(changes(read_events(spark, log, spec), spec)) == ALL[:5]


def test_events_and_headers(spark, log):
    events = read_events(spark, log).cache()
    assert events.schema == EVENT and events.filter("event_type = 2").count() == 0
    assert [tuple(r) for r in bind.rotations(events).collect()] == [("bin.000009", 4, "bin.000010")]
    assert {r.server_version for r in bind.formats(events).collect()} == {"8.0.36"}
    assert bind.unbound(bind.bind(events)).count() == 1
    raw = encode.event(30, b"abc", 1_700_000_000, 7, 4)
    h = spark.createDataFrame([(raw,), (b"short",)], "p binary").select(bind.header(F.col("p")).alias("h")).collect()
    assert tuple(h[0].h) == (1_700_000_000, 30, 7, 22, 26, 0) and h[1].h is None
    assert "ROTATE_EVENT" in "".join(r.value for r in sinks.event_text(events).collect())


def test_map_from_an_earlier_file(spark, log):
    events = read_events(spark, log)
    assert bind.bind(events.filter("event_type <> 19 or binlog_file = 'bin.000009'"), across_files=True).filter("table_id = 5 and table.table_name = 'noise'").count() == 1


def test_faulty_event_is_set_aside(spark):
    good, bad = encode.rows(WRITE_ROWS, 5, 2, [image(1, "x")]), encode.rows(WRITE_ROWS, 5, 2, [image(1, "x"), b"\0\1"])
    rows = [("b.1", 4, TABLE_MAP, encode.table_map(5, "shop", "t", COLUMNS)), ("b.1", 100, WRITE_ROWS, bad), ("b.1", 200, WRITE_ROWS, good)]
    events = spark.createDataFrame([(f, p, k, 0, 1, len(d) + 19, p + 50, 0, d) for f, p, k, d in rows], EVENT)
    out = expand(bind.bind(events)).orderBy("log_pos", "event_row_index").collect()
    assert [(r.log_pos, r.event_row_index, r._error is None, r.after_values is None) for r in out] == [(150, 1, True, False), (150, 2, False, True), (250, 1, True, False)]


def test_checksum_is_verified_on_demand(spark, tmp_path):
    raw = bytearray(encode.log_file(statement("t", WRITE_ROWS, [image(1, "x")]), True))
    raw[-1] ^= 1
    (tmp_path / "b.000001").write_bytes(raw)
    from tidemark.sources.binlog import Log

    log = Log({"path": str(tmp_path)})
    assert len(list(log.events(log.files()[0]))) == 3
    with pytest.raises(WireError):
        strict = Log({"path": str(tmp_path), "verify_checksum": "true"})
        list(strict.events(strict.files()[0]))
    (tmp_path / "b.000001").write_bytes(raw[:-5])  # a truncated tail ends the file
    assert len(list(log.events(log.files()[0]))) == 2


def test_parquet_sink(spark, log, tmp_path):
    spec = CaptureSpec(from_binlog_file="bin.000009", output_mode="parquet", parquet_output_dir=str(tmp_path / "out"), parquet_batch_size=2)
    for _ in range(2):  # writing again replaces
        assert run(spark, log, spec)["rows_processed"] == 7
    files = sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith((".", "_")))
    assert files == ["bin.000009.parquet", "bin.000010.parquet"]
    read = spark.read.parquet(str(tmp_path / "out/bin.000009.parquet"))
    assert read.columns == ["timestamp", "server_id", "log_pos", "event_row_index", "database", "table_name", "dml_type", "before_values", "after_values"]
    assert read.count() == 6
    meta = pq.ParquetFile(next((tmp_path / "out/bin.000009.parquet").glob("*.parquet"))).metadata
    column = meta.row_group(0).column(0)
    assert column.compression == "GZIP" and "PLAIN" in column.encodings and column.statistics is not None


def test_stdout(spark, log, capsys):
    assert run(spark, log, SPEC)["rows_processed"] == 7
    out = capsys.readouterr().out
    assert out.startswith("[INSERT] shop.items\n") and "  columns: LONG, VARCHAR\n  after: 0, 'i0'\n" in out and "  before: 2, NULL\n  after: 2, 'c'\n" in out


def test_stream_is_exactly_once(spark, log, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    assert catch_up(spark, log, SPEC, out, checkpoint, max_events=2) > 1
    assert catch_up(spark, log, SPEC, out, checkpoint, max_events=2) == 0  # nothing new
    got = spark.read.parquet(out).withColumnRenamed("_file", "binlog_file")
    assert found(got) == ALL and got.select("_batch").distinct().count() > 1


def test_a_query_runs_through_all_batches(spark, log, tmp_path, monkeypatch):
    from tidemark.streaming import follow as module

    started, follow = [], module.follow
    monkeypatch.setattr(module, "follow", lambda *a, **k: started.append(1) or follow(*a, **k))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    assert catch_up(spark, log, SPEC, out, checkpoint, max_events=2) > 2 and len(started) == 1
    assert found(spark.read.parquet(out).withColumnRenamed("_file", "binlog_file")) == ALL


def planned(stream, start, end):
    """Rows that the tasks of a batch read, and the files they read."""
    parts = stream.partitions(start, end)
    return [r for p in parts for b in stream.read(p) for r in zip(*(c.to_pylist() for c in b.columns))], [p.name for p in parts]


@pytest.mark.parametrize("most", [1, 3, 5, 1000])
def test_tasks_read_what_a_batch_takes_of_each_file(log, most):
    from tidemark.sources.binlog import BinlogStream, Log

    options = {"path": log, "max_events": str(most)}
    want = [e for f in Log(options).files() for e in Log(options).events(f)]
    stream = BinlogStream(options)
    start, got = stream.initialOffset(), []
    while (end := stream.latestOffset()) != start:
        rows, files = planned(stream, start, end)
        assert rows and len(files) == len({r[0] for r in rows})
        # the same from a checkpoint, with and without what the offset says of the format description
        assert planned(BinlogStream(options), start, end)[0] == rows
        assert planned(BinlogStream(options), {k: start[k] for k in ("file", "pos")}, end)[0] == rows
        got += rows
        start = end
    assert got == want and stream.partitions(end, end) == []


def test_a_stream_finds_what_a_file_got_before_the_next_began(log, tmp_path):
    from tidemark.sources.binlog import BinlogStream, Log

    names = [f.name for f in Log({"path": log}).files()]
    data = [open(f"{log}/{n}", "rb").read() for n in names]
    options = {"path": str(tmp_path)}
    (tmp_path / names[0]).write_bytes(data[0][: len(data[0]) * 2 // 3])
    stream = BinlogStream(options)
    start, got = stream.initialOffset(), []
    for grown in (False, True):
        if grown:
            (tmp_path / names[0]).write_bytes(data[0])
            (tmp_path / names[1]).write_bytes(data[1])
        while (end := stream.latestOffset()) != start:
            got += planned(stream, start, end)[0]
            start = end
        assert bool(got) and (len({r[0] for r in got}) == 2) == grown
    assert got == [e for f in Log({"path": log}).files() for e in Log({"path": log}).events(f)]


def test_envelope_requires(spark):
    df = spark.createDataFrame([(1, 1, 4, 1, None, None, "INSERT", None, "{}")], "timestamp long, server_id int, log_pos long, event_row_index long, database string, table_name string, dml_type string, before_values string, after_values string")
    assert envelope.to_envelope(df).count() == 1
    with pytest.raises(Exception, match="dml_type is null"):
        envelope.to_envelope(df.withColumn("dml_type", F.lit(None).cast("string"))).collect()


def test_names(spark):
    r = spark.range(1).select(envelope.type_name(F.lit(246)), envelope.type_name(F.lit(99)), envelope.event_name(F.lit(19)), envelope.dml_type(F.lit(39)), envelope.is_artificial_rotate(F.lit(4))).first()
    assert tuple(r) == ("NEWDECIMAL", "UNKNOWN", "TABLE_MAP_EVENT", "UPDATE", True)


def test_metrics(spark):
    cols = "start_ns long, end_ns long, rows_processed long, batches_flushed long, bytes_written long"
    parts = spark.createDataFrame([(100, 500, 10, 1, 0), (50, 600, 20, 2, 1024), (0, 0, 0, 0, 0)], cols)
    assert tuple(metrics.merge(parts).select("start_ns", "end_ns", "rows_processed", "batches_flushed", "bytes_written").first()) == (50, 600, 30, 3, 1024)
    assert metrics.throughput(metrics.merge(parts)).first().rows_per_second == pytest.approx(30 / 550e-9)


def test_json_lines(spark, log):
    lines = sinks.log_lines(changes(read_events(spark, log, SPEC), SPEC)).collect()
    assert {json.loads(r.value)["dml"] for r in lines} == {"INSERT", "UPDATE", "DELETE"}
