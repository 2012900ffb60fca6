import random

import pytest
from pyspark.sql import Window, functions as F

from shelfstream.functions import thresholds
from shelfstream.operators import logs
from shelfstream.sources import logs as log_source
from shelfstream.streaming import alerts
from shelfstream.workload import jobs


def status(listener, used, limit=100):
    return f"SERVICE (svc) : listener count: {listener}, drone count: {used}/{limit}"


def test_service_severity_keeps_the_worst(rows):
    lines = [status(0, 1), status(1, 74), status(1, 75), status(1, 90), status(0, 75), "noise", status(1, 5, 0)]
    df = rows("line_no bigint, ts timestamp_ntz, line string", *[(i, "2020-01-01 00:00:00", text) for i, text in enumerate(lines)])
    got = {r.line_no: (r.severity, r.drone_pct) for r in logs.service_health(df).collect()}
    assert got == {0: (2, 1), 1: (0, 74), 2: (1, 75), 3: (2, 90), 4: (2, 75), 5: (0, None), 6: (0, None)}
    hour = logs.health_per_hour(logs.service_health(df)).first()
    assert (hour.severity, hour.findings) == (2, 4)


def brute_trace(lines, search, patterns):
    import re

    terms, out = [search], []
    for number, line in lines:
        if any(term in line for term in terms):
            out.append(number)
            for pattern in patterns:
                found = re.search(pattern, line)
                if found:
                    terms.append(found.group(1))
    return out


def test_trace_is_forward_only_and_matches_brute_force(spark):
    rng = random.Random(3)
    lines = []
    for n in range(250):
        token = f"{rng.randrange(12):032x}" if rng.random() < 0.2 else ""
        message = rng.choice(["start", "call", f"see {rng.randrange(100, 160)}", token, "Returning NULL"])
        level = "ERR " if message == "Returning NULL" else "INFO"
        lines.append((n, f"[2020-01-01 00:00:00] host{n % 3} [{level}:{rng.randrange(100, 140)}:M.pm:{n % 9}:{5000 + n}] {message}"))
    df = spark.createDataFrame(lines, "line_no bigint, line string")
    search = f"{3:032x}"
    for flags in ({"follow_auth": True}, {"follow_pid": True, "follow_trace": True}, {}):
        patterns = [p for p, on in ((logs.LINE_PID, "follow_pid"), (logs.LINE_AUTH, "follow_auth"), (logs.LINE_TRACE, "follow_trace")) if flags.get(on)]
        got = sorted(r.line_no for r in logs.trace_related_lines(df, search, **flags).collect())
        assert got == brute_trace(lines, search, patterns), flags


def test_a_chain_of_200_hops_takes_few_tables(spark, monkeypatch):
    """Each line names the trace id of the line before; a hop backwards is not followed."""
    line = "[2020-01-01 00:00:00] h [INFO:1:M.pm:1:{}] after {}"
    chain = [(10 + k, line.format(70_000 + k + 1, 70_000 + k)) for k in range(200)]
    other = [(5, line.format(1, 70_150)), (400, line.format(2, 90_000)), (401, line.format(3, 70_200))]
    df = spark.createDataFrame([*chain, *other], "line_no bigint, line string")
    written = []
    monkeypatch.setattr(logs, "materialize", lambda table, label, keep=logs.materialize: written.append(label) or keep(table, label))
    got = sorted(r.line_no for r in logs.trace_related_lines(df, "after 70000", follow_trace=True).collect())
    assert got == [*range(10, 210), 401] and len(written) < 13 and sum(x == "trace-since" for x in written) < 10


def test_trace_terms_inside_longer_runs_repeated_rows_and_null_numbers(spark):
    rng = random.Random(5)
    tokens = [f"{k:032x}" for k in (3, 10, 11)] + ["1234567890" * 3 + "12", "ab" * 16]
    lines = []
    for n in range(300):
        message = rng.choice(["start", f"see {rng.randrange(10**9)}", f"{rng.randrange(100)}{rng.choice(tokens)}f{rng.randrange(10)}", f"x{rng.randrange(1000, 1300)}", "-"])
        lines.append((n, f"[2020-01-01 00:00:00] host{n % 3} [INFO:{rng.randrange(20000, 20900)}:M.pm:{n % 9}:{rng.choice((1000, 110000)) + n}] {message}"))
    rows = [*lines, *lines, (None, f"[t] h [INFO:20001:M.pm:1:1001] {tokens[1]}")]
    df = spark.createDataFrame(rows, "line_no bigint, line string")
    every = {"follow_pid": logs.LINE_PID, "follow_auth": logs.LINE_AUTH, "follow_trace": logs.LINE_TRACE}
    for flags in (["follow_auth"], ["follow_trace"], ["follow_auth", "follow_trace"], list(every)):
        for search in (tokens[1], "x12", "not there"):
            want = brute_trace(lines, search, [every[f] for f in flags])
            got = sorted(r.line_no for r in logs.trace_related_lines(df, search, **dict.fromkeys(flags, True)).collect())
            assert got == sorted(want * 2), (flags, search)


def test_unrelated_lines_take_no_part_in_the_rounds(spark, monkeypatch):
    """A line's own trace id and token, which no other line holds, are written nowhere but in the list of terms."""
    line = "[2020-01-01 00:00:00] h [INFO:1:M.pm:1:{}] {}"
    lines = [(n, line.format(5_000_000 + n, f"login token {n:031d}b")) for n in range(500)]
    related = [(500, line.format(6_000_000, "find me")), (501, line.format(6_000_001, "call 6000000")), (502, line.format(6_000_002, "call 6000001"))]
    df = spark.createDataFrame([*lines, *related], "line_no bigint, line string")
    written = {}

    def noted(table, label, keep=logs.materialize):
        written.setdefault(label, []).append(kept := keep(table, label))
        return kept

    monkeypatch.setattr(logs, "materialize", noted)
    got = sorted(r.line_no for r in logs.trace_related_lines(df, "find me", follow_auth=True, follow_trace=True).collect())
    assert got == [500, 501, 502]
    assert sum(t.count() for label, tables in written.items() if label not in ("trace-yields", "trace-since") for t in tables) <= 4


def test_trace_can_include_errors(spark):
    df = spark.createDataFrame([(1, "[t] h [ERR :1:M.pm:1:2] x"), (2, "[t] h [INFO:9:M.pm:1:3] y")], "line_no bigint, line string")
    assert [r.line_no for r in logs.trace_related_lines(df, "zzz", include_errors=True).collect()] == [1]


def test_sample_delta_equals_one_window_per_host(spark, folder):
    samples = jobs(spark, folder).t.cpu_sample
    order = Window.partitionBy("host").orderBy("ts", "sample_no")
    plain = samples.select("host", "sample_no", (F.col("cpu_user") - F.lag("cpu_user").over(order)).alias("d_cpu_user"))
    split = logs.sample_delta(samples, ["cpu_user"]).select("host", "sample_no", "d_cpu_user")
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_missing_hours(rows):
    df = rows("ts timestamp_ntz, line string", ("2020-03-08 01:10:00", "a"), ("2020-03-08 03:59:59", "b"))
    got = [str(r.hour) for r in logs.missing_hours(df, "2020-03-08 01:00:00", "2020-03-08 04:00:00").orderBy("hour").collect()]
    assert got == ["2020-03-08 02:00:00", "2020-03-08 04:00:00"]


def test_thresholds_are_ordered(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate((0, 30, 60, 400, 650, 730))], "i int, v double")
    got = [r.b for r in df.select("i", thresholds.classify_band(F.col("v"), 800.0).alias("b")).orderBy("i").collect()]
    assert got == [2, 2, 1, 0, 1, 2]
    memory = spark.createDataFrame([(70.0, 100.0, 60.0), (70.0, 100.0, 100.0), (70.0, 100.0, 500.0), (60.0, 100.0, 1.0)], "u double, t double, f double")
    got = [r.m for r in memory.select(thresholds.classify_memory(F.col("u"), F.col("t"), F.col("f")).alias("m")).collect()]
    assert got == [2, 1, 0, 0]


def test_ram_shares_strict_reports_free_as_buffers(rows):
    df = rows("host string, sample_no bigint, mem_total bigint, mem_free bigint, buffers bigint, cached bigint", ("h", 1, 1000, 500, 10, 20))
    assert logs.ram_shares(df).first().buffers_pct == 1.0
    assert logs.ram_shares(df, strict_reference=True).first().buffers_pct == 50.0


def test_hour_is_read_from_the_file_name(spark, tmp_path):
    day = tmp_path / "2020" / "01" / "02"
    day.mkdir(parents=True)
    (day / "gateway.07.log").write_text("one\ntwo\n")
    got = log_source.read_log_lines(spark, str(tmp_path)).collect()
    assert {(r.line, str(r.hour)) for r in got} == {("one", "2020-01-02 07:00:00"), ("two", "2020-01-02 07:00:00")}


def test_stream_resumes_where_it_stopped_and_equals_batch(spark, tmp_path):
    source, out, mark = (str(tmp_path / name) for name in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()

    def run():
        lines = log_source.stream_log_lines(spark, source)
        alerts.stream_service_health(lines, out, mark).awaitTermination()
        return sorted((r.line, r.severity) for r in spark.read.parquet(out).collect())

    (tmp_path / "in" / "a.log").write_text(status(0, 1) + "\n" + status(1, 80) + "\n")
    assert len(run()) == 2
    (tmp_path / "in" / "b.log").write_text(status(1, 95) + "\n")
    streamed = run()
    batch = logs.service_health(log_source.read_log_lines(spark, source))
    assert streamed == sorted((r.line, r.severity) for r in batch.collect()) and len(streamed) == 3


def test_stream_sees_lines_appended_to_a_file_it_has_read(spark, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    day = tmp_path / "in" / "2024" / "01" / "15"
    day.mkdir(parents=True)
    log = day / "eg_stats.10.log"

    def run(block_bytes):
        lines = log_source.stream_log_lines(spark, str(tmp_path / "in"), block_bytes)
        lines.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(
            availableNow=True
        ).start().awaitTermination()
        return sorted((r.line, str(r.hour)) for r in spark.read.schema("line string, hour timestamp_ntz").parquet(out).collect())

    def expected(*lines):
        return sorted((line, "2024-01-15 10:00:00") for line in lines)

    log.write_bytes("eins\nzw\u00f6lf".encode())
    assert run(3) == expected("eins")
    with log.open("ab") as file:
        file.write(b"f\n\nlong " + b"x" * 200 + b"\nopen")
    long = "long " + "x" * 200
    assert run(7) == expected("eins", "zw\u00f6lff", "", long)
    assert run(7) == expected("eins", "zw\u00f6lff", "", long)
    with log.open("ab") as file:
        file.write(b" end\r\n")
    (day / "eg_stats.11.log").write_bytes(b"next hour\n")
    (day / ".eg_stats.11.log.crc").write_bytes(b"no log\n")
    streamed = run(1 << 20)
    assert streamed == sorted([*expected("eins", "zw\u00f6lff", "", long, "open end"), ("next hour", "2024-01-15 11:00:00")])
    batch = log_source.read_log_lines(spark, str(tmp_path / "in"))
    assert streamed == sorted((r.line, str(r.hour)) for r in batch.collect())


def test_a_file_started_anew_is_read_from_its_beginning():
    reader = log_source.GrowingLogReader("/nowhere", 10)
    blocks = reader.partitions({"files": '{"a": 30, "b": 5}'}, {"files": '{"a": 12, "b": 5, "c": 1}'})
    assert [(b.file, b.start, b.end) for b in blocks] == [("a", 0, 10), ("a", 10, 12), ("c", 0, 1)]


def test_a_file_that_begins_with_other_bytes_is_read_from_its_beginning(tmp_path):
    """Also if it has grown past the length read before; short beginnings are compared over the length they had."""
    (tmp_path / "in").mkdir()
    reader = log_source.GrowingLogReader(str(tmp_path / "in"), 1 << 20)

    def take(before):
        after = log_source.GrowingLogReader(reader.path, 1 << 20).latestOffset() if len(before["files"]) % 2 else reader.latestOffset()
        lines = {}
        for block in reader.partitions(before, after):
            for batch in reader.read(block):
                lines.setdefault(block.file.rsplit("/", 1)[1], []).extend(batch.column("line").to_pylist())
        return after, lines

    short, long, kept = (tmp_path / "in" / name for name in ("short", "long", "kept"))
    short.write_text("one\n")
    long.write_text("x" * 300 + "\n")
    kept.write_text("y" * 100 + "\n")
    offset, lines = take(reader.initialOffset())
    assert lines == {"short": ["one"], "long": ["x" * 300], "kept": ["y" * 100]}
    assert take(offset)[1] == {}
    short.write_text("two\nthree\n")
    long.write_text("z" * 400 + "\nnew\n")
    kept.write_text("y" * 100 + "\n" + "more" * 100 + "\n")
    offset, lines = take(offset)
    assert lines == {"short": ["two", "three"], "long": ["z" * 400, "new"], "kept": ["more" * 100]}
    assert take(offset)[1] == {}


def test_many_log_files_and_a_missing_folder(tmp_path):
    """Files that have not changed are not opened again; a folder that is not there is an error."""
    for k in range(3000):
        (tmp_path / f"{k}.log").write_text(f"line {k}\n")
    reader, opened = log_source.GrowingLogReader(str(tmp_path), 1 << 20), []
    reader._head = lambda store, file, size, own=reader._head: opened.append(file) or own(store, file, size)
    offset = reader.latestOffset()
    assert len(opened) == 3000 and len(reader.partitions(reader.initialOffset(), offset)) == 3000
    (tmp_path / "7.log").write_text("line 7\nagain\n")
    latest = reader.latestOffset()
    blocks = reader.partitions(offset, latest)
    assert len(opened) == 3002 and [(b.start, b.end) for b in blocks] == [(7, 13)]
    with pytest.raises(FileNotFoundError):
        log_source.GrowingLogReader(str(tmp_path / "none"), 10).latestOffset()


def test_missing_hours_are_reported_and_withdrawn_as_lines_come(spark, tmp_path):
    source, out, mark = (str(tmp_path / name) for name in ("in", "out", "mark"))
    written = []

    def run(*lines):
        written.extend(lines)
        new = spark.createDataFrame([(s, f"2024-01-15 {t}:00Z") for s, t in lines], "source string, t string")
        new.select("source", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(source)
        lines = spark.readStream.schema("source string, ts timestamp").parquet(source)
        alerts.stream_missing_hours(lines, "2024-01-15 08:00:00", 3, out, mark).awaitTermination()
        found = alerts.missing_hours(spark, out).select("source", F.unix_seconds("hour").alias("s"), "severity").collect()
        assert all(r.severity == 1 for r in found)
        return {(r.source, r.s // 3600 % 24) for r in found}

    def expected():
        """The batch operator's rows for each source, up to the hour before the newest line."""
        newest = max(int(t[:2]) for _, t in written)
        missing = set()
        for name in {s for s, _ in written}:
            stamps = spark.createDataFrame([(f"2024-01-15 {t}:00",) for s, t in written if s == name], "t string")
            batch = logs.missing_hours(stamps.select(F.col("t").cast("timestamp_ntz").alias("ts")), "2024-01-15 08:00:00", f"2024-01-15 {newest - 1:02}:00:00")
            missing |= {(name, r.hour.hour) for r in batch.collect()}
        return missing

    assert run(("a", "08:10"), ("a", "08:20"), ("b", "09:59"), ("a", "12:00")) == expected() == {("a", 9), ("a", 10), ("a", 11), ("b", 8), ("b", 10), ("b", 11)}
    # A late line withdraws; a source that has fallen silent is reported when the others go on.
    assert run(("a", "10:30"), ("a", "14:01")) == expected()
    assert ("b", 13) in run(("a", "13:00"), ("a", "15:00")) and ("a", 13) not in run(("a", "15:10"))


def test_streamed_windows_show_while_they_are_open(spark, tmp_path):
    source, out, mark = (str(tmp_path / name) for name in ("in", "out", "mark"))

    def run(*stamps):
        new = spark.createDataFrame([(f"2024-01-15 {t}:00Z", "x Returning NULL") for t in stamps] + [("2024-01-15 23:00:00Z", "fine")], "t string, line string")
        new.select(F.col("t").cast("timestamp").alias("ts"), "line").coalesce(1).write.mode("append").parquet(source)
        lines = spark.readStream.schema("ts timestamp, line string").parquet(source)
        alerts.stream_window_counts(lines, "Returning NULL", 60, "1 hour", out, mark).awaitTermination()
        found = alerts.window_counts(spark, out, 2, 4).select(F.unix_seconds("window_start").alias("s"), "n", "severity").collect()
        return {(r.s // 3600 % 24): (r.n, r.severity) for r in found}

    assert run("10:01", "10:59") == {10: (2, 1)}
    assert run("10:30", "11:00") == {10: (3, 1), 11: (1, 0)}
    assert run("11:10", "10:10", "11:20", "11:59") == {10: (4, 2), 11: (4, 2)}
