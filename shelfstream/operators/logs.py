"""Log and metric operators over batch DataFrames; the line rules also serve streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from shelfstream.functions.dates import epoch_seconds, from_epoch_seconds, hour_trunc
from shelfstream.functions.thresholds import classify
from shelfstream.session import materialize

# Texts that mark a log line.
LOST_MARKS = ("listener count: 0", "controller count: 0", "master count: 0")
DRONE_COUNT = r"(?i)drone count: (\d+)/(\d+)"
LINE_PID = r"^\[.+?\] \S+ \[.+?:(\d+):.+"
LINE_AUTH = r"([0-9a-f]{32})"
LINE_TRACE = r"^\[.+?\] \S+ \[.+?:\d+:.+?:\d+:(\d+)\]"


def service_health(lines: DataFrame) -> DataFrame:
    """Severity of each service status line.

    A lost listener, controller or master is critical, a drone share of 75 %
    warns and of 90 % is critical; the worst of both counts.
    """
    line = F.col("line")
    lost = F.lit(False)
    for mark in LOST_MARKS:
        lost = lost | line.contains(mark)
    used = F.regexp_extract(line, DRONE_COUNT, 1).try_cast("double")
    limit = F.regexp_extract(line, DRONE_COUNT, 2).try_cast("double")
    share = F.when(line.contains("SERVICE") & (limit > 0), used / limit)
    drones = F.coalesce(F.when(share >= 0.9, 2).when(share >= 0.75, 1), F.lit(0))
    return lines.withColumn("drone_pct", F.ceil(share * 100).cast("bigint")).withColumn(
        "severity", F.greatest(F.when(lost, 2).otherwise(0), drones)
    )


def health_per_hour(scored: DataFrame) -> DataFrame:
    """Worst severity and number of findings per hour."""
    return scored.groupBy(hour_trunc(F.col("ts")).alias("hour")).agg(
        F.max("severity").alias("severity"),
        F.count(F.when(F.col("severity") > 0, 1)).alias("findings"),
    )


def regex_log_fields(lines: DataFrame) -> DataFrame:
    """Process id, 32-digit token and trace id of application log lines."""
    def found(pattern):
        return F.nullif(F.regexp_extract("line", pattern, 1), F.lit(""))

    return (
        lines.withColumn("pid", found(LINE_PID))
        .withColumn("auth", found(LINE_AUTH))
        .withColumn("trace", found(LINE_TRACE))
    )


def log_server(line: Column) -> Column:
    """Third blank-separated token of a log line."""
    return F.get(F.split(line, " "), 2)


def missing_hours(lines: DataFrame, first_hour: str, last_hour: str) -> DataFrame:
    """Expected hours that have no log line."""
    spark = lines.sparkSession
    expected = spark.range(1).select(
        F.explode(
            F.sequence(
                F.lit(first_hour).cast("timestamp_ntz"), F.lit(last_hour).cast("timestamp_ntz"), F.expr("INTERVAL 1 HOUR")
            )
        ).alias("hour")
    )
    seen = lines.select(hour_trunc(F.col("ts")).alias("hour")).distinct()
    return expected.join(seen, "hour", "left_anti").withColumn("severity", F.lit(1))


def service_counts(processes: DataFrame, config: DataFrame) -> DataFrame:
    """Listener and drone processes of every configured service against its maximum."""
    role = F.lower(F.regexp_extract("line", r"(\w+) \[([^\]]+)\]", 1))
    service = F.regexp_extract("line", r"(\w+) \[([^\]]+)\]", 2)
    running = (
        processes.select(service.alias("service"), role.alias("role"))
        .groupBy("service").pivot("role", ["listener", "drone"]).agg(F.count(F.lit(1)))
    )
    return config.join(running, "service", "left").select(
        "service",
        F.coalesce("listener", F.lit(0)).cast("bigint").alias("listeners"),
        F.coalesce("drone", F.lit(0)).cast("bigint").alias("drones"),
        "max_children",
    )


def sample_delta(samples: DataFrame, counters: list[str]) -> DataFrame:
    """Difference of each counter to the host's previous sample.

    Samples are ordered within (host, hour); the first sample of an hour takes
    its predecessor from the host's previous hour with samples.  A host with a
    large share of all samples is thereby spread over its hours.
    """
    order = F.struct("ts", "sample_no")
    stamped = samples.withColumn("_bucket", hour_trunc(F.col("ts")))
    inner = Window.partitionBy("host", "_bucket").orderBy("ts", "sample_no")
    ends = stamped.groupBy("host", "_bucket").agg(
        *[F.max_by(c, order).alias(f"_end_{c}") for c in counters]
    )
    across = Window.partitionBy("host").orderBy("_bucket")
    before = ends.select(
        "host", "_bucket", *[F.lag(f"_end_{c}").over(across).alias(f"_before_{c}") for c in counters]
    )
    local = stamped.withColumn("_nth", F.row_number().over(inner))
    for counter in counters:
        local = local.withColumn(f"_lag_{counter}", F.lag(counter).over(inner))
    joined = local.join(before, ["host", "_bucket"])
    previous = {
        c: F.when(F.col("_nth") == 1, F.col(f"_before_{c}")).otherwise(F.col(f"_lag_{c}")) for c in counters
    }
    return joined.select(
        *samples.columns, *[(F.col(c) - previous[c]).alias(f"d_{c}") for c in counters]
    )


def two_places(value: Column) -> Column:
    return F.floor(value * 100 + 0.5) / 100


CPU_COUNTERS = [
    "cpu_user", "cpu_nice", "cpu_system", "cpu_idle", "cpu_iowait", "cpu_irq", "cpu_softirq", "cpu_steal",
]


def cpu_shares(samples: DataFrame) -> DataFrame:
    """User, idle, I/O-wait and steal per cent of the time since the previous sample."""
    deltas = sample_delta(samples, CPU_COUNTERS)
    total = sum((F.col(f"d_{c}") for c in CPU_COUNTERS[1:]), F.col(f"d_{CPU_COUNTERS[0]}"))

    def share(counter):
        return two_places(F.col(f"d_{counter}") / F.nullif(total, F.lit(0)) * 100)

    return deltas.filter(F.col("d_cpu_user").isNotNull()).select(
        "host", "sample_no",
        share("cpu_user").alias("user_pct"), share("cpu_idle").alias("idle_pct"),
        share("cpu_iowait").alias("iow_pct"), share("cpu_steal").alias("steal_pct"),
    )


def ram_shares(samples: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Per cent of total memory; ``strict_reference`` reports free memory as the buffer share."""
    available = F.col("mem_free") + F.col("buffers") + F.col("cached")

    def share(amount):
        return two_places(amount / F.nullif(F.col("mem_total"), F.lit(0)) * 100)

    return samples.select(
        "host", "sample_no", available.alias("available"),
        share(F.col("mem_free")).alias("free_pct"),
        share(F.col("mem_free" if strict_reference else "buffers")).alias("buffers_pct"),
        share(F.col("cached")).alias("cached_pct"),
        share(available).alias("available_pct"),
    )


def window_count_alert(lines: DataFrame, mark: str, minutes: int, warn: int, crit: int) -> DataFrame:
    """Marked lines per tumbling window with the alert level and the busiest server.

    Lines are counted per window and server first; equal counts go to the lowest name.
    """
    per_server = (
        lines.filter(F.col("line").contains(mark))
        .groupBy(F.window("ts", f"{minutes} minutes").alias("w"), log_server(F.col("line")).alias("server"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_server.groupBy("w")
        .agg(F.sum("n").alias("n"), F.min_by("server", F.struct((-F.col("n")).alias("k"), "server")).alias("top_server"))
        .select(
            F.col("w.start").alias("window_start"), "n", classify(F.col("n"), warn, crit, inclusive=True).alias("severity"),
            "top_server",
        )
    )


def recent_count_alert(lines: DataFrame, mark: str, now: str, minutes: int, warn: int, crit: int) -> DataFrame:
    """Marked lines of the past minutes, the minute of ``now`` included, with the alert level."""
    moment = F.lit(now).cast("timestamp_ntz")
    first = from_epoch_seconds(F.floor(epoch_seconds(moment) / 60) * 60 - minutes * 60)
    return (
        lines.filter(F.col("line").contains(mark) & (F.col("ts") >= first) & (F.col("ts") <= moment))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("n", classify(F.col("n"), warn, crit, inclusive=True).alias("severity"))
    )


def top_server(lines: DataFrame, mark: str) -> DataFrame:
    """Server with the most marked lines; ties go to the lowest name (a top-1 report)."""
    return (
        lines.filter(F.col("line").contains(mark))
        .groupBy(log_server(F.col("line")).alias("server"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "server").limit(1)
    )


def failed_trigger_events(events: DataFrame, definitions: DataFrame, day: str) -> DataFrame:
    """Definitions with a failed event on the day: their number, sorted names and level."""
    failed = events.filter(
        ((F.col("state") == "error") | F.col("error_output").isNotNull())
        & (F.to_date("add_time") == F.lit(day).cast("date"))
    ).select(F.col("event_def").alias("id")).distinct()
    return definitions.join(failed, "id", "left_semi").agg(
        F.count("name").alias("failures"),
        F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"),
        F.when(F.count("name") > 0, 2).otherwise(0).alias("severity"),
    )


def pending_backlog(events: DataFrame, warn: int = 900_000, crit: int = 1_000_000) -> DataFrame:
    return events.filter(F.col("state") == "pending").agg(F.count(F.lit(1)).alias("pending")).select(
        "pending", classify(F.col("pending"), warn, crit).alias("severity")
    )


def replication_lag(status: DataFrame, warn: int = 150, crit: int = 200) -> DataFrame:
    return status.withColumn("severity", classify(F.col("st_lag_num_events"), warn, crit))


def real_queries(activity: DataFrame) -> DataFrame:
    query = F.col("current_query")
    return activity.filter(~query.like("<IDL%") & ~query.like("%vacuum%"))


def oldest_query(activity: DataFrame) -> DataFrame:
    """The longest-running real query (a top-1 report)."""
    return real_queries(activity).orderBy("query_start", "current_query").limit(1)


def long_query(activity: DataFrame, now: str, warn_hours: int = 5, crit_hours: int = 7) -> DataFrame:
    """Full hours the oldest real query has run, per database, with the level."""
    oldest = real_queries(activity).groupBy("database").agg(F.min("query_start").alias("query_start"))
    seconds = epoch_seconds(F.lit(now).cast("timestamp_ntz")) - epoch_seconds(F.col("query_start"))
    hours = F.floor(seconds / 3600).cast("bigint")
    return oldest.select("database", hours.alias("hours"), classify(hours, warn_hours, crit_hours).alias("severity"))


def _pieces(lines: DataFrame, digit_sizes: list[int], hex_sizes: list[int]) -> DataFrame:
    """(line_no, term): all substrings of digits, and of hexadecimal digits, that have one of the sizes (ascending).

    The latter may leave out substrings of digits only, as those have sizes of their own.
    """
    parts = [
        F.regexp_extract_all("line", F.lit(f"{alphabet}{{{sizes[0]},}}"), F.lit(0))
        for alphabet, sizes in (("[0-9]", digit_sizes), ("[0-9a-f]", hex_sizes)) if sizes
    ]
    runs = lines.select("line_no", F.explode(F.concat(*parts)).alias("run"))
    sizes = F.when(F.col("run").rlike("[a-f]"), F.lit(hex_sizes)).otherwise(F.lit(digit_sizes)).cast("array<int>")
    sized = runs.select("line_no", "run", F.explode(sizes).alias("size")).filter("length(run) >= size")
    placed = sized.select("line_no", "run", "size", F.explode(F.expr("sequence(1, length(run) - size + 1)")).alias("at"))
    return placed.select("line_no", F.expr("substring(run, at, size)").alias("term"))


def trace_related_lines(
    lines: DataFrame,
    search: str,
    follow_pid: bool = False,
    follow_auth: bool = False,
    follow_trace: bool = False,
    include_errors: bool = False,
) -> DataFrame:
    """Lines holding the search text, and later lines related to them.

    A matching line adds its process id, token or trace id as search terms for
    *later* lines, transitively.  ``lines`` carries ``line_no`` and ``line``.

    Followed terms are digits or hexadecimal digits, so each line is cut into
    the substrings that have a term's alphabet and length, and the substring
    test becomes an equi-join.  A term counts from the first reached line that
    yields it; a line that holds a term and yields others is a step from the
    one to the others at its line number.  No line up to the first that yields
    a term is reached by it, so its steps begin behind that line.  The earliest
    line of each term settles by relaxing the steps, several hops in one plan
    and twice as many in the next, so a chain of n hops takes about log2(n) jobs.
    """
    direct = F.col("line").contains(search)
    if include_errors:
        direct = direct | F.col("line").contains("[ERR")
    patterns = [p for p, on in ((LINE_PID, follow_pid), (LINE_AUTH, follow_auth), (LINE_TRACE, follow_trace)) if on]
    if not patterns:
        return lines.join(lines.filter(direct).select("line_no"), "line_no", "left_semi")

    terms = F.array_distinct(F.array_remove(F.array(*[F.regexp_extract("line", p, 1) for p in patterns]), ""))
    found = lines.select("line_no", F.explode_outer(terms).alias("term"), direct.alias("direct"))
    found = materialize(found.filter("line_no IS NOT NULL AND (direct OR term IS NOT NULL)"), "trace-yields")
    first, yields = found.filter("direct").select("line_no"), found.filter("term IS NOT NULL")
    digits, head = F.col("term").rlike("^[0-9]+$"), F.substring("term", 1, 15).try_cast("long")
    # One row for each distinct term length and alphabet: a handful of small numbers.
    kinds = yields.groupBy(digits.alias("digits"), F.length("term").alias("size")).agg(
        F.min(head).alias("low"), F.max(head).alias("high"), F.min(F.when(F.col("direct"), F.col("line_no"))).alias("start")
    ).orderBy("digits", "size").collect()
    start = min((k["start"] for k in kinds if k["start"] is not None), default=None)
    if start is None:
        return lines.join(first, "line_no", "left_semi")
    fits = F.lit(False)
    for k in kinds:
        fits = fits | (F.length("term") == k["size"]) & (head.between(k["low"], k["high"]) if k["digits"] else F.lit(True))
    digit_sizes, hex_sizes = ([k["size"] for k in kinds if k["digits"] == only] for only in (True, False))
    pieces = _pieces(lines.filter(F.col("line_no") > start), digit_sizes, hex_sizes).filter(fits)
    known = yields.filter(F.col("line_no") >= start).groupBy("term").agg(F.min("line_no").alias("first"))
    holds = pieces.join(known, "term").filter(F.col("line_no") > F.col("first")).select("line_no", "term")
    # Spread by line once, for the distinct rows and for the join.
    holds = holds.repartition("line_no").distinct()
    steps = holds.join(yields.select("line_no", F.col("term").alias("next")), "line_no", "left")
    steps = materialize(steps.select("term", F.nullif("next", "term").alias("next"), "line_no"), "trace-steps")
    since = yields.filter("direct").groupBy("term").agg(F.min("line_no").alias("since"))
    since = _earliest(since, steps.filter("next IS NOT NULL"))
    later = steps.join(since, "term").filter(F.col("line_no") > F.col("since")).select("line_no")
    return lines.join(first.unionByName(later).distinct(), "line_no", "left_semi")


FIRST_HOPS, MOST_HOPS = 2, 64


def _earliest(since: DataFrame, steps: DataFrame) -> DataFrame:
    """(term, since) when no step (term, next, line_no) brings any term earlier: the least line that yields it.

    A step counts if its line comes after its term's.  Every round writes the numbers with a count of those that its last
    hop brought down, and the rounds end when there are none.  In a hop each term is met once by its steps; terms are
    folded before the shuffle.  The terms, which are unique, are hashed in their partitions: the steps are shuffled once a
    round and stream past them unsorted.
    """
    def hop(table):
        reach = F.struct(F.col("next").alias("term"), F.col("line_no").alias("since"), F.lit(None).cast("long").alias("before"))
        own = F.struct("term", "since", F.col("since").alias("before"))
        rows = table.hint("shuffle_hash").join(steps, "term", "left").select(F.explode(F.array(own, F.when(F.col("line_no") > F.col("since"), reach))).alias("r"))
        return rows.filter("r IS NOT NULL").groupBy("r.term").agg(F.min("r.since").alias("since"), F.min("r.before").alias("before"))

    table, hops = materialize(since, "trace-since"), FIRST_HOPS
    while True:
        further = table
        for _ in range(hops):
            further = hop(further.select("term", "since"))
        observed = Observation()
        earlier = F.count_if(F.col("before").isNull() | (F.col("since") < F.col("before"))).alias("earlier")
        table = materialize(further.observe(observed, earlier), "trace-since").select("term", "since")
        if not observed.get["earlier"]:
            return table
        hops = min(2 * hops, MOST_HOPS)
