"""Text log sources: hourly files as batch or as a stream that resumes inside growing files."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Fixed value: how an hourly file path spells its day and hour.
HOUR_IN_PATH = r"(\d{4})/(\d{2})/(\d{2})/[^/]*?\.(\d{2})\.log"

BLOCK_BYTES = 32 << 20  # of a file's new bytes that one task reads
LOOK_BACK = 64 << 10
HEAD_BYTES = 256  # by which a file is known again
OPENERS = 32  # files looked at side by side on the driver
GROWING = pa.schema([("line", pa.string()), ("file", pa.string())])


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, hour) of hourly files below ``path``; the hour comes from the file name."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("value").alias("line"), hour_in_path(F.col("_metadata.file_path")).alias("hour"))


def stream_log_lines(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The same as a stream that also sees lines appended to files it has read.

    The query's checkpoint keeps a byte position per file, so each line comes once, also after a restart.  A line counts
    when its line feed is written; text after a file's last line feed waits for the next run.  A file that has become
    shorter, or that begins with other bytes than before, was started anew and is read from its beginning.  Files are plain
    UTF-8 text; names led by ``.`` or ``_`` are left out, as Spark's own readers do.  ``path`` may be any URI that pyarrow's
    file systems open; one without a scheme lies in the session's default store (``spark.hadoop.fs.defaultFS``), as for
    Spark's own readers.  A folder that does not exist is an error.
    """
    store = spark.conf.get("spark.hadoop.fs.defaultFS", None)
    if store and path.startswith("/"):
        path = store.rstrip("/") + path
    spark.dataSource.register(GrowingLog)
    lines = spark.readStream.format(GrowingLog.name()).option("blockBytes", str(block_bytes)).load(path)
    return lines.select("line", hour_in_path(F.col("file")).alias("hour"))


def stamped_line(value):
    """(ts, line) of text led by ``yyyy-MM-dd HH:mm:ss[.ffffff] host ``; ``ts`` is NULL without it."""
    pattern = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?) \S+ (.*)$"
    matched = value.rlike(pattern)
    return F.struct(
        F.when(matched, F.regexp_extract(value, pattern, 1).try_cast("timestamp_ntz")).alias("ts"),
        F.when(matched, F.regexp_extract(value, pattern, 2)).otherwise(value).alias("line"),
    )


def hour_in_path(path: Column) -> Column:
    parts = [F.regexp_extract(path, HOUR_IN_PATH, n) for n in range(1, 5)]
    stamp = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit(" "), parts[3], F.lit(":00:00"))
    return stamp.try_cast("timestamp_ntz")


# ---- growing files -----------------------------------------------------------
@dataclass
class Block(InputPartition):
    """The bytes [start, end) of a file; it owns the lines whose line feed lies in it."""

    file: str
    start: int
    end: int


class GrowingLog(DataSource):
    """Streaming source of log files: the offset is the length read and the beginning of each file, tasks read the new bytes."""

    @classmethod
    def name(cls) -> str:
        return "growing_log"

    def schema(self) -> str:
        return "line string, file string"

    def streamReader(self, schema) -> GrowingLogReader:
        return GrowingLogReader(self.options["path"], int(self.options.get("blockBytes", BLOCK_BYTES)))


def _known(offset: dict) -> dict[str, tuple[int, int | None]]:
    """(length, checksum of the beginning) of an offset's files; offsets of earlier versions hold lengths only."""
    return {file: tuple(v) if isinstance(v, list) else (v, None) for file, v in json.loads(offset["files"]).items()}


class GrowingLogReader(DataSourceStreamReader):
    def __init__(self, path: str, block_bytes: int):
        self.path, self.block_bytes = path, block_bytes
        self._heads: dict[str, tuple[object, int]] = {}  # of files that have not changed since

    def _open(self) -> tuple[fs.FileSystem, str]:
        path = self.path
        if path.startswith("file:"):
            path = "/" + path.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def _head(self, store: fs.FileSystem, file: str, size: int) -> int:
        """Checksum of the file's first bytes, at most ``size`` of them."""
        with store.open_input_file(file) as source:
            return zlib.crc32(source.read_at(min(size, HEAD_BYTES), 0))

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        """Length and checksum of all files, as text because offsets hold plain values only; unchanged files are not opened."""
        store, root = self._open()
        found = {}
        for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
            below = info.path.removeprefix(root.rstrip("/") + "/").split("/")
            if info.type == fs.FileType.File and not any(part.startswith((".", "_")) for part in below):
                found[info.path] = info.size, info.mtime_ns
        new = [file for file, state in found.items() if self._heads.get(file, (None,))[0] != state]
        with ThreadPoolExecutor(OPENERS) as openers:
            heads = dict(zip(new, openers.map(lambda file: self._head(store, file, found[file][0]), new), strict=True))
        self._heads = {file: (state, heads[file] if file in heads else self._heads[file][1]) for file, state in found.items()}
        return {"files": json.dumps({file: [state[0], head] for file, (state, head) in self._heads.items()}, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Block]:
        before, latest = _known(start), _known(end)
        store = self._open()[0] if before else None

        def first(file: str) -> int:
            """Where the new bytes of a file begin: behind what was read, or at 0 if it was started anew.

            A beginning that was still short when it was read is compared over that length.
            """
            length, head = before.get(file, (0, None))
            size, latest_head = latest[file]
            if size < length:
                return 0
            if head is not None and min(length, HEAD_BYTES) < min(size, HEAD_BYTES):
                latest_head = self._head(store, file, length)
            return length if head is None or latest_head in (None, head) else 0

        with ThreadPoolExecutor(OPENERS) as openers:
            firsts = list(openers.map(first, latest))
        return [
            Block(file, at, min(at + self.block_bytes, size))
            for (file, (size, _)), begin in zip(latest.items(), firsts, strict=True)
            for at in range(begin, size, self.block_bytes)
        ]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        store, _ = self._open()
        with store.open_input_file(partition.file) as source:
            data = source.read_at(partition.end - partition.start, partition.start)
            last = data.rfind(b"\n")
            if last < 0:
                return
            # The first line may have begun in an earlier block.
            at, head = partition.start, b""
            while at > 0 and b"\n" not in head:
                step = min(at, max(LOOK_BACK, len(head)))
                at -= step
                head = source.read_at(step, at) + head
        lines = (head[head.rfind(b"\n") + 1 :] + data[:last]).split(b"\n")
        for k in range(0, len(lines), 10_000):
            texts = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines[k : k + 10_000]]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([partition.file] * len(texts), pa.string())], schema=GROWING)
