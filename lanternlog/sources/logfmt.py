"""``key=value`` log files as a data source of their own: splits, filters on times and levels, streams.

Lines look like ``ts=2024-05-01T10:00:00 level=info id=7 msg="said \\"no\\"" user=3``; values with
blanks, quotes or ``=`` are quoted, with a backslash before quotes and backslashes. ``ts``, ``level``, ``id``
and ``msg`` are columns, the other keys are the map ``rest``. A line without ``ts`` or with an odd
form keeps its text in ``bad`` and nothing else, so it can be set apart by its reason later.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

FORMAT = "logfmt"
SCHEMA = "ts timestamp_ntz, level string, id string, msg string, rest map<string,string>, bad string"
PAIR = re.compile(r'([A-Za-z_][\w.-]*)=("(?:[^"\\]|\\.)*"|[^\s"=]*)(?:\s+|$)')
SPLIT_BYTES = 32 << 20


def file_system(path: str):
    """(file system, path there) by ``pyarrow``: shared mounts, HDFS, object stores."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the files of a folder, or of one file, by name."""
    from pyarrow import fs

    system, at = file_system(path)
    info = system.get_file_info(at)
    found = system.get_file_info(fs.FileSelector(at, recursive=True)) if info.type == fs.FileType.Directory else [info]
    return sorted((x.path, x.size) for x in found if x.type == fs.FileType.File and not x.base_name.startswith(("_", ".")))


def line_values(line: str) -> tuple:
    """The columns of one line."""
    pairs, at = {}, 0
    while at < len(line):
        m = PAIR.match(line, at)
        if not m:
            return (None, None, None, None, None, line)
        value = m[2]
        pairs[m[1]] = re.sub(r"\\(.)", r"\1", value[1:-1]) if value[:1] == '"' else value
        at = m.end()
    try:
        stamp = datetime.fromisoformat(pairs.pop("ts"))
        if stamp.tzinfo:
            raise ValueError("a time without a zone is needed")
    except (KeyError, ValueError):
        return (None, None, None, None, None, line)
    named = [pairs.pop(k, None) for k in ("level", "id", "msg")]
    return (stamp, *named, pairs, None)


@dataclass
class Span(InputPartition):
    """Bytes of a file: the lines that begin in them."""

    path: str
    start: int
    end: int

    def __init__(self, path: str, start: int, end: int):
        super().__init__(path)
        self.path, self.start, self.end = path, start, end


class Terms:
    """Filters taken over from Spark: comparisons of ``ts``, values of ``level``."""

    def __init__(self) -> None:
        self.low: list[tuple[datetime, bool]] = []
        self.high: list[tuple[datetime, bool]] = []
        self.levels: list[set] = []

    def take(self, f: Filter) -> bool:
        """Whether the filter is applied here, for good."""
        at = getattr(f, "attribute", None)
        if at == ("level",) and isinstance(f, (EqualTo, In)):
            self.levels.append(set(f.value) if isinstance(f, In) else {f.value})
        elif at == ("ts",) and isinstance(getattr(f, "value", None), datetime) and not f.value.tzinfo:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low.append((f.value, isinstance(f, GreaterThanOrEqual)))
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.high.append((f.value, isinstance(f, LessThanOrEqual)))
            else:
                return False
        else:
            return False
        return True

    def hold(self, row: tuple) -> bool:
        stamp, level = row[:2]
        if (self.low or self.high) and stamp is None or any(level not in x for x in self.levels):
            return False
        return all(stamp > t or same and stamp == t for t, same in self.low) and all(stamp < t or same and stamp == t for t, same in self.high)


def read_span(root: str, span: Span, terms: Terms) -> Iterator[tuple]:
    """Rows of the lines that begin inside the span; a line over its end is read to its own end."""
    system, _ = file_system(root)
    with system.open_input_file(span.path) as f:
        at = max(span.start - 1, 0)
        f.seek(at)
        held = b""
        if span.start:  # the line before ends at its mark, which may be the byte before the span
            while (block := f.read(1 << 16)) and b"\n" not in block:
                at += len(block)
            if not block:
                return
            cut = block.index(b"\n") + 1
            held, at = block[cut:], at + cut
        while at < span.end:
            while b"\n" not in held and (block := f.read(1 << 20)):
                held += block
            line, mark, held = held.partition(b"\n")
            if not line and not mark:
                return
            at += len(line) + len(mark)
            if text := line.decode("utf-8", "replace").strip():
                row = line_values(text)
                if terms.hold(row):
                    yield row


class LogfmtReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))
        self.terms = Terms()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.terms.take(f):
                yield f

    def partitions(self) -> list[Span]:
        return [Span(p, at, min(at + self.split, size)) for p, size in files(self.path) for at in range(0, size, self.split)]

    def read(self, partition: Span | None) -> Iterator[tuple]:
        return read_span(self.path, partition, self.terms) if partition else iter(())


class LogfmtStreamReader(DataSourceStreamReader):
    """New files of a folder, by name: names must sort in the order of arrival, and a file is whole when it appears."""

    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        found = files(self.path)
        return {"after": found[-1][0] if found else ""}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        new = [(p, size) for p, size in files(self.path) if start["after"] < p <= end["after"]]
        return [Span(p, at, min(at + self.split, size)) for p, size in new for at in range(0, size, self.split)]

    def read(self, partition: Span) -> Iterator[tuple]:
        return read_span(self.path, partition, Terms())

    def commit(self, end: dict) -> None:
        """Files stay where they are."""


class LogfmtSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogfmtReader:
        return LogfmtReader(self.options)

    def streamReader(self, schema) -> LogfmtStreamReader:
        return LogfmtStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format('logfmt')`` known; filters are handed to Python sources only where the session says so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LogfmtSource)
