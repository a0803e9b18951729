"""Log files that grow while they are read, as a stream.

An offset is what was read of every file: the bytes up to the end of its last complete line, and two marks, hashes of
bytes at its beginning and before that end.  Marks, not names, say which file it is: a file that was renamed by
rotation goes on where it was left, one that was cut short or replaced under its old name is read from the start, and
a repeated batch finds its bytes again wherever the file is now.  If it is nowhere, the batch fails.

A last line without its line break waits for the next batch.  What is new in a file is read in parallel, in ranges of
``splitBytes``; a range has the lines that begin in it.  The driver lists the folder and looks at a few hundred bytes of
files whose size or date changed, plus what it takes to find the last line break; it reads no other content.
"""

from __future__ import annotations

import fnmatch
import hashlib
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of a mark, and bytes read at a time in search of a line break.
MARK_BYTES = 256
BLOCK_BYTES = 1 << 16
#: Lines in one batch of a task.
BATCH_LINES = 10_000

SCHEMA = "segment string, offset long, value string"


@dataclass
class Range(InputPartition):
    """Lines of ``path`` that begin in ``begin:end``; new bytes lie in ``low:high``, which ends with a line break."""

    path: str
    low: int
    begin: int
    end: int
    high: int


# --- files -------------------------------------------------------------------------------------------------


def _hash(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()[:32]


def _bytes(files: fs.FileSystem, path: str, begin: int, end: int) -> bytes:
    with files.open_input_file(path) as file:
        file.seek(begin)
        return file.read(end - begin)


def _last_break(files: fs.FileSystem, path: str, low: int, high: int) -> int:
    """The place after the last line break in ``low:high``, or ``low``."""
    with files.open_input_file(path) as file:
        end = high
        while end > low:
            begin = max(low, end - BLOCK_BYTES)
            file.seek(begin)
            found = file.read(end - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
    return low


def _next_break(files: fs.FileSystem, path: str, low: int, high: int) -> int:
    """The place after the first line break in ``low:high``, or ``high``."""
    with files.open_input_file(path) as file:
        file.seek(low)
        at = low
        while at < high:
            block = file.read(min(BLOCK_BYTES, high - at))
            if not block:
                break
            found = block.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(block)
    return high


def _marked(files: fs.FileSystem, path: str, at: int) -> dict:
    """How far a file was read, and the marks by which it is known again."""
    first = min(MARK_BYTES, at)
    return {"at": at, "head": _hash(_bytes(files, path, 0, first)), "tail": _hash(_bytes(files, path, at - first, at))}


def _is_same(files: fs.FileSystem, path: str, size: int, known: dict) -> bool:
    """Whether this is the file of which ``known`` tells, or one that begins like it."""
    at, first = known["at"], min(MARK_BYTES, known["at"])
    return size >= at and _hash(_bytes(files, path, 0, first)) == known["head"] and _hash(
        _bytes(files, path, at - first, at)) == known["tail"]


# --- stream ------------------------------------------------------------------------------------------------


class FollowReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.uri, self.glob = options["path"], options.get("glob", "*")
        self.split = max(1, int(options.get("splitbytes", 32 << 20)))
        #: Per path the size and date at which its entry was made.
        self.seen: dict[str, tuple[int, int, dict]] = {}

    def _open(self) -> tuple[fs.FileSystem, str]:
        if re.match(r"file:/(?!//)", self.uri):
            return fs.LocalFileSystem(), self.uri.removeprefix("file:")
        return fs.FileSystem.from_uri(self.uri) if "://" in self.uri else (fs.LocalFileSystem(), self.uri)

    def _listed(self, files: fs.FileSystem, root: str) -> dict[str, tuple[int, int]]:
        """Size and date of the files below the folder."""
        found = files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return {i.path: (i.size, i.mtime_ns or 0) for i in found
                if i.type == fs.FileType.File and fnmatch.fnmatch(posixpath.basename(i.path), self.glob)}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        files, root = self._open()
        now: dict[str, dict] = {}
        seen: dict[str, tuple[int, int, dict]] = {}
        for path, (size, date) in self._listed(files, root).items():
            if path in self.seen and self.seen[path][:2] == (size, date):
                entry = self.seen[path][2]
            else:
                entry = self._entry(files, path, size)
            if entry is not None:
                now[path], seen[path] = entry, (size, date, entry)
        self.seen = seen
        return {"files": now}

    def _entry(self, files: fs.FileSystem, path: str, size: int) -> dict | None:
        """How far ``path`` can be read now; None where it vanished meanwhile."""
        try:
            return _marked(files, path, _last_break(files, path, 0, size))
        except FileNotFoundError:
            return None

    def partitions(self, start: dict, end: dict) -> list[Range]:
        files, root = self._open()
        before, listed = start["files"], None
        out = []
        for name, entry in sorted(end["files"].items()):
            known = before.get(name)
            if known == entry or not entry["at"]:
                continue
            path = name
            try:
                there = _is_same(files, path, files.get_file_info(path).size or 0, entry)
            except FileNotFoundError:
                there = False
            if not there:  # renamed since the offset was taken
                listed = self._listed(files, root) if listed is None else listed
                path = next((p for p, (size, _) in sorted(listed.items()) if p != name and _is_same(files, p, size, entry)), None)
                if path is None:
                    raise ValueError(f"bytes up to {entry['at']} of {name} are gone: it was cut short or removed before they were read")
            low = self._begin(files, path, name, entry, before)
            for begin in range(low, entry["at"], self.split):
                out.append(Range(path, low, begin, min(begin + self.split, entry["at"]), entry["at"]))
        return out

    @staticmethod
    def _begin(files: fs.FileSystem, path: str, name: str, entry: dict, before: dict) -> int:
        """How far the file was read in earlier batches, under this name or another."""
        own = [before[name]] if name in before else []
        others = sorted((k for n, k in before.items() if n != name), key=lambda k: -k["at"])
        for known in own + others:
            if 0 < known["at"] <= entry["at"] and _is_same(files, path, entry["at"], known):
                return known["at"]
        return 0

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, _ = self._open()
        with files.open_input_file(partition.path) as file:
            at = partition.begin
            if at > partition.low:
                at = _next_break(files, partition.path, at - 1, partition.high)
            file.seek(at)
            rest, places, lines = b"", [], []
            while at < partition.end:
                # Whole blocks, then the end of the line that goes on over the end of the range.
                block = file.read(min(BLOCK_BYTES * 16, partition.high - at - len(rest)))
                if not block and not rest:
                    break
                parts = (rest + block).split(b"\n")
                rest = parts.pop()
                for part in parts:
                    if at >= partition.end:
                        break
                    places.append(at)
                    lines.append((part[:-1] if part.endswith(b"\r") else part).decode("utf-8", "ignore"))
                    at += len(part) + 1
                    if len(lines) >= BATCH_LINES:
                        yield self._batch(partition.path, places, lines)
                        places, lines = [], []
                if not block:
                    break
            if lines:
                yield self._batch(partition.path, places, lines)

    @staticmethod
    def _batch(path: str, places: list, lines: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * len(lines), pa.string()), pa.array(places, pa.int64()), pa.array(lines, pa.string())],
            ["segment", "offset", "value"])


class FollowSource(DataSource):
    """Format ``logweft_follow``."""

    @classmethod
    def name(cls) -> str:
        return "logweft_follow"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> FollowReader:
        return FollowReader({k.lower(): v for k, v in self.options.items()})


def follow_log_lines(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    source: Column | None = None,
    split_bytes: int = 32 << 20,
) -> DataFrame:
    """Lines appended to the files below ``path``, each once: ``source, segment, offset, value``.

    ``segment`` is the file at the time of reading and ``offset`` the byte at which the line begins in it.  ``source``
    is an expression on ``segment``; by default the file's name without what rotation appends to it.  A batch takes all
    that is new; Python sources cannot be bounded across restarts.
    """
    spark.dataSource.register(FollowSource)
    reader = spark.readStream.format("logweft_follow").option("path", path).option("glob", glob).option("splitBytes", split_bytes)
    name = F.regexp_replace(F.element_at(F.split("segment", "/"), -1), r"\.\d{8}_\d{6}\.\d+$", "")
    return reader.load().select((name if source is None else source).alias("source"), "segment", "offset", "value")
