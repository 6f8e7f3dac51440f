"""Log files that grow, as a stream with a byte offset for each file.

The checkpoint keeps up to which byte each file was read.  A batch takes what was appended since,
up to the last line end; a half-written line waits for its end.  A file that became shorter was
replaced and is read from its start; one that was replaced by a longer one between two
batches looks like a grown one, so rotate by renaming.  The renamed file is read again if the pattern
matches its new name.  Files that vanish before they were read are left out.

Large files are split: a line belongs to the range its first byte is in.  The driver lists the
files and reads back from the end of each that changed to its last line end.  Files are opened by
the driver and the tasks, below a mounted folder or by any address that Arrow opens.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The reader runs in processes of its own, which need no installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "growing_lines"

#: Bytes of a file that one task reads, and that it holds besides the line it is in.
SPLIT_BYTES = 64 << 20
_PIECE = 1 << 20

_SCHEMA = pa.schema([("value", pa.binary()), ("path", pa.string())])


@dataclass
class Range(InputPartition):
    """Lines of ``path`` that begin at ``begin`` or later and before ``end``; a line begins at ``first``."""

    path: str
    first: int
    begin: int
    end: int


def matching(files: fs.FileSystem, pattern: str) -> dict[str, int]:
    """Sizes of the files whose path matches, part by part; hidden ones are left out."""
    parts = pattern.split("/")
    plain = next((i for i, part in enumerate(parts) if set(part) & set("*?[")), len(parts) - 1)
    below = fs.FileSelector("/".join(parts[:plain]) or "/", recursive=True, allow_not_found=True)
    return {
        info.path: info.size
        for info in files.get_file_info(below)
        if info.type == fs.FileType.File
        and not info.base_name.startswith(("_", "."))
        and info.path.count("/") == len(parts) - 1
        and all(fnmatchcase(a, b) for a, b in zip(info.path.split("/"), parts, strict=True))
    }


def last_line_end(files: fs.FileSystem, path: str, size: int, known: int) -> int:
    """Where the last whole line ends; ``known`` is such an end, and none may follow."""
    with files.open_input_file(path) as file:
        high = size
        while high > known:
            low = max(known, high - _PIECE // 16)
            file.seek(low)
            found = file.read(high - low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            high = low
    return known


def lines_of(files: fs.FileSystem, part: Range) -> Iterator[list[bytes]]:
    """The range's lines without their ends, in lists of about a megabyte."""
    with files.open_input_file(part.path) as file:
        # From one byte before, a line that begins at ``begin`` follows an end.
        skip = part.begin > part.first
        at = part.begin - skip
        file.seek(at)
        rest, start = [], at  # the open line and where it begins
        while start < part.end:
            piece = file.read(_PIECE)
            if not piece:
                return
            cut = piece.rfind(b"\n") + 1
            if not cut:
                rest.append(piece)
                continue
            lines = b"".join([*rest, piece[:cut]]).split(b"\n")[:-1]
            rest, out = [piece[cut:]], []
            for line in lines:
                if start >= part.end:
                    break
                if not skip:
                    out.append(line.removesuffix(b"\r"))
                skip = False
                start += len(line) + 1
            yield out


class _Reader(DataSourceStreamReader):
    def __init__(self, pattern: str, split: int):
        self.pattern, self.split = pattern, split
        self.ends: dict[str, int] = {}
        self.sizes: dict[str, int] = {}

    def _opened(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.pattern)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        files, pattern = self._opened()
        sizes, ends = matching(files, pattern), {}
        for path, size in sizes.items():
            known = self.ends.get(path, 0)
            if size == self.sizes.get(path):
                ends[path] = known
            else:
                ends[path] = last_line_end(files, path, size, known if size >= known else 0)
        self.sizes, self.ends = sizes, ends
        return ends

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, stop in end.items():
            first = start.get(path, 0)
            first = first if first <= stop else 0
            out += [
                Range(path, first, low, min(low + self.split, stop)) for low in range(first, stop, self.split)
            ]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, _ = self._opened()
        for lines in lines_of(files, partition):
            paths = pa.array([partition.path] * len(lines), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), paths], schema=_SCHEMA)

    def commit(self, end: dict) -> None:
        pass


class GrowingLines(DataSource):
    """Options: ``path``, a pattern, and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value binary, path string"

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def growing_log_stream(spark: SparkSession, glob: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines appended to the files, each once, as a stream of ``value, path``."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).option("splitBytes", split_bytes).load(glob)
