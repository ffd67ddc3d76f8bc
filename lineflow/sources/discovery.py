"""Discovery of files as a streaming source, by modification time and by dated directories.

A store whose listing isn't consistent shows a file later than a newer one. So files are
looked for from a low mark on, which trails the newest time seen by an offset, and those
above it that were taken are remembered with their times: a file is taken once, again if
it is rewritten, and also if it is listed late by up to the offset.

Directories named by time, such as 20240131/2345, are walked level by level. Those that
lie further behind the directory mark than `rescan` aren't listed, nor are their parents.
Newer ones are listed in chunks of time; an empty chunk is jumped over, and the first that
has files ends the scan, so that a backlog comes in batches.

Each scan that takes files is written to a log, of which an offset is the number: batches
can be replayed, and a restart goes on from the last scan.

    spark.dataSource.register(NodeFiles)
    spark.readStream.format("node_files").option("log", "s3://bucket/log").load("s3://bucket/in")
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from lineflow.sources.stores import locate, read_file

NEVER = -(1 << 62)
#: path, modification time in microseconds, length.
File = tuple[str, int, int]


@dataclass
class Marks:
    """What a scan leaves: the number of scans, low and high mark and directory mark (microseconds), files taken above the low mark."""

    scan: int = 0
    low: int = NEVER
    high: int = NEVER
    directory: int | None = None
    processed: dict[str, int] = field(default_factory=dict)


def _us(t: datetime) -> int:
    return int(t.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000


class Discovery:
    """Scans of one root. `listed` holds the directories of the last scan, in order."""

    def __init__(self, root: str, offset_s: float = 2, formats: str | None = None, chunk_s: int = 900, rescan_s: int = 2700, glob: str = "*", backlog: bool = False):
        self.fs, self.root, self.prefix = locate(root.rstrip("/"))
        self.offset, self.formats, self.chunk, self.rescan = int(offset_s * 1e6), formats and formats.split("/"), chunk_s * 1_000_000, rescan_s * 1_000_000
        self.glob, self.backlog, self.listed = glob, backlog, []

    def _list(self, path: str) -> list[pafs.FileInfo]:
        self.listed.append(path)
        return sorted(self.fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)), key=lambda i: i.path)

    def _time(self, names: list[str]) -> int | None:
        """Time that the names of a directory and its parents tell, down to their level."""
        try:
            return _us(datetime.strptime("/".join(names), "/".join(self.formats[: len(names)])))
        except ValueError:
            return None

    def _cut(self, mark: int, level: int) -> int:
        """The mark less the rescan, cut to the precision of a level."""
        at = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=mark - self.rescan)
        form = "/".join(self.formats[:level])
        return _us(datetime.strptime(at.strftime(form), form))

    def _below(self, path: str) -> Iterator[pafs.FileInfo]:
        """All files under a path."""
        for info in self._list(path):
            if info.type == pafs.FileType.Directory and not info.base_name.startswith((".", "_")):
                yield from self._below(info.path)
            elif info.type == pafs.FileType.File:
                yield info

    def _walk(self, path: str, names: list[str], mark: int | None, loose: list) -> Iterator[tuple[int, str]]:
        """(time, path) of the dated directories that may have new files; what lies beside them goes to loose."""
        level = len(names) + 1
        for info in self._list(path):
            if info.type == pafs.FileType.File:
                loose.append(info)
            elif info.type == pafs.FileType.Directory and not info.base_name.startswith((".", "_")):
                time = self._time([*names, info.base_name])
                if time is None:
                    loose += self._below(info.path)
                elif mark is None or time >= self._cut(mark, level):
                    if level == len(self.formats):
                        yield time, info.path
                    else:
                        yield from self._walk(info.path, [*names, info.base_name], mark, loose)

    def _new(self, infos: list[pafs.FileInfo], marks: Marks) -> list[File]:
        out = []
        for info in infos:
            at, path = info.mtime_ns // 1000, f"{self.prefix}{info.path}"
            if info.base_name.startswith((".", "_")) or info.base_name.endswith("_COPYING_") or not fnmatch(info.base_name, self.glob):
                continue
            if at <= marks.low or at <= marks.high and at <= marks.processed.get(path, NEVER):
                continue
            out.append((path, at, info.size))
        return out

    def scan(self, marks: Marks) -> tuple[Marks, list[File]]:
        """The next marks, and the files to take, oldest first; the same marks if there are none."""
        self.listed, directory = [], marks.directory
        if self.formats is None:
            taken = self._new(list(self._below(self.root)), marks)
        else:
            loose: list[pafs.FileInfo] = []
            dated = sorted(self._walk(self.root, [], directory, loose))
            old = [path for time, path in dated if directory is not None and time <= directory]
            taken = self._new(loose + [i for path in old for i in self._below(path)], marks)
            new = [x for x in dated if directory is None or x[0] > directory]
            begin = directory if directory is not None else new[0][0] - 1_000_000 if new else 0
            chunks: dict[int, list[tuple[int, str]]] = {}
            for time, path in new:
                chunks.setdefault(-(-(time - begin) // self.chunk), []).append((time, path))
            for number in sorted(chunks):
                found = self._new([i for _, path in chunks[number] for i in self._below(path)], marks)
                if found:
                    taken, directory = taken + found, chunks[number][-1][0]
                    if not self.backlog:
                        break
        if not taken:
            return marks, []
        high = max(marks.high, max(at for _, at, _ in taken))
        low = max(high - self.offset, marks.low)
        processed = {p: at for p, at in (marks.processed | {p: at for p, at, _ in taken}).items() if at > low}
        return Marks(marks.scan + 1, low, high, directory, processed), sorted(taken, key=lambda f: (f[1], f[0]))


class ScanLog:
    """One file for each scan that took files, with its marks; written in one step."""

    def __init__(self, folder: str):
        self.fs, self.path, _ = locate(folder.rstrip("/"))

    def _file(self, scan: int) -> str:
        return f"{self.path}/scan-{scan:012d}.json"

    def append(self, marks: Marks, taken: list[File]) -> None:
        self.fs.create_dir(self.path)
        temporary = f"{self.path}/.{marks.scan}.tmp"
        with self.fs.open_output_stream(temporary) as f:
            f.write(json.dumps({**vars(marks), "taken": taken}).encode())
        self.fs.move(temporary, self._file(marks.scan))

    def last(self) -> Marks:
        names = [i.base_name for i in self.fs.get_file_info(pafs.FileSelector(self.path, allow_not_found=True)) if i.base_name.startswith("scan-")]
        if not names:
            return Marks()
        record = self._read(int(max(names)[5:-5]))
        return Marks(**{k: v for k, v in record.items() if k != "taken"})

    def _read(self, scan: int) -> dict:
        with self.fs.open_input_stream(self._file(scan)) as f:
            return json.loads(f.read())

    def taken(self, after: int, to: int) -> list[File]:
        return [tuple(f) for scan in range(after + 1, to + 1) for f in self._read(scan)["taken"]]


@dataclass
class Files(InputPartition):
    files: list[File]

    def __post_init__(self) -> None:
        super().__init__(None)


class _Reads:
    """Rows of a partition: names, times and sizes, and contents if asked for, opened in the task."""

    def __init__(self, options: dict[str, str]):
        self.content, self.each = options.get("content", "false").lower() == "true", int(options.get("filesPerPartition", 200))

    def split(self, files: list[File]) -> list[Files]:
        return [Files(files[i : i + self.each]) for i in range(0, len(files), self.each)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        step = 1 if self.content else 10_000
        for i in range(0, len(partition.files), step):
            path, at, size = map(list, zip(*partition.files[i : i + step]))
            columns = [pa.array(path), pa.array(at, pa.timestamp("us", "UTC")), pa.array(size, pa.int64())]
            names = ["path", "modificationTime", "length"]
            if self.content:
                columns, names = [*columns, pa.array([read_file(p) for p in path], pa.binary())], [*names, "content"]
            yield pa.RecordBatch.from_arrays(columns, names)


class NodeFiles(DataSource):
    """format("node_files"): path, modificationTime, length[, content] of new files.

    Options: path; log (streams), the folder of the scans; offsetSeconds (2), formats of
    dated directories (such as %Y%m%d/%H%M), chunkSeconds (900), rescanSeconds (2700),
    glob, content (false), filesPerPartition (200), backlog (false): whether a scan takes
    all chunks, as a run over what is there must.
    """

    @classmethod
    def name(cls) -> str:
        return "node_files"

    def schema(self) -> str:
        return "path string, modificationTime timestamp, length long" + (", content binary" if self.options.get("content", "false").lower() == "true" else "")

    def discovery(self, backlog: bool) -> Discovery:
        o = self.options
        return Discovery(o["path"], float(o.get("offsetSeconds", 2)), o.get("formats"), int(o.get("chunkSeconds", 900)), int(o.get("rescanSeconds", 2700)), o.get("glob", "*"), backlog)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BatchReader(self)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self)


class _BatchReader(DataSourceReader):
    def __init__(self, source: NodeFiles):
        self.reads, self.discovery = _Reads(source.options), source.discovery(True)

    def partitions(self) -> list[Files]:
        return self.reads.split(self.discovery.scan(Marks())[1])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        yield from self.reads.read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, source: NodeFiles):
        if "log" not in source.options:
            raise ValueError("option log: a folder for the scans of this stream")
        self.reads, self.log = _Reads(source.options), ScanLog(source.options["log"])
        self.discovery, self.marks = source.discovery(source.options.get("backlog", "false").lower() == "true"), self.log.last()

    def initialOffset(self) -> dict:
        return {"scan": 0}

    def latestOffset(self) -> dict:
        marks, taken = self.discovery.scan(self.marks)
        if taken:
            self.log.append(marks, taken)  # before Spark knows the offset: a scan is never lost, nor taken twice
            self.marks = marks
        return {"scan": self.marks.scan}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return self.reads.split(self.log.taken(start["scan"], end["scan"]))

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        yield from self.reads.read(partition)
