"""Subtitle files, shot lists and JSON lines as Spark data sources, batch and stream; one text file for each row as a sink.

``register(spark)`` makes the formats ``srt``, ``shot_list``, ``record_lines`` and ``entity_files`` known, and the table function
``explode_srt``. A partition of a scan is many small files or a large one. Paths are folders or files of any file system that Arrow knows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType

from reelspark.functions.texts import SPEAKER_PREFIXES
from reelspark.sources.records import COMPLETE

#: Files of a partition: so many, and so many bytes; where that gives more than ``_PARTITIONS``, so many more files as it takes.
_FILES, _BYTES, _PARTITIONS = 100, 32 << 20, 1000
#: Threads that move files into place, and files that one takes at a time.
_MOVERS, _MOVES = 16, 500
_TIME = re.compile(r"\s*(\d+):(\d+):(\d+),(\d+)\s*")


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _listed(path: str, ending: str) -> list[tuple[int, str, int]]:
    """(time of change in ns, path, bytes) of the files, in that order; hidden and unfinished ones are passed over."""
    fs, root = _opened(path)
    info = fs.get_file_info(root)
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True)) if info.type == pafs.FileType.Directory else []
    files = [i for i in found if i.type == pafs.FileType.File and not any(p.startswith((".", "_")) for p in i.path[len(root) :].split("/")) and i.path.lower().endswith(ending)]
    return sorted((i.mtime_ns, i.path, i.size or 0) for i in files)


def _read(fs: pafs.FileSystem, file: str) -> str:
    with fs.open_input_stream(file) as f:
        return f.read().decode("utf-8", "replace")


def _seconds(code: str) -> float | None:
    m = _TIME.fullmatch(code)
    return int(m[1]) * 3600 + int(m[2]) * 60 + int(m[3]) + int(m[4]) / 1000 if m else None


def srt_rows(text: str) -> Iterator[tuple[int, float, float, str]]:
    """idx, start, end, text of a file's cues; the rules are those of ``subtitles.srt_cues``."""
    kept = 0
    for block in re.split(r"\n\s*\n", text.replace("\r\n", "\n").replace("﻿", "").strip()):
        lines = [x.strip() for x in block.split("\n") if x.strip()]
        timed = bool(lines) and "-->" in lines[0]
        if len(lines) < 2 - timed:
            continue
        times = lines[0 if timed else 1].split("-->")
        start, end = (_seconds(x) for x in (times[0], times[1] if len(times) > 1 else ""))
        said = " ".join(lines[1 if timed else 2 :]).strip()
        for prefix in SPEAKER_PREFIXES:
            said = re.sub(prefix, "", said)
        said = said.strip()
        if start is not None and end is not None and end > start and said:
            kept += 1
            own = None if timed or not re.fullmatch(r"[+-]?\d+", lines[0]) else int(lines[0])
            yield kept if own is None else own, round(start, 3), round(end, 3), said


def shot_rows(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """line_no, start_frame, end_frame of a shot list's lines, each with whether the list is finished."""
    lines = text.splitlines()
    complete = next((x.strip() == COMPLETE for x in reversed(lines) if x.strip()), False)
    for number, line in enumerate(lines):
        if m := re.fullmatch(r"\s*(-?\d+)\s+(-?\d+)(\s.*)?", line):
            yield number, int(m[1]), int(m[2]), complete


def record_rows(text: str) -> Iterator[tuple[int, str]]:
    """line_no, line of the lines that are JSON objects; others are passed over."""
    for number, line in enumerate(re.split(r"\r?\n", text)):
        try:
            if isinstance(json.loads(line), dict):
                yield number, line
        except ValueError:
            pass


@dataclass
class _Files(InputPartition):
    paths: list[str]


def _packed(files: list[tuple[int, str, int]]) -> list[_Files]:
    """All files in their order, dealt to partitions: starting a task takes longer than reading some hundred small files."""
    most, out, size = max(_FILES, -(-len(files) // _PARTITIONS)), [], 0
    for _, path, n in files:
        if not out or len(out[-1].paths) >= most or size + n > _BYTES:
            out.append(_Files([]))
            size = 0
        out[-1].paths.append(path)
        size += n
    return out


class _Reader(DataSourceReader):
    def __init__(self, path: str, ending: str, parse: Callable):
        self.path, self.ending, self.parse = path, ending, parse

    def partitions(self) -> list[_Files]:
        return _packed(_listed(self.path, self.ending))

    def read(self, partition: _Files) -> Iterator[tuple]:
        if partition is not None:
            fs = _opened(self.path)[0]
            for path in partition.paths:
                for row in self.parse(_read(fs, path)):
                    yield (path, *row)


class _StreamReader(_Reader, DataSourceStreamReader):
    """An offset is the last file taken, by time of change and path; files are expected to be moved into place whole."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        found = _listed(self.path, self.ending)
        return {"time": found[-1][0], "path": found[-1][1]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[_Files]:
        low, high = ((x["time"], x["path"]) for x in (start, end))
        return _packed([f for f in _listed(self.path, self.ending) if low < f[:2] <= high])


class _Source(DataSource):
    ending, rows = "", ""
    parse: Callable

    def schema(self) -> str:
        return f"path string, {self.rows}"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.ending, type(self).parse)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options["path"], self.ending, type(self).parse)


class SrtSource(_Source):
    ending, rows, parse = ".srt", "idx long, start double, end double, text string", staticmethod(srt_rows)

    @classmethod
    def name(cls) -> str:
        return "srt"


class ShotListSource(_Source):
    ending, rows, parse = ".txt", "line_no long, start_frame long, end_frame long, complete boolean", staticmethod(shot_rows)

    @classmethod
    def name(cls) -> str:
        return "shot_list"


class RecordLinesSource(_Source):
    ending, rows, parse = ".jsonl", "line_no long, line string", staticmethod(record_rows)

    @classmethod
    def name(cls) -> str:
        return "record_lines"


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    names: list[str]


class EntityFiles(DataSource):
    """Sink of (name, text): a file ``name`` below the path for each row. An append fails where a file is there already, an overwrite replaces it.

    A task writes into a folder of its own below ``_unfinished``; a commit moves the files of one attempt a task to their
    places. So a task that runs twice leaves one result, and a job that fails leaves nothing.
    """

    @classmethod
    def name(cls) -> str:
        return "entity_files"

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        out = _Writer(self.options["path"], [f.name for f in schema.fields], overwrite)
        fs, root = _opened(out.path)
        fs.create_dir(f"{root}/_unfinished/{out.job}", recursive=True)
        return out


class _Writer(DataSourceWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex
        self.name_at, self.text_at = columns.index("name"), columns.index("text")

    def write(self, iterator: Iterator) -> _Written:
        fs, root = _opened(self.path)
        folder, names, made = f"{root}/_unfinished/{self.job}/{uuid.uuid4().hex}", [], set()

        def make(path: str) -> None:
            # The job's folder itself is never made here: a task that goes on after an abort finds it gone, and fails.
            if path not in made and path != f"{root}/_unfinished/{self.job}":
                make(path.rpartition("/")[0])
                fs.create_dir(path, recursive=False)
                made.add(path)

        for row in iterator:
            name = row[self.name_at]
            if not name or name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"{name!r} is no name of a file below the path")
            make(f"{folder}/{name}".rpartition("/")[0])
            with fs.open_output_stream(f"{folder}/{name}") as f:
                f.write((row[self.text_at] or "").encode())
            names.append(name)
        return _Written(folder, names)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, root = _opened(self.path)
        every = [n for m in messages if m for n in m.names]
        if len(every) != len(set(every)):
            self.abort(messages)
            raise ValueError("several rows have the same name")
        runs = [(m.folder, m.names[k : k + _MOVES]) for m in messages if m for k in range(0, len(m.names), _MOVES)]

        def found(run: tuple[str, list[str]]) -> list[str]:
            return [i.path for i in fs.get_file_info([f"{root}/{n}" for n in run[1]]) if i.type != pafs.FileType.NotFound]

        def move(run: tuple[str, list[str]]) -> None:
            for n in run[1]:
                fs.move(f"{run[0]}/{n}", f"{root}/{n}")

        with ThreadPoolExecutor(_MOVERS) as pool:
            there = [] if self.overwrite else [p for paths in pool.map(found, runs) for p in paths]
            if there:
                self.abort(messages)
                raise FileExistsError(there[0])
            for folder in sorted({n.rpartition("/")[0] for n in every}):
                fs.create_dir(f"{root}/{folder}".rstrip("/"), recursive=True)
            for _ in pool.map(move, runs):
                pass
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        fs, root = _opened(self.path)
        if fs.get_file_info(f"{root}/_unfinished/{self.job}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/_unfinished/{self.job}")
        if fs.get_file_info(f"{root}/_unfinished").type != pafs.FileType.NotFound and not fs.get_file_info(pafs.FileSelector(f"{root}/_unfinished")):
            fs.delete_dir(f"{root}/_unfinished")


@udtf(returnType="idx: long, start: double, end: double, text: string")
class ExplodeSrt:
    """The cues of one text, for use in SQL."""

    def eval(self, text: str):
        yield from srt_rows(text or "")


def register(spark: SparkSession) -> None:
    for source in (SrtSource, ShotListSource, RecordLinesSource, EntityFiles):
        spark.dataSource.register(source)
    spark.udtf.register("explode_srt", ExplodeSrt)
