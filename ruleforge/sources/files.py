"""Files written and copied by executors, with a commit: all of a write becomes visible at its end, or nothing.

Tasks write into a staging folder below the root, each attempt into one of its own. The commit moves the files of the attempts that Spark chose to their places and drops the
rest, so a task that ran twice leaves one copy; a write that fails drops them all. (Readers pass over the staging folder by its name, should it outlive a lost driver.) Roots are local paths or URIs that pyarrow has a file system for (file, hdfs, s3, gs);
on a cluster a local path must be one that all machines mount. A commit that is itself cut short can leave part of the files in their places, each of them whole.
"""

from __future__ import annotations

import io
import json
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import BinaryType, StructField, StructType

#: Files that a commit moves at once and knows at once; bytes that a copy holds.
MOVES, KNOWN, PIECE = 32, 4096, 1 << 22


def file_system(root: str):
    """(file system, path) of a root."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def _uri(root: str) -> str:
    return root if "://" in root else f"file://{root}"


@dataclass
class Written(WriterCommitMessage):
    folder: str


class FileWriter(DataSourceArrowWriter):
    """Rows (path, content, sources): the content, or else the first of the sources that exists, goes to ``root/path``."""

    def __init__(self, root: str, job: str):
        self.root, self.job = root, job

    def _staging(self):
        files, root = file_system(self.root)
        return files, root.rstrip("/"), f"{root.rstrip('/')}/_staging-{self.job}"

    def write(self, iterator: Iterator) -> Written:
        files, _, staging = self._staging()
        folder, made = f"{staging}/{uuid.uuid4().hex}", set()
        files.create_dir(f"{folder}/files")
        with files.open_output_stream(f"{folder}/log") as log:
            for batch in iterator:
                for path, content, sources in zip(*(batch.column(c) for c in ("path", "content", "sources")), strict=True):
                    path, source, error = path.as_py(), None, None
                    try:
                        if path is None or path.startswith(("/", "_")) or ".." in path.split("/"):
                            raise ValueError("no path below the root")
                        target = f"{folder}/files/{path}"
                        above = target.rpartition("/")[0]
                        if above not in made:
                            files.create_dir(above)
                            made.add(above)
                        if sources.is_valid:
                            source = self._copied(files, sources.as_py(), target)
                            error = None if source else "no source"
                        elif content.is_valid:
                            with files.open_output_stream(target) as out:
                                out.write(content.as_buffer())
                        else:
                            error = "no content"
                    except (OSError, ValueError) as e:
                        error = str(e)
                    log.write((json.dumps({"path": path, "source": source, "error": error}) + "\n").encode())
        return Written(folder)

    @staticmethod
    def _copied(files, sources: list, target: str) -> str | None:
        from pyarrow import fs

        for source in sources:
            if source:
                other, place = file_system(source)
                if other.get_file_info(place).type == fs.FileType.File:
                    with other.open_input_stream(place) as data, files.open_output_stream(target) as out:
                        while piece := data.read(PIECE):
                            out.write(piece)
                    return source
        return None

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        files, root, _ = self._staging()
        logs = f"{root}/_written/{self.job}"
        files.create_dir(logs)

        def moved(place: str, target: str) -> None:
            try:
                files.move(place, target)
            except OSError:  # a path that a task wrote twice is there already
                if files.get_file_info(place).type != fs.FileType.NotFound or files.get_file_info(target).type != fs.FileType.File:
                    raise

        with ThreadPoolExecutor(MOVES) as pool:
            for i, m in enumerate(x for x in messages if x is not None):
                for paths in self._logged(files, f"{m.folder}/log"):
                    list(pool.map(files.create_dir, {f"{root}/{p}".rpartition("/")[0] for p in paths}))
                    list(pool.map(lambda p, m=m: moved(f"{m.folder}/files/{p}", f"{root}/{p}"), paths))
                files.move(f"{m.folder}/log", f"{logs}/part-{i}.json")
        self.abort([])

    @staticmethod
    def _logged(files, log: str) -> Iterator[list[str]]:
        """The paths that a task wrote, KNOWN at a time: the driver holds no list of all files, however many there are."""
        with files.open_input_stream(log) as data, io.TextIOWrapper(io.BufferedReader(data), encoding="utf-8") as lines:
            entries = (json.loads(line) for line in lines)
            paths = (e["path"] for e in entries if e["error"] is None)
            while some := list(dict.fromkeys(islice(paths, KNOWN))):
                yield some

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        files, _, staging = self._staging()
        for wait in (0.0, 0.2, 0.5, 1.0, 2.0):  # other tasks of a failed write may still be writing
            time.sleep(wait)
            try:
                if files.get_file_info(staging).type == fs.FileType.Directory:
                    files.delete_dir(staging)
                return
            except OSError:
                continue


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_per_row"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["root"], self.options["job"])


def _written(rows: DataFrame, root: str) -> DataFrame:
    """(path, source, error) of the rows once they are written."""
    spark, job = rows.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(FileSink)
    rows.write.format("file_per_row").mode("append").options(root=root, job=job).save()
    return spark.read.schema("path string, source string, error string").json(f"{_uri(root).rstrip('/')}/_written/{job}")


def write_files(df: DataFrame, root: str, path: str = "path", content: str = "content") -> DataFrame:
    """Writes each row's bytes to ``root/path``, all at once at the end. Returns (path, error), a row a row: null contents and paths outside the root are errors, and others go on."""
    rows = df.select(F.col(path).alias("path"), F.col(content).cast("binary").alias("content"), F.lit(None).cast("array<string>").alias("sources"))
    return _written(rows, root).select("path", "error")


def copy_files(df: DataFrame, root: str, candidates: list[str], target: str = "target") -> DataFrame:
    """Copies the first of the candidate paths that exists to ``root/target``, all at once at the end. Returns (target, source, error); source is null if none does."""
    rows = df.select(F.col(target).alias("path"), F.lit(None).cast("binary").alias("content"), F.array(*candidates).alias("sources"))
    return _written(rows, root).select(F.col("path").alias("target"), "source", "error")


def read_files(df: DataFrame, root: str, path: str = "path") -> DataFrame:
    """Adds ``content``: the bytes of ``root/path``, which tasks open by these names, PIECE or one file at a time. Nothing is listed, so the driver holds nothing of a file."""

    def read(batches):
        import pyarrow as pa

        files, base = file_system(root)

        def together(batch, start, data):
            return pa.RecordBatch.from_arrays([*batch.slice(start, len(data)).columns, pa.array(data, pa.binary())], [*batch.schema.names, "content"])

        for batch in batches:
            start, size, data = 0, 0, []
            for p in batch.column(path):
                with files.open_input_stream(f"{base.rstrip('/')}/{p.as_py()}") as stream:
                    data.append(stream.read())
                size += len(data[-1])
                if size >= PIECE:
                    yield together(batch, start, data)
                    start, size, data = start + len(data), 0, []
            if data:
                yield together(batch, start, data)

    return df.mapInArrow(read, StructType([*df.schema, StructField("content", BinaryType())]))
