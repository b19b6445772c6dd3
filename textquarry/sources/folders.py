"""Very many small files on a file system of the machine's own, made, listed and read by tasks.

Names, contents and what counts are those of Spark's own sources: `<column>=<value>` with %XX for special signs, a part file for each task that
has rows of a value, no names that begin with `_` or `.`. Only the list of a write's tasks goes through the driver.
"""

from __future__ import annotations

import errno
import os
import shutil
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: As Spark names what has no value, or an empty one.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = {c: f"%{c:02X}" for c in (*range(1, 32), *b"\"#%'*/:=?\\{[]^", 127)}
#: Bytes of files handed to Spark at once; more only for a single larger file.
BATCH = 1 << 22


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the machine's own functions take it; none for other file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(target).toUri().getPath() if system.getUri().getScheme() == "file" else None


def _written(staging: str, write: str, column: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        own = f"{staging}/{task.partitionId()}-{task.taskAttemptId()}"
        name = f"part-{task.partitionId():05d}-{write}.c000.txt"
        some = False
        for batch in batches:
            for value, text in zip(batch.column(0), batch.column(1), strict=True):
                if not some:
                    os.mkdir(own)
                    some = True
                value = value.as_py()
                folder = f"{own}/{column}={value.translate(_ESCAPED) if value else NO_VALUE}"
                try:
                    os.mkdir(folder)
                except FileExistsError:
                    pass  # the value's rows before this one are in the file
                with open(f"{folder}/{name}", "ab") as f:
                    if text.is_valid:
                        f.write(text.as_buffer())
                    f.write(b"\n")
        if some:
            yield pa.RecordBatch.from_pydict({"folder": [own]})

    return run


def _moved(own: str, to: str, write: str) -> None:
    """What one task has written takes the place of earlier files. It can be done again; other tasks of the write may have files in the same folders."""
    for folder in os.scandir(own):
        target = f"{to}/{folder.name}"
        try:
            os.rename(folder.path, target)  # to no folder or an empty one
        except OSError as e:
            if e.errno not in (errno.ENOTEMPTY, errno.EEXIST):
                raise
            for old in os.scandir(target):
                if write in old.name:
                    continue
                if old.is_dir(follow_symlinks=False):
                    shutil.rmtree(old.path, ignore_errors=True)
                else:
                    try:
                        os.unlink(old.path)
                    except FileNotFoundError:
                        pass  # another task was first
            for file in os.scandir(folder.path):
                os.rename(file.path, f"{target}/{file.name}")


def write_texts(rows: DataFrame, to: str) -> None:
    """Rows of a value and a text as lines of a file in the value's folder, whose earlier files go. Nothing counts before all tasks have written."""
    write = str(uuid.uuid4())
    staging = f"{to}/.staging-{write}"
    os.makedirs(staging)
    try:
        done = rows.mapInArrow(_written(staging, write, rows.columns[0]), "folder string").collect()
        if done:
            spark = rows.sparkSession
            spark.sparkContext.parallelize([r["folder"] for r in done], len(done)).foreach(lambda own: _moved(own, to, write))
        with open(f"{to}/_SUCCESS", "wb"):
            pass
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def _counts(name: str) -> bool:
    """As Spark's file sources see it."""
    left_out = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return not left_out or name.startswith(("_common_metadata", "_metadata"))


def _files(folder: str) -> Iterator[str]:
    for entry in os.scandir(folder):
        if _counts(entry.name):
            if entry.is_dir():
                yield from _files(entry.path)
            else:
                yield entry.path


def _listed(folder: str, tasks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                found = []
                for entry in os.scandir(folder):
                    if _counts(entry.name) and zlib.crc32(os.fsencode(entry.name)) % tasks == k:
                        found.extend(_files(entry.path) if entry.is_dir() else [entry.path])
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["file"])

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"])

    paths, contents, size = [], [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open(path, "rb", 0) as f:
                content = f.read()
            if paths and size + len(content) > BATCH:
                yield rows(paths, contents)
                paths, contents, size = [], [], 0
            paths.append(f"file:{path}")
            contents.append(content)
            size += len(content)
    yield rows(paths, contents)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """`(path, content)` of the files of a folder and of all folders below it, dealt over tasks one by one."""
    cores = spark.sparkContext.defaultParallelism
    shares = spark.range(0, cores, 1, cores).mapInArrow(_listed(folder, cores), "file string")
    tasks = max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return shares.repartition(tasks, "file").mapInArrow(_read, "path string, content binary")
