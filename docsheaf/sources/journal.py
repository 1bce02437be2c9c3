"""Outcomes of calls, on record as soon as each call ends.

A call costs money, so what it gave must outlive the task that made it. Tasks
append each outcome to a journal in storage all executors share, a line of
JSON that is flushed before the next row is begun; where a store cannot append,
an outcome is a file of its own. A task reads what earlier attempts of it have
on record before it calls, and a later run what earlier runs have, so after a
loss only the calls under way are made again.

A journal is a folder::

    <folder>/<run>/task-<partition>-<attempt>.jsonl    outcomes as calls end
    <folder>/<run>.done                                the files of finished tasks

The files of a run that was not finished are as good as others: each line stands
for itself and has its ``end``, so one that was cut short is left out. Of several outcomes
of one row the first by file name and line counts.
"""

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from docsheaf import schemas
from docsheaf.sources.files import _uri

OUTCOME = tuple(field.split()[0] for field in schemas.CALL.split(", "))


def as_they_end(items: Iterable, one: Callable, in_flight: int) -> Iterator[tuple]:
    """``(item, one(item))`` as each ends, with ``in_flight`` under way on threads while there are items."""
    items = iter(items)
    with ThreadPoolExecutor(in_flight) as threads:
        running: dict[Future, object] = {}
        while True:
            while len(running) < in_flight and (item := next(items, None)) is not None:
                running[threads.submit(one, item)] = item
            if not running:
                return
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for call in ended:
                yield running.pop(call), call.result()


class TaskJournal:
    """What one task writes, and what attempts before it wrote."""

    def __init__(self, folder: str, partition: int, attempt: int):
        from pyarrow import fs

        self.store, self.root = fs.FileSystem.from_uri(_uri(folder))
        self.prefix = f"{self.root}/task-{partition:06d}-"
        self.name = f"{self.prefix}{attempt:012d}"
        self.files: list[str] = []
        self.stream = None
        self.store.create_dir(self.root, recursive=True)

    def earlier(self) -> Iterator[dict]:
        """Outcomes that earlier attempts of this task have on record."""
        from pyarrow import fs

        for info in self.store.get_file_info(fs.FileSelector(self.root)):
            if info.path.startswith(self.prefix):
                with self.store.open_input_stream(info.path) as stream:
                    yield from whole_lines(stream.read())

    def _open(self):
        """A stream that can be flushed line by line, or none where an outcome needs a file of its own."""
        try:
            path = f"{self.name}.jsonl"
            stream = self.store.open_append_stream(path)
        except (NotImplementedError, OSError, pa.ArrowNotImplementedError):
            return False
        self.files.append(path.rpartition("/")[2])
        return stream

    def add(self, row: dict) -> None:
        line = (json.dumps(row | {"end": True}) + "\n").encode()
        if self.stream is None:
            self.stream = self._open()
        if self.stream:
            self.stream.write(line)
            self.stream.flush()
            return
        path = f"{self.name}-{len(self.files):09d}.jsonl"
        with self.store.open_output_stream(path) as stream:
            stream.write(line)
        self.files.append(path.rpartition("/")[2])

    def close(self) -> None:
        if self.stream:
            self.stream.close()


def whole_lines(content: bytes) -> Iterator[dict]:
    """The outcomes of a file; what a lost task began to write is left out."""
    for line in content.split(b"\n")[:-1]:
        try:
            yield json.loads(line)
        except ValueError:
            continue


def keyed_rows(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, str]]:
    """``(key, request)`` of every row."""
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in (*keys, "request")]
        for *key, request in zip(*columns, strict=True):
            yield tuple(key), request


def recorded_calls(
    rows: Iterable[tuple[tuple, str]], journal: TaskJournal, keys: tuple[str, ...], one: Callable, in_flight: int
) -> int:
    """Call for every row that is not on record and add each outcome as it comes; the number of calls made."""
    known = {tuple(row[k] for k in keys) for row in journal.earlier()}
    todo = ((key, request) for key, request in rows if key not in known)
    made = 0
    try:
        for (key, _), outcome in as_they_end(todo, lambda item: one(item[1]), in_flight):
            journal.add(dict(zip(keys, key, strict=True)) | dict(zip(OUTCOME, outcome, strict=True)))
            made += 1
    finally:
        journal.close()
    return made


class _Written(WriterCommitMessage):
    def __init__(self, partition: int, files: list[str], made: int):
        self.partition, self.files, self.made = partition, files, made


def finish(folder: str, run: str, tasks: Iterable[tuple[int, list[str], int]]) -> None:
    """Name the files of the finished tasks of a run."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(_uri(folder))
    named = [{"partition": p, "files": f, "calls": made} for p, f, made in sorted(tasks)]
    with store.open_output_stream(f"{root}/{run}.done") as stream:
        stream.write(json.dumps(named).encode())


def journal_sink(name: str, folder: str, run: str, keys: tuple[str, ...], make_one: Callable, in_flight: int) -> type:
    """A data source that calls for the rows written to it. ``make_one()`` runs on an executor."""

    class Writer(DataSourceArrowWriter):
        def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
            from pyspark import TaskContext

            context = TaskContext.get()
            journal = TaskJournal(f"{folder}/{run}", context.partitionId(), context.taskAttemptId())
            made = recorded_calls(keyed_rows(batches, keys), journal, keys, make_one(), in_flight)
            return _Written(context.partitionId(), journal.files, made)

        def commit(self, messages: list[WriterCommitMessage | None]) -> None:
            finish(folder, run, [(m.partition, m.files, m.made) for m in messages if m is not None])

        def abort(self, messages: list[WriterCommitMessage | None]) -> None:
            """What is on record stays."""

    class Journal(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return Writer()

    return Journal


def run_name() -> str:
    """Names of later runs sort after those of earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_outcomes(rows: DataFrame, folder: str, keys: tuple[str, ...], make_one: Callable, in_flight: int = 1) -> str:
    """Call for every row of ``rows(*keys, request)``, one after another in each partition but for ``in_flight``.

    ``make_one()`` gives a function from a request to its outcome, a tuple of
    the fields of ``schemas.CALL``. Returns the name of the run.
    """
    spark = rows.sparkSession
    run = run_name()
    name = f"outcomes_{uuid.uuid4().hex}"
    spark.dataSource.register(journal_sink(name, folder, run, keys, make_one, in_flight))
    rows.select(*keys, "request").write.format(name).mode("append").save()
    return run


def read_outcomes(spark: SparkSession, folder: str, keys: str) -> DataFrame:
    """``(keys, outcome)`` of every row on record in a journal; ``keys`` is DDL. A missing journal has none."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(_uri(folder))
    schema = f"{keys}, {schemas.CALL}"
    lines = spark.read.schema(f"{schema}, end boolean").option("recursiveFileLookup", True)
    runs = [i.path for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if not i.is_file]
    if not runs:
        return spark.createDataFrame([], schema)
    names = [field.split()[0] for field in keys.split(", ")]
    found = lines.option("pathGlobFilter", "*.jsonl").json(folder).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    first = Window.partitionBy(*names).orderBy("_file", "_block", "_line")
    whole = found.filter("end").withColumn("_copy", F.row_number().over(first))
    return whole.filter("_copy = 1").select(*names, *OUTCOME)
