"""Text files as documents."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsheaf.functions.text import unify_newlines

ACCEPTED = {".txt": "file_txt", ".pdf": "file_pdf"}
#: Folders whose files one task lists.
FOLDERS_PER_TASK = 16


def suffix(path: Column) -> Column:
    """Lower-cased last extension of the file name; a leading dot is no extension."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def decode_text(content: Column) -> Column:
    """UTF-8, or Latin-1 for the whole content if it is not valid UTF-8."""
    as_utf8 = content.cast("string")
    text = F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(content, "ISO-8859-1"))
    return unify_newlines(text)


def route_files(files: DataFrame) -> DataFrame:
    """Add ``source_type`` by extension; null marks a file that is not accepted."""
    ext = suffix(F.col("source"))
    kind = F.lit(None).cast("string")
    for accepted, name in ACCEPTED.items():
        kind = F.when(ext == accepted, name).otherwise(kind)
    return files.withColumn("source_type", kind)


def _rejects(rows: DataFrame, reason: Column) -> DataFrame:
    return rows.select("source", F.lit("ingest").alias("stage"), reason.alias("reason"))


def unsupported_files(files: DataFrame) -> DataFrame:
    """Rejects: files whose extension is not accepted."""
    reason = F.concat(F.lit("unsupported file type '"), suffix(F.col("source")), F.lit("'"))
    return _rejects(route_files(files).filter(F.col("source_type").isNull()), reason)


def pdfs_without_pages(files: DataFrame, page_documents: DataFrame) -> DataFrame:
    """Rejects: accepted PDF files of which ``page_documents(source)`` has no page texts."""
    pdfs = route_files(files).filter(F.col("source_type") == "file_pdf")
    return _rejects(
        pdfs.join(page_documents.select("source"), "source", "left_anti"), F.lit("no page texts")
    )


# --- listing and reading ------------------------------------------------------------------
#
# Spark's own file sources leave out files of zero bytes and all whose name
# starts with "_" or ".", so tasks list and read the files themselves.


def _uri(path: str) -> str:
    """As Arrow's file systems take it: Hadoop also writes ``file:/x``."""
    if "://" in path:
        return path
    return "file://" + path.removeprefix("file:")


def _folders_below(path: str) -> list[str]:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    return [root] + [i.path for i in store.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(source, size)`` of every file below the folder ``path``, a URI or an absolute path.

    The driver lists the first level; tasks list the folders below it.
    """
    uri = _uri(path)
    root, *below = _folders_below(uri)
    prefix = uri[: len(uri.rstrip("/")) - len(root.rstrip("/"))]
    folders = [(root, False), *[(folder, True) for folder in below]]
    tasks = max(1, -(-len(folders) // FOLDERS_PER_TASK))

    def listed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(uri)
        for part in parts:
            for row in part.to_pylist():
                selector = fs.FileSelector(row["folder"], recursive=row["recursive"])
                found = [i for i in store.get_file_info(selector) if i.type == fs.FileType.File]
                sources = pa.array([prefix + i.path for i in found], pa.string())
                sizes = pa.array([i.size for i in found], pa.int64())
                yield pa.RecordBatch.from_arrays([sources, sizes], ["source", "size"])

    table = spark.createDataFrame(folders, "folder string, recursive boolean").repartition(tasks, "folder")
    return table.mapInArrow(listed, "source string, size bigint")


def read_contents(paths: DataFrame) -> DataFrame:
    """Add ``content`` and ``error`` to rows with ``source``, a URI; one of them is null."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for part in parts:
            for k, source in enumerate(part.column("source").to_pylist()):
                content, error = None, None
                try:
                    store, path = fs.FileSystem.from_uri(_uri(source))
                    with store.open_input_stream(path) as stream:
                        content = stream.read()
                except Exception as problem:  # noqa: BLE001 - any problem becomes the row's reject
                    error = str(problem).split("\n")[0]
                # one file at a time: a batch of large files would not fit in memory
                columns = [*part.slice(k, 1).columns, pa.array([content], pa.binary()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "content", "error"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in paths.dtypes)
    return paths.mapInArrow(read, f"{schema}, content binary, error string")


def scan_files(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """``(source, size, content, error)`` of every file below ``path``.

    ``partitions`` deals the files out before they are read; by default as
    many as shuffles have.
    """
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_contents(list_files(spark, path).repartition(partitions, "source"))


def read_text_files(files: DataFrame) -> DataFrame:
    """``(source, source_type, raw_text)`` of the text files. Blank and empty files are kept."""
    return (
        route_files(files)
        .filter((F.col("source_type") == "file_txt") & F.col("content").isNotNull())
        .select("source", "source_type", decode_text(F.col("content")).alias("raw_text"))
    )


def unreadable_files(files: DataFrame) -> DataFrame:
    """Rejects: accepted files whose content could not be read."""
    bad = route_files(files).filter(F.col("source_type").isNotNull() & F.col("error").isNotNull())
    return _rejects(bad, F.concat(F.lit("cannot be read: "), F.col("error")))


def missing_files(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Rejects: paths in ``wanted(source)`` that ``files(source)``, a listing, does not have."""
    return _rejects(wanted.join(files.select("source"), "source", "left_anti"), F.lit("file not found"))


def write_contents(files: DataFrame, folder: str) -> DataFrame:
    """Write each ``content`` as a file named ``source`` below ``folder``; gives the names written.

    Lazy: an action writes the files. A repeated task writes the same ones again.
    """
    uri = _uri(folder).rstrip("/")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        made = set()
        for part in parts:
            for row in part.to_pylist():
                path = f"{root}/{row['source']}"
                if (parent := path.rpartition("/")[0]) not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                with store.open_output_stream(path) as stream:
                    stream.write(row["content"] or b"")
            yield pa.RecordBatch.from_arrays([part.column("source")], ["source"])

    return files.select("source", "content").mapInArrow(write, "source string")
