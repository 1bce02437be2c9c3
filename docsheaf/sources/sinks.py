"""Writers for results and reports, and their publication as one.

Outputs that belong together are written to a folder of their own, where no
reader looks. Then a manifest that names them is put in place by one rename.
What has no manifest was not published, whatever its save left behind, and a
save may be repeated until there is one.
"""

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from docsheaf.operators.results import flat_rows

CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


class EmptyStage(RuntimeError):
    """A stage produced no rows, so the run stops and writes nothing further."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyStage(f"no {what}")
    return df


def write_json(results: DataFrame, path: str, compression: str | None = None) -> None:
    """Nested records, one JSON object per line; null fields are left out."""
    results.drop("parse_path").write.mode("errorifexists").json(path, compression=compression)


def write_csv(results: DataFrame, path: str, compression: str | None = None) -> None:
    """Flat rows with a header in every part."""
    flat_rows(results).write.mode("errorifexists").options(**CSV_OPTIONS).csv(path, compression=compression)


def read_csv(spark, path: str, schema) -> DataFrame:
    """Read back what ``write_csv`` wrote. The format does not tell empty from
    null, and no flat column is ever null."""
    options = CSV_OPTIONS | {"multiLine": True}
    return spark.read.schema(schema).options(**options).csv(path).na.fill("")


def write_report(lines: DataFrame, path: str, compression: str | None = None) -> None:
    """The report as text parts; in name order they are the whole report.

    A sort by range keeps the work distributed, as chunk summaries grow with
    the data.
    """
    ordered = lines.orderBy("section_no", "item_no", "line_no").select("line")
    ordered.write.mode("errorifexists").text(path, compression=compression)


# --- publication -------------------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    """Spark's file system of a path, and the path for it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _manifest(folder: str, run_id: str) -> str:
    return f"{folder}/run_{run_id}.manifest"


def published(spark: SparkSession, folder: str, run_id: str) -> dict[str, str] | None:
    """The paths of a published run by name, or none."""
    store, path = _files(spark, _manifest(folder, run_id))
    if not store.exists(path):
        return None
    lines = spark.read.text(_manifest(folder, run_id), wholetext=True).collect()
    return {name: f"{folder}/{where}" for name, where in json.loads(lines[0].value).items()}


def publish(
    spark: SparkSession, folder: str, run_id: str, outputs: Mapping[str, tuple[str, Callable[[str], None]]]
) -> dict[str, str]:
    """Write ``outputs``, ``name -> (file name, writer of a path)``, and publish them together.

    A run that is published already is left as it is.
    """
    done = published(spark, folder, run_id)
    if done is not None:
        return done
    own = f"run_{run_id}-{uuid.uuid4().hex}"
    for file, write in outputs.values():
        write(f"{folder}/{own}/{file}")
    manifest = json.dumps({name: f"{own}/{file}" for name, (file, _) in outputs.items()})
    store, begun = _files(spark, f"{folder}/.{own}.manifest")
    stream = store.create(begun, True)
    try:
        stream.write(bytearray(manifest.encode()))
    finally:
        stream.close()
    _, path = _files(spark, _manifest(folder, run_id))
    if not store.rename(begun, path) and not store.exists(path):
        raise OSError(f"cannot publish {path}")
    # of two saves at once the first to rename counts
    return published(spark, folder, run_id)
