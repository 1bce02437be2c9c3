"""The most frequent names of each group, without a shuffle of all names.

Every task counts its own names and writes the counts where it is. Then, of
these partial counts:

1. The first few of each task and group are added up. The sum that ranks last
   among the first n is a bound: the n-th name of the whole has no less.
2. With m partial tables, a name that reaches the bound has at least an m-th of
   it in one of them. Only those names are candidates.
3. All partial counts of the candidates are added up, which is exact.

If no name stands out the candidates are all names, and the result is the same.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsheaf.session import materialize, workspace

#: Distinct names that a task holds; beyond that it begins another partial table.
HELD_NAMES = 1 << 20
PARTIAL = "part string, grp int, name string, n bigint, place bigint, local_rank bigint"


def _added(table: pa.Table) -> pa.Table:
    out = table.group_by(["grp", "name"]).aggregate([("n", "sum"), ("place", "min")])
    return out.rename_columns({"n_sum": "n", "place_min": "place"}).select(["grp", "name", "n", "place"])


def _ranked(table: pa.Table, part: str) -> pa.RecordBatch:
    """The partial table in the order of its counts, with each name's rank in its group."""
    order = [("grp", "ascending"), ("n", "descending"), ("place", "ascending")]
    table = table.sort_by(order).combine_chunks()
    groups = table.column("grp").to_numpy()
    first = groups.searchsorted(groups)
    rank = pa.array(range(len(table))).cast(pa.int64())
    table = table.append_column("local_rank", pc.add(pc.subtract(rank, pa.array(first, pa.int64())), 1))
    table = table.add_column(0, "part", pa.array([part] * len(table), pa.string()))
    return table.to_batches()[0] if len(table) else None


def _counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    held, number, task = None, 0, TaskContext.get().partitionId()
    for part in parts:
        rows = pa.Table.from_batches([part]).append_column("n", pa.array([1] * part.num_rows, pa.int64()))
        own = _added(rows)
        held = own if held is None else _added(pa.concat_tables([held, own]))
        if len(held) > HELD_NAMES:
            yield _ranked(held, f"{task}-{number}")
            held, number = None, number + 1
    if held is not None and len(held):
        yield _ranked(held, f"{task}-{number}")


def partial_counts(rows: DataFrame) -> DataFrame:
    """Each task's counts of ``rows(grp int, name string, place bigint)``, written once."""
    counted = rows.select("grp", "name", "place").mapInArrow(_counted, PARTIAL)
    return materialize(counted, workspace(rows.sparkSession, "names"))


def least_counts(partial: DataFrame, n: int) -> dict[int, int]:
    """For each group the least partial count of a name that can be among the first ``n``."""
    firsts = partial.filter(F.col("local_rank") <= n).groupBy("grp", "name").agg(F.sum("n").alias("n"))
    # n sums of each group, and the number of partial tables
    bound = F.sort_array(F.collect_list("n"), asc=False)
    sums = firsts.groupBy("grp").agg(F.coalesce(F.get(bound, F.lit(n - 1)), F.lit(0)).alias("bound"))
    tables = partial.filter("local_rank = 1").groupBy("grp").agg(F.count_distinct("part").alias("parts"))
    return {r.grp: -(-r.bound // r.parts) for r in sums.join(tables, "grp").collect()}


def candidate_counts(rows: DataFrame, n: int) -> DataFrame:
    """``(grp, name, n, place)``: exact counts and first places of all names that can be among the first ``n``."""
    partial = partial_counts(rows)
    least = least_counts(partial, n)
    reach = F.lit(False)
    for grp, count in least.items():
        reach = reach | ((F.col("grp") == grp) & (F.col("n") >= count))
    names = partial.filter(reach).select("grp", "name").distinct()
    both = partial.join(names, ["grp", "name"], "left_semi")
    return both.groupBy("grp", "name").agg(F.sum("n").alias("n"), F.min("place").alias("place"))
