"""One document table from several sources."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsheaf import schemas
from docsheaf.operators.numbering import dense_numbers

# room for 2**40 documents per source, in order
POSITION_BITS = 40


def _in_room(position):
    """The position; one that would run into the next source's numbers fails the job."""
    fits = position.between(0, (1 << POSITION_BITS) - 1)
    problem = F.concat(F.lit("position out of range: "), F.coalesce(position.cast("string"), F.lit("null")))
    return F.when(fits, position).otherwise(F.raise_error(problem).cast("bigint"))


def union_sources(*sources: tuple[DataFrame, str]) -> DataFrame:
    """Documents of all sources, in source order, then by position in the source.

    Each source is ``(documents, position column)``. ``doc_seq`` is made from
    both numbers: it has gaps but needs neither a shuffle nor a global sort.
    Positions are unique and below 2**40 within a source.
    """
    parts = [
        df.select(
            (F.lit(rank << POSITION_BITS) + _in_room(F.col(position).cast("bigint"))).alias("doc_seq"),
            "source",
            "source_type",
            "raw_text",
        )
        for rank, (df, position) in enumerate(sources)
    ]
    return schemas.conform(reduce(DataFrame.unionByName, parts), schemas.DOCUMENTS)


def union_rejects(*rejects: DataFrame) -> DataFrame:
    """One table of the inputs that were skipped and why."""
    return reduce(DataFrame.unionByName, [schemas.conform(r, schemas.REJECTS) for r in rejects])


def number_by(df: DataFrame, key: str, into: str = "position", partitions: int | None = None) -> DataFrame:
    """Number rows densely in the order of a unique key, such as a file path.

    Only the keys are sorted; their numbers are joined back by key.
    """
    return df.join(dense_numbers(df.select(key), [key], into, partitions), key)
