"""What the operators of this package share: table access, checkpoints, Arrow maps over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.cluster import checkpoint_folder, checkpointed, ship

#: Rows that a Python step turns into Python objects at a time; bounds a worker's memory, not the result.
ROWS_AT_ONCE = 256

#: A key that more than one row in so many has is sent to all tasks: fewer keys than this, whatever the table's size.
HOT_SHARE = 1_000

__all__ = ["checkpoint_folder", "checkpointed", "ddl", "filter_texts", "fresh", "id_remainder", "map_texts", "ship", "table", "uneven_join"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def map_texts(df: DataFrame, columns: Sequence[str], schema: str, make: Callable[[], Callable[..., Iterable]], rows: int = ROWS_AT_ONCE) -> DataFrame:
    """Run make()'s function over slices of the named columns (as Python lists); it returns the output columns.

    Each input row is seen once; a function may hold state between slices of a task and may return any number of rows.
    If it has an attribute `end`, that is called when the task's rows are over.
    """
    ship(df.sparkSession)
    struct = StructType.fromDDL(schema)

    def run(batches):
        step, arrow = make(), to_arrow_schema(struct)

        def built(out):
            return pa.RecordBatch.from_arrays([x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(out, arrow)], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = step(*(c.to_pylist() for c in batch.slice(at, rows).columns))
                if out is not None:
                    yield built(out)
        if hasattr(step, "end"):
            for out in step.end():
                yield built(out)

    return df.select(*columns).mapInArrow(run, struct)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def uneven_join(big: DataFrame, small: DataFrame, key: str, n: str) -> DataFrame:
    """big joined with small by key. small holds each key of big once, with n, the number of big's rows that have it.

    Rows of the keys that more than one row in HOT_SHARE has stay where they are and meet small's part for these keys,
    of fewer than HOT_SHARE rows, in their own tasks; the others are dealt out by key. big and small are read twice.
    """
    total = small.agg(F.sum(n)).first()[0] or 0
    often, seldom = small.where(F.col(n) * HOT_SHARE > total).drop(n), small.where(F.col(n) * HOT_SHARE <= total).drop(n)
    here = big.join(F.broadcast(often), key)
    return here.unionByName(big.join(F.broadcast(often.select(key)), key, "left_anti").join(seldom, key))


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def filter_texts(docs: DataFrame, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows, with all their columns whatever their names, for whose texts make()'s function says true. It is asked of
    null and empty texts too; repeated rows are asked for each; no rows give no rows."""
    at = docs.columns.index("text")

    def built():
        wanted = make()

        def step(*values):
            rows = [k for k, w in enumerate(wanted(values[at])) if w]
            return [[v[k] for k in rows] for v in values]

        return step

    return map_texts(docs, docs.columns, ddl(docs), built)
