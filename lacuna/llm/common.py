"""What the operators share: table reading, Arrow row helpers, sized repartitioning."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lacuna.session import checkpoint_dir, ship

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder, so that later passes read it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def pick(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Exactly (id, text) whatever else the table has; a null text is an empty one."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: StructType | str,
                setup: Callable[[], object] | None = None, rows: int = 500) -> DataFrame:
    """Apply ``fn`` to batches of ``rows`` given as column lists; ``setup`` runs once a task and is passed on."""
    ship(df.sparkSession)
    target = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = [f.name for f in target]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        state = setup() if setup else None
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                given = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
                out = fn(given, state) if setup else fn(given)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[n], type=arrow.field(n).type) for n in names], schema=arrow)

    return df.mapInArrow(run, target)


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one narrow scan, used to size blocks and buckets."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts_for(size: int, each: int) -> int:
    """How many parts of about ``each`` bytes hold ``size`` bytes."""
    return max(1, math.ceil(size / each))
