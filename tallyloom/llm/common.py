"""What the operators of this subpackage share: stored tables, documents by row, components of a graph.

Executors may be lost at any time, so a table that is read twice is written as Parquet to the
folder named by spark.checkpoint.dir and read back; its rows are then fixed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.storage import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder: the lineage ends here."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task holds as Python objects at once.
ROWS = 2048


_KEPT = []


def kept_in_worker(cached):
    """Marks a cache that serves later tasks of its own operator and is emptied when another operator uses the worker."""
    _KEPT.append(cached)
    return cached


def let_go() -> None:
    for cached in _KEPT:
        cached.cache_clear()


def map_batches(
    df: DataFrame, make: Callable[[pa.RecordBatch], dict | None], schema: pa.Schema, rows: int | None = None, keeps: bool = False
) -> DataFrame:
    """An output batch for every ROWS (or `rows`) rows of an Arrow batch; `make` gives its columns by name.

    Only an operator that `keeps` finds again what kept_in_worker caches hold.
    """
    rows = rows or ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            let_go()
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                columns = make(whole.slice(start, rows))
                if columns is None:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    return df.mapInArrow(run, spark_schema(schema))


def spark_schema(schema: pa.Schema):
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(schema)


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """Documents with a row number that no two rows share, stored so that it stays the same.

    Ids may be null or occur twice; joins inside an operator use `row_id`.
    """
    return stored(docs.select(F.monotonically_increasing_id().alias("row_id"), *columns), "numbered")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (columns a, b): root is the smallest node it reaches.

    Alternating large-star and small-star steps (Kiveris et al., "Connected Components in
    MapReduce and Beyond"): each makes neighbours of the smallest neighbour, in two joins that
    Spark can split at a hot node. The steps end when the edges stay the same; then every
    component is a star around its smallest node.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
        edges = stored(small.filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
