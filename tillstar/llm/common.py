"""Shared helpers: row keys, checked broadcasts, Arrow text buffers, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import hadoop_path, materialize, tune

#: The ASCII white space of all word and line contracts, U+0009 to U+000D and the space.
SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A broadcast may hold this many bytes at most; a larger side is joined by shuffle.
BROADCAST_BYTES = 64 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """SQL settings of these jobs; shuffle files go when a job has ended."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")  # bounds what a Python worker holds
    return tune(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def text_key(text: str) -> Column:
    """128 bits of hash of a text; no bytes for a null one, which differs from the empty text's."""
    return F.coalesce(F.unhex(F.md5(F.col(text).cast("binary"))), F.lit(b""))


def row_keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, th``: (doc_id, th) identifies a row up to equal rows, also where doc_id
    is null or repeated; equal rows have equal results. Other columns are left out."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text"), text_key("text").alias("th"))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on keys that may be null; the right side's keys are dropped."""
    renamed = right.select(*(F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns))
    on = None
    for c in keys:
        same = left[c].eqNullSafe(renamed[f"_r_{c}"])
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*(f"_r_{c}" for c in keys))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def fits(df: DataFrame, row_bytes: int) -> bool:
    """Whether a written table may be broadcast."""
    return df.count() * row_bytes <= BROADCAST_BYTES


def delete(df: DataFrame) -> None:
    """Delete a written intermediate table that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        fs, path = hadoop_path(df.sparkSession, folder)
        fs.delete(path, True)


# ---------------------------------------------------------------- Arrow text


class Texts:
    """Consecutive texts of a column as one run of UTF-8 bytes; a null counts as empty."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        self.first = int(ends[0])
        self.data = np.frombuffer(data, np.uint8)[self.first : int(ends[-1])] if data else np.zeros(0, np.uint8)
        self.starts = ends[:-1] - self.first
        self.lens = np.diff(ends)

    def __len__(self) -> int:
        return len(self.lens)


def pieces(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20, name: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut to about ``limit`` bytes of text, one row at least: bounds what numpy holds."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        sizes = column.cast(pa.large_binary())
        offsets = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def table_batch(schema: str, columns: list) -> pa.RecordBatch:
    """A record batch of numpy or Arrow columns, named by a Spark DDL string."""
    names = [x.split()[0] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


# ---------------------------------------------------------------- graph


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over undirected ``a, b`` links.

    Alternates large-star and small-star steps: every node hangs all its neighbours on the
    smallest one, which keeps the number of links and halves the distances. Each step is
    written, so that a lost executor costs one step. Nodes are comparable (numbers or structs).
    """
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    while _open(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.where("b > a").join(lows, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tops = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(tops, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(tops.selectExpr("a", "m as b"))
        new = materialize(small.where("a <> b").distinct(), "links")
        delete(edges)
        edges = new
    nodes = edges.selectExpr("a as node", "b as component")
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _open(edges: DataFrame) -> bool:
    """Whether some node is not a leaf of one top, or a top of leaves."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), (F.col("b") > F.col("a")).cast("int").alias("down"))
    roles = roles.unionAll(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    wrong = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)")
    return wrong.count() > 0
