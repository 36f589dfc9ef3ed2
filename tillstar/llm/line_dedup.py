"""Repeated lines: levelled sorted runs of line hashes.

Documents arrive in batches of rising doc_id. Every batch's line hashes are merge-joined with
the runs that earlier batches left: a hash found there belongs to an earlier document. Hashes
not found there form the batch's own run. Runs are tables bucketed and sorted by hash, so a join
moves the new batch only; when a level holds ``fanout`` runs they merge into one of the next level.

DataFrame operations only. Defined cases: a null or empty text is one empty line; rows with a
null doc_id count as one document that comes last; rows that repeat a doc_id belong to one
document; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import SPACES, delete, lower_ascii, null_safe, row_keyed
from tillstar.session import hadoop_path, materialize, scratch_path

BATCHES, FANOUT, MIN_CHARS = 4, 3, 10
_LAST = (1 << 63) - 1


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_positions(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, th, pos, h1, h2`` of every line whose key has ``min_chars`` code points: two
    independent 64-bit hashes stand for the key."""
    key = lower_ascii(F.btrim(F.col("line"), F.lit(SPACES)))
    lines = row_keyed(docs).select("doc_id", "th", F.posexplode_outer(_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc_id", "th", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("doc_id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


class Runs:
    """Levelled sorted runs of (h1, h2); each run is a table bucketed and sorted by hash."""

    def __init__(self, spark, fanout: int):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, hashes: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        dealt = hashes.select("h1", "h2").repartition(self.buckets, "h1", "h2")
        writer = dealt.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        writer.option("path", scratch_path(self.spark, name)).saveAsTable(name)
        return name

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, hashes: DataFrame) -> None:
        """Add a run of hashes that no other run holds; merge full levels."""
        self._put(0, self._write(hashes))

    def _put(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            parts, self.levels[level] = self.levels[level], []
            merged = self.spark.table(parts[0])
            for part in parts[1:]:
                merged = merged.unionAll(self.spark.table(part))
            name = self._write(merged)
            self._drop(parts)
            self._put(level + 1, name)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            folder = self.spark.table(name).inputFiles()
            self.spark.sql(f"DROP TABLE {name}")
            for path in {f.rpartition("/")[0] for f in folder}:
                fs, p = hadoop_path(self.spark, path)
                fs.delete(p, True)

    def drop(self) -> None:
        self._drop([name for level in self.levels for name in level])
        self.levels = []


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, th, pos`` of the lines to drop."""
    spark = docs.sparkSession
    rank = F.coalesce("doc_id", F.lit(_LAST))
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), [i / batches for i in range(1, batches)], 1000)).first()[0]
    batch = sum((F.coalesce(F.col("doc_id") > c, F.lit(True)).cast("int") for c in sorted(set(cuts or []))), F.lit(0))
    lines = line_positions(docs, min_chars).withColumn("batch", batch)
    path = scratch_path(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    runs, dropped = Runs(spark, fanout), []
    for i in range(len(set(cuts or [])) + 1):
        new = lines.where(F.col("batch") == i).drop("batch")
        found = new.groupBy("h1", "h2").agg(F.min(rank).alias("owner"), F.max(rank).alias("other"))
        seen = F.lit(False)
        for k, run in enumerate(runs.tables()):
            found = found.join(run.withColumn(f"run{k}", F.lit(True)), ["h1", "h2"], "left")
            seen = seen | F.coalesce(f"run{k}", F.lit(False))
        found = materialize(found.select("h1", "h2", "owner", "other", seen.alias("seen")), "found")
        runs.add(found.where("not seen"))
        repeated = found.where("seen or owner <> other").select("h1", "h2", F.when(~F.col("seen"), F.col("owner")).alias("owner"))
        hit = new.join(repeated, ["h1", "h2"]).where(F.col("owner").isNull() | (rank != F.col("owner")))
        dropped.append(materialize(hit.select("doc_id", "th", "pos"), "dropped"))
        delete(found)
    runs.drop()
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)
    out = dropped[0]
    for more in dropped[1:]:
        out = out.unionAll(more)
    return out


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, th, n_lines, n_dropped, kept_text``, a row for each input row."""
    gone = dropped_positions(docs, min_chars, batches, fanout).groupBy("doc_id", "th").agg(F.collect_set("pos").alias("gone"))
    rows = null_safe(row_keyed(docs), gone, ["doc_id", "th"], "left")
    rows = rows.withColumn("lines", _lines(F.col("text")))
    n = F.size("lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda p: F.get(F.col("lines"), p)), "\n")
    )
    return rows.select(
        "doc_id", "th", n.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text")
    )
