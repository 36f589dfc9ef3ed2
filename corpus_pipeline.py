"""Corpus pipeline: language, repeated lines, near duplicates, benchmark passages, token ids.

Each stage works on all that its predecessor kept, takes effect, and is written and read again before
the next. All but the last return the columns of ``documents``; the last adds ``ids`` and ``n_ids``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import langid
from tillstar.llm.common import null_safe, prepare, read, text_key
from tillstar.llm.decontam import contaminated
from tillstar.llm.line_dedup import dedup_lines
from tillstar.llm.near_dup import near_duplicates
from tillstar.llm.sentencepiece import encode
from tillstar.session import materialize

#: The stages draw on fitted models, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None

_KEY = ["_id", "_th"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows as one struct beside the operators' row key: no name of theirs can clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").cast("long").alias("_id"), text_key("text").alias("_th"))


def _kept(docs: DataFrame, verdict: DataFrame, how: str) -> DataFrame:
    return null_safe(_keyed(docs), verdict.distinct(), _KEY, how).select("_row.*")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those that the identifier rejects go."""
    prepare(spark)
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, model).where("accepted").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    return _kept(docs, found, "left_semi")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; ``n_chars`` follows the text."""
    prepare(spark)
    found = dedup_lines(docs).where("n_dropped > 0").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("kept_text").alias("_text"))
    joined = null_safe(_keyed(docs), found.dropDuplicates(_KEY), _KEY, "left")
    text = F.coalesce("_text", "_row.text")
    changed = {"text": text, "n_chars": F.when(F.col("_text").isNull(), F.col("_row.n_chars")).otherwise(F.char_length("_text")).cast("long")}
    return joined.select(*(changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: of the smallest doc_id (null last), then of the smallest text hash;
    of rows that are equal in both, the smallest by all their columns. Documents without words all stay."""
    prepare(spark)
    found = near_duplicates(docs).where("`group` IS NOT NULL").groupBy("group", "doc_id", "th").agg(F.count("*").alias("n"))
    found = materialize(found, "near")
    first = found.groupBy("group").agg(F.sum("n").alias("rows"), F.min(_order()).alias("first")).where("rows > 1")
    verdict = found.join(first, "group").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "n", _order().eqNullSafe(F.col("first")).alias("stays"))
    verdict = materialize(verdict, "verdict")
    equal = verdict.where("stays and n > 1").select(*_KEY)
    if equal.isEmpty():
        return _kept(docs, verdict.where("not stays").select(*_KEY), "left_anti")
    back = null_safe(_keyed(docs), equal, _KEY, "left_semi").withColumn("_json", F.to_json("_row"))
    back = back.groupBy(*_KEY).agg(F.min_by("_row", "_json").alias("_row")).select("_row.*")
    return _kept(docs, verdict.where("not stays or n > 1").select(*_KEY), "left_anti").unionAll(back)


def _order():
    """Documents by id, those without one last, then by text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = contaminated(docs, read(spark, sf_dir, "benchmark"))
    return _kept(docs, found.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")), "left_anti")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids, source, language and token ids."""
    prepare(spark)
    coded = encode(docs.select("doc_id", "lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"))


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
