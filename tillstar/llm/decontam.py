"""Benchmark passages in documents: exact similarity of item-sized windows.

Texts become lower-case words of letters and digits, and these become five-word shingles by hash. Windows of
an item's length start at every shingle that document and item share: a window of the highest
overlap can always be moved right to such a start without losing one. The exact similarity of the
weighted shingles, sum of minima over sum of maxima, decides on every such window.

There is no SimHash: where a shingle is repeated it decides the bits of a window's fingerprint, so blocks and
a Hamming radius miss windows far above the threshold. A linear bound that the overlap cannot pass (shared
distinct shingles and the window's repetitions) comes before the exact count instead and loses nothing.
DataFrame operations only. Defined cases: null or
empty texts, and items or documents of fewer than five words, match nothing; a document shorter than an item is
one window; repeated rows give one result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import fits, null_safe, row_keyed
from tillstar.session import materialize

WORDS, PERCENT = 5, 80


def with_shingles(rows: DataFrame, words: int) -> DataFrame:
    """``rows`` with ``sh``, the hashes of consecutive ``words`` words of its text; empty for fewer words."""
    plain = F.btrim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "))
    hashed = rows.withColumn("wh", F.transform(F.split(plain, " "), lambda w: F.xxhash64(w)))
    last = F.size("wh") - words
    every = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(F.col("wh"), i + j) for j in range(words))))
    return hashed.withColumn("sh", F.when(last >= 0, every).otherwise(F.array().cast("array<bigint>"))).drop("wh", "text")


def _overlap(a: str, b: str) -> Column:
    """Sum over shingles of the smaller number of occurrences."""
    times = f"least(size(filter({a}, x -> x = h)), size(filter({b}, x -> x = h)))"
    return F.expr(f"aggregate(array_distinct(array_intersect({a}, {b})), 0, (acc, h) -> acc + {times})")


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, th, item_id, start, n_windows, similarity``: for every document and item alike, the first of the
    most similar windows (counted in words) and the number of windows above the threshold."""
    # Arrays are written before expressions read them many times.
    items = materialize(with_shingles(benchmark.select("item_id", "text").distinct(), words), "items").withColumn("k", F.size("sh"))
    items = materialize(items.where("k > 0").withColumn("item", F.xxhash64("item_id", "sh")), "items")
    seeds = materialize(items.select("item", "k", F.explode(F.array_distinct("sh")).alias("h")), "seeds")
    rows = row_keyed(docs)
    # The outer form keeps Spark from computing the array once more to test whether it is empty.
    shingled = with_shingles(rows, words)
    every = shingled.select("doc_id", "th", F.size("sh").alias("n"), "sh", F.posexplode_outer("sh").alias("p", "h"))
    start = F.greatest(F.lit(0), F.least(F.col("p"), F.col("n") - F.col("k")))
    if fits(seeds, 48):
        # Seeds are looked up where the text is read; a hit takes its window along, and no text is shuffled.
        hits = every.join(F.broadcast(seeds), "h").withColumn("start", start)
        windows = hits.select("doc_id", "th", "item", "start", F.expr("slice(sh, start + 1, k)").alias("win")).dropDuplicates(["doc_id", "th", "item", "start"])
    else:
        hits = every.drop("sh").join(seeds, "h")
        starts = hits.select("doc_id", "th", F.struct("item", "k", start.alias("start")).alias("w")).groupBy("doc_id", "th").agg(F.collect_set("w").alias("ws"))
        held = with_shingles(null_safe(rows, starts, ["doc_id", "th"], "inner").distinct(), words)
        windows = held.select("doc_id", "th", "sh", F.explode("ws").alias("w"))
        windows = windows.select("doc_id", "th", "w.item", "w.start", F.expr("slice(sh, w.start + 1, w.k)").alias("win"))
    windows = materialize(windows, "windows")
    both = windows.join(items.select("item", "item_id", F.col("sh").alias("ish")), "item")
    # The overlap is at most the distinct shared shingles and the window's repetitions.
    most = F.size(F.array_intersect("win", "ish")) + F.size("win") - F.size(F.array_distinct("win"))
    both = both.withColumn("most", most).where(f"100 * most >= {percent} * (size(win) + size(ish) - most)")
    both = both.withColumn("o", _overlap("win", "ish")).withColumn("u", F.size("win") + F.size("ish") - F.col("o")).where(f"100 * o >= {percent} * u")
    both = both.withColumn("similarity", F.col("o") / F.col("u"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("best")
    out = both.groupBy("doc_id", "th", "item_id").agg(best, F.count_distinct("start").alias("n_windows"))
    return out.select("doc_id", "th", "item_id", (-F.col("best.s")).cast("long").alias("start"), "n_windows", "best.similarity")
