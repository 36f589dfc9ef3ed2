"""Ranked lexical search: best-first document intervals bounded by range maxima of posting lists.

`build` cuts the documents into shards of bounded size. A shard's rows are one posting list per term (places
of documents and how often each holds the term) and, under the empty term, its documents' ids and lengths.
Inside a shard the documents are ordered by their most frequent term and their length, so neighbours are alike.

`search` adds up document frequencies, weighs the terms and searches every shard by itself. Each list of
impacts gets a sparse table, which gives the place of the range maximum of any interval of documents at once.
The sum of an item's weighted maxima bounds every score in an interval. The intervals of highest bound are
opened first: the document of the largest single weighted impact is scored exactly and splits its interval in
two. The search ends when no bound reaches the k-th best score, so the shard's best k are exact. They are
ranked in two steps, by parts of the shards and then in all, so that no task sees all rows of an item.

Score of a document for an item, all in 64-bit integers, ``div`` rounding down: the sum over the item's
distinct terms of w * ((1000000000 * tf) div (1000 * tf + 20 * m)), w = floor(1000 * ln((2N + 2) / (2df + 1))),
m = 50 + ((50 * n * N) div L), with n a document's terms, N the documents with a term and L all their terms.

Terms are maximal runs of ASCII letters and digits and of all other non-ASCII characters, A-Z lower-cased.
Defined cases: null or empty texts have no terms and are never found; items of one id are one item with the
terms of all its rows, a null id is an id like any other; documents of equal score come by ascending doc_id,
null last; repeated rows are documents of their own; fewer than k documents above 0 give fewer rows; no
documents or no items give no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.llm.common import Texts, fits, lower_ascii, pieces, table_batch
from tillstar.session import materialize, scratch_path

#: Bytes of text in one shard; bounds what a task holds.
SHARD_BYTES = 8 << 20
#: Bytes of terms in one block of items that is sent with the tasks; more items are searched block by block.
BLOCK_BYTES = 16 << 20
#: Intervals opened together; more cost needless openings, fewer cost calls.
TOGETHER = 64
TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
LISTS = "shard bigint, term string, places array<int>, counts array<int>, ids array<bigint>"
_PLAIN = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))


@dataclass
class Index:
    """A written index: one row per shard and term, the empty term's row listing the shard's documents."""

    lists: DataFrame

    @staticmethod
    def open(spark: SparkSession, folder: str) -> Index:
        return Index(spark.read.schema(LISTS).parquet(folder))


def build(docs: DataFrame, folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> Index:
    """Index the whole texts of ``docs`` (``doc_id``, ``text``) in one pass without a shuffle."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "lexical")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(pieces(batches, shard_bytes)):
            yield from _shard(task + k, batch)

    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, LISTS).write.parquet(folder)
    return Index.open(spark, folder)


def _shard(shard: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of one shard, by term."""
    texts = Texts(batch.column(1))
    data = texts.data.tobytes().translate(_PLAIN)
    words = [data[a : a + n].split() for a, n in zip(texts.starts.tolist(), texts.lens.tolist(), strict=True)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    coded = pa.array([w for part in words for w in part], pa.binary()).dictionary_encode()
    names, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    size = max(1, len(names))
    pairs, counts = np.unique(np.repeat(np.arange(len(words)), lengths) * size + codes, return_counts=True)
    doc, code = pairs // size, pairs % size
    # A document's most frequent term; neighbours in this order are alike.
    top, by_count = np.full(len(words), -1), np.argsort(counts, kind="stable")
    top[doc[by_count]] = code[by_count]
    order = np.lexsort((lengths, top))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    rank = np.empty(size, np.int64)
    sorted_names = pa.compute.sort_indices(names).to_numpy()
    rank[sorted_names] = np.arange(len(names))
    keys = rank[code] * max(1, len(words)) + place[doc]
    by_term = np.argsort(keys)
    term, places, counts = rank[code][by_term], place[doc][by_term].astype(np.int32), counts[by_term].astype(np.int32)
    documents = pa.ListArray.from_arrays([0, len(words)], batch.column(0).cast(pa.int64()).take(pa.array(order)))
    span = pa.array(np.array([0, len(words)], np.int32))
    ints = lambda x: pa.ListArray.from_arrays(span, pa.array(x.astype(np.int32)))
    yield table_batch(LISTS, [[shard], [""], ints(np.arange(len(words))), ints(lengths[order]), documents])
    ends = np.searchsorted(term, np.arange(len(names) + 1)).astype(np.int32)
    names = names.take(pa.array(sorted_names)).cast(pa.string())
    for at in range(0, len(names), 20_000):
        cut = slice(at, min(len(names), at + 20_000) + 1)
        a, b = int(ends[cut][0]), int(ends[cut][-1])
        offsets, n = pa.array(ends[cut] - a), len(ends[cut]) - 1
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[a:b])) for x in (places, counts)]
        yield table_batch(LISTS, [pa.array([shard] * n, pa.int64()), names.slice(at, n), *lists, pa.nulls(n, pa.list_(pa.int64()))])


class Lists:
    """Posting lists of one shard, one behind the other, with sparse tables for range maxima.

    ``impacts`` and ``places`` hold all lists; list t is ``ends[t]:ends[t + 1]``.
    """

    def __init__(self, places: np.ndarray, impacts: np.ndarray, ends: np.ndarray, documents: int):
        self.places, self.impacts, self.ends, self.documents = places, impacts, ends, documents
        sizes = np.diff(ends)
        # A key per posting: its list and document. All lists are searched in one call.
        self.keys = np.repeat(np.arange(len(sizes)) * documents, sizes) + places
        # Row j: place of the maximum of 2^j postings from each one on; the first of equal ones.
        self.table = [np.arange(len(places), dtype=np.int32)]
        step = 1
        while 2 * step <= (int(sizes.max()) if len(sizes) else 0):
            a, b = self.table[-1][:-step], self.table[-1][step:]
            self.table.append(np.where(impacts[b] > impacts[a], b, a))
            step *= 2
        self.flat = np.concatenate(self.table)
        self.rows = np.cumsum([0, *map(len, self.table)])[:-1]

    def top(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the maximum of each range of postings of one list; -1 for an empty one."""
        size = high - low
        level = np.frexp(np.maximum(size, 1))[1] - 1
        at = self.rows[level]
        a, b = self.flat[np.where(size > 0, at + low, 0)], self.flat[np.where(size > 0, at + high - (1 << level), 0)]
        return np.where(size > 0, np.where(self.impacts[b] > self.impacts[a], b, a), -1)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best documents above 0 for weighted lists; equal scores by ``ids``."""
        impacts, base = np.append(self.impacts, 0), terms * self.documents

        def bounded(low, high):
            tops = self.top(low, high)
            values = impacts[tops] * weights
            return tops, values, values.sum(axis=1)

        low, high = self.ends[terms][None, :], self.ends[terms + 1][None, :]
        tops, values, bounds = bounded(low, high)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = 1
        while True:
            open_ = bounds >= least
            if not open_.all():
                low, high, tops, values, bounds = (x[open_] for x in (low, high, tops, values, bounds))
            if not len(bounds):
                break
            if len(bounds) > TOGETHER:
                chosen = np.zeros(len(bounds), bool)
                chosen[np.argpartition(bounds, -TOGETHER)[-TOGETHER:]] = True
            else:
                chosen = np.ones(len(bounds), bool)
            # The document of the largest weighted impact is scored in full and splits its interval.
            a, b, rows = low[chosen], high[chosen], np.arange(int(chosen.sum()))
            heads = self.places[tops[chosen][rows, values[chosen].argmax(axis=1)]].astype(np.int64)
            wanted = base + heads[:, None]
            at = np.searchsorted(self.keys, wanted)
            holds = (at < b) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)
            score = (np.where(holds, impacts[np.where(holds, at, -1)], 0) * weights).sum(axis=1)
            places, scores = np.concatenate((places, heads)), np.concatenate((scores, score))
            if len(scores) > k:
                order = np.lexsort((ids[places], -scores))[:k]
                places, scores = places[order], scores[order]
            if len(scores) == k:
                least = max(1, int(scores.min()))
            new_low, new_high = np.concatenate((a, at + holds)), np.concatenate((at, b))
            new = bounded(new_low, new_high)
            rest = ~chosen
            low, high = np.concatenate((low[rest], new_low)), np.concatenate((high[rest], new_high))
            tops, values, bounds = (np.concatenate((x[rest], y)) for x, y in zip((tops, values, bounds), new, strict=True))
        order = np.lexsort((ids[places], -scores))
        return places[order][scores[order] > 0], scores[order][scores[order] > 0]


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item, term``: distinct terms of each item."""
    found = F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(TERM), F.lit(1))
    return items.select(F.col(item).alias("item"), F.explode(found).alias("term")).distinct()


def search(index: Index, items: DataFrame, k: int = 50, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = items.sparkSession
    terms = materialize(item_terms(items, item, text), "item_terms")
    wanted = materialize(terms.select("term").distinct(), "wanted")
    lists = index.lists.where("term <> ''").join(F.broadcast(wanted) if fits(wanted, 100) else wanted, "term", "left_semi")
    lengths = index.lists.where("term = ''").select(F.explode("counts").alias("n")).where("n > 0")
    totals = lengths.agg(F.count("*").alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    df = lists.groupBy("term").agg(F.sum(F.size("places")).cast("long").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(totals["N"]) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = materialize(terms.join(df, "term").select("item", "term", weight.alias("w")).where("w > 0"), "weighted")
    size = weighted.agg(F.sum(F.octet_length("term") + 48).alias("s")).first()["s"] or 0
    blocks = size // BLOCK_BYTES + 1
    found = [_found(index, weighted.where(F.pmod(F.hash("item"), F.lit(blocks)) == b), totals["N"], totals["L"], k) for b in range(blocks)]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionAll(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = F.pmod(F.xxhash64("shard"), F.lit(1 + int(index.lists.where("term = ''").count() ** 0.5)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item", parts).orderBy(*order))).where(F.col("rank") <= k)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return rows.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def _found(index: Index, weighted: DataFrame, documents: int, length: int, k: int) -> DataFrame:
    """``item, doc_id, score, shard``: each shard's best of a block of items of bounded size."""
    spark = weighted.sparkSession
    block = weighted.orderBy("item", "term").toArrow()
    names = block["term"].combine_chunks().dictionary_encode()
    codes, weights = names.indices.to_numpy().astype(np.int64), block["w"].to_numpy()
    ids = block["item"].combine_chunks().dictionary_encode("encode")
    item_of = ids.indices.to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(item_of)) + 1).tolist(), len(item_of)] if len(item_of) else [0]
    known, item_values = names.dictionary, ids.dictionary.to_pylist()
    item_field = weighted.schema["item"].dataType.simpleString()
    wanted = spark.createDataFrame(pa.table({"term": known}), "term string").unionAll(spark.sql("SELECT ''"))
    rows = index.lists.join(F.broadcast(wanted), "term", "left_semi")
    # A table of its own for the work: cut to the block's terms, dealt by shard.
    dealt = rows.repartition("shard")

    def shard(table: pa.Table) -> pa.Table:
        names = table["term"].combine_chunks()
        head = pa.compute.index(names, "").as_py()
        out = [[], [], [], []]
        if head >= 0:
            doc_ids = table["ids"].slice(head, 1).combine_chunks().flatten()
            n = table["counts"].slice(head, 1).combine_chunks().flatten().to_numpy().astype(np.int64)
            rest = table.filter(pa.compute.not_equal(names, ""))
            lists = rest["places"].combine_chunks()
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            places = lists.flatten().to_numpy().astype(np.int64)
            counts = rest["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
            m = 50 + (50 * n * documents) // max(1, length)
            impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * m[places])
            postings = Lists(places, impacts, np.concatenate(([0], np.cumsum(sizes))), len(n))
            here = np.full(len(known), -1, np.int64)
            here[pa.compute.index_in(rest["term"].combine_chunks(), known).to_numpy()] = np.arange(len(rest))
            order = doc_ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            shard_id = table["shard"][0].as_py()
            for a, b in zip(cuts, cuts[1:], strict=False):
                lists_here = here[codes[a:b]]
                use = lists_here >= 0
                if not use.any():
                    continue
                found, scores = postings.best(lists_here[use], weights[a:b][use], k, order)
                out[0].extend([item_values[item_of[a]]] * len(found))
                out[1].extend(doc_ids.take(pa.array(found)).to_pylist())
                out[2].extend(scores.tolist())
                out[3].extend([shard_id] * len(found))
        return pa.table([pa.array(c, t) for c, t in zip(out, (block["item"].type, pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["item", "doc_id", "score", "shard"])

    return dealt.groupBy("shard").applyInArrow(shard, f"item {item_field}, doc_id bigint, score bigint, shard bigint")
