"""Near-duplicate documents: bottom-k sketches from one hash function.

A document is the set of its hashed word shingles. Equal sets form a class. A class keeps the
``k`` smallest hashes of its set. Two sets with similarity of at least ``percent`` share at least
``least`` of their retained values (but for a chance below 1e-8), so they also share one of each
one's rarest ``k - least + 1`` values: only those enter the inverted lists, and values that
very many documents hold stay out of them. Members of a list are compared with a hub of the list;
links found merge components, and lists that lie in one component are done. Classes of the lists that
are still open (large groups of half-alike documents) get exact lists from their full sets, which
documents with a fifth of their shingles for themselves do not enter, and go on with these in rounds of
more and other hubs, so that every two members of a list end in one component or have been compared.
A compared pair must pass the estimate from the union of both sketches, then exact similarity on the
full sets.

Shingles equal in 64 bits of hash count as equal. Defined cases: a document without words or text has an
empty set and is linked with nothing; fewer words than a shingle's make one shingle; rows are
documents, so rows that repeat a doc_id may lie in different components; a null doc_id counts as the
largest and a component of such rows alone has a null id; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import components, pieces, row_keyed, table_batch
from tillstar.session import materialize

K, PERCENT, WORDS = 64, 80, 5
#: Share of the retained values that a linked pair has in common but for a chance below 1e-8.
LEAST = 0.47
_NO_ID = (1 << 63) - 1
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, text after text, and their number."""
    digest = xxhash.xxh3_64_intdigest
    parts = [t.translate(_LOWER).split() for t in texts]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    hashed = np.fromiter((digest(w) for p in parts for w in p), np.uint64, int(counts.sum()))
    doc = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)
    value = np.zeros(len(hashed), np.uint64)
    place = np.arange(len(hashed)) - (ends - counts)[doc]
    # A shingle shorter than `words` is a whole short text: the missing words count as zeros.
    size = np.minimum(counts, words)[doc]
    for j in range(words):
        step = np.zeros(len(hashed), np.uint64)
        step[: len(hashed) - j] = hashed[j:]
        value = value * _A + np.where(j < size, step, np.uint64(0)) + np.uint64(j + 1)
    value ^= value >> np.uint64(31)
    value *= _B
    value ^= value >> np.uint64(29)
    full = place <= (counts[doc] - size)
    value, doc = value[full].view(np.int64), doc[full]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], np.bincount(doc[new], minlength=len(texts))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values))


_SKETCH = "doc_id bigint, th binary, n int, d1 bigint, d2 bigint, sketch array<bigint>"


def sketches(docs: DataFrame, words: int, k: int) -> DataFrame:
    """Size, digest and ``k`` smallest hashes of each row's set; nulls and 0 for an empty set."""

    def work(batches):
        for batch in pieces(batches, 4 << 20):
            doc_id, text, th = batch.columns
            values, counts = shingles([t or b"" for t in text.cast(pa.large_binary()).to_pylist()], words)
            ends = np.cumsum(counts).tolist()
            digests = [xxhash.xxh3_128_digest(values[b - c : b]) for b, c in zip(ends, counts.tolist(), strict=True)]
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            kept = np.minimum(counts, k)
            place = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
            few = values[place < k]
            yield table_batch(_SKETCH, [doc_id, th, counts.astype(np.int32), np.ascontiguousarray(pair[:, 0]), np.ascontiguousarray(pair[:, 1]), _lists(few, kept)])

    return row_keyed(docs).mapInArrow(work, _SKETCH)


def full_sets(rows: DataFrame, words: int) -> DataFrame:
    """``rep, d1, shingles`` (sorted) of rows ``rep, d1, text``."""
    schema = "rep bigint, d1 bigint, shingles array<bigint>"

    def work(batches):
        for batch in pieces(batches, 4 << 20):
            rep, d1, text = batch.columns
            values, counts = shingles([t or b"" for t in text.cast(pa.large_binary()).to_pylist()], words)
            yield table_batch(schema, [rep, d1, _lists(values, counts)])

    return rows.select("rep", "d1", "text").mapInArrow(work, schema)


def inverted_lists(classes: DataFrame, k: int, percent: int, least: float) -> DataFrame:
    """``v, rep, d1, n, c``: each class under its rarest retained values that another class holds too.

    ``c`` tells how central a class is: the mean logarithm of how many classes hold each of its values."""
    values = classes.select("rep", "d1", "n", F.explode("sketch").alias("v"))
    # Written before the join, so that Spark can split a hot value's side of it.
    counts = materialize(values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "counts")
    shared = values.join(counts, "v")
    kept = F.least(F.col("n"), F.lit(k))
    # A set so small that its partners are retained whole too has `percent` of itself in common with them.
    needed = F.when(100 * F.col("n") <= percent * k, F.ceil(F.col("n") * percent / 100)).otherwise(F.ceil(kept * least))
    rarest = shared.groupBy("rep", "d1", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"), F.sum(F.ln("df")).alias("logs"))
    # values that no other class holds are the rarest and take the first places
    room = kept - needed.cast("int") + 1 - (kept - F.size("vs"))
    few = F.slice("vs", 1, F.greatest(room, F.lit(0)))
    return rarest.select("rep", "d1", "n", (F.col("logs") / kept).alias("c"), F.explode(few).alias("x")).select("x.v", "rep", "d1", "n", "c")


def exact_lists(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``v, n, node, c, left`` for some classes, from their full sets: each class under its rarest shingles, as many as
    two sets must have one of in common to be linked. A shingle that no other of these classes holds takes a
    place without a list, so a set with many shingles of its own enters few lists or none; no link is lost.
    ``left`` is the number of the set's shingles from this one on, the most that it can have in common with a set
    that shares none of the rarer ones.
    """
    values = sets.select(_node().alias("node"), "shingles").join(nodes, "node", "left_semi")
    values = values.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("v"))
    counts = materialize(values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "exact_counts")
    rarest = values.join(counts, "v").groupBy("node", "n")
    rarest = rarest.agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"), F.sum(F.ln("df")).alias("logs"))
    # A linked set has `needed` shingles in common with its partner, so one of the other places' and one more.
    needed = F.ceil(F.col("n") * percent / 100).cast("int")
    room = F.size("vs") - needed + 1
    few = F.slice("vs", 1, F.greatest(room, F.lit(0)))
    placed = rarest.select("node", "n", (F.col("logs") / F.col("n")).alias("c"), F.size("vs").alias("shared"), F.posexplode(few).alias("at", "x"))
    return placed.select("x.v", "n", "node", "c", (F.col("shared") - F.col("at")).alias("left"))


def _node():
    return F.struct("rep", "d1")


def verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, k: int, percent: int, least: float) -> DataFrame:
    """The pairs ``a, b`` whose exact similarity is at least ``percent``."""
    brief = classes.select(_node().alias("node"), F.col("sketch").alias("s"))
    both = pairs.join(brief.toDF("a", "sa"), "a").join(brief.toDF("b", "sb"), "b")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    # Two sets that are retained whole and give a short union are compared exactly here.
    whole = (F.size("sa") < k) & (F.size("sb") < k) & (F.size(union) < k)
    enough = F.when(whole, percent / 100 - 1e-9).otherwise(least)
    likely = materialize(both.where(common >= enough * F.size(union)).select("a", "b"), "likely")
    whole = sets.select(_node().alias("node"), "shingles")
    both = likely.join(whole.toDF("a", "sa"), "a").join(whole.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def links(lists: DataFrame, classes: DataFrame, sets: DataFrame, k: int, percent: int, least: float) -> DataFrame | None:
    """``node, component`` of the linked classes, None without any link.

    The first round compares the members of each list of retained values with the list's hub, its most central
    member: the text that a group's copies come from links most of them at once, and lists with nearly the same
    members share their hub and its comparisons. Classes whose lists are still open get exact lists from their
    full sets; further rounds take these, with sixteen times as many hubs each, until every two members of a
    list have been compared or lie in one component. Two members whose shingles from the list's one on are too few
    for a link are not compared there: if they are linked, a rarer shingle that they share has a list with both."""
    comps, checked = None, lambda pairs: verified(pairs, classes, sets, k, percent, least)
    # The whole set may lie behind a retained value.
    open_, comps = _round(lists.select("v", "n", _node().alias("node"), "c", F.col("n").alias("left")), comps, 1, percent, checked)
    if open_ is None:
        return comps
    still = _open(open_, comps).select("node").distinct()
    open_, hubs = materialize(exact_lists(sets, still, percent), "exact_lists"), 1
    while open_ is not None:
        open_, comps = _round(open_, comps, hubs, percent, checked)
        hubs *= 16
    return comps


def _open(lists: DataFrame, comps: DataFrame | None, seed: int = 0) -> DataFrame:
    """The members of lists that do not lie in one component: ``v, n, node, c, left, comp, hash, place, size, first``."""
    named = lists.withColumn("comp", F.col("node"))
    if comps is not None:
        named = lists.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    # One hub is the most central member, more are chosen by hash.
    first = -F.col("c") if seed <= 1 else F.lit(0.0)
    named = named.withColumn("hash", F.xxhash64(F.lit(seed), "node")).withColumn("place", F.struct(first.alias("c"), "hash"))
    spread = named.groupBy("v").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("place").alias("first"))
    return named.join(spread.where("lo <> hi").select("v", "size", "first"), "v")


def _round(lists: DataFrame, comps: DataFrame | None, hubs: int, percent: int, checked) -> tuple[DataFrame | None, DataFrame | None]:
    """Compare the members ``v, n, node, c, left`` of each list with its hubs; the members that were no hubs, and the components."""
    hub = F.col("place") == F.col("first")
    if hubs > 1:
        hub = hub | (F.col("size") <= 2 * hubs) | (F.pmod("hash", F.lit(1 << 30)) / float(1 << 30) < hubs / F.col("size"))
    marked = materialize(_open(lists, comps, hubs).select("v", "n", "node", "c", "left", "comp", hub.alias("hub")), "marked")
    if marked.isEmpty():
        return None, comps
    heads = marked.where("hub").select("v", F.col("node").alias("a"), F.col("n").alias("an"), F.col("left").alias("al"), F.col("comp").alias("ac"))
    members = marked.select("v", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("left").alias("bl"), F.col("comp").alias("bc"), F.col("hub").alias("bh"))
    pairs = heads.join(members, "v").where("ac <> bc and (not bh or a < b)")
    pairs = pairs.where(f"100 * least(an, bn) >= {percent} * greatest(an, bn)")
    pairs = pairs.where(f"{100 + percent} * least(al, bl) >= {percent} * (an + bn)")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    new = materialize(checked(pairs), "verified")
    if not new.isEmpty():
        known = [] if comps is None else [comps.select(F.col("node").alias("a"), F.col("component").alias("b"))]
        comps = components(reduce(DataFrame.unionAll, known, new))
    return marked.where("not hub").select("v", "n", "node", "c", "left"), comps


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, k: int = K, least: float = LEAST) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, kept, group``, a row for each input row.

    ``group`` is the same for the rows of one component, also where they lack an id, and null for empty sets."""
    rows = materialize(sketches(docs, words, k), "sketches")
    filled = rows.where("n > 0")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(_NO_ID)).alias("rep"), F.col("th"))).alias("first")
    classes = filled.groupBy("d1", "d2").agg(first, F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = materialize(classes.select("d1", "d2", "first.rep", "first.th", "n", "sketch"), "classes")
    lists = inverted_lists(classes, k, percent, least)
    lists = materialize(lists, "lists")
    wanted = lists.select("rep", "d1").distinct().join(classes.select("rep", "d1", "th"), ["rep", "d1"])
    keyed = row_keyed(docs).select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("rep"), "th", "text")
    # Equal rows have equal sets: one of them is enough.
    sets = materialize(full_sets(keyed.join(wanted, ["rep", "th"]), words).dropDuplicates(["rep", "d1"]), "sets")
    comps = links(lists, classes, sets, k, percent, least)
    named = classes.select("d1", "d2", _node().alias("node"))
    if comps is not None:
        named = named.join(comps, "node", "left").withColumn("node", F.coalesce("component", "node"))
    named = named.select("d1", "d2", F.col("node.rep").alias("component_id"), F.col("node").alias("group"))
    members = filled.select("doc_id", "th", "n", "d1", "d2").join(named, ["d1", "d2"])
    whole = members.select("doc_id", "th", "n", F.when(F.col("component_id") != _NO_ID, F.col("component_id")).alias("component_id"), "group")
    alone = rows.where("n = 0").select("doc_id", "th", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast(whole.schema["group"].dataType).alias("group"))
    return whole.unionAll(alone).select(
        "doc_id", "th", F.col("n").cast("long").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "group"
    )
