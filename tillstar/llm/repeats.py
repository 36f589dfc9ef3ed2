"""Repeated byte strings across a corpus: common-prefix interval trees over enhanced suffix arrays.

A string of ``span`` bytes that occurs twice has the same leftmost-minimal gram (by hash) in both
places, its anchor. So every start of such a string belongs to one anchor, and consecutive starts
with one anchor make a segment. Only segments whose anchor occurs elsewhere can hold a repeat:

1. every text gives its segments: (anchor hash, segment hash, place);
2. anchors found once are dropped; equal segments are repeats as a whole;
3. of the different segments of an anchor one copy each is read again; a task concatenates whole
   groups, builds their suffix array and LCP array, and scans it with a stack: each interval of at
   least ``span`` common bytes is a node of the tree, marked maximal where the bytes to its left
   differ, and every suffix hangs on its deepest node, so all occurrences are given;
4. the nodes' places are carried to all copies of their segments.

An anchor with more than ``hot`` different segments is not one task's work: its strings of ``span``
bytes are grouped by hash with map-side counting instead.

Strings equal in 128 bits of hash count as equal. Defined cases: a null or empty text has no bytes;
rows are documents, so a repeated row repeats all of its strings; rows with a null doc_id are kept;
texts shorter than ``span`` are untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import Texts, delete, null_safe, pieces, row_keyed, table_batch
from tillstar.session import materialize

SPAN, GRAM, HOT = 200, 48, 8192
_RNG = np.random.default_rng(20240131)
_MIX = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = _RNG.integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 20) - 1)
_PIECE = 1 << 19
_END = 0xFF  # no byte of UTF-8


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at each place; the last places' are of no use."""
    level, size, done, out = _MIX[data], 1, 0, None
    bits = 0
    while True:
        if gram & size:
            out = level if out is None else _moved(out, done, level, _ODD[bits])
            done += size
        if size * 2 > gram:
            break
        nxt = level * _ODD[bits]
        nxt[:-size] += level[size:] if size < len(level) else 0
        level, size, bits = nxt, size * 2, bits + 1
    out = out ^ (out >> np.uint64(32))
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def _moved(first: np.ndarray, done: int, level: np.ndarray, odd: np.uint64) -> np.ndarray:
    out = first * odd
    if done < len(level):
        out[:-done] += level[done:]
    return out


def segments_of(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, span: int, gram: int):
    """First start, number of starts, anchor hash and text of the segments of a block of texts."""
    n = len(data)
    grams = gram_hashes(data, gram)
    # The low bits hold the place, so the smallest value is the leftmost of equal hashes.
    low = (grams & ~_PLACE) | np.arange(n, dtype=np.uint64)
    width, size = span - gram + 1, 1
    while size * 2 <= width:
        low = _pair(low, size)
        size *= 2
    if size < width:
        low = _pair(low, width - size)
    place = (low & _PLACE).astype(np.int64)
    usable = lens >= span
    valid = np.zeros(n + 1, np.int32)
    np.add.at(valid, starts[usable], 1)
    np.add.at(valid, starts[usable] + lens[usable] - span + 1, -1)
    valid = np.cumsum(valid[:n]) > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    first[starts[usable]] = True
    lo = np.flatnonzero(first)
    if not len(lo):
        return lo, lo, lo, lo
    last = valid.copy()
    last[:-1] &= ~valid[1:] | first[1:]
    count = np.flatnonzero(last) - lo + 1
    text = np.searchsorted(starts, lo, "right") - 1
    return lo, count, grams[place[lo]], text


def _pair(low: np.ndarray, shift: int) -> np.ndarray:
    out = low.copy()
    if shift < len(low):
        np.minimum(low[:-shift], low[shift:], out=out[:-shift])
    return out


def _blocks(texts: Texts, span: int):
    """(data, starts, lens, text number, offset) of parts of at most _PIECE starts, long texts in several."""
    at = 0
    while at < len(texts):
        if texts.lens[at] > _PIECE:
            for offset in range(0, int(texts.lens[at]) - span + 1, _PIECE):
                first = int(texts.starts[at]) + offset
                size = min(int(texts.lens[at]) - offset, _PIECE + span - 1)
                yield texts.data[first : first + size], np.zeros(1, np.int64), np.array([size]), np.array([at]), offset
            at += 1
            continue
        end = at + 1
        while end < len(texts) and texts.starts[end] + texts.lens[end] - texts.starts[at] <= _PIECE:
            end += 1
        first = int(texts.starts[at])
        last = int(texts.starts[end - 1] + texts.lens[end - 1])
        yield texts.data[first:last], texts.starts[at:end] - first, texts.lens[at:end], np.arange(at, end), 0
        at = end


_SEGMENT = "anchor bigint, seg bigint, doc_id bigint, th binary, lo bigint, n int"


def segments(docs: DataFrame, span: int, gram: int) -> DataFrame:
    def work(batches):
        for batch in pieces(batches, 4 << 20):
            doc_id, text, th = batch.columns
            texts = Texts(text)
            for data, starts, lens, rows, offset in _blocks(texts, span):
                lo, count, anchor, which = segments_of(data, starts, lens, span, gram)
                if not len(lo):
                    continue
                view, digest = memoryview(data), xxhash.xxh3_64_intdigest
                ends = (lo + count + span - 1).tolist()
                seg = np.fromiter((digest(view[a:b]) for a, b in zip(lo.tolist(), ends, strict=True)), np.uint64, len(lo))
                row = pa.array(rows[which])
                yield table_batch(
                    _SEGMENT,
                    [anchor.view(np.int64), seg.view(np.int64), doc_id.take(row), th.take(row), lo - starts[which] + offset, count.astype(np.int32)],
                )

    return row_keyed(docs).where(F.octet_length("text") >= span).mapInArrow(work, _SEGMENT)


# ---------------------------------------------------------------- suffix array of a group


def suffix_array(data: np.ndarray, starts: np.ndarray, remaining: np.ndarray, depth: int):
    """Sorted suffixes among ``starts`` and the common prefix of each with its predecessor, by prefix
    doubling to ``depth`` bytes. ``remaining``: bytes of each suffix before its text's end mark."""
    n = len(data)
    pad = np.full(n + 8, _END, np.uint64)
    pad[:n] = data
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | pad[j : n + j]
    packed = key
    ranks, size = [], 8
    while True:
        order = np.argsort(key)
        step = np.empty(n, bool)
        step[:1], step[1:] = False, np.diff(key[order]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        ranks.append((size, rank))
        if size >= depth:
            break
        moved = np.full(n, 0, np.int64)
        moved[: n - size if size < n else 0] = rank[size:] + 1
        key = rank.astype(np.uint64) << np.uint64(32) | moved.astype(np.uint64)
        size *= 2
    order = np.argsort(rank[starts], kind="stable")
    sa, left = starts[order], remaining[order]
    a, b = sa[:-1].copy(), sa[1:].copy()
    lcp = np.zeros(len(a), np.int64)
    for size, rank in reversed(ranks):
        inside = np.maximum(a, b) < n
        same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        lcp += size * same
        a += size * same
        b += size * same
    rest = packed[np.minimum(a, n - 1)] ^ packed[np.minimum(b, n - 1)]
    for size in (4, 2, 1):
        same = (np.maximum(a, b) < n) & (rest >> np.uint64(64 - 8 * size) == 0)
        lcp += size * same
        rest = np.where(same, rest << np.uint64(8 * size), rest)
    lcp = np.minimum(lcp, np.minimum(left[:-1], left[1:]))
    return sa, np.concatenate(([0], lcp))


def intervals(lcp: list[int], least: int):
    """Nodes (depth, first, last, parent) of a common-prefix interval tree and each entry's deepest node,
    by one scan with a stack. ``lcp[0]`` is not used."""
    nodes: list[list[int]] = []
    deepest = [-1] * len(lcp)
    stack: list[int] = []
    for i in range(1, len(lcp) + 1):
        depth = lcp[i] if i < len(lcp) and lcp[i] >= least else 0
        first, child = i - 1, -1
        while stack and nodes[stack[-1]][0] > depth:
            child = stack.pop()
            nodes[child][2] = i - 1
            first = nodes[child][1]
            if stack and nodes[stack[-1]][0] >= depth:
                nodes[child][3] = stack[-1]
        if depth and (not stack or nodes[stack[-1]][0] < depth):
            nodes.append([depth, first, -1, -1])
            if child >= 0:
                nodes[child][3] = len(nodes) - 1
            stack.append(len(nodes) - 1)
    for k in sorted(range(len(nodes)), key=lambda k: nodes[k][0]):
        deepest[nodes[k][1] : nodes[k][2] + 1] = [k] * (nodes[k][2] + 1 - nodes[k][1])
    return nodes, deepest


def group_repeats(texts: list[bytes], span: int):
    """Repeats among different texts: arrays (text, start, length, node, parent, maximal), a row for
    each suffix on the node of its longest repeat. Subtrees whose suffixes all have one byte to
    their left are left out: the strings one byte longer to the left hold them."""
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    lens = np.array([len(t) for t in texts])
    begins = np.cumsum(lens + 1) - lens - 1
    per = np.maximum(lens - span + 1, 0)
    starts = np.repeat(begins - (np.cumsum(per) - per), per) + np.arange(per.sum())
    text = np.repeat(np.arange(len(texts)), per)
    remaining = (begins + lens)[text] - starts
    sa, lcp = suffix_array(joined, starts, remaining, int(lens.max()))
    owner = np.searchsorted(begins, sa, "right") - 1
    head = sa == begins[owner]
    before = joined[np.maximum(sa - 1, 0)].astype(np.int64)
    # changes[j]: whether the byte to the left differs from the entry above; a text's head differs from all
    changes = np.zeros(len(sa), np.int64)
    changes[1:] = (before[1:] != before[:-1]) | head[1:] | head[:-1]
    changed = np.cumsum(changes)
    linked = lcp >= span
    run = np.cumsum(~linked) - 1
    first = np.flatnonzero(~linked)
    last = np.append(first[1:], len(sa)) - 1
    diverse = (last > first) & (changed[last] > changed[first])
    out = []
    pairs = diverse & (last == first + 1)
    if pairs.any():
        i = np.flatnonzero(pairs[run])
        node = first[run[i]]
        out.append(np.stack([owner[i], sa[i] - begins[owner[i]], lcp[last[run[i]]], node, np.full(len(i), -1), np.ones(len(i), np.int64)], 1))
    for r in np.flatnonzero(diverse & (last > first + 1)):
        f, l = int(first[r]), int(last[r])
        nodes, deepest = intervals(lcp[f : l + 1].tolist(), span)
        table = np.array(nodes)
        maximal = changed[f + table[:, 2]] > changed[f + table[:, 1]]
        i, k = np.arange(f, l + 1), np.array(deepest)
        parent = np.where(table[k, 3] >= 0, table[k, 3] * len(sa) + f, -1)
        out.append(np.stack([owner[i], sa[i] - begins[owner[i]], table[k, 0], k * len(sa) + f, parent, maximal[k].astype(np.int64)], 1))
    return np.concatenate(out) if out else np.zeros((0, 6), np.int64)


_REPEAT = "anchor bigint, seg bigint, start int, len int, node bigint, parent bigint, maximal boolean"


def _trees(span: int, limit: int):
    """Task: groups of segments, sorted by anchor, to their repeats; whole groups up to ``limit`` bytes at once."""

    def chunk(rows):
        found = group_repeats([r[2] for r in rows], span)
        which = found[:, 0]
        anchor = np.array([r[0] for r in rows], np.int64)[which]
        seg = np.array([r[1] for r in rows], np.int64)[which]
        ids = [np.where(found[:, k] >= 0, found[:, k] ^ (anchor & ~np.int64(0xFFFFFFFFFF)), -1) for k in (3, 4)]
        return table_batch(_REPEAT, [anchor, seg, found[:, 1].astype(np.int32), found[:, 2].astype(np.int32), *ids, found[:, 5] > 0])

    def work(batches):
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= limit and row[0] != rows[-1][0]:
                    yield chunk(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2])
        if rows:
            yield chunk(rows)

    return work


def _strings(span: int):
    """Task: every ``span`` bytes of the hot anchors' segments as a hash."""

    def work(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                anchor, seg, start, hashes = [], [], [], []
                for a, s, t in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    n = len(t) - span + 1
                    anchor += [a] * n
                    seg += [s] * n
                    start += range(n)
                    hashes += [digest(t[i : i + span]) for i in range(n)]
                yield table_batch(
                    "anchor bigint, seg bigint, start int, h bigint",
                    [np.array(anchor, np.int64), np.array(seg, np.int64), np.array(start, np.int32), np.array(hashes, np.uint64).view(np.int64)],
                )

    return work


def _cut(span: int):
    """Task: texts with the places of wanted segments to the segments' bytes."""

    def work(batches):
        for batch in pieces(batches, 4 << 20):
            text, wanted = batch.columns
            data = text.cast(pa.large_binary()).to_pylist()
            rows = [(w["anchor"], w["seg"], d[w["lo"] : w["lo"] + w["n"] + span - 1]) for d, ws in zip(data, wanted.to_pylist(), strict=True) for w in ws]
            for at in range(0, len(rows), 5000):
                a, s, t = zip(*rows[at : at + 5000], strict=True)
                yield table_batch("anchor bigint, seg bigint, bytes binary", [pa.array(a, pa.int64()), pa.array(s, pa.int64()), pa.array(t, pa.binary())])

    return work


def occurrences(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, th, start, len, node, parent, maximal``: every place of a repeat, by byte.

    ``node`` joins the occurrences of one string; ``parent`` is the node of its longest shorter
    prefix that occurs more often, so all places of a node are those of its subtree."""
    every = materialize(segments(docs, span, gram), "segments")
    shared = every.groupBy("anchor").agg(F.count("*").alias("c"), (F.min("seg") != F.max("seg")).alias("differ")).where("c > 1")
    # Written before the join, so that Spark can split a hot anchor's side of it.
    shared = materialize(shared.select("anchor", "differ"), "shared")
    again = materialize(every.join(shared, "anchor"), "again")
    delete(every)
    # One place of each different segment, where an anchor has several; and how often each occurs.
    place = F.struct("doc_id", "th", "lo", "n")
    kinds = again.groupBy("anchor", "seg", "differ").agg(F.count("*").alias("copies"), F.min(place).alias("place"))
    kinds = materialize(kinds, "kinds")
    several = kinds.where("differ")
    wanted = several.select("place.doc_id", "place.th", F.struct("anchor", "seg", "place.lo", "place.n").alias("w"))
    wanted = wanted.groupBy("doc_id", "th").agg(F.collect_list("w").alias("wanted"))
    texts = null_safe(row_keyed(docs), wanted, ["doc_id", "th"], "inner")
    cut = materialize(texts.select("text", "wanted").mapInArrow(_cut(span), "anchor bigint, seg bigint, bytes binary"), "cut")
    hottest = several.groupBy("anchor").count().where(F.col("count") > hot).select("anchor", F.lit(True).alias("hot"))
    cut = cut.join(hottest, "anchor", "left")
    groups = cut.where("hot IS NULL").dropDuplicates(["anchor", "seg"]).select("anchor", "seg", "bytes")
    groups = groups.repartition("anchor").sortWithinPartitions("anchor", "seg")
    trees = groups.mapInArrow(_trees(span, 1 << 20), _REPEAT)
    strings = cut.where("hot").select("anchor", "seg", "bytes").mapInArrow(_strings(span), "anchor bigint, seg bigint, start int, h bigint").distinct()
    twice = strings.groupBy("anchor", "h").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    flat = strings.join(twice, ["anchor", "h"]).select(
        "anchor", "seg", "start", F.lit(span).alias("len"), F.col("h").alias("node"), F.lit(-1).cast("long").alias("parent"), F.lit(True).alias("maximal")
    )
    whole = kinds.where("copies > 1").select(
        "anchor", "seg", F.lit(0).alias("start"), (F.col("place.n") + F.lit(span - 1)).alias("len"),
        F.xxhash64("anchor", "seg").alias("node"), F.lit(-1).cast("long").alias("parent"), F.lit(True).alias("maximal"),
    )
    spans = materialize(trees.unionAll(flat).unionAll(whole), "spans")
    found = again.select("anchor", "seg", "doc_id", "th", "lo").join(spans, ["anchor", "seg"])
    return found.select("doc_id", "th", (F.col("lo") + F.col("start")).alias("start"), "len", "node", "parent", "maximal")


_REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT, kept: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and the ``kept`` bytes) after the
    bytes that a repeated string covers are taken away."""
    places = occurrences(docs, span, gram, hot)
    places = places.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "len")).alias("spans"))
    rows = null_safe(row_keyed(docs), places, ["doc_id", "th"], "left").select("doc_id", "text", "spans")
    schema = _REMOVED + (", kept binary" if kept else "")

    def work(batches):
        for batch in pieces(batches, 4 << 20):
            doc_id, text, spans = batch.columns
            out = []
            starts, lens = spans.flatten().field("start").to_numpy(), spans.flatten().field("len").to_numpy()
            ends = np.cumsum(spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            first = 0
            for data, last in zip(text.cast(pa.large_binary()).to_pylist(), ends.tolist(), strict=True):
                data = data or b""
                if last == first:
                    out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data))
                    continue
                cover = np.zeros(len(data) + 1, np.int32)
                np.add.at(cover, starts[first:last], 1)
                np.add.at(cover, starts[first:last] + lens[first:last], -1)
                gone = np.cumsum(cover)[:-1] > 0
                rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest(), rest))
                first = last
            size, gone, runs, digest, rest = zip(*out, strict=True)
            columns = [doc_id, pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())]
            yield table_batch(schema, [*columns, pa.array(rest, pa.binary())] if kept else columns)

    return rows.mapInArrow(work, schema)
