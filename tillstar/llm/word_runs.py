"""Periodic runs of words: internal pattern matching over a suffix array and a wavelet tree.

A run is a longest stretch of consecutive words with smallest period q (words q apart are equal) that
spans at least ``repeats`` periods and ``least`` words. Runs of one document never reach into another.

Within a block of documents the words are ranked per document, and prefix doubling gives the rank of
every substring of 2^k words, for all k, and the suffix array. A run of period q holds a dyadic block:
a substring of 2^k words, 2^(k-1) <= q < 2^k, that starts at a multiple of 2^(k-1) and has q + 2^k words
of the run from its start on (four periods are enough for that). The suffix array interval of the block's
rank lists its occurrences; the wavelet tree's range successor gives the first one behind it. Both open
the progression of occurrences whose difference is the run's period: a nearer occurrence would be a
smaller period. Each candidate is extended both ways by the dyadic ranks, so runs are exact.

Words are `[^\\x20\\x09-\\x0D]+`. Defined cases: a null or empty text has no words, no runs and an empty
collapsed text; equal rows have equal results; columns named ``runs``, ``n_words`` or ``collapsed`` are
replaced, all others pass through untouched, ids are not used. A text is worked on whole, in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillstar.llm.common import pieces

LEAST = 6
REPEATS = 4
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class Substrings:
    """Ranks of all substrings of 2^k words within documents, the suffix array, and the dyadic blocks
    that occur more than once in their document, as ``start, low, high, size``: suffix array interval."""

    def __init__(self, words: np.ndarray, first: np.ndarray, last: np.ndarray):
        """Word codes of all documents in one array; of each word its document's first place and end."""
        n = len(words)
        self.first, self.last = first, last
        key = first * (int(words.max()) + 1 if n else 1) + words
        self.suffixes = np.argsort(key, kind="stable")
        rank, slots, open_ = self._groups(key[self.suffixes], np.arange(n), np.zeros(n, np.int64), self.suffixes)
        self.ranks = [rank]
        found = []
        longest = int((last - first).max()) if n else 0
        size = 1
        while len(open_) and 2 * size <= longest // 2:
            ahead = open_ + size
            inside = ahead < last[open_]
            key = rank[open_].astype(np.int64) * (n + 1) + np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
            order = np.argsort(key, kind="stable")
            self.suffixes[slots] = open_[order]
            rank, slots, open_ = self._groups(key[order], slots, rank, open_[order])
            self.ranks.append(rank)
            size *= 2
            if len(open_):
                low = rank[open_]
                high = slots[np.searchsorted(low, low, "right") - 1] + 1  # open_ is in suffix order here
                use = (open_ - first[open_]) % (size // 2) == 0
                found.append((open_[use], low[use], high[use], np.full(int(use.sum()), size)))
        self.blocks = tuple(np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)) if found else None

    @staticmethod
    def _groups(keys: np.ndarray, slots: np.ndarray, rank: np.ndarray, places: np.ndarray):
        """New ranks from sorted keys (a group's rank is its first slot), and the slots and places of groups of two or more."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        heads = np.maximum.accumulate(np.where(new, slots, 0)) if len(keys) else slots
        rank = rank.astype(np.int32)
        rank[places] = heads
        alone = new.copy()
        alone[:-1] &= new[1:]
        return rank, slots[~alone], places[~alone]

    def common(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of the longest common extension of places a < b, forward from them or backward up to them."""
        length = np.zeros(len(a), np.int64)
        todo = np.arange(len(a))
        top = len(self.ranks) - 1
        first, last = self.first[a], self.last[a]
        for k in range(top, -1, -1):
            rank, size = self.ranks[k], 1 << k
            open_ = todo
            while len(open_):
                at = a[open_] + (-length[open_] - size if back else length[open_])
                to = b[open_] + (-length[open_] - size if back else length[open_])
                fits = (at >= first[open_]) if back else (to + size <= last[open_])
                same = fits.copy()
                same[fits] = rank[at[fits]] == rank[to[fits]]
                open_ = open_[same]
                length[open_] += size
                if k < top:
                    break
        return length


class WaveletTree:
    """Values of an array by bits from the highest one; answers queries over ranges of the array."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for bit in range(max(1, int(values.max()).bit_length()) - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            before = np.concatenate(([0], np.cumsum(ones))).astype(np.int32)
            self.levels.append((bit, before, len(values) - int(before[-1])))
            values = np.concatenate((values[~ones], values[ones]))

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value >= x in each range, -1 where there is none: counts the smaller ones, then selects."""
        left, right, smaller = low, high, np.zeros(len(low), np.int64)
        beyond = x >> len(self.levels) > 0
        for bit, before, zeros in self.levels:
            one = x >> bit & 1 == 1
            l1, r1 = before[left], before[right]
            smaller += np.where(one, right - r1 - left + l1, 0)
            left, right = np.where(one, zeros + l1, left - l1), np.where(one, zeros + r1, right - r1)
        found = (smaller < high - low) & ~beyond
        left, right, rest, value = low[found], high[found], smaller[found], np.zeros(int(found.sum()), np.int64)
        for bit, before, zeros in self.levels:
            l1, r1 = before[left], before[right]
            none = right - r1 - left + l1
            one = rest >= none
            rest = rest - np.where(one, none, 0)
            value += one.astype(np.int64) << bit
            left, right = np.where(one, zeros + l1, left - l1), np.where(one, zeros + r1, right - r1)
        out = np.full(len(low), -1, np.int64)
        out[found] = value
        return out


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Runs of consecutive documents: rows ``document, start, length, period``, sorted."""
    none = np.zeros((0, 4), np.int64)
    if not len(words):
        return none
    ends = np.cumsum(sizes)
    document = np.repeat(np.arange(len(sizes)), sizes)
    text = Substrings(words, (ends - sizes)[document], ends[document])
    if text.blocks is None:
        return none
    start, low, high, size = text.blocks
    # The tree holds only the suffixes that some block's interval covers.
    change = np.bincount(low, minlength=len(words) + 1) - np.bincount(high, minlength=len(words) + 1)
    covered = np.cumsum(change[:-1]) > 0
    place = np.concatenate(([0], np.cumsum(covered)))
    tree = WaveletTree(text.suffixes[covered])
    next_ = tree.successor(place[low], place[high], start + 1)
    period = next_ - start
    use = (next_ > 0) & (2 * period >= size) & (period < size)
    start, period = start[use], period[use]
    back = text.common(start, start + period, back=True)
    ahead = text.common(start, start + period)
    length = back + period + ahead
    use = (length >= least) & (length >= repeats * period)
    first = start[use] - back[use]
    rows = np.stack([document[first], first - text.first[first], length[use], period[use]], axis=1) if len(first) else none
    return np.unique(rows, axis=0)


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without what a run holds after its first period, joined by one space."""
    if len(runs):
        kept = np.ones(len(words), bool)
        for _, start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def word_runs(docs: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period in words, by start and period) and ``collapsed``."""
    if repeats < REPEATS:
        raise ValueError(f"a dyadic block is sure to be found in runs of {REPEATS} periods or more")
    docs = docs.drop("n_words", "runs", "collapsed")
    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([*docs.schema.fields, *added])
    struct = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def work(batches):
        for batch in pieces(batches, 2 << 20, text):
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()).to_pylist()
            words = [(t or b"").split() for t in column]
            sizes = np.array([len(w) for w in words], np.int64)
            flat = pa.array([x for w in words for x in w], pa.large_binary()).dictionary_encode()
            runs = find_runs(flat.indices.to_numpy().astype(np.int64), sizes, least, repeats)
            cuts = np.searchsorted(runs[:, 0], np.arange(len(words) + 1))
            inner = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(struct))
            listed = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), inner)
            left = pa.array([collapse(w, runs[a:b]) for w, a, b in zip(words, cuts, cuts[1:], strict=False)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes), listed, left], names=[*batch.schema.names, "n_words", "runs", "collapsed"])

    return docs.mapInArrow(work, schema)
