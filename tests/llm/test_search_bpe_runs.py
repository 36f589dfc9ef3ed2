"""Ranked search, byte-level BPE and periodic runs against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tillstar.llm import bpe, lexical
from tillstar.llm.queries import QUERIES
from tillstar.llm.word_runs import Substrings, WaveletTree, find_runs, word_runs

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, shard string, term string, ids string, runs string, w string"


@pytest.fixture(scope="module")
def docs():
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "a", "b", "c", "d", "e") for d, t in rows], SCHEMA).repartition(3)


# ---------------------------------------------------------------- ranked search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(rows, items, k):
    counts = [(d, collections.Counter(terms(t))) for d, t in rows]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, c in counts for t in c)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i].update(terms(t))
    out = []
    for i, words in wanted.items():
        scores = []
        for (d, c), size in zip(counts, sizes, strict=True):
            m = 50 + (50 * size * n) // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in words if c[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, r + 1, x[2], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["été", "Straße", "日本", "A1"]
    text = lambda: " ".join(rnd.choice(words[: rnd.choice([3, 20, 64])]) for _ in range(rnd.randrange(1, 40)))
    rows = [(i, text()) for i in range(n)]
    rows += [(None, rows[3][1]), (None, rows[5][1]), (7, rows[7][1]), (n, None), (n + 1, ""), (n + 2, " .,\x00;\n"), (n + 3, "w1 " * 5000)]
    rows += [(n + 10 + i, rows[4][1]) for i in range(70)]  # ties beyond k
    items = [(i, text()) for i in range(8)] + [(8, None), (9, ""), (10, "unknown words only"), (None, "w1 w2"), (None, "w3"), (3, "été Straße,A1"), (11, rows[4][1])]
    return rows, items


@pytest.mark.parametrize("shard_bytes", [1, 600, 8 << 20])
def test_search(spark, monkeypatch, shard_bytes):
    rows, items = corpus(1, 120)
    monkeypatch.setattr(lexical, "TOGETHER", 3 if shard_bytes == 600 else 64)
    index = lexical.build(frame(spark, rows), shard_bytes=shard_bytes)
    found = lexical.search(index, spark.createDataFrame([(*x, "z") for x in items], "item_id bigint, text string, term string"), k=20)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked(rows, items, 20)


def test_search_by_blocks_of_items(spark, monkeypatch):
    rows, items = corpus(2, 40)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 2000)
    folder = lexical.scratch_path(spark, "kept_index")
    lexical.build(frame(spark, rows), folder)
    index = lexical.Index.open(spark, folder)
    found = lexical.search(index, spark.createDataFrame(items, "item_id bigint, text string"), k=5)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked(rows, items, 5)


def test_search_of_nothing(spark):
    rows, items = corpus(3, 10)
    docs, wanted = frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    assert lexical.search(lexical.build(docs.where("false")), wanted).count() == 0
    assert lexical.search(lexical.build(docs.where("text is null")), wanted).count() == 0
    assert lexical.search(lexical.build(docs), wanted.where("false")).count() == 0


def test_range_maxima():
    rnd = np.random.default_rng(0)
    ends = np.array([0, 5, 5, 60, 61])
    places = np.concatenate([np.sort(rnd.choice(100, n, replace=False)) for n in np.diff(ends)])
    lists = lexical.Lists(places, rnd.integers(1, 9, 61), ends, 100)
    for a, b in zip(ends, ends[1:], strict=False):
        for low in range(a, b + 1):
            for high in range(low, b + 1):
                want = low + int(lists.impacts[low:high].argmax()) if high > low else -1
                assert lists.top(np.array([low]), np.array([high]))[0] == want


# ---------------------------------------------------------------- byte-level BPE


def test_bpe(spark, docs):
    library = Tokenizer.from_file(bpe.MODEL)
    rnd = random.Random(4)
    letters = "ab c'sdtrevlm  \n\t.,!?0123éñß日本語　\x00\x85 😀ªⅷ²ا​" + chr(0x558) + chr(0x11DE0)
    rows = [*docs, (-1, None), (-2, ""), (-3, "<|endoftext|>"), (-4, "a<|endoftext|> <|endoftext|>b"), (-5, "x" * 30_000), (None, "it's I'D")]
    rows += [(-6, "日本" * 5000 + " " * 4000), (-6, "same id"), (-6, "same id")]
    rows += [(-10 - i, "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 80)))) for i in range(2000)]
    coded = bpe.decode(bpe.encode(frame(spark, rows)))
    assert coded.columns == [*(c for c in SCHEMA.replace(" bigint", "").replace(" string", "").split(", ") if c != "ids"), "ids", "decoded"]
    want = sorted(((d, None if t is None else library.encode(t, add_special_tokens=False).ids, t) for d, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in coded.collect()), key=repr) == want
    broken = [[243, 165], [], [161, 50256, 226]]
    cut = bpe.decode(spark.createDataFrame([(x,) for x in broken], "ids array<int>"))
    assert sorted(r["decoded"] for r in cut.collect()) == sorted(library.decode(x, skip_special_tokens=False) for x in broken)


def test_segment_trees_agree():
    """Side by side, one by one and by definition: the lowest rank first, the leftmost of equal ones."""
    rnd = random.Random(5)
    pairs = [(a, b) for a in range(4) for b in range(4)]
    rnd.shuffle(pairs)
    ids, order = {}, []
    for a, b in pairs[:9]:
        ids[(a, b)] = 4 + len(ids)
        order.append((a, b))
    for a, b in [(4, 0), (5, 4), (4, 4), (6, 1)]:
        ids[(a, b)] = 4 + len(ids)
        order.append((a, b))
    merges = bpe.Merges(order, [ids[p] for p in order], 32)
    words = [[rnd.randrange(4) for _ in range(rnd.choice([1, 2, 3, 5, 9, 40]))] for _ in range(400)]

    def plain(word):
        word = list(word)
        while True:
            ranked_pairs = [(order.index(p), i) for i, p in enumerate(zip(word, word[1:], strict=False)) if p in ids]
            if not ranked_pairs:
                return word
            r, i = min(ranked_pairs)
            word[i : i + 2] = [ids[order[r]]]

    want = [plain(w) for w in words]
    for some in (words, words[:20]):
        symbols, counts = merges.words(np.array([x for w in some for x in w]), np.array([len(w) for w in some]))
        cuts = np.concatenate(([0], np.cumsum(counts)))
        assert [symbols[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)] == want[: len(some)]


def test_bpe_refuses_other_models(tmp_path):
    with pytest.raises(ValueError):
        bpe.Vocabulary(bpe.load("/opt/tokenizers/word_bpe_49k.json"))


def test_bpe_query(spark, docs):
    library = Tokenizer.from_file(bpe.MODEL)
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_byte_bpe"](spark, SF_DIR).collect()}
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got[d] == (d, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))


# ---------------------------------------------------------------- periodic runs


def plain_runs(w, least=6, repeats=4):
    out = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size, s = j - i + q, w[i : j + q]
            if j > i and size >= max(least, repeats * q) and not any(s[p:] == s[:-p] for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def test_runs():
    rnd = random.Random(6)
    for _ in range(400):
        documents = []
        for _ in range(rnd.randrange(1, 6)):
            n, letters = rnd.choice([0, 1, 3, 7, 10, 30, 80, 200]), rnd.choice([1, 2, 3, 5])
            w = [rnd.randrange(letters) for _ in range(n)]
            if n > 5:
                s = rnd.randrange(n)
                p = rnd.randint(1, max(1, (n - s) // 4))
                w = [w[i] if i < s else w[s + (i - s) % p] for i in range(n)]
                if rnd.random() < 0.4:
                    w[rnd.randrange(n)] = 99
            documents.append(w)
        got = find_runs(np.array([x for d in documents for x in d], np.int64), np.array([len(d) for d in documents], np.int64))
        assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, d in enumerate(documents) for r in plain_runs(d)]


def test_wavelet_successor_and_ranks():
    rnd = np.random.default_rng(1)
    values = rnd.permutation(70)
    tree = WaveletTree(values)
    low, high, x = rnd.integers(0, 71, 500), rnd.integers(0, 71, 500), rnd.integers(0, 200, 500)
    low, high = np.minimum(low, high), np.maximum(low, high)
    want = [min([v for v in values[a:b].tolist() if v >= c], default=-1) for a, b, c in zip(low, high, x.tolist(), strict=True)]
    assert tree.successor(low, high, x).tolist() == want
    words = np.array([1, 2, 1, 2, 1, 2, 1, 3, 1, 2, 1, 2])
    text = Substrings(words, np.zeros(12, np.int64), np.full(12, 12))
    a, b = np.array([0, 2, 8]), np.array([2, 4, 10])
    assert text.common(a, b).tolist() == [5, 3, 2] and text.common(a, b, back=True).tolist() == [0, 2, 0]


def test_runs_of_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b " * 9), (None, "x " * 50_000 + "y"), (4, "a b " * 9), (5, "plain words only"), (6, "u v\x0bw\x1cz  u v w\x1cz  " * 3)]
    got = word_runs(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "shard", "term", "ids", "w", "n_words", "runs", "collapsed"]
    for r in got.collect():
        words = re.findall("[^\x20\x09-\x0d]+", r["text"] or "")
        assert r["n_words"] == len(words)
        want = [(0, 50_000, 1)] if len(words) > 50_000 else plain_runs(words)
        assert [tuple(x) for x in r["runs"]] == want
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert word_runs(frame(spark, rows).where("false")).count() == 0
    with pytest.raises(ValueError):
        word_runs(frame(spark, rows), repeats=2)


def test_runs_query(spark, docs):
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_word_runs"](spark, SF_DIR).collect()}
    assert any(r[1] for r in got.values())
    for d, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        h = zlib.crc32(str(d).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w) if len(w) < 3000 or h % 10 == 0 else None
        if runs is None:
            continue
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want = (d, len(runs), *top, 1000 * top[1] // top[2] if runs else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)))
        assert got[d] == (*want, digest(" ".join(x for i, x in enumerate(w) if i not in gone)))
