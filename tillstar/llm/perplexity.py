"""Quality rules with an n-gram language model.

Texts become sequences of 64 symbols from which they can be read again: a small letter, a digit, a space, a line break, a frequent sign
or lead byte is one symbol, a capital its letter behind a mark, a continuation byte its six bits, any other byte two symbols. No byte
is left out and no two texts of valid UTF-8 become the same. A modified Kneser-Ney model of order five is counted for each
language over all its texts: tasks pre-aggregate, Spark adds up. A 5-gram's code is its 30 bits. One task builds a language's model,
which is broadcast: arrays of the sorted codes that its texts have, with log probabilities and back-off weights.
A document's perplexity under its language's model must lie within the band of its language and
length class: the median of the log perplexity plus and minus ``width`` robust deviations (from the median
absolute deviation), taken from exact counts. N-grams and bands are counted over distinct texts of a language, so
copies have no more weight than one. A class of fewer than ``FEW`` texts, or without a deviation, takes the centre and
the deviation of its whole language.

Defined cases: a null or empty text has no words and fails the base rules; a null language is a
language of its own; rows are documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import SPACES, Texts, pieces, table_batch, text_key
from tillstar.session import materialize

ORDER, SYMBOL_BITS, WIDTH = 5, 6, 6.0
_CODE_BITS = ORDER * SYMBOL_BITS
MIN_WORDS, REPEAT_WORDS, REPEAT_PERCENT = 20, 8, 30
FEW = 30  # distinct texts that a band of its own rests on at least
_STEP = 0.01  # of the log perplexity (base 2), in the counts that set the bands


_SINGLE = b"abcdefghijklmnopqrstuvwxyz0123456789 \n.,;:!?'\"()-/"  # one symbol each, as are the lead bytes
_LEADS = b"\xc2\xc3\xc4\xc5\xd0\xd1\xd8\xd9\xe2\xe3"  # of Latin, Cyrillic, Arabic, signs and kana
_CAPITAL = len(_SINGLE) + len(_LEADS)  # the mark before a capital; three more before the low six bits of any other byte
_SPACE = _SINGLE.index(b" ")


def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """The first symbol of each byte, and the second one or ``_NONE``."""
    byte = np.arange(256)
    other = np.array([1, 2, 0, 3])[byte >> 6]  # by the two high bits; continuation bytes need no mark
    first, second = (_CAPITAL + other).astype(np.uint8), (byte & 63).astype(np.uint8)
    first[128:192], second[128:192] = byte[128:192] & 63, _NONE
    for k, c in enumerate(_SINGLE + _LEADS):
        first[c], second[c] = k, _NONE
    for k in range(26):
        first[ord("A") + k], second[ord("A") + k] = _CAPITAL, k
    return first, second


_NONE = 255
_FIRST, _SECOND = _symbols()
_WIDTHS = 1 + (_SECOND != _NONE)
_SPACE_BYTE = np.zeros(256, bool)
_SPACE_BYTE[[ord(c) for c in SPACES]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in "#*$%&|<>"]] = True


def ngrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The code of the ORDER symbols that end at each symbol (spaces stand before a text), and the
    number of symbols of each text."""
    widths = _WIDTHS[texts.data]
    ends = np.concatenate(([0], np.cumsum(widths)))
    at = ends[:-1]
    symbol = np.empty(int(ends[-1]), np.int64)
    symbol[at] = _FIRST[texts.data]
    two = widths > 1
    symbol[at[two] + 1] = _SECOND[texts.data[two]]
    counts = ends[texts.starts + texts.lens] - ends[texts.starts]
    place = np.arange(len(symbol)) - np.repeat(np.cumsum(counts) - counts, counts)
    code = symbol.copy()
    for j in range(1, ORDER):
        before = np.full(len(symbol), _SPACE, np.int64)
        before[j:] = symbol[:-j]
        code |= np.where(place >= j, before, _SPACE) << (SYMBOL_BITS * j)
    return code, counts


def count_ngrams(docs: DataFrame) -> DataFrame:
    """``lang, code, c`` over all rows; each task sends what it has added up."""
    schema = "lang string, code bigint, c bigint"

    def work(batches):
        total: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}
        for batch in pieces(batches, 4 << 20):
            lang, text = batch.columns
            code, counts = ngrams(Texts(text))
            coded = lang.dictionary_encode()
            names = [*coded.dictionary.to_pylist(), None]
            which = coded.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
            joint = np.repeat(which.astype(np.int64), counts) << _CODE_BITS | code
            joint.sort()
            first = np.flatnonzero(np.concatenate(([True], joint[1:] != joint[:-1]))) if len(joint) else np.zeros(0, np.int64)
            number = np.diff(np.append(first, len(joint)))
            found = joint[first]
            for k in np.unique(found >> _CODE_BITS):
                mine = found >> _CODE_BITS == k
                codes, c = found[mine] & ((1 << _CODE_BITS) - 1), number[mine]
                if names[k] in total:
                    old, n = total[names[k]]
                    codes, where = np.unique(np.concatenate((old, codes)), return_inverse=True)
                    c = np.bincount(where, np.concatenate((n, c))).astype(np.int64)
                total[names[k]] = codes, c
        for name, (codes, c) in total.items():
            yield table_batch(schema, [pa.array([name] * len(codes), pa.string()), codes, c])

    parts = docs.select("lang", "text").mapInArrow(work, schema)
    return parts.groupBy("lang", "code").agg(F.sum("c").alias("c"))


# ---------------------------------------------------------------- the model


class Model:
    """Sorted n-gram codes with log2 probabilities, and sorted contexts with log2 back-off weights, for each order."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], unseen: float):
        self.orders, self.unseen = orders, unseen

    @classmethod
    def build(cls, codes: np.ndarray, counts: np.ndarray) -> Model:
        """Modified Kneser-Ney, interpolated, from the counts of one language's highest order."""
        levels = [(codes, counts.astype(np.float64))]
        for n in range(ORDER - 1, 0, -1):  # lower orders count the different symbols to the left
            low, number = np.unique(levels[0][0] & ((1 << SYMBOL_BITS * n) - 1), return_counts=True)
            levels.insert(0, (low, number.astype(np.float64)))
        size = 1 << SYMBOL_BITS
        below, orders, unseen = None, [], 0.0
        for n, (code, c) in enumerate(levels, 1):
            n1, n2, n3, n4 = (float((c == k).sum()) for k in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2) if n1 else 0.0
            cut = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0]
            cut = np.array([0.0, *(min(max(d, 0.05), k + 0.95) for k, d in enumerate(cut))])
            discount = cut[np.minimum(c, 3).astype(int)]
            context, where = np.unique(code >> SYMBOL_BITS, return_inverse=True)
            total = np.bincount(where, c)
            weight = np.bincount(where, discount) / total
            lower = np.full(len(code), 1.0 / size) if below is None else below[np.searchsorted(levels[n - 2][0], code & ((1 << SYMBOL_BITS * (n - 1)) - 1))]
            p = (c - discount) / total[where] + weight[where] * lower
            if n == 1:
                unseen = float(np.log2(max(weight[0], 1e-9) / size))
            orders.append((code, np.log2(p).astype(np.float32), context, np.log2(np.maximum(weight, 1e-9)).astype(np.float32)))
            below = p
        return cls(orders, unseen)

    def log2(self, code: np.ndarray) -> np.ndarray:
        """Log probability of each code's last symbol after the others. Equal codes are looked up once, in their order."""
        placed = np.sort(code << 32 | np.arange(len(code)))
        found = placed >> 32
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(code) else np.zeros(0, np.int64)
        out = np.empty(len(code), np.float32)
        out[placed & 0xFFFFFFFF] = np.repeat(self._log2(found[first]), np.diff(np.append(first, len(code))))
        return out

    def _log2(self, code: np.ndarray) -> np.ndarray:
        out = np.zeros(len(code), np.float32)
        open_ = np.arange(len(code))
        for n in range(ORDER, 0, -1):
            hashes, logs, contexts, weights = self.orders[n - 1]
            want = code[open_] & ((1 << SYMBOL_BITS * n) - 1)
            at = np.minimum(np.searchsorted(hashes, want), len(hashes) - 1)
            hit = hashes[at] == want
            out[open_[hit]] += logs[at[hit]]
            open_, want = open_[~hit], want[~hit]
            if not len(open_):
                return out
            if n > 1:
                at = np.minimum(np.searchsorted(contexts, want >> SYMBOL_BITS), len(contexts) - 1)
                known = contexts[at] == want >> SYMBOL_BITS
                out[open_[known]] += weights[at[known]]
        out[open_] += self.unseen
        return out

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, unseen=self.unseen, **{f"{n}{k}": a for n, order in enumerate(self.orders) for k, a in zip("abcd", order, strict=True)})
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as f:
            return cls([tuple(f[f"{n}{k}"] for k in "abcd") for n in range(ORDER)], float(f["unseen"]))


def fit(docs: DataFrame) -> dict[str | None, object]:
    """A broadcast model for each language of ``lang, text`` rows; equal rows count once."""
    spark = docs.sparkSession
    counts = materialize(count_ngrams(docs.select("lang", "text").distinct()), "ngrams")

    def build(key, table):
        codes, c = table["code"].to_numpy().astype(np.int64), table["c"].to_numpy()
        order = np.argsort(codes)
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "model": pa.array([Model.build(codes[order], c[order]).dumps()], pa.binary())})

    models = counts.groupBy("lang").applyInArrow(build, "lang string, model binary")
    return {row["lang"]: spark.sparkContext.broadcast(bytes(row["model"])) for row in models.toLocalIterator()}


# ---------------------------------------------------------------- rules

_RULES = (
    "doc_id bigint, th binary, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_letters bigint, log_perplexity double"
)


def repeated_words(ids: np.ndarray, doc: np.ndarray, size: int, n_docs: int) -> np.ndarray:
    """Words of each document that lie in a window of ``size`` words found twice in it."""
    rank, width = ids, 1
    while width < size:  # equal ranks: equal strings of `width` words
        step = min(width, size - width)
        other = np.zeros(len(rank), np.int64)
        other[: len(rank) - step if step < len(rank) else 0] = rank[step:]
        _, rank = np.unique(rank * (int(rank.max(initial=0)) + int(other.max(initial=0)) + 1) + other, return_inverse=True)
        width += step
    inside = np.zeros(len(ids), bool)
    if len(ids) >= size:
        inside[: len(ids) - size + 1] = doc[: len(ids) - size + 1] == doc[size - 1 :]
    at = np.flatnonzero(inside)
    key = doc[at] * (int(rank.max(initial=0)) + 1) + rank[at]
    _, where, number = np.unique(key, return_inverse=True, return_counts=True)
    found = at[number[where] > 1]
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + size, -1)
    return np.bincount(doc[np.cumsum(cover)[:-1] > 0], minlength=n_docs)


def _sums(flags: np.ndarray, texts: Texts) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[texts.starts + texts.lens] - total[texts.starts]


def measure(docs: DataFrame, models: dict) -> DataFrame:
    """The counts of the base rules and the log perplexity (base 2, null without symbols) of each row."""

    def work(batches):
        loaded: dict[str | None, Model] = {}
        for batch in pieces(batches, 4 << 20):
            doc_id, text, th, lang = batch.columns
            texts, n = Texts(text), len(batch)
            raw = texts.data.tobytes()
            parts = [raw[a : a + size] for a, size in zip(texts.starts.tolist(), texts.lens.tolist(), strict=True)]
            words = [p.split() for p in parts]
            n_words = np.fromiter(map(len, words), np.int64, n)
            index: dict[bytes, int] = {}
            put = index.setdefault
            ids = np.fromiter((put(w, len(index)) for ws in words for w in ws), np.int64, int(n_words.sum()))
            repeated = repeated_words(ids, np.repeat(np.arange(n), n_words), REPEAT_WORDS, n)
            dup_lines = np.zeros(n, np.int64)
            for i, p in enumerate(parts):
                lines = [line for line in p.split(b"\n") if line.strip()]
                dup_lines[i] = len(lines) - len(set(lines))
            chars = _sums((texts.data & 0xC0 != 0x80) & ~_SPACE_BYTE[texts.data], texts)
            code, counts = ngrams(texts)
            logs = np.zeros(len(code), np.float32)
            names = lang.to_pylist()
            owner = np.repeat(np.arange(n), counts)
            for name in set(names):
                mine = np.array([x == name for x in names])[owner]
                if name in models and mine.any():
                    if name not in loaded:
                        loaded[name] = Model.loads(models[name].value)
                    logs[mine] = loaded[name].log2(code[mine].astype(np.int64))
            total = np.bincount(owner, logs, minlength=n)
            score = pa.array(-total / np.maximum(counts, 1), pa.float64(), mask=counts == 0)
            yield table_batch(_RULES, [doc_id, th, lang, n_words, chars, _sums(_SIGN[texts.data], texts), dup_lines, repeated, counts, score])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"), text_key("text").alias("th"), F.col("lang").cast("string"))
    return rows.mapInArrow(work, _RULES)


def _length_class():
    """Powers of two of the number of symbols; short texts vary more."""
    return F.floor(F.log2(F.least(F.greatest(F.col("n_letters"), F.lit(128)), F.lit(1 << 14)))).cast("int")


def bands(measured: DataFrame, width: float = WIDTH) -> list[tuple[str | None, int, float, float]]:
    """(language, length class, lowest, highest log perplexity): medians of rounded values over all distinct texts."""
    rows = measured.where("log_perplexity IS NOT NULL AND NOT base_failed")
    # Equal texts have equal values throughout; different ones hardly ever share all of them.
    rows = rows.select("lang", "th", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_letters", "log_perplexity").distinct()
    binned = rows.select("lang", _length_class().alias("class"), F.round(F.col("log_perplexity") / _STEP).cast("int").alias("bin"))
    table = binned.groupBy("lang", "class", "bin").count().toPandas().sort_values("bin")
    out = []
    for name, language in table.groupby("lang", dropna=False):
        pooled = _centre(language.groupby("bin", as_index=False)["count"].sum())
        for size, mine in language.groupby("class"):
            middle, away = _centre(mine)
            if mine["count"].sum() < FEW or not away:
                middle, away = pooled
            spread = max(away, 1) * 1.4826 * width
            out.append((None if pd.isna(name) else name, int(size), (middle - spread) * _STEP, (middle + spread) * _STEP))
    return out


def _centre(table: pd.DataFrame) -> tuple[float, float]:
    """Median and median absolute deviation of sorted bins."""
    values, counts = table["bin"].to_numpy(), table["count"].to_numpy()
    middle = _median(values, counts)
    away = np.abs(values - middle)
    order = np.argsort(away, kind="stable")
    return middle, _median(away[order], counts[order])


def _median(values: np.ndarray, counts: np.ndarray) -> float:
    return float(values[np.searchsorted(np.cumsum(counts), counts.sum() / 2)])


def judge(docs: DataFrame, width: float = WIDTH) -> DataFrame:
    """``doc_id, th, lang``, the counts, ``base_failed, perplexity, kept``, a row for each input row."""
    measured = measure(docs, fit(docs))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    measured = materialize(measured.withColumn("base_failed", failed), "measured")
    inside = F.lit(False)
    for name, size, low, high in bands(measured, width):
        inside = inside | (F.col("lang").eqNullSafe(F.lit(name)) & (_length_class() == size) & F.col("log_perplexity").between(low, high))
    return measured.withColumn("perplexity", F.pow(F.lit(2.0), "log_perplexity")).withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
