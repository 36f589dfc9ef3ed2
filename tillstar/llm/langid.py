"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the 3- and 4-byte strings of the text (A-Z lower-cased, white space as a space, digits
alike, a space at both ends), hashed to buckets. A text's hidden vector is the mean of its subwords'
embeddings. Both layers are trained by stochastic gradient descent in numpy, in one task, on a bounded sample of
labelled rows: about ``per_language`` rows of each of the ``LANGUAGES`` most frequent labels, chosen by a
hash of id and text, equal rows once; of a text of more than ``train_bytes`` as many bytes in chunks at
random places all over it. A fifth of the rows (of a language of ``FEW`` at least; smaller ones are learned
whole and calibrated with the others) is kept from training; up to ``HELD`` times as many of them are read
whole in tasks that send a few numbers each. They set the softmax temperature and two limits, each passed by
all but ``reject_rate`` of the correct predictions among them:

* confidence: the least probability of the predicted language; a half at most, as a calibrated prediction
  above that is more likely right than wrong;
* strangeness: how much rarer the text's subwords are in the predicted language's sample than the sample's own:
  the mean log frequency below the sample's mean, in its standard deviations, less ``SHORT`` over the root of
  their number, as short texts vary. A softmax is sure of any text, also of one in a language or script it
  never saw; the frequencies tell. The limit has a margin (``MARGIN``, and ``LEAST_LIMIT`` at least), as what
  is rejected should be foreign and not merely unusual.

Prediction reads whole texts; as both layers are linear, a table of bucket logits serves for them.

Defined cases: ``und`` with score 0 for a null text, a text without a letter, or if there is no
labelled row; null labels are not learned; an empty table gives an empty result; of equal labels'
ties the first in order wins; other columns are ignored.
"""

from __future__ import annotations

import io
import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import SPACES, Texts, pieces, table_batch, text_key

BITS, DIM, EPOCHS, RATE = 16, 16, 6, 0.5
MIN_STEPS = 12_000  # a small sample is passed over more often
PER_LANGUAGE, TRAIN_BYTES, REJECT_RATE = 700, 1 << 15, 0.001
CHUNKS = 32  # of a long text
FEW, HELD = 25, 8
LANGUAGES = 1000
MARGIN, LEAST_LIMIT, SHORT = 1.5, 2.4, 6.0
UNKNOWN = "und"
_TOGETHER = 100

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[[ord(c) for c in SPACES]] = 32
_FOLD[ord("0") : ord("9") + 1] = ord("0")


def subwords(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each text's subwords, text after text, and their number for each text.

    The second half of the buckets is for 4-byte strings."""
    n = len(texts)
    padded = np.full(len(texts.data) + n + 4, 32, np.uint32)
    doc = np.repeat(np.arange(n), texts.lens)
    padded[np.arange(len(texts.data)) + doc + 1] = _FOLD[texts.data]
    three = padded[:-2] | padded[1:-1] << 8 | padded[2:] << 16
    four = three[:-1] | padded[3:] << 24
    starts = texts.starts + np.arange(n)
    shift = np.uint32(32 - BITS)
    h3 = (three * np.uint32(2654435761)) >> shift
    h4 = ((four * np.uint32(2246822519)) >> shift) + np.uint32(1 << BITS)
    # Texts of n bytes have n strings of 3 and n - 1 of 4, the outer spaces included.
    index = np.repeat(starts, texts.lens) + (np.arange(len(texts.data)) - np.repeat(texts.starts, texts.lens))
    both = np.empty((len(index), 2), np.uint32)
    both[:, 0], both[:, 1] = h3[index], h4[index]
    last = texts.starts[texts.lens > 0] + texts.lens[texts.lens > 0] - 1
    both[last, 1] = 2 << BITS  # no string of 4 starts at the last place: a bucket of zeros
    return both.reshape(-1), texts.lens * 2


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # logits of each bucket, the last one of zeros
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    known: np.ndarray | None = None  # log frequency of each bucket in each language's sample
    usual: np.ndarray | None = None  # its mean and standard deviation over the sample, per language
    limit: float = np.inf

    def logits(self, texts: Texts) -> np.ndarray:
        return self.read(texts)[0]

    def read(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Logits of each text, and its strangeness to the language of the largest one."""
        buckets, counts = subwords(texts)
        out, strange = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        some = counts > 0
        if some.any():
            starts, real = (np.cumsum(counts) - counts)[some], np.maximum(counts[some] - 1, 1)
            out[some] = np.add.reduceat(self.table[buckets], starts, axis=0, dtype=np.float64) / real[:, None]
            if self.known is not None:
                best = (out + self.bias).argmax(axis=1)
                seen = self.known[buckets, np.repeat(best, counts)]
                mean, spread = self.usual[best[some]].T
                strange[some] = (mean - np.add.reduceat(seen, starts, dtype=np.float64) / real) / spread - SHORT / np.sqrt(real)
        return out + self.bias, strange

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Model | None:
    """Stochastic gradient descent over whole sample texts and random parts of them."""
    if not texts:
        return None
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    found: list[np.ndarray] = []
    for at in range(0, len(texts), _TOGETHER):  # few texts at once: only their buckets stay
        buckets, counts = subwords(Texts(pa.array(texts[at : at + _TOGETHER], pa.binary())))
        found += [part.copy() for part in np.split(buckets, np.cumsum(counts)[:-1])]
    rng = np.random.default_rng(seed)
    size = (2 << BITS) + 1
    embed = rng.uniform(-1.0 / DIM, 1.0 / DIM, (size, DIM)).astype(np.float32)
    embed[-1] = 0
    weights = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    order = np.flatnonzero(np.array([len(f) for f in found]) > 0)
    epochs = max(EPOCHS, -(-MIN_STEPS // max(1, len(order))))
    steps, step = max(1, epochs * len(order)), 0
    for _ in range(epochs):
        for i in rng.permutation(order):
            first, last = 0, len(found[i])
            if rng.random() < 0.5:  # a short part, so that short texts are learned too
                part = 2 * int(rng.integers(8, 200))
                first = first + 2 * int(rng.integers(0, max(1, (last - first - part) // 2 + 1)))
                last = min(last, first + part)
            index, times = np.unique(found[i][first:last], return_counts=True)
            share = (times / times.sum()).astype(np.float32)
            hidden = share @ embed[index]
            z = hidden @ weights + bias
            e = np.exp(z - z.max())
            error = e / e.sum()
            error[y[i]] -= 1
            rate = RATE * (1 - step / steps)
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= rate * 0.1 * error
            embed[index] -= rate * 10 * share[:, None] * back
            step += 1
    embed[-1] = 0
    known, usual = frequencies(found, y, len(languages), size)
    return Model(languages, (embed @ weights).astype(np.float32), bias.astype(np.float64), known=known, usual=usual)


def frequencies(found: list[np.ndarray], y: np.ndarray, languages: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Log frequency of each bucket in each language's sample, smoothed, and its mean and deviation there."""
    known, usual = np.zeros((size, languages), np.float32), np.zeros((languages, 2))
    for k in range(languages):
        counts = np.zeros(size)
        for i in np.flatnonzero(y == k):
            counts += np.bincount(found[i], minlength=size)
        counts[-1] = 0
        total = counts.sum()
        known[:, k] = np.log((counts + 0.5) / (total + 0.5 * size))
        mean = float(counts @ known[:, k] / max(total, 1))
        usual[k] = mean, max(0.5, float(np.sqrt(counts @ (known[:, k] - mean) ** 2 / max(total, 1))))
    known[-1] = 0  # the place-holder at a text's end counts for nothing
    return known, usual


def calibrate(model: Model, logits: np.ndarray, strange: np.ndarray, truth: np.ndarray, reject_rate: float = REJECT_RATE) -> None:
    """Set temperature and both limits from rows that were not trained on."""
    rows = np.arange(len(truth))

    def loss(t: float) -> float:
        model.temperature = t
        return -float(np.log(np.maximum(model.probabilities(logits)[rows, truth], 1e-300)).mean())

    model.temperature = min(np.geomspace(0.01, 10, 91), key=loss)
    p = model.probabilities(logits)
    right = p.argmax(axis=1) == truth
    if right.any():
        model.threshold = min(0.5, float(np.quantile(p.max(axis=1)[right], reject_rate)))
        model.limit = max(LEAST_LIMIT, MARGIN * float(np.quantile(strange[right], 1 - reject_rate)))


def held_out(doc_id: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, train_bytes: int = TRAIN_BYTES, reject_rate: float = REJECT_RATE) -> Model | None:
    """Train on ``doc_id, text, lang`` rows; which rows are seen depends on the ids' hashes alone."""
    rows = labelled.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    labels = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    counts = {r["lang"]: r["count"] for r in labels.collect()}
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    fifth = F.pmod(F.xxhash64("doc_id", "text", F.lit("held")), F.lit(5)) == 0
    trained, held = F.lit(False), F.lit(False)
    for lang, n in sorted(counts.items()):
        mine = F.col("lang") == lang
        trained = trained | (mine & (place < per_language / n) & (~fifth if n >= FEW else F.lit(True)))
        held = held | (mine & (place < HELD * per_language / n) & fifth & F.lit(n >= FEW))
    # Rows without an id, or with a shared one, are told apart by their texts; equal ones count once.
    sample = rows.where(trained).select(_spread(train_bytes).alias("text"), "lang", place.alias("place")).distinct()
    fitted = _in_one_task(sample, ["place", "lang", "text"], lambda table: _arrays(train(table["text"].tolist(), table["lang"].tolist())))
    if fitted is None:
        return None
    model = Model(json.loads(fitted["languages"].tobytes()), fitted["table"], fitted["bias"], known=fitted["known"], usual=fitted["usual"])
    languages = model.languages

    def limits(table: pd.DataFrame) -> dict[str, np.ndarray]:
        found, table = Model(languages, np.zeros(0), np.zeros(0)), table[table["lang"].isin(languages)]
        if len(table):
            truth = np.array([languages.index(x) for x in table["lang"]])
            calibrate(found, np.stack(table["logits"].to_list()), table["strange"].to_numpy(), truth, reject_rate)
        return {"limits": np.array([found.temperature, found.threshold, found.limit])}

    known = _logits(rows.where(held).select("text", "lang", place.alias("place")), model).distinct()
    found = _in_one_task(known, ["place", "lang", "strange"], limits)
    if found is not None:
        model.temperature, model.threshold, model.limit = found["limits"].tolist()
    return model


def _arrays(model: Model) -> dict[str, np.ndarray]:
    names = np.frombuffer(json.dumps(model.languages).encode(), np.uint8)
    return {"languages": names, "table": model.table, "bias": model.bias, "known": model.known, "usual": model.usual}


def _in_one_task(sample: DataFrame, order: list[str], learn) -> dict[str, np.ndarray] | None:
    """The arrays that ``learn`` makes of a bounded sample, in that order; None without a row. The sample and what is
    made of it stay with the task: a driver keeps memory that it has once touched."""

    def work(batches):
        tables = [b.to_pandas() for b in batches if len(b)]
        if tables:
            out = io.BytesIO()
            np.savez(out, **learn(pd.concat(tables).sort_values(order)))
            yield table_batch("arrays binary", [pa.array([out.getvalue()], pa.binary())])

    row = sample.coalesce(1).mapInArrow(work, "arrays binary").first()
    if row is None:
        return None
    with np.load(io.BytesIO(row["arrays"])) as f:
        return {name: f[name] for name in f.files}


def _spread(size: int) -> Column:
    """The bytes of ``text``, or of a text of more than ``size`` chunks at random places of ``CHUNKS`` equal parts."""
    data, n, part = F.col("text").cast("binary"), F.octet_length("text").cast("long"), size // CHUNKS
    chunks = []
    for k in range(CHUNKS):
        first = F.floor(n * k / CHUNKS)
        room = F.greatest(F.floor(n / CHUNKS) - part, F.lit(0)) + 1
        at = (first + F.pmod(F.xxhash64("doc_id", F.lit(k)), room) + 1).cast("int")
        chunks += [F.substr(data, at, F.lit(part)), F.lit(b" ")]
    return F.when(n <= size, data).otherwise(F.concat(*chunks))


def _logits(rows: DataFrame, model: Model) -> DataFrame:
    """``place, lang, strange, logits`` of whole texts."""
    schema = "place double, lang string, strange double, logits array<double>"
    limit = (4 << 20) // max(4, len(model.languages))

    def work(batches):
        for batch in pieces(batches, limit):
            text, lang, place = batch.columns
            z, strange = model.read(Texts(text))
            flat = pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], z.reshape(-1))
            yield table_batch(schema, [place, lang, strange, flat])

    return rows.mapInArrow(work, schema)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, th, lang_pred, score, accepted`` of every whole text."""
    schema = "doc_id bigint, th binary, lang_pred string, score double, accepted boolean"
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text"), text_key("text").alias("th"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter")
    )
    languages = model.languages if model else []
    limit = (4 << 20) // max(4, len(languages))

    def work(batches):
        for batch in pieces(batches, limit):
            doc_id, text, th, letter = batch.columns
            known = letter.to_numpy(zero_copy_only=False)
            score, best, strange = np.zeros(len(batch)), np.zeros(len(batch), np.int64), np.zeros(len(batch))
            if model:
                z, strange = model.read(Texts(text))
                p = model.probabilities(z)
                score, best = p.max(axis=1), p.argmax(axis=1)
            known = known & bool(model)
            names = pa.array([languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)], pa.string())
            score = np.where(known, score, 0.0)
            accepted = known & (score >= (model.threshold if model else 0)) & (strange <= (model.limit if model else 0))
            yield table_batch(schema, [doc_id, th, names, score, accepted])

    return rows.mapInArrow(work, schema)
