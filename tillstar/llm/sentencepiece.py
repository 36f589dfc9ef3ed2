"""SentencePiece encoding and decoding over a trie of distinct marked words.

A text is marked (spaces become U+2581, one is put in front) and cut into units: a run of marks
with what follows it, cut again at characters the vocabulary lacks. No piece spans two units, so
each distinct unit is encoded once. The distinct units of a block of documents are sorted, which
is depth-first order of their trie; the forward states of a unit are kept on a stack and the next
unit goes on from the deepest state they share.

The forward state follows the model's type. Unigram: the best score of each prefix and the length
of its last piece (Viterbi). BPE: the last piece of each prefix's own encoding; a piece extends
a prefix if it and the prefix's last piece stay apart when merged together, and exactly one piece
does. The best sum of scores is not what a BPE model encodes, so that state replaces the score.

Defined cases: null gives null ids and null text; the empty text gives no ids; decoding turns marks
into spaces and takes one leading space away, so a text that holds U+2581 itself comes back with a
space there. Characters outside the vocabulary become their UTF-8 byte pieces (or the unknown piece
where a model has none). Other columns pass through `encode` and `decode` untouched.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillstar.llm.common import pieces

#: A public vocabulary; a parameter of every entry point.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Entries of one generation of a task's memory. What a block needs moves to the young generation; when that
#: is full it becomes the old one, so that what is frequent is never forgotten.
REMEMBERED = 200_000
_MODEL_LIMIT = 32 << 20


def load(path: str) -> bytes:
    """The model's bytes, sent with the tasks; its size is checked."""
    with open(path, "rb") as f:
        model = f.read()
    if len(model) > _MODEL_LIMIT:
        raise ValueError("a vocabulary of this size is not sent with tasks")
    return model


@dataclass
class Vocabulary:
    ids: dict[str, int]
    scores: list[float]
    byte_ids: list[int]
    unknown: int
    unigram: bool
    longest: int
    texts: list[bytes]
    size: int
    apart: dict[int, bool] = field(default_factory=dict)
    apart_before: dict[int, bool] = field(default_factory=dict)
    whole: dict[int, bool] = field(default_factory=dict)

    @classmethod
    def of(cls, model: bytes) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models")
        normal = proto.normalizer_spec
        if len(normal.precompiled_charsmap) or normal.remove_extra_whitespaces or not normal.add_dummy_prefix:
            raise ValueError("only models without character rules that keep white space and mark the start")
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        plain = {
            p: i for i, p in enumerate(names) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        }
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in plain):
            raise ValueError("a piece spans words")
        bytes_ = {int(p[3:5], 16): i for i, p in enumerate(names) if sp.is_byte(i)}
        texts = [b""] * len(names)
        for p, i in plain.items():
            texts[i] = p.replace(MARK, " ").encode()
        for b, i in bytes_.items():
            texts[i] = bytes([b])
        return cls(
            plain, [sp.get_score(i) for i in range(len(names))], [bytes_[b] for b in range(256)] if len(bytes_) == 256 else [],
            sp.unk_id(), proto.trainer_spec.model_type == 1, max(map(len, plain)), texts, len(names),
        )

    def outside(self, ch: str) -> list[int]:
        return [self.byte_ids[b] for b in ch.encode()] if self.byte_ids else [self.unknown]

    def merged(self, text: str) -> list[str]:
        """BPE of a short text by its definition: merge the best adjacent pair, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stays_apart(self, left: int, right: int, text: str, cut: int) -> bool:
        key = left * self.size + right
        found = self.apart.get(key)
        if found is None:
            found = self.apart_before.get(key)
            if found is None:
                found = self.merged(text) == [text[:cut], text[cut:]]
            self.apart[key] = found
        return found

    def stays_whole(self, k: int, piece: str) -> bool:
        found = self.whole.get(k)
        if found is None:
            found = self.whole[k] = len(self.merged(piece)) == 1
        return found

    def encode_sorted(self, units: list[str]) -> list[list[int]]:
        """Ids of sorted units; the forward states of shared prefixes are computed once."""
        out, before = [], ""
        # of the prefix of each length: its last piece's id and length, and (unigram) its score
        last, length, score = [-1], [0], [0.0]
        forward = self._forward_unigram if self.unigram else self._forward_bpe
        for unit in units:
            same, most = 0, min(len(before), len(unit))
            while same < most and before[same] == unit[same]:
                same += 1
            del last[same + 1 :], length[same + 1 :], score[same + 1 :]
            forward(unit, same + 1, last, length, score)
            before, ids, at = unit, [], len(unit)
            while at > 0:
                ids.append(last[at])
                at -= length[at]
            out.append(ids[::-1])
        return out

    def _forward_unigram(self, unit: str, first: int, last: list, length: list, score: list) -> None:
        get, longest, scores = self.ids.get, self.longest, self.scores
        for end in range(first, len(unit) + 1):
            best, piece_id, piece_size = None, -1, 0
            for start in range(max(0, end - longest), end):
                k = get(unit[start:end])
                if k is not None and (best is None or score[start] + scores[k] > best):
                    best, piece_id, piece_size = score[start] + scores[k], k, end - start
            last.append(piece_id)
            length.append(piece_size)
            score.append(best)

    def _forward_bpe(self, unit: str, first: int, last: list, length: list, score: list) -> None:
        get, longest, size, known = self.ids.get, self.longest, self.size, self.apart.get
        for end in range(first, len(unit) + 1):
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                k = get(unit[start:end])
                if k is None:
                    continue
                if start:
                    ok = known(last[start] * size + k)
                    if ok is None:
                        ok = self.stays_apart(last[start], k, unit[start - length[start] : end], length[start])
                else:
                    ok = self.stays_whole(k, unit[:end])
                if ok:
                    last.append(k)
                    length.append(end - start)
                    break
            else:
                raise ValueError(f"no encoding of {unit!r}")
            score.append(0.0)


class Encoder:
    """Encodes blocks of texts; remembers marked words up to a bound."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary.of(model)
        self.letters = {p for p in self.vocabulary.ids if len(p) == 1}
        known = "".join(re.escape(c) for c in sorted(self.letters - {MARK}))
        # A unit: marks and the known characters that follow; or one unknown character.
        self.units = re.compile(f"{MARK}+[{known}]*|[{known}]+|[^{known}{MARK}]").findall
        self.words = re.compile(f"{MARK}+[^{MARK}]*").findall
        self.memory: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _marked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Index and count of each text's marked words, and the distinct ones."""
        mark = pa.scalar(MARK)
        joined = pc.binary_join_element_wise(mark, pc.replace_substring(texts.fill_null(""), " ", MARK), "")
        # One mark before each word, except where spaces stand together: those words are cut apart below.
        runs = pc.match_substring(joined, MARK * 2).to_numpy(zero_copy_only=False)
        if runs.any():
            lists = pa.array([self.words(t) if run else None for t, run in zip(joined.to_pylist(), runs, strict=True)], pa.list_(pa.string()))
        else:
            lists = pa.nulls(len(texts), pa.list_(pa.string()))
        plain = pc.split_pattern(pc.if_else(pa.array(runs), pa.scalar(None, pa.string()), pc.utf8_slice_codeunits(joined, 1)), MARK)
        words = plain.flatten().dictionary_encode()
        more = lists.flatten().dictionary_encode()
        names = [MARK + w for w in words.dictionary.to_pylist()]
        extra = more.dictionary.to_pylist()
        counts = plain.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        others = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        index = np.zeros(int(counts.sum() + others.sum()), np.int64)
        starts = np.cumsum(counts + others) - counts - others
        index[spread(starts[~runs], counts[~runs])] = words.indices.to_numpy()
        index[spread(starts[runs], others[runs])] = more.indices.to_numpy() + len(names)
        return index, counts + others, names + extra

    def _learn(self, words: list[str]) -> None:
        cut = {w: self.units(w) for w in words}
        known, letters, memory = self.vocabulary, self.letters, {}
        units = {u for parts in cut.values() for u in parts}
        for u in units:
            if len(u) == 1 and u not in letters:
                memory[u] = known.outside(u)
        inside = sorted(u for u in units if u not in memory)
        memory.update(zip(inside, known.encode_sorted(inside), strict=True))
        for w, parts in cut.items():
            self.memory[w] = array("i", [k for u in parts for k in memory[u]]).tobytes()

    def encode(self, texts: pa.Array) -> pa.Array:
        """A list array of ids."""
        empty = pc.equal(pc.binary_length(texts).fill_null(0), 0)
        index, counts, names = self._marked(texts)
        if len(self.memory) > REMEMBERED:
            self.memory, self.before = {}, self.memory
        if len(self.vocabulary.apart) > REMEMBERED:
            self.vocabulary.apart, self.vocabulary.apart_before = {}, self.vocabulary.apart
        missing = [w for w in names if w not in self.memory]
        self.memory.update((w, self.before[w]) for w in missing if w in self.before)
        self._learn([w for w in missing if w not in self.before])
        coded = [self.memory[w] for w in names]
        flat = np.frombuffer(b"".join(coded), np.int32)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = np.cumsum(sizes) - sizes
        # A null or empty text has one bare mark here; it has no ids.
        use = np.repeat(~empty.to_numpy(zero_copy_only=False), counts)
        lengths = np.where(use, sizes[index], 0)
        values = flat[spread(starts[index], lengths)]
        offsets = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=texts.is_null())


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of consecutive ranges."""
    ends = np.cumsum(sizes)
    out = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    return out + np.repeat(starts - (ends - sizes), sizes)


class Decoder:
    def __init__(self, model: bytes):
        texts = Vocabulary.of(model).texts
        self.flat = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: pa.ListArray) -> pa.Array:
        values = ids.flatten().to_numpy(zero_copy_only=False)
        lengths = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        sizes = self.sizes[values]
        data = self.flat[spread(self.starts[values], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(lengths)))]
        raw = data.tobytes()
        null = ids.is_null().to_pylist()
        out = []
        for i in range(len(ids)):
            part = raw[ends[i] : ends[i + 1]]
            out.append(None if null[i] else part.removeprefix(b" ").decode("utf-8", "replace"))
        return pa.array(out, pa.string())


def _with_column(docs: DataFrame, name: str, kind: T.DataType, work) -> DataFrame:
    """``docs`` with one more column (or a replaced one) that ``work`` makes of a record batch."""
    if name in docs.columns:
        docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])
    return docs.mapInArrow(work, schema)


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of its text column."""
    data = load(model)

    def work(batches):
        encoder = Encoder(data)
        for batch in pieces(batches, 8 << 20, text):
            column = encoder.encode(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, ids])

    return _with_column(docs, ids, T.ArrayType(T.IntegerType()), work)


def round_trip(docs: DataFrame, model: str = MODEL, text: str = "text", ids: str = "ids", back: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows."""
    data = load(model)

    def work(batches):
        encoder, decoder = Encoder(data), Decoder(data)
        for batch in pieces(batches, 2 << 20, text):
            column = encoder.encode(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column, decoder.decode(column)], names=[*batch.schema.names, ids, back])

    docs = docs.drop(ids, back)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(back, T.StringType())])
    return docs.mapInArrow(work, schema)


def decode(docs: DataFrame, model: str = MODEL, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of its ids column."""
    data = load(model)

    def work(batches):
        decoder = Decoder(data)
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                column = decoder.decode(batch.column(batch.schema.get_field_index(ids)))
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, text])

    return _with_column(docs, text, T.StringType(), work)
