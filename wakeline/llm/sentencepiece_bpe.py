"""SentencePiece byte-pair encoding and decoding by a table of each prefix's last token.

Every prefix of a word has exactly one token that can end its encoding: of all pieces that end there (found by an
Aho-Corasick automaton), the one that may follow the last token of the prefix before it. Two tokens may stand side by
side if no merge across their border comes before the merges that build them; this is seen from the merge that makes
each token and the pieces that pairs merge into, and kept for the next time. The ids are read backwards from the
table. The work is linear in the text, however long a word is.

A piece holds spaces at its beginning only, so words part at spaces; runs of spaces merge after everything else.
Characters without a piece become byte pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

#: Words that a worker remembers from the last two spells, each ended by so many new words; and pairs of tokens.
REMEMBERED = 500_000
META = "▁"
#: Parts of a text: each with the space before it, further spaces apart.
_AT_SPACES = re.compile(r" ?[^ ]+| ")
_SIGNS = r"\x00-\x1F!-/:-@\[-`{-\x7F\u00A1-\u00BF\u2010-\u203E"
_AT_SIGNS = re.compile(rf" ?[^ {_SIGNS}]+| ?[{_SIGNS}]+| ")
_SIGN = re.compile(f"[{_SIGNS}]")
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class Vocabulary:
    """What the model file says, with tokens numbered by merge order: characters first, then better merges first."""

    ids: list[int]
    texts: list[str]
    parts: list[tuple[int, int]]  # the pair whose merge makes the token; of a character, itself twice
    merged: dict[tuple[int, int], int]
    byte_ids: list[int]
    pieces: list[bytes]  # by id, what decoding puts
    scores: dict[str, float]
    begin: int
    end: int


def _merge(symbols: list[str], scores: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Merge neighbours, best score and then leftmost first, until nothing merges; also the last pair merged."""
    texts: list[str | None] = list(symbols)
    after = list(range(1, len(texts) + 1))
    before = list(range(-1, len(texts) - 1))
    heap: list[tuple[float, int, int, str]] = []

    def offer(left: int, right: int) -> None:
        text = texts[left] + texts[right]
        if text in scores:
            heapq.heappush(heap, (-scores[text], left, right, text))

    for i in range(len(texts) - 1):
        offer(i, i + 1)
    made = None
    while heap:
        _, left, right, text = heapq.heappop(heap)
        if texts[left] is None or texts[right] is None or texts[left] + texts[right] != text or after[left] != right:
            continue
        made = (texts[left], texts[right])
        texts[left], texts[right] = text, None
        after[left] = after[right]
        if after[left] < len(texts):
            before[after[left]] = left
            offer(left, after[left])
        if before[left] >= 0:
            offer(before[left], left)
    return [x for x in texts if x is not None], made


def read_vocabulary(model: bytes) -> Vocabulary:
    """Read a model file's bytes; models that normalise or part text otherwise than this module raise ValueError."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    norm, train = proto.normalizer_spec, proto.trainer_spec
    plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
    if train.model_type != 2 or not train.byte_fallback or not plain or train.treat_whitespace_as_suffix:
        raise ValueError("only byte-pair models with byte fallback and without normalisation are supported")
    if any(p.type in (_USER, _UNUSED) or META in p.piece.lstrip(META) for p in proto.pieces):
        raise ValueError("user-defined or unused pieces, and pieces across spaces, are not supported")
    numbers = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
    scores = {text: proto.pieces[i].score for text, i in numbers.items()}
    #: Runs of spaces are merged apart, by spaces().
    texts = sorted(
        (t for t in numbers if len(t) == 1 or t.strip(META)), key=lambda t: (len(t) > 1, -scores[t] if len(t) > 1 else 0)
    )
    made = {t: _merge(list(t), scores) for t in texts}
    texts = [t for t in texts if len(made[t][0]) == 1]  # pieces that no merge leads to never come up
    rank = {t: k for k, t in enumerate(texts)}
    if len({scores[t] for t in texts if len(t) > 1}) != sum(len(t) > 1 for t in texts):
        raise ValueError("two pieces have the same score")
    pieces = []
    for p in proto.pieces:
        if p.type == _BYTE:
            pieces.append(bytes([int(p.piece[3:5], 16)]))
        else:
            pieces.append(b"" if p.type == _CONTROL else p.piece.replace(META, " ").encode())
    byte_ids = [0] * 256
    for i, p in enumerate(proto.pieces):
        if p.type == _BYTE:
            byte_ids[int(p.piece[3:5], 16)] = i
    return Vocabulary(
        ids=[numbers[t] for t in texts],
        texts=texts,
        parts=[(rank[made[t][1][0]], rank[made[t][1][1]]) if len(t) > 1 else (k, k) for k, t in enumerate(texts)],
        merged={
            (rank[t[:i]], rank[t[i:]]): rank[t]
            for t in texts
            for i in range(1, len(t))
            if t[:i] in rank and t[i:] in rank
        },
        byte_ids=byte_ids,
        pieces=pieces,
        scores={t: s for t, s in scores.items() if not t.strip(META)},
        begin=train.bos_id,
        end=train.eos_id,
    )


class Codec(dict):
    """Encodes and decodes; as a dict it holds the ids, as bytes, of the parts of words met last.

    A text is parted where no piece holds both neighbouring characters: before spaces, and, if the pieces allow it,
    between signs and letters or digits. A part's key is its text with the space before it, if there is one.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary
        self.older: dict[str, bytes] = {}
        pairs = {pair for text in vocabulary.texts for pair in zip(text, text[1:]) if META not in pair}
        mixed = any(bool(_SIGN.match(a)) != bool(_SIGN.match(b)) for a, b in pairs)
        self.part = (_AT_SPACES if mixed else _AT_SIGNS).findall
        self.pairs: dict[int, bool] = {}
        self.runs: dict[int, bytes] = {}
        self.lengths = [len(t) for t in vocabulary.texts]
        self.packed = [struct.pack("<I", i) for i in vocabulary.ids]
        self.alone = self.packed[vocabulary.texts.index(META)]
        self.packed_bytes = [struct.pack("<I", i) for i in vocabulary.byte_ids]
        self.automaton = ahocorasick.Automaton()
        for k, text in enumerate(vocabulary.texts):
            self.automaton.add_word(text, k)
        self.automaton.make_automaton()

    def _adjoin(self, left: int, right: int) -> bool:
        """Whether the encoding of both texts together is just these two tokens."""
        parts, merged = self.v.parts, self.v.merged
        limit = len(parts) + 1
        while True:
            if merged.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, left = left, parts[left][1]
                if left == limit:  # a character: only the right token can still be parted
                    limit, right = right + 1, parts[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, parts[right][0]
                if right + 1 == limit:
                    limit, left = left, parts[left][1]
                    if left == limit:
                        return True

    def word(self, text: str) -> list[bytes]:
        """The ids, each as four bytes, of a text with at most one space, as META at its beginning."""
        lengths, pairs = self.lengths, self.pairs
        last: list[int | None] = [None] * (len(text) + 1)
        for end, token in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                previous = last[end - lengths[token]]
                if previous is None:  # the beginning, or a character without a piece
                    last[end] = token
                else:
                    pair = previous << 20 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= REMEMBERED:
                            pairs.clear()
                        fits = pairs[pair] = self._adjoin(previous, token)
                    if fits:
                        last[end] = token
        out: list[bytes] = []
        end = len(text)
        while end:
            token = last[end]
            if token is None:
                end -= 1
                out.extend(self.packed_bytes[b] for b in reversed(text[end].encode()))
            else:
                out.append(self.packed[token])
                end -= lengths[token]
        out.reverse()
        return out

    def spaces(self, count: int) -> bytes:
        """A run of spaces that stays by itself."""
        if count not in self.runs:
            ids = {t: struct.pack("<I", i) for i, t in enumerate(self.v.pieces)}
            parts, _ = _merge([META] * count, self.v.scores)
            self.runs[count] = b"".join(ids[p.replace(META, " ").encode()] for p in parts)
        return self.runs[count]

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = b"".join(self.word(key.replace(" ", META)))
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def encode(self, text: str) -> bytes:
        """All ids as little-endian unsigned 32-bit integers, with begin and end."""
        body = b""
        if text:
            text = " " + text.replace(META, " ")
            parts = self.part(text)
            body = self._with_runs(parts) if "  " in text or text[-1] == " " else b"".join(map(self.__getitem__, parts))
        return struct.pack("<I", self.v.begin) + body + struct.pack("<I", self.v.end)

    def _with_runs(self, parts: list[str]) -> bytes:
        out, run = [], 0
        for part in parts:
            if part == " ":
                run += 1
                continue
            ids = self[part]
            if part[0] == " ":
                apart = ids[:4] == self.alone  # else the last space is in the word's first piece
                if run + apart:
                    out.append(self.spaces(run + apart))
                out.append(ids[4:] if apart else ids)
                run = 0
            else:
                out.append(ids)
        if run:
            out.append(self.spaces(run))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, in UTF-8; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.v.pieces.__getitem__, memoryview(ids).cast("I"))).removeprefix(b" ")
        try:
            text.decode()
        except UnicodeDecodeError:
            return text.decode(errors="replace").encode()
        return text


def encoder(vocabulary: Vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over (doc_id, text): the ids of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for batch in batches:
            ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def digester(vocabulary: Vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over (doc_id, text): the number of ids and digests of the ids and of what they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for text in batch.column("text"):
                ids = codec.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                encoded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _vocabulary(model_path: str) -> Vocabulary:
    with open(model_path, "rb") as file:
        return read_vocabulary(file.read())


def encode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, ids), ids as little-endian unsigned 32-bit integers with begin and end.

    One row a row of ``docs``, repeated rows too. A null or empty text has begin and end only. Other columns are not
    read, whatever their names. The vocabulary is the model file's, of fixed size, and goes with the task.
    """
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(encoder(_vocabulary(model_path)), f"doc_id {kind}, ids binary")


def encode_decode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): each text is encoded, and its ids are decoded again.

    Rows, nulls and other columns as in ``encode``; the decoded text of a null is empty.
    """
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        digester(_vocabulary(model_path)),
        f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
