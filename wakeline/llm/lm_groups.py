"""Language-model scores of many texts: nothing that grows with them is broadcast, and no pair or word is joined.

The scores are those of ``lm``, with the same filter. Texts are written once in groups of GROUP_BYTES. A group sends its
distinct pairs in order of their hash, cut into parts of PART_SEGMENTS segments of the filter, and a part sends back a
level for each, in the same order. So neither pairs nor texts are named on the way: a pair takes some six bytes there and
a fraction of one back. Words go the same way, with their sums by history; then a group has all that its scores need. What
moves is distinct pairs and words within groups, however often they come and however few the histories are.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import bucketed, staged
from wakeline.llm.lm import (
    Filter,
    Words,
    _after,
    _count_at,
    _level_of,
    _token_runs,
    pair_keys,
    segment_bits,
)

#: Bytes of text that a task works on at once, some two million words.
GROUP_BYTES = 12 << 20
#: Segments of the filter whose pairs, or words of as many tokens, a task gathers at once.
PART_SEGMENTS = 16
WORD_SEGMENTS = 64

_SENT = "part int, group bigint, size int, places binary, counts binary, kept binary"
_ANSWERS = "part int, group bigint, size int, counts binary, kept binary"


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``group``: texts of one task whose bytes, added up, lie in the same stretch of GROUP_BYTES."""
    end, first = 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = end + np.cumsum(sizes)
        end = int(ends[-1]) if len(ends) else end
        group = first + (ends - sizes) // GROUP_BYTES
        yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], ["group", *batch.schema.names])


def _packed(values: np.ndarray) -> bytes:
    """Numbers as bytes, compressed: all first bytes, all second ones, and so on."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=size * width, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(kind).reshape(size)


def _first_place(segment: np.ndarray, number: int) -> np.ndarray:
    """The first place of each segment; places are as many as 64-bit numbers, and the first segments have one more."""
    most, more = divmod(1 << 64, number)
    return segment * np.uint64(most) + np.minimum(segment, np.uint64(more))


def _places(keys: np.ndarray, number: int) -> np.ndarray:
    """A bijection of 64-bit numbers that lays the keys of a segment, equal modulo ``number``, side by side."""
    return _first_place(keys % np.uint64(number), number) + keys // np.uint64(number)


def _cuts(number: int, size: int) -> np.ndarray:
    """The first place of each part of ``size`` segments."""
    return _first_place(np.arange(0, number, size, dtype=np.uint64), number)


def _sent(group: int, cuts: np.ndarray, places: np.ndarray, counts: np.ndarray, kept: np.ndarray | None) -> pa.Table:
    """Rows of _SENT, one a part that holds some of the places, which are in order."""
    rows = []
    ends = np.append(np.searchsorted(places, cuts), len(places))
    for part in np.flatnonzero(np.diff(ends)):
        own = slice(ends[part], ends[part + 1])
        steps = np.diff(places[own], prepend=cuts[part])
        sums = None if kept is None else _packed(kept[own])
        rows.append((part, group, len(steps), _packed(steps), _packed(counts[own]), sums))
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "group", "size", "places", "counts", "kept"])


def _parts(batches: Iterator[pa.RecordBatch], cuts: np.ndarray) -> Iterator[tuple[int, list[dict], list[np.ndarray]]]:
    """Parts with their rows of _SENT and each row's places; the rows come in order of parts."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for part, sent in itertools.groupby(rows, key=lambda row: row["part"]):
        sent = list(sent)
        steps = (_unpacked(row["places"], row["size"], np.uint64) for row in sent)
        yield part, sent, [cuts[part] + np.cumsum(s, dtype=np.uint64) for s in steps]


def _answers(part: int, sent: list[dict], counts: np.ndarray, kept: np.ndarray) -> pa.RecordBatch:
    """Rows of _ANSWERS for all rows of a part; the values are those of the rows one after another."""
    ends = np.cumsum([0, *(row["size"] for row in sent)])
    columns = [
        pa.array([part] * len(sent), pa.int32()),
        pa.array([row["group"] for row in sent], pa.int64()),
        pa.array([row["size"] for row in sent], pa.int32()),
        *(pa.array([_packed(v[a:b]) for a, b in zip(ends, ends[1:])], pa.binary()) for v in (counts, kept)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "group", "size", "counts", "kept"])


def _levels(number: int) -> Callable:
    """For mapInArrow over rows of pairs: their levels in the filter, and the level to add up by history, which a pair has
    in the first row alone that counts it."""
    cuts = _cuts(number, PART_SEGMENTS)

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sent, places in _parts(batches, cuts):
            counts = np.concatenate([_unpacked(row["counts"], row["size"], np.int32) for row in sent])
            distinct, inverse = np.unique(np.concatenate(places), return_inverse=True)
            total = np.bincount(inverse, weights=counts).astype(np.int64)
            trained = total > 0
            true, level = np.zeros(len(total), np.int64), np.zeros(len(total), np.int64)
            true[trained] = _level_of(total[trained])
            segments = np.arange(part * PART_SEGMENTS, min(number, (part + 1) * PART_SEGMENTS), dtype=np.uint64)
            firsts = _first_place(segments, number)
            ends = np.append(np.searchsorted(distinct, firsts), len(distinct))
            for segment, first, a, b in zip(segments, firsts, ends, ends[1:]):
                held = trained[a:b]
                if held.any():
                    keys, of_key = (distinct[a:b] - first) * np.uint64(number) + segment, true[a:b][held]
                    bits, size = segment_bits(keys[held], of_key)
                    one = Filter(bits, np.zeros(1, np.int64), np.array([size], np.uint64), of_key.max(keepdims=True))
                    level[a:b] = one.level(keys)
            owned, counted = np.zeros(len(counts), np.uint8), np.flatnonzero(counts)[::-1]
            owner = np.zeros(len(total), np.int64)
            owner[inverse[counted]] = counted  # the last that is set, which is the first that counts
            owned[owner[trained]] = true[trained]
            yield _answers(part, sent, level.astype(np.uint8)[inverse], owned)

    return levels


def _sums(number: int) -> Callable:
    """For mapInArrow over rows of words: the count of each and the sum of its pairs."""
    cuts = _cuts(number, WORD_SEGMENTS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sent, places in _parts(batches, cuts):
            _, inverse = np.unique(np.concatenate(places), return_inverse=True)
            counts = np.concatenate([_unpacked(row["counts"], row["size"], np.int32) for row in sent])
            kept = np.concatenate([_unpacked(row["kept"], row["size"], np.float64) for row in sent])
            counts, kept = (np.bincount(inverse, weights=v) for v in (counts, kept))
            yield _answers(part, sent, counts.astype(np.int64)[inverse], kept[inverse])

    return sums


def _received(rows: pa.Table, kind: type, column: str = "counts") -> np.ndarray:
    """The values of a group's rows of _ANSWERS, part after part."""
    rows = rows.select(["part", "size", column]).sort_by("part").to_pylist()
    return np.concatenate([np.zeros(0, kind), *(_unpacked(row[column], row["size"], kind) for row in rows)])


class _Group:
    """The tokens of a group of texts, and their pairs."""

    def __init__(self, texts: pa.Table) -> None:
        runs = [(tokens, np.diff(starts)) for _, tokens, starts in _token_runs(iter(texts.to_batches()))]
        self.tokens = np.concatenate([tokens for tokens, _ in runs])
        self.sizes = np.concatenate([sizes for _, sizes in runs])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.training = np.repeat(~texts["held_out"].to_numpy(), self.sizes)
        self.after = _after(self.starts)

    def places(self, number: int) -> np.ndarray:
        return _places(pair_keys(self.tokens[self.after - 1], self.tokens[self.after]), number)


def _counts(inverse: np.ndarray, training: np.ndarray, size: int) -> np.ndarray:
    """How often each distinct value occurs in training texts."""
    return np.bincount(inverse[training], minlength=size).astype(np.int32)


def _send_pairs(number: int) -> Callable:
    cuts = _cuts(number, PART_SEGMENTS)

    def send(key: tuple, texts: pa.Table) -> pa.Table:
        group = _Group(texts)
        places, inverse = np.unique(group.places(number), return_inverse=True)
        return _sent(key[0].as_py(), cuts, places, _counts(inverse, group.training[group.after], len(places)), None)

    return send


def _send_words(number: int) -> Callable:
    cuts = _cuts(number, WORD_SEGMENTS)

    def send(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        group = _Group(texts)
        owned = _received(answers, np.uint8, "kept")
        _, first = np.unique(group.places(number), return_index=True)
        words, inverse = np.unique(group.tokens, return_inverse=True)
        histories = inverse[group.after[first[owned > 0]] - 1]
        kept = np.bincount(histories, weights=_count_at(owned[owned > 0].astype(np.int64)), minlength=len(words))
        return _sent(key[0].as_py(), cuts, words, _counts(inverse, group.training, len(words)), kept)

    return send


def _score(number: int, tokens: int, distinct: int) -> Callable:
    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        group = _Group(texts)
        of_words = pc.is_valid(answers["kept"])
        levels = _received(answers.filter(pc.invert(of_words)), np.uint8)
        values = answers.filter(of_words)
        words, inverse = np.unique(group.tokens, return_inverse=True)
        count = _received(values, np.int64)
        model = Words(words, count, _received(values, np.float64, "kept"), tokens, distinct)
        total, left = model.totals(slice(None))
        unigram, factor = model.log_unigram(slice(None))[inverse], np.zeros(len(group.tokens))
        factor[group.after] = np.log10(left / total)[inverse[group.after - 1]]
        _, of_pair = np.unique(group.places(number), return_inverse=True)
        level = levels[of_pair].astype(np.int64)
        at = group.after[level > 0]
        history = inverse[at - 1]
        gained = left[history] + _count_at(level[level > 0]) / 10.0 ** unigram[at]
        factor[at] = np.log10(gained / total[history])

        def sums(values: np.ndarray) -> pa.Array:
            return pa.array(np.add.reduceat(values, group.starts[:-1]))

        columns = [pa.array(group.sizes), sums((count > 0)[inverse].astype(np.int64)), sums(unigram), sums(unigram + factor)]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        return pa.table([texts["doc_id"], texts["held_out"], *columns], names)

    return score


def _answered(rows: DataFrame, answer: Callable, name: str) -> DataFrame:
    return staged(rows.repartition("part").sortWithinPartitions("part").mapInArrow(answer, _ANSWERS), name)


def score_groups(texts: DataFrame, number: int, tokens: int, distinct: int) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, base_score, score), one a row of ``texts`` (doc_id, held_out, text).

    ``number`` is that of the filter's segments; there are ``tokens`` training tokens, and ``distinct`` words among them.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()
    grouped = texts.mapInArrow(_grouped, f"group bigint, doc_id {kind}, held_out boolean, text string")
    with bucketed(grouped, "texts", "group", compression="zstd") as groups:
        by_group = groups.groupBy("group")
        pairs = _answered(by_group.applyInArrow(_send_pairs(number), _SENT), _levels(number), "pair-levels")
        own = by_group.cogroup(pairs.select("group", "part", "size", "kept").groupBy("group"))
        words = _answered(own.applyInArrow(_send_words(number), _SENT), _sums(number), "word-sums")
        answers = pairs.select("group", "part", "size", "counts", F.lit(None).cast("binary").alias("kept"))
        answers = answers.unionByName(words.select("group", "part", "size", "counts", "kept")).groupBy("group")
        scored = by_group.cogroup(answers).applyInArrow(
            _score(number, tokens, distinct),
            f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
        )
        return staged(scored, "scored")
