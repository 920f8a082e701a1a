"""Language-model scores from a log-frequency Bloom filter.

The model is a bigram model over a smoothed unigram model. Every word and every pair of words in the training texts
counts, however rare. A pair's count is quantised on a log scale and put into the filter once for every level up to its
own, so that probing level after level until one is missing gives it back. Levels are the steps of the scale that some
count reaches: none is spent between 1 and 2, or 3 and 4. The filter grows with the pairs: it is
cut into segments by the pair's hash, each a bit array that one task builds.

    P(w | h) = (pair(h, w) + (total(h) - kept(h) + PRIOR) * P(w)) / (total(h) + PRIOR),  kept(h) = sum of pair(h, .)

sums to one over all words but for the filter's false positives. After an unknown word, and at the beginning, P(w) is
used. P(w) = (c + 0.5) / (N + 0.5 * (V + 1)) with exact counts.

Where things lie depends on sizes, the scores do not. While they are small, the filter and every word that occurs twice
are broadcast. A training text's other words occur once, which its task knows without a join. Other words of the texts
held out are joined with the counts, and so are their pairs that cannot be settled in the task; both come back as one sum
for each text. Beyond that size nothing is broadcast, and texts are scored in groups (``lm_groups``).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import slices, staged
from wakeline.llm.words import hashed_words, mix

#: Words that may be broadcast; 24 bytes each.
MOST_WORDS = 2_000_000
#: Bytes up to which the filter is broadcast. It has no more than HASHES / ln 2 bits a training token.
FILTER_BYTES = 128 << 20
#: Training tokens, and so at most pairs, a segment; small filters have LEAST_SEGMENTS, so that all tasks build some.
SEGMENT_TOKENS = 1 << 16
LEAST_SEGMENTS = 1024
#: Step of the log scale, and hash functions: one probe in 2 ** HASHES of a missing pair succeeds.
BASE = 1.25
HASHES = 10
#: Weight of the unigram model after a word, in tokens.
PRIOR = 1000.0
#: Tokens that a task counts before it sends counts on, and histories whose sums it holds.
COUNTED_TOKENS = 1 << 21
HELD_SUMS = 1 << 18
#: Pairs whose levels a task keeps from text to text, and from which level on: those take the most probes and come again.
HELD_LEVELS = 1 << 20
KEPT_LEVEL = 3
END = np.uint64(0x5EED_0E0D_0000_0001)


def _token_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches with all their tokens, each text's words and its end, and where each text's tokens start."""
    for batch in slices(batches, "text"):
        words, firsts = hashed_words(batch.column("text"))
        starts = firsts + np.arange(len(firsts))
        tokens = np.full(len(words) + len(batch), END, dtype=np.uint64)
        is_word = np.ones(len(tokens), dtype=bool)
        is_word[starts[1:] - 1] = False
        tokens[is_word] = words
        yield batch, tokens, starts


def _counted(runs: Iterator[np.ndarray], name: str) -> Iterator[pa.RecordBatch]:
    """Counts of equal values, added up over COUNTED_TOKENS at a time."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], [name, "c"])

    for run in runs:
        held.append(run)
        if sum(map(len, held)) >= COUNTED_TOKENS:
            yield flush()
    if held:
        yield flush()


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _counted((tokens for _, tokens, _ in _token_runs(batches)), "h")


def _places(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The place of each token among the frequent ones, or -1."""
    at = np.searchsorted(frequent, tokens)
    at[at == len(frequent)] = 0
    return np.where(frequent[at] == tokens, at, -1) if len(frequent) else np.full(len(tokens), -1)


def pair_keys(histories: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(histories ^ mix(words + np.uint64(0x9E3779B97F4A7C15)))


def _pair_counts(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """Rows (segment, h, runs, w, c) of pairs within texts, added up over COUNTED_TOKENS at a time, a row a segment.

    The columns are arrays as bytes: the distinct histories, and by history the number of its words, the words and the
    counts.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        h, w = (np.concatenate(x) for x in zip(*held))
        held.clear()
        keys, first, counts = np.unique(pair_keys(h, w), return_index=True, return_counts=True)
        segment = (keys % np.uint64(segments)).astype(np.int32)
        order = np.lexsort((h[first], segment))
        segment, h, w, c = segment[order], h[first[order]], w[first[order]], counts[order].astype(np.int32)
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (segment[1:] != segment[:-1])
        runs = np.diff(np.append(np.flatnonzero(new), len(h))).astype(np.int32)
        number, ends = np.unique(segment, return_index=True)
        ends = np.append(ends, len(h))
        run_ends = np.concatenate([[0], np.cumsum(new)])[ends]
        columns = [pa.array(number), _bytes(h[new], run_ends), _bytes(runs, run_ends), _bytes(w, ends), _bytes(c, ends)]
        return pa.RecordBatch.from_arrays(columns, ["segment", "h", "runs", "w", "c"])

    for _, tokens, starts in _token_runs(batches):
        after = _after(starts)
        held.append((tokens[after - 1], tokens[after]))
        if sum(len(h) for h, _ in held) >= COUNTED_TOKENS:
            yield flush()
    if held:
        yield flush()


def _bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A row of bytes for each stretch of the values."""
    offsets = pa.array(ends * values.itemsize, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets.buffers()[1], pa.py_buffer(values.tobytes())])


def _after(starts: np.ndarray) -> np.ndarray:
    """The places of the tokens that have one before them in their text."""
    later = np.ones(starts[-1], dtype=bool)
    later[starts[:-1]] = False
    return np.flatnonzero(later)


def _steps(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(count) / math.log(BASE) + 1e-9).astype(np.int64)


#: Steps of the log scale that counts reach, by level. Small counts leave steps out; further on every step holds a count.
REACHED = np.unique(_steps(np.arange(1, 1 << 12)))


def _count_at(level: np.ndarray) -> np.ndarray:
    further = np.maximum(level - len(REACHED), 0)
    return BASE ** (REACHED[np.clip(level, 1, len(REACHED)) - 1] + further - 0.5)


def _level_of(count: np.ndarray) -> np.ndarray:
    """The level of each count, from 1: steps of the log scale without those that no count reaches."""
    step = _steps(count)
    return np.searchsorted(REACHED, step, side="right") + np.maximum(step - REACHED[-1], 0)


def _starts(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of the hashes of each key at a level."""
    one = mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    return one, mix(one) | np.uint64(1)


def _bit(one: np.ndarray, two: np.ndarray, i: int, size: np.ndarray) -> np.ndarray:
    """The place of hash ``i`` in ``size`` bits, which are fewer than 2 ** 32."""
    return (((one + np.uint64(i) * two) >> np.uint64(32)) * size) >> np.uint64(32)


def segment_bits(keys: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, int]:
    """The bit array, as bytes, of pairs and their levels, and its size in bits."""
    size = max(64, math.ceil(int(levels.sum()) * HASHES / math.log(2)))
    bits = np.zeros(size, dtype=bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        one, two = _starts(keys[levels >= level], level)
        for i in range(HASHES):
            bits[_bit(one, two, i, np.uint64(size))] = True
    return np.packbits(bits, bitorder="little"), size


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over rows of ``_pair_counts`` in order of segments: rows (segment, bits, size, levels), and rows
    (histories, kept) of sums by history."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def row(segment: int | None, bits: bytes | None, size: int, levels: int, h: np.ndarray, kept: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([segment], pa.int32()),
                pa.array([bits], pa.binary()),
                pa.array([size], pa.int64()),
                pa.array([levels], pa.int32()),
                pa.array([h.view(np.int64)], pa.list_(pa.int64())),
                pa.array([kept], pa.list_(pa.float64())),
            ],
            ["segment", "bits", "size", "levels", "histories", "kept"],
        )

    def sums() -> tuple[np.ndarray, np.ndarray]:
        h, kept = (np.concatenate(x) for x in zip(*held))
        distinct, inverse = np.unique(h, return_inverse=True)
        return distinct, np.bincount(inverse, weights=kept)

    none = np.zeros(0, np.uint64), np.zeros(0)
    for segment, h, w, c in _runs(batches):
        keys, levels = pair_keys(h, w), _level_of(c)
        bits, size = segment_bits(keys, levels)
        yield row(segment, bits.tobytes(), size, int(levels.max()), *none)
        held.append((h, _count_at(levels)))
        if sum(len(x) for x, _ in held) >= HELD_SUMS:
            held[:] = [sums()]
            if len(held[0][0]) >= HELD_SUMS // 2:
                yield row(None, None, 0, 0, *held.pop())
    if held:
        yield row(None, None, 0, 0, *sums())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(segment, h, w, c) of the distinct pairs of each segment, from ordered rows of ``_pair_counts``."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    for segment, parts in itertools.groupby(rows(), key=lambda row: row["segment"]):
        parts = list(parts)
        h, runs, w, c = (
            np.frombuffer(b"".join(p[name] for p in parts), dtype=kind)
            for name, kind in (("h", np.uint64), ("runs", np.int32), ("w", np.uint64), ("c", np.int32))
        )
        h = np.repeat(h, runs)
        _, first, inverse = np.unique(pair_keys(h, w), return_index=True, return_inverse=True)
        yield segment, h[first], w[first], np.bincount(inverse, weights=c)


@dataclass
class Filter:
    """Segments side by side; those without pairs have size 0."""

    bits: np.ndarray  # as bytes
    start: np.ndarray  # in bytes, by segment
    size: np.ndarray  # in bits, by segment
    levels: np.ndarray  # by segment

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Quantised counts: levels are probed from the first until one is missing; 0 where the first is."""
        segment = (keys % np.uint64(len(self.size))).astype(np.int64)
        size, start, levels = self.size[segment], self.start[segment], self.levels[segment]
        level = np.zeros(len(keys), dtype=np.int64)
        live, step = np.arange(len(keys)), 0
        while len(live):
            step += 1
            live = live[levels[live] >= step]
            one, two = _starts(keys[live], step)
            for some in (range(2), range(2, HASHES)):
                bits, at = size[live], start[live]
                present = np.ones(len(live), dtype=bool)
                for i in some:
                    bit = _bit(one, two, i, bits)
                    byte = self.bits[at + (bit >> np.uint64(3)).view(np.int64)]
                    present &= (byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                live, one, two = live[present], one[present], two[present]
            level[live] = step
        return level


class HeldLevels:
    """Levels of a filter for one lot of distinct keys after another; high ones are held and not probed again."""

    def __init__(self, pairs: Filter) -> None:
        self.pairs = pairs
        self.keys, self.levels = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def level(self, keys: np.ndarray) -> np.ndarray:
        place = _places(keys, self.keys)
        new = place < 0
        level = np.zeros(len(keys), dtype=np.int64)
        level[~new] = self.levels[place[~new]]
        level[new] = self.pairs.level(keys[new])
        kept = np.flatnonzero(new & (level >= KEPT_LEVEL))[: HELD_LEVELS - len(self.keys)]
        if len(kept):
            held = np.concatenate([self.keys, keys[kept]])
            order = np.argsort(held)
            self.keys, self.levels = held[order], np.concatenate([self.levels, level[kept]])[order]
        return level


def filter_of(rows: pa.Table, segments: int) -> Filter:
    """The filter of rows (segment, bits, size, levels)."""
    at = rows["segment"].to_numpy()
    parts = [np.frombuffer(b.as_buffer(), dtype=np.uint8) for b in rows["bits"]]
    start, size, levels = np.zeros(segments, np.int64), np.zeros(segments, np.uint64), np.zeros(segments, np.int64)
    start[at] = np.cumsum([0, *map(len, parts)])[:-1]
    size[at] = rows["size"].to_numpy()
    levels[at] = rows["levels"].to_numpy()
    return Filter(np.concatenate([np.zeros(0, np.uint8), *parts]), start, size, levels)


@dataclass
class Words:
    """The words that are broadcast, and their values by place."""

    frequent: np.ndarray  # word hashes in order
    count: np.ndarray
    kept: np.ndarray
    tokens: int
    distinct: int

    def log_unigram(self, place: np.ndarray) -> np.ndarray:
        return np.log10((self.count[place] + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def totals(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of histories: total + PRIOR, and what of it is left for the unigram model."""
        total = np.maximum(self.count[place], self.kept[place]) + PRIOR
        return total, total - self.kept[place]

    def single(self) -> Words:
        """A word that occurs once, so that one pair of the first level follows it."""
        return Words(np.zeros(1, np.uint64), np.ones(1, np.int64), _count_at(np.ones(1, np.int64)), self.tokens, self.distinct)


def words_of(rows: pa.Table, tokens: int, distinct: int) -> Words:
    """The words of rows (h, c, kept)."""
    hashes = rows["h"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Words(hashes[order], rows["c"].to_numpy()[order], rows["kept"].to_numpy()[order], tokens, distinct)


def _scored(
    words: Words, pairs: Filter, batches: Iterator[pa.RecordBatch], once: bool = False
) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held_out, n_tokens, frequent, base, score, rare, ask_h, ask_w, ask_n, ask_q).

    With ``once`` every word that occurs twice in training is broadcast. So a training text's other words occur there and
    nowhere else, with one pair after each, and need no join: they count as frequent.

    The sums are over frequent words, and over what is known of pairs after them; the rare words are listed. So are the
    pairs that are left to ask for, once a text with their number: those in the filter with a rare word, with their
    quantised count.
    """
    levels = HeldLevels(pairs)
    for batch, tokens, starts in _token_runs(batches):
        distinct, inverse = np.unique(tokens, return_inverse=True)
        places = _places(distinct, words.frequent)
        frequent = places >= 0
        values = np.zeros((4, len(distinct)))
        values[0, frequent] = words.log_unigram(places[frequent])
        values[1:3, frequent] = words.totals(places[frequent])
        known = frequent[inverse]
        if once:
            single = words.single()
            values[0, ~frequent] = single.log_unigram(0)
            values[1:3, ~frequent] = np.reshape(single.totals(0), (2, 1))
            known |= np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False), np.diff(starts))
            frequent[:] = True
        values[3, frequent] = np.log10(values[2, frequent] / values[1, frequent])
        unigram, factor = np.where(known, values[0][inverse], 0), np.zeros(len(tokens))
        after = _after(starts)
        factor[after] = np.where(known[after - 1], values[3][inverse[after - 1]], 0)
        keys = pair_keys(tokens[after - 1], tokens[after])
        distinct, of_pair = np.unique(keys, return_inverse=True)
        level = levels.level(distinct)[of_pair]
        both = (level > 0) & known[after] & known[after - 1]
        at = after[both]
        total, left = values[1:3, inverse[at - 1]]
        factor[at] = np.log10((left + _count_at(level[both]) / 10.0 ** unigram[at]) / total)
        ask = (level > 0) & ~both
        asked, keys, level = after[ask], keys[ask], level[ask]
        text = np.searchsorted(starts, asked, side="right") - 1
        order = np.lexsort((keys, text))
        asked, keys, text, level = asked[order], keys[order], text[order], level[order]
        new = np.ones(len(asked), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        number = np.diff(np.append(first, len(asked)))
        ends = pa.array(np.searchsorted(text[first], np.arange(len(batch) + 1)), pa.int32())
        asked = asked[first]

        def sums(values: np.ndarray) -> pa.Array:
            return pa.array(np.add.reduceat(values, starts[:-1]))

        def listed(values: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64)))

        rare = np.concatenate([[0], np.cumsum(~known)])[starts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(np.diff(starts)),
                sums(known.astype(np.int64)),
                sums(unigram),
                sums(unigram + factor),
                pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(tokens[~known].view(np.int64))),
                listed(tokens[asked - 1]),
                listed(tokens[asked]),
                listed(number),
                pa.ListArray.from_arrays(ends, pa.array(_count_at(level[first]))),
            ],
            ["doc_id", "held_out", "n_tokens", "frequent", "base", "score", "rare", "ask_h", "ask_w", "ask_n", "ask_q"],
        )


def _with_gain(pairs: DataFrame, words: DataFrame, log_p: Column) -> DataFrame:
    """Add ``gain``, what a pair of ``q`` adds to the weight of its history."""
    left = F.greatest("c", "kept") - F.col("kept") + PRIOR
    pairs = pairs.join(words.select("h", left.alias("left")), "h", "left")
    pairs = pairs.join(words.select(F.col("h").alias("w"), "c"), "w", "left")
    weight = F.coalesce("left", F.lit(PRIOR)) * F.pow(F.lit(10.0), log_p)
    return pairs.withColumn("gain", F.log10(1 + F.col("q") / weight))


def held_out(id_column: str) -> Column:
    """Whether a document is kept from training; one without an id is not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 1, F.lit(False))


def _least_count(words: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach; there are fewer counts than the root of twice the tokens."""
    numbers = words.groupBy("c").count().toArrow().sort_by([("c", "descending")])
    reached = np.cumsum(numbers["count"].to_numpy())
    fit = int(np.searchsorted(reached, most, side="right"))
    return 1 if fit == len(reached) else int(numbers["c"][fit].as_py()) + 1


def score_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_words: int = MOST_WORDS,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one a row of ``docs``.

    A null or empty text has its end as its only token. Repeated rows are scored, and counted in training, as often as
    they come. Without training rows every count is 0. Other columns are not read, whatever their names. ``most_words``
    and ``filter_bytes`` say what is broadcast and change no score.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"), F.col(text_column).alias("text")
    )
    training = texts.where(~F.col("held_out")).select("text")
    counts = training.mapInArrow(_token_counts, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))
    counts = staged(counts, "token-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct")).first()
    tokens, distinct = int(total["tokens"]), int(total["distinct"])
    number = max(LEAST_SEGMENTS, tokens // SEGMENT_TOKENS)
    least = _least_count(counts, most_words)
    train_tokens = F.lit(tokens).cast("bigint").alias("train_tokens")
    if tokens * HASHES / math.log(2) / 8 > filter_bytes or least > 2:
        from wakeline.llm.lm_groups import score_groups

        scored = score_groups(texts, number, tokens, distinct)
        return scored.select("doc_id", "held_out", "n_tokens", "n_known", train_tokens, "base_score", "score")
    pairs = training.mapInArrow(
        lambda batches: _pair_counts(batches, number), "segment int, h binary, runs binary, w binary, c binary"
    )
    segments = pairs.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        _segments, "segment int, bits binary, size bigint, levels int, histories array<bigint>, kept array<double>"
    )
    segments = staged(segments, "segments")
    sums = segments.where("segment is null").select(F.explode(F.arrays_zip("histories", "kept")).alias("s"))
    sums = sums.groupBy(F.col("s.histories").alias("h")).agg(F.sum("s.kept").alias("kept"))
    words = counts.join(sums, "h", "left").select("h", "c", F.coalesce("kept", F.lit(0.0)).alias("kept"))
    words = staged(words, "words")
    often = words_of(words.where(F.col("c") >= least).toArrow(), tokens, distinct)
    bits = segments.where("segment is not null").select("segment", "bits", "size", "levels")
    held = filter_of(bits.toArrow(), number)
    sent = spark.sparkContext.broadcast((vars(often), vars(held)))  # plain arrays, which need no class on the workers
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = texts.mapInArrow(
        lambda batches: _scored(Words(**sent.value[0]), Filter(**sent.value[1]), batches, least == 2),
        f"doc_id {kind}, held_out boolean, n_tokens bigint, frequent bigint, base double, score double,"
        " rare array<bigint>, ask_h array<bigint>, ask_w array<bigint>, ask_n array<bigint>, ask_q array<double>",
    )
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    sent.destroy()  # what is scored is written
    sent = often = held = None
    log_p = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / (tokens + 0.5 * (distinct + 1)))
    weight = F.greatest("c", "kept") + PRIOR
    back_off = F.when(F.col("h") != int(END.view(np.int64)), F.log10((weight - F.col("kept")) / weight))
    rare = scored.select("row", F.explode("rare").alias("h")).join(words.where(F.col("c") < least), "h", "left")
    rare = rare.select("row", log_p.alias("log_p"), "c", F.coalesce(back_off, F.lit(0.0)).alias("back_off"))
    rare = rare.groupBy("row").agg(
        F.sum("log_p").alias("rare_sum"), F.count("c").alias("rare_known"), F.sum("back_off").alias("rare_back_off")
    )
    asks = ["ask_h", "ask_w", "ask_n", "ask_q"]
    scored_rows = scored.drop("rare", *asks).join(rare, "row", "left")
    asked = scored.select("row", F.explode(F.arrays_zip(*asks)).alias("ask"))
    asked = asked.select("row", *(F.col(f"ask.{name}").alias(name[-1]) for name in asks))
    gained = F.lit(0.0)
    if not asked.isEmpty():
        gains = _with_gain(asked, words, log_p).groupBy("row").agg(F.sum(F.col("n") * F.col("gain")).alias("gained"))
        scored_rows = scored_rows.join(gains, "row", "left")
        gained = F.coalesce("gained", F.lit(0.0))
    rare_sum = F.coalesce("rare_sum", F.lit(0.0))
    return scored_rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("frequent") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        train_tokens,
        (F.col("base") + rare_sum).alias("base_score"),
        (F.col("score") + rare_sum + F.coalesce("rare_back_off", F.lit(0.0)) + gained).alias("score"),
    )
