"""Removal of repeated sentences across documents, the earliest ranked one staying.

Lines are cut after full stops, question and exclamation marks that white space follows. Pieces of at least 8 words are the
units, compared in lower case (A-Z) and with one space for any white space. So a passage is found wherever in a line, and
across which lines, it stands: all but the pieces at its two ends are the same units. Of equal units that of the smallest
document id stays, in it the first. The others are repeats; they are removed where repeats that no other unit parts have at
least 20 words together, so that a short sentence that two texts happen to share stays. White space that follows a removed
piece in its line goes too, and the places in the original text are kept. A line of which nothing is left goes with its
break. Units are known by 64-bit digests.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import BROADCAST_ROWS, staged

MIN_WORDS = 8
#: Fewest words of a passage of repeats that is removed.
MIN_PASSAGE = 20
_CUT = re.compile("[.!?]+[\x20\x09\x0b-\x0d]+")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def pieces(line: str) -> list[tuple[str, int, int | None]]:
    """The pieces of a line in order, together the whole line, each with its words and, if it is a unit, its digest."""
    found, at = [], 0
    for end in [*(cut.end() for cut in _CUT.finditer(line)), len(line)]:
        piece, at = line[at:end], end
        words = piece.encode("utf-8", "surrogatepass").split()
        digest = None
        if len(words) >= MIN_WORDS:
            same = hashlib.blake2b(b" ".join(words).translate(_LOWER), digest_size=8).digest()
            digest = int.from_bytes(same, "little", signed=True)
        found.append((piece, len(words), digest))
    return found


def units(text: str) -> set[int]:
    """The digests of the units of a text."""
    return {digest for line in text.split("\n") for *_, digest in pieces(line) if digest is not None}


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, text): rows (digest, doc_id), once a document."""
    for batch in batches:
        found, owner = [], []
        for i, text in enumerate(batch.column("text")):
            own = units(text.as_py() or "")
            found.extend(own)
            owner.extend([i] * len(own))
        ids = batch.column("doc_id").take(pa.array(owner, pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), ids], ["digest", "doc_id"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, text, gone): the text without units whose digests are in ``gone`` or came before."""
    for batch in batches:
        texts, counts, spans = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            rest, n, out = _without(text or "", set(gone or ()))
            counts.append(n)
            spans.append(out)
            texts.append(rest if out else text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(texts, pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ],
            ["doc_id", "text", "n_units", "removed"],
        )


def _repeated(parts: list[tuple[str, int, int | None]], seen: set[int]) -> set[int]:
    """The indices of the pieces to remove; ``seen`` are digests of units that came before."""
    gone, passage, size = set(), [], 0
    for i, (_, n_words, digest) in enumerate([*parts, ("", 0, 0)]):
        if digest is not None and i < len(parts) and digest in seen:
            passage.append(i)
            size += n_words
        elif digest is not None:
            if size >= MIN_PASSAGE:
                gone.update(passage)
            passage, size = [], 0
            seen.add(digest)
    return gone


def _without(text: str, seen: set[int]) -> tuple[str, int, list[dict]]:
    """The text without passages of units in ``seen`` or met before, its number of units, and the places removed."""
    lines = [pieces(line) for line in text.split("\n")]
    parts = [part for line in lines for part in line]
    gone = _repeated(parts, seen)
    kept_lines, out, at, i = [], [], 0, 0
    for line in lines:
        kept, before = [], len(out)
        for piece, _, _ in line:
            if i in gone:
                out.append({"start": at, "end": at + len(piece)})
            else:
                kept.append(piece)
            at += len(piece)
            i += 1
        at += 1
        if len(out) == before or any(kept):
            kept_lines.append("".join(kept))
    return "\n".join(kept_lines), sum(digest is not None for *_, digest in parts), out


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, text, n_units, removed), one a row of ``docs``; ``removed`` lists the places (start, end) removed.

    A null text stays null and has no units. Rows that repeat an id are versions of one document: what it keeps, each
    keeps. Rows without an id neither take nor lose units of others, and lose their own repeats. Other columns are not
    read, whatever their names.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.where("doc_id is not null").mapInArrow(_digests, f"digest bigint, doc_id {kind}")
    found = staged(found.distinct(), "units")
    owners = found.groupBy("digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    repeats = owners.where("owner <> last").select("digest", "owner")
    lost = found.join(repeats, "digest").where("doc_id <> owner").groupBy("doc_id")
    lost = staged(lost.agg(F.collect_list("digest").alias("gone")), "gone")
    few = (lost.agg(F.sum(F.size("gone"))).first()[0] or 0) <= BROADCAST_ROWS
    joined = texts.join(F.broadcast(lost) if few else lost, "doc_id", "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(
        _removed, f"doc_id {kind}, text string, n_units bigint, removed array<struct<start:bigint,end:bigint>>"
    )
