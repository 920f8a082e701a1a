"""Secrets in texts: three fixed patterns, and strings of high entropy in a sliding window.

A candidate is a long run of letters, digits and ``+/_=-`` with a digit in it. The narrowest character class of a window
gives its threshold, so that what stands before a key does not change how it is judged. The window's entropy and class
follow from the counts of its characters, of which one goes up and one goes down at each step. Windows that reach into
a placeholder or a date, and runs and spans on the allow-list, are left out. Only rows with a match pay for more than
the search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of at least so many, or none: runs are taken whole, so this is the same as dropping short ones.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits a character that a window must reach, by its narrowest class: hex of one case, letters and digits, any. Digits
#: alone never do; 20 characters have 4.32 bits at most.
BITS = {"hex": 3.0, "alnum": 3.6, "any": 3.8}
#: Whole runs or spans that look random but are no secrets.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",  # UUID
    r"^[A-Za-z]+([-_/=][A-Za-z]+)*[-_/=]?[0-9]{0,4}$",  # words and at most a number
)
#: Parts of runs that no window may reach into, and their lengths.
MASKED = (
    *((rf"(?i:{word})", len(word)) for word in ("placeholder", "example", "sample", "dummy", "xxxx")),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}", 10),  # date
)
_MASK = "~"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-" + _MASK


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(pattern: str, group: int) -> str:
    """SQL for an array of (start, match, part): the pieces between matches and the matches give the places."""
    quoted = _quote(pattern)
    return f"""
        aggregate(
          transform(
            arrays_zip(split(text, {quoted}, -1), regexp_extract_all(text, {quoted}, 0),
                       regexp_extract_all(text, {quoted}, {group})),
            z -> named_struct('piece', z.`0`, 'whole', z.`1`, 'part', z.`2`)),
          named_struct('at', 0, 'found', CAST(array() AS array<struct<start:int,whole:string,part:string>>)),
          (a, m) -> named_struct(
            'at', a.at + length(m.piece) + coalesce(length(m.whole), 0),
            'found', CASE WHEN m.whole IS NULL THEN a.found
                     ELSE concat(a.found, array(named_struct('start', a.at + length(m.piece),
                                                             'whole', m.whole, 'part', m.part))) END),
          a -> a.found)"""


def _spans(kind: str, pattern: str, group: int, test: str, when: str) -> str:
    """SQL for the array of (start, kind as a number, end) of matches that pass ``test`` on ``m``."""
    return f"""CASE WHEN {when} THEN transform(filter({_matches(pattern, group)}, m -> {test}), m -> named_struct(
        'start', m.start, 'kind', {KINDS.index(kind)}, 'end', m.start + length(m.whole)))
        ELSE CAST(array() AS array<struct<start:int,kind:int,end:int>>) END"""


def _term(count: str) -> str:
    return f"(CASE WHEN {count} > 1 THEN {count} * log2(CAST({count} AS DOUBLE)) ELSE 0D END)"


#: Groups of places in the alphabet, from 1, whose numbers in the window give its class.
_GROUPS = {"upper": (1, 26), "lower": (27, 52), "other_hex": (7, 26), "other_low": (33, 52), "signs": (63, 67), "masks": (68, 68)}


def _window_span(text: str) -> str:
    """SQL for (first, last) of the windows of ``text`` that reach the bits of their class; nulls if there is none.

    The state holds the count of each character of the alphabet in the window, the numbers of the groups of characters,
    and the sum of count * log2(count).
    """
    size = len(_ALPHABET)
    entering = f"instr('{_ALPHABET}', substr({text}, i + 1, 1))"
    leaving = f"CASE WHEN i < {WINDOW} THEN 0 ELSE instr('{_ALPHABET}', substr({text}, i + 1 - {WINDOW}, 1)) END"
    up, down = "element_at(a.counts, x.up)", "element_at(a.counts, x.down)"
    change = (
        f"CASE WHEN x.up = x.down THEN 0D ELSE {_term(f'({up} + 1)')} - {_term(up)} + "
        f"CASE WHEN x.down = 0 THEN 0D ELSE {_term(f'({down} - 1)')} - {_term(down)} END END"
    )
    groups = ", ".join(
        f"'{name}', a.{name} + CAST(x.up BETWEEN {lo} AND {hi} AS INT) - CAST(x.down BETWEEN {lo} AND {hi} AS INT)"
        for name, (lo, hi) in _GROUPS.items()
    )
    none = ", ".join(f"'{name}', 0" for name in _GROUPS)
    bits = (
        f"CASE WHEN n.signs > 0 THEN {BITS['any']}D WHEN n.upper + n.lower = 0 THEN 9.9D"
        " WHEN n.other_hex + n.other_low = 0 AND (n.upper = 0 OR n.lower = 0) "
        f"THEN {BITS['hex']}D ELSE {BITS['alnum']}D END"
    )
    high = f"x.i >= {WINDOW - 1} AND n.masks = 0 AND log2({WINDOW}D) - n.total / {WINDOW} >= {bits} - 1e-9"
    held = ", ".join(f"'{name}', n.{name}" for name in _GROUPS)
    return f"""
        aggregate(transform(sequence(0, length({text}) - 1), i -> named_struct('i', i, 'up', {entering}, 'down', {leaving})),
          named_struct('counts', array_repeat(0, {size}), 'total', 0D, {none},
                       'first', CAST(NULL AS INT), 'last', CAST(NULL AS INT)),
          (a, x) -> aggregate(array(named_struct('total', a.total + {change}, {groups})), a, (b, n) -> named_struct(
            'counts', transform(a.counts, (c, j) -> c + CASE WHEN j + 1 = x.up THEN 1 ELSE 0 END
                                                      - CASE WHEN j + 1 = x.down THEN 1 ELSE 0 END),
            'total', n.total, {held},
            'first', CASE WHEN a.first IS NULL AND {high} THEN x.i - {WINDOW - 1} ELSE a.first END,
            'last', CASE WHEN {high} THEN x.i + 1 ELSE a.last END)),
          a -> named_struct('first', a.first, 'last', a.last))"""


def _entropy_spans() -> str:
    def allowed(text: str) -> str:
        return " OR ".join(f"{text} RLIKE {_quote(p)}" for p in ALLOWED)

    masked = "m.whole"
    for pattern, length in MASKED:
        masked = f"regexp_replace({masked}, {_quote(pattern)}, '{_MASK * length}')"
    found = "substr(s.whole, s.w.first + 1, s.w.last - s.w.first)"
    return f"""CASE WHEN text RLIKE {_quote(RUN)} THEN
        transform(filter(transform(transform(filter({_matches(RUN, 0)}, m -> NOT ({allowed('m.whole')})),
            m -> named_struct('start', m.start, 'whole', m.whole, 'masked', {masked})),
            m -> named_struct('start', m.start, 'whole', m.whole, 'w', {_window_span('m.masked')})),
            s -> s.w.first IS NOT NULL AND NOT ({allowed(found)})),
          s -> named_struct('start', s.start + s.w.first, 'kind', {KINDS.index('entropy')}, 'end', s.start + s.w.last))
        ELSE CAST(array() AS array<struct<start:int,kind:int,end:int>>) END"""


def _listed(spans: str) -> str:
    names = ", ".join(_quote(k) for k in KINDS)
    return (
        f"array_join(transform({spans}, s -> concat(element_at(array({names}), s.kind + 1), ':', s.start, ':', s.end)), ',')"
    )


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, spans), spans an array of (start, kind, end) in order; places count code points, end exclusive.

    One row a row of ``docs``, repeated rows and null ids too. A null or empty text has no spans. Other columns are not
    read, whatever their names. Nothing is shuffled.
    """
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    assign = "contains(text, ':') OR contains(text, '=')"
    found = narrow.select(
        "doc_id",
        F.expr(_spans("assign", ASSIGN, 2, "length(m.part) >= 12", f"({assign}) AND text RLIKE {_quote(ASSIGN)}")).alias("a"),
        F.expr(_spans("access", ACCESS, 0, "true", "contains(text, 'AKIA')")).alias("k"),
        F.expr(_spans("hex", HEX, 0, "true", f"text RLIKE {_quote(HEX)}")).alias("h"),
        F.expr(_entropy_spans()).alias("e"),
    )
    return found.select("doc_id", F.array_sort(F.concat("a", "k", "h", "e")).alias("spans"))


def secret_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy) of ``secret_spans``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    found = secret_spans(docs, id_column, text_column).withColumnRenamed("spans", "found")
    base = _listed(f"filter(found, s -> s.kind < {KINDS.index('entropy')})")
    return found.select(
        "doc_id",
        *(count(k) for k in KINDS[:3]),
        F.sha2(F.expr(base), 256).alias("base_sha256"),
        F.expr(_listed("found")).alias("spans"),
        count("entropy"),
    )
