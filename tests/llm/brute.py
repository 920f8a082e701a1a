"""Plain Python versions of the operators, for small tables."""

import hashlib
import html
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, width=5):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def jaccard_groups(rows):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for pair in {(a, b) for ds in holders.values() for a in ds for b in ds if a < b}:
        a, b = (sets[d] for d in pair)
        if 100 * len(a & b) >= 75 * len(a | b):
            low, high = sorted(map(root, pair))
            parent[high] = low
    return {d: (len(s), root(d)) for d, s in sets.items()}


def contamination(text, items):
    """(n_words, n_hit, ids) of a text; items is a list of (item_id, text)."""
    w = ITEM_WORD.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for item, body in items:
        v = ITEM_WORD.findall((body or "").translate(LOWER))
        n = min(10, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def quality(text):
    """The measurements (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 3)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def kept_by_quality(text):
    n, chars, symbols, dup, repeat = quality(text)
    lines = sum(1 for x in (text or "").split("\n") if WORD.search(x))
    return not (
        n < 50
        or 100 * repeat > 50 * n
        or 100 * symbols > 10 * chars
        or (lines >= 4 and 100 * dup > 60 * lines)
        or chars < 2 * n
        or chars > 30 * n
    )


def base_scores(rows):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}"""
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    tokens = {d: [*words(t), None] for d, t in rows}
    c = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total = sum(c.values())
    below = total + 0.5 * (len(c) + 1)
    return {
        d: (held[d], len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10((c[w] + 0.5) / below) for w in ws))
        for d, ws in tokens.items()
    }


def base_secrets(text):
    """([n_assign, n_access, n_hex], base_sha256)"""
    text, found = text or "", []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.A):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end()))
    for kind, (pattern, least) in enumerate(((r"AKIA[A-Z0-9]+", 18), (r"[0-9a-f]+", 16)), 1):
        found.extend((m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least)
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
    return [sum(k == j for _, j, _ in found) for k in range(3)], hashlib.sha256(listed.encode()).hexdigest()


def entropy_span(run, bits, window=20):
    """First start and last end of the windows with so many bits a character, each window counted anew."""
    high = []
    for i in range(len(run) - window + 1):
        counts = Counter(run[i : i + window]).values()
        if -sum(c / window * math.log2(c / window) for c in counts) >= bits - 1e-9:
            high.append(i)
    return (high[0], high[-1] + window) if high else None


def drop_boilerplate(rows, ratio=0.02, least=5):
    """[(doc_id, host, text)] -> {doc_id: text} without lines that many pages of the host hold."""
    key = lambda line: " ".join(WORD.findall(line))
    of, pages = Counter(h for _, h, _ in rows), Counter()
    for _, h, t in rows:
        pages.update({(h, key(x)) for x in (t or "").split("\n")})
    gone = {(h, k) for (h, k), n in pages.items() if k and n >= least and n > ratio * of[h]}
    return {
        d: None if t is None else "\n".join(x for x in t.split("\n") if (h, key(x)) not in gone) for d, h, t in rows
    }


def article(page):
    """The words of the only article of a page."""
    inside = page[page.index("<article>") : page.index("</article>")]
    return " ".join(html.unescape(re.sub("<[^>]*>", " ", inside)).split())


def without_repeats(rows):
    """{doc_id: (text, spans)}: the smallest id keeps a sentence of eight words, others lose 20 such words in a row."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        cut = [re.findall("(?s).+?(?:[.!?][\x20\x09\x0b-\x0d]+|$)", line) or [""] for line in (t or "").split("\n")]
        state = []  # of each piece: repeated words, 0 for a short one, None for a unit that is new
        for piece in itertools.chain(*cut):
            w = tuple(words(piece))
            state.append(0 if len(w) < 8 else len(w) if w in seen else None)
            if len(w) >= 8:
                seen.add(w)
        gone = []
        for new, run in itertools.groupby(state, key=lambda n: n is None):
            run = list(run)
            gone += [bool(n) and not new and sum(run) >= 20 for n in run]
        kept, spans, at, flags = [], [], 0, iter(gone)
        for line in cut:
            left, lost = "", False
            for piece in line:
                if next(flags):
                    spans.append((at, at + len(piece)))
                    lost = True
                else:
                    left += piece
                at += len(piece)
            if left or not lost:
                kept.append(left)
            at += 1
        out[d] = (None if t is None else "\n".join(kept), spans)
    return out
