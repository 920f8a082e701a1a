"""Nulls, empty and very long texts, ties and repeated rows, empty tables, and columns whose names clash."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wakeline.llm import components, lm, quality, secrets
from wakeline.llm.decontaminate import clean_documents, contamination
from wakeline.llm.html_text import blocks, main_text
from wakeline.llm.line_dedup import drop_boilerplate
from wakeline.llm.ngram_join import jaccard_groups, one_of_each_group
from wakeline.llm.queries import QUERIES
from wakeline.llm.sentencepiece_bpe import encode_decode
from wakeline.llm.sharding import interleaved
from wakeline.llm.substring_dedup import without_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"t{i % 997}x{i}" for i in range(60000))
LINE = "one two three four five six seven eight nine ten eleven"
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, LONG, "en", "a", len(LONG)),
    (5, LONG, "en", None, len(LONG)),
    (6, f"{LINE}\nrest of six", "en", "b", None),
    (6, f"{LINE}\nrest of six", "en", "b", None),
    (7, f"{LINE}\n\nother rest", "en", "b", None),
    (None, f"{LINE}\n\nother rest", "en", "b", None),
    (None, None, None, None, None),
    (8, "😀 é́   x", "xx", "c", 9),
]
#: Names that the operators use inside.
CLASHES = (
    "key h n root a b m hit row fp words win pos n_words failures _text _words n_lines digest host pages size draw shard"
    " slot rank position place text_crc32 held_out base score rare row_a gone removed units html url main rest"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, f"{LINE}"), (2, None), (3, ""), (None, "x y z"), (4, "rest OF"), (5, LINE.upper())]
    return spark.createDataFrame(rows, "item_id long, text string")


def model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


OPERATORS = {
    "groups": lambda d, i: jaccard_groups(d),
    "contamination": contamination,
    "quality": lambda d, i: quality.ledger(d),
    "scores": lambda d, i: lm.score_documents(d),
    "shards": lambda d, i: interleaved(d, 4).drop("slot", "shard"),
    "secrets": lambda d, i: secrets.secret_report(d),
    "lines": lambda d, i: drop_boilerplate(d).select("doc_id", "text", "_n_lines", "_n_dropped"),
    "repeats": lambda d, i: without_repeats(d),
    "tokens": lambda d, i: encode_decode(d, model()),
}


def rows_of(frame):
    def plain(v):
        return round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(map(plain, r)) for r in frame.collect()), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_and_other_columns(docs, items, name):
    """Every row comes back, and columns with clashing names change nothing."""
    got = rows_of(OPERATORS[name](docs, items))
    assert sorted(str(r[0]) for r in got) == sorted(str(r[0]) for r in ROWS)
    assert rows_of(OPERATORS[name](docs.withColumns({c: F.lit("x") for c in CLASHES}), items)) == got


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, items, name):
    assert OPERATORS[name](docs.limit(0), items).collect() == []


def test_contamination_folds_words_alike(spark):
    """Letters beyond ASCII that lower by what is around them, and by which marks part them."""
    rng = random.Random(11)
    words = ["ΟΔΟΣ", "οδοσ", "ΝΕΑ", "İstanbul", "ſet", "Straße", "ΣΑΣ", "É", "x9", "KELVIN", "\u212aelvin", "ǅ"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 10, 14])))) for i in range(25)]
    texts = []
    for i in range(150):
        body = items[i % 25][1] if i % 2 else " ".join(rng.choice(words) for _ in range(12))
        texts.append((i, "ab " + rng.choice(["'", ".", " ", "-", "\n"]).join(body.split()) + rng.choice(["'s", ".", "Σ"])))
    got = contamination(
        spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want = {d: brute.contamination(t, items) for d, t in texts}
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got.collect()} == {
        d: (n, hit, len(ids)) for d, (n, hit, ids) in want.items()
    }
    assert sum(hit > 0 for _, hit, _ in want.values()) > 50


def test_defined_results(docs, items):
    groups = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_groups(docs).collect()]
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 59996, 4), (4, 59996, 4), (8, 1, 8)} <= set(groups)
    assert groups.count((6, 10, 6)) == 2 and (None, 0, None) in groups
    hits = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in contamination(docs, items).collect()}
    assert hits[1] == (0, 0, 0, False) and hits[6] == (14, 13, 3, True) and hits[7] == (13, 11, 2, True)
    assert rows_of(contamination(docs, items.limit(0)).where("contaminated")) == []
    kept = {r.doc_id: (r.text, [tuple(s) for s in r.removed]) for r in without_repeats(docs).collect() if r.doc_id}
    # Eleven words that two documents share are no passage; whole copies are.
    assert kept[7] == (ROWS[7][1], []) and kept[6][1] == [] and kept[1] == (None, []) and kept[5] == ("", [(0, len(LONG))])


def test_filters_keep_columns(spark, docs, items):
    more = docs.withColumns({c: F.lit("x") for c in CLASHES})
    for kept in (
        quality.kept_documents(more),
        one_of_each_group(more),
        clean_documents(more, items),
        drop_boilerplate(more).select(*more.columns),
    ):
        assert kept.columns == more.columns
        kept.collect()
    ids = sorted(str(r.doc_id) for r in clean_documents(docs, items).collect())
    assert ids == ["1", "2", "3", "4", "5", "8", "None"]


def test_frequent_lines_of_a_host_go(spark):
    rows = [(i, f"menu  of all\nown {i}\n\nmenu of all ", "h") for i in range(20)] + [(99, "menu of all", "other")]
    got = drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.text for r in got if r.source == "h"} == {f"own {i}\n" for i in range(20)}
    assert [(r.text, r._n_dropped) for r in got if r.source == "other"] == [("menu of all", 0)]


def test_groups_of_copies_keep_their_lines(spark):
    """A third of a source are copies, a third near copies; one line is on half of the other pages."""
    lines = [f"line {k} of the text that has been copied" for k in range(8)]
    near = [f"sentence {k} of the text that was copied and changed" for k in range(8)]
    rows = [(i, "\n".join(lines), "en", "s", 1) for i in range(40)]
    rows += [(100 + i, "\n".join([*near[: i % 8], f"changed {i}", *near[i % 8 + 1 :]]), "en", "s", 1) for i in range(40)]
    rows += [(200 + i, f"own text {i} of a page of this source\n" + ("menu of all" if i % 2 else "x"), "en", "s", 1) for i in range(40)]
    stage = dict(corpus_pipeline.STAGES)["line dedup"]
    got = {r.doc_id: r.text for r in stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert all(got[r[0]] == r[1] for r in rows if r[0] < 200)
    assert {got[200 + i] for i in range(1, 40, 2)} == {f"own text {i} of a page of this source" for i in range(1, 40, 2)}


def test_stages_on_odd_rows(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, docs.limit(0)):
            stage(spark, frame, "/root/testdata/sf0.001").collect()


def test_pages(spark):
    rows = [
        (1, None, None),
        (2, "no url", ""),
        (2, "http://x/", "<article><p>a &amp; b<p>c &lt;d&gt; <!-- no --><div class=ad>no</div></article><article class=comment>no</article>"),
        (None, "http://x/", "<p>alone"),
        (4, "http://x/", "<script>var a='<p>no</p>'</script><style>p{}</style><article><h1>T</h1><b>x <i>y</b> z<br>w</article>"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    more = frame.withColumns({c: F.lit("x") for c in CLASHES if c not in ("html", "url")})
    want = [("", 0), ("", 0), ("T\nx y z w", 9), ("a & b\nc <d>", 11), ("alone", 5)]
    for f in (frame, more):
        assert sorted(((r.text, r.n_chars) for r in main_text(f).collect()), key=str) == sorted(want, key=str)
    assert main_text(frame.limit(0)).collect() == []
    assert blocks("<div>a</div><p>b<br>c</p><nav>d</nav>") == [("", "a"), ("", "b c"), ("out", "d")]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {200: 150}


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_class_names_alone_take_no_text_from_an_article(spark):
    """Parts of longer names leave it to the host's repeats; whole words, and boxes outside the article, go."""
    names = (
        "ad-free related-work share-price social-science comment-text search-results menu-item-description"
        " sponsored-research cookie-recipe banner-story"
    ).split()
    again = "Please tell all of your friends about this page today"
    rows = []
    for i in range(12):
        inner = "".join(f'<div class="{n}">On {n} page {i} says {i * 7 + k} things of note</div>' for k, n in enumerate(names))
        boxes = f'<div class="share-buttons">{again}</div><div class="ad">buy now</div>'
        page = f'<div class="share-price">out {i}</div><article><p>First {i}.</p>{inner}{boxes}</article>'
        rows.append((i, "http://a.example/x", page))
    rows.append((12, None, rows[0][2]))
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        want = [f"First {i}.", *(f"On {n} page {i} says {i * 7 + k} things of note" for k, n in enumerate(names))]
        assert got[i] == "\n".join(want)
    # Without a host nothing says what is repeated.
    assert got[12] == got[0] + "\n" + again


def test_votes_of_menus_and_of_copies(spark):
    """Pages under one menu are pages each, and lose it; a large group of copies and near copies keeps its text."""
    menu = "\n".join(["Home", "About us", "Contact", "Archive", "Imprint", "Log in here"])
    prose = [f"Line {k} of a text that very many rows have nearly word by word, in copies and near copies" for k in range(8)]
    rows = [(i, f"{menu}\nown words of page {i}", "menus") for i in range(200)]
    for i in range(120):
        lines = prose[: i % 8] + [f"this is row {i}, where one line of the eight was put in other words by hand"] + prose[i % 8 + 1 :]
        rows.append((1000 + i, "\n".join(prose if i % 2 else lines), "copies"))
    rows += [(2000 + i, f"page {i} of the rest\nwith two lines {i}", "copies") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in drop_boilerplate(frame, "source", copies=False).collect()}
    assert all((got[i].text, got[i]._n_dropped) == (f"own words of page {i}", 6) for i in range(200))
    assert all(got[d]._n_dropped == 0 for d, _, s in rows if s == "copies")


def test_passages_that_start_inside_lines_are_found(spark):
    """A passage of five sentences in lines of other words, wrapped otherwise: all but the pieces at its ends go."""
    said = [f"Sentence {k} of the passage has some nine words here{m}" for k, m in enumerate(".!?..")]
    rows = [
        (1, "Own start of one " + " ".join(said) + " own end of one"),
        (2, "Two before it. " + "  ".join(said[:2]) + "\n" + " ".join(said[2:]) + "\n\nTwo after it."),
        (3, "no match here. " * 3 + "\n" + said[4].upper() + "\nlast"),
        (4, None),
        (5, "".join(said)),
    ]
    got = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: (r.text, [tuple(s) for s in r.removed]) for d, r in got.items()} == brute.without_repeats(rows)
    assert got[2].text == "Two before it. " + said[0] + "  \n\nTwo after it." and len(got[2].removed) == 4
    assert got[3].text == rows[2][1] and not got[1].removed and not got[5].removed  # one sentence alone stays
