"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

from tagloom.llm.hamming import nearest
from tagloom.llm.host_rules import host_rules
from tagloom.llm.line_duplicates import without_repeated_lines
from tagloom.llm.main_text import main_text
from tagloom.llm.mixing import mixed, mixture
from tagloom.llm.near_duplicates import keep_one_of_each_group, near_duplicates
from tagloom.llm.packing import packing
from tagloom.llm.pii import personal_data_digest
from tagloom.llm.repeated_spans import without_repeated_spans
from tagloom.llm.rule_ensemble import keep_good, scored

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, members string, "
    "key string, found string, component string, host string, _tokens string, _doc string"
)
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "", 0),
    (3, " \t\n\n", "en", "a", 4),
    (4, "one", "en", "a", 3),
    (5, "one", "en", "a", 3),
    (5, "one", "en", "a", 3),
    (None, "no id but a text of some words that is long enough to be a line", "en", "b", 60),
    (7, LONG, "en", "b", len(LONG)),
    (8, "the same line of text, long enough\nthe same line of text, long enough\n", "é", "b", 70),
    (9, "The same line of text, long enough", "é", "b", 34),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["x"] * 0, *[None] * 8) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, None, 0), (None, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")


def _count(df):
    return len(df.collect())


def test_host_rules(docs):
    got = {r.doc_id: r for r in host_rules(docs).collect()}
    assert _count(host_rules(docs)) == len(ROWS)
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept
    assert got[8].n_dup_lines == 1 and got[7].n_words == 60_000
    assert _count(host_rules(docs.limit(0))) == 0


def test_near_duplicates(docs):
    got = near_duplicates(docs, 2).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_shingles == 0 and by_id[1].component_id == 1 and by_id[1].kept
    assert by_id[5].component_id == 4 and not by_id[5].kept and by_id[4].n_shingles == 1
    assert by_id[None].component_id is None and by_id[None].kept
    kept = keep_one_of_each_group(docs)
    assert kept.columns == docs.columns and _count(kept) == len(ROWS) - 2
    assert _count(near_duplicates(docs.limit(0))) == 0


def test_packing(docs):
    got = packing(docs).toPandas()
    assert got["length"].sum() == got.drop_duplicates(["doc_id", "start", "ids_crc32"])["length"].sum() + 2  # "one" twice
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048
    assert _count(packing(docs.limit(0))) == 0


def test_spans(docs):
    got = {r.doc_id: r for r in without_repeated_spans(docs).collect()}
    assert got[1].text is None and got[2].text == "" and got[4].text == "one"
    assert _count(without_repeated_spans(docs)) == len(ROWS)
    assert _count(without_repeated_spans(docs.limit(0))) == 0


def test_lines(docs):
    got = without_repeated_lines(docs)
    assert got.columns == [*docs.columns, "_removed", "_left"]
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].text is None and rows[3].text == " \t\n\n"
    assert rows[8].text == "the same line of text, long enough\n" and rows[8]._removed == 1 and rows[8].n_chars == 35
    assert rows[9].text == "" and rows[9]._left == 0
    assert _count(without_repeated_lines(docs.limit(0))) == 0


def test_personal_data(spark, docs):
    assert _count(personal_data_digest(docs)) == len(ROWS)
    text = "é mail a@b.c_d@e.f, card 4111 1111 1111 1111; GB82 WEST 1234 5698 7654 32 my ssn 123-45-6789 256.1.1.1 1.2.3.4"
    row = personal_data_digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.spans == "email:7:12,email:12:18,card:25:44,iban:46:73,ssn:81:92,ip:103:110"
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (2, 1, 1, 0)
    runs = spark.createDataFrame([(1, "9" * 200_000), (2, "a" * 200_000), (3, "1 2-" * 50_000)], "doc_id long, text string")
    assert {r.spans for r in personal_data_digest(runs).collect()} == {""}
    assert _count(personal_data_digest(docs.limit(0))) == 0


def test_mixing(docs):
    got = mixture(docs).collect()
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}
    assert mixed(docs).drop("_mix").columns == docs.columns
    assert _count(mixture(docs.limit(0))) == 0


def test_classifier(docs, labels):
    got = scored(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert _count(scored(docs, labels.limit(0))) == len(ROWS)
    assert keep_good(docs, labels).columns == docs.columns
    assert _count(scored(docs.limit(0), labels)) == 0


def test_pages(spark):
    pages = spark.createDataFrame(
        [
            (1, "u", None, 1),
            (2, None, "", 2),
            (3, "u", "no markup &amp; some  words", 3),
            (4, "u", "<nav>menu of links</nav><div class='cookie-notice'>we use cookies here</div><main><h1>A title</h1>"
                     "<p>Text of the article, with <b>bold</b> and &eacute;<p>more of it here<script>var x='</p>'</script>"
                     "<aside>see also this</aside><p>the end of it</main><section id=comments><p>I like it</section>"
                     "<footer>the footer", 4),
        ],
        "page_id long, url string, html string, text long",
    )
    got = {r.page_id: r for r in main_text(pages).collect()}
    assert got[1].text == "" and got[2].n_chars == 0 and got[3].text == "no markup & some words"
    assert got[4].text == "A title Text of the article, with bold and é more of it here the end of it"
    assert _count(main_text(pages.limit(0))) == 0


def test_codes(spark):
    rows = [(i, [1.0 if (i * 37 >> b) & 1 else -1.0 for b in range(64)], i) for i in range(200)]
    rows += [(None, [1.0] * 64, 1), (500, None, 1), (501, [1.0], 1), (150, rows[150][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    known = [(i, e) for i, e, _ in rows if i is not None and e is not None]

    def far(a, b):
        pad = lambda e: [x > 0 for x in e] + [False] * (64 - len(e))
        return sum(x != y for x, y in zip(pad(a), pad(b)))

    got = {}
    for r in nearest(table).collect():
        got.setdefault(r.query_id, []).append((r.distance, r.vec_id))
    for q in (0, 50, 100):
        e = dict(known)[q]
        want = sorted((far(e, f), i) for i, f in known if i != q)[:10]
        assert sorted(got[q]) == want
    assert _count(nearest(table.limit(0))) == 0
    few = nearest(table.where(F.col("vec_id") < 3)).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(0, 1), (0, 2)]
