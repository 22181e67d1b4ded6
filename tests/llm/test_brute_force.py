"""Operators against plain Python, an exact round trip or held-out labels over the sample tables."""

import collections
import html
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tagloom.llm import registry

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.execute(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())


def _lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    from tests.oracle_check import compare, connect

    _, difference = compare(registry.QUERIES[name](spark, SF), connect(SF), registry.SQL[name])
    assert difference is None


def test_packing_is_a_round_trip(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*e.ids, 1] for i, e in zip(texts, coder.encode_batch(list(texts.values()), add_special_tokens=False))}
    got = registry.QUERIES["op2_bm25_packing"](spark, SF).toPandas()
    assert got["length"].sum() == sum(map(len, ids.values()))
    for r in got.itertuples():
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    for key, at in (("doc_id", "start"), ("sequence_id", "offset")):
        for _, rows in got.sort_values(at).groupby(key):
            assert rows[at].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]]
    sizes = got.groupby("sequence_id")["length"].sum()
    assert sizes.max() <= 2048 and (sizes < 2048).sum() <= 1


def test_neighbours_of_the_whole_table_share_a_shard(spark, monkeypatch):
    from tagloom.llm import packing

    monkeypatch.setattr(packing, "SHARD_TOKENS", 20_000)
    rng = np.random.default_rng(3)
    # 16 topics of 20 words, each topic written in letters of its own; 40 words that all topics use.
    own = [rng.choice([chr(0x3041 + 5 * g + k) for k in range(5)], (20, 2)) for g in range(16)]
    common = ["".join(w) for w in rng.choice(list("abcdefghijklmnop"), (40, 4))]
    text = lambda g: " ".join([*rng.choice(common, 40), *("".join(w) for w in own[g][rng.integers(0, 20, 20)])])
    docs = spark.createDataFrame([(i, text(i % 16)) for i in range(800)], "doc_id long, text string")
    ids = {r.doc_id: np.frombuffer(r.ids, dtype="<u2") for r in packing.tokens(docs).collect()}
    got = packing.packing(docs).collect()
    shard = {r.doc_id: r.sequence_id >> 32 for r in got}
    sizes = collections.Counter(shard[r.doc_id] for r in got for _ in range(r.length))
    assert len(sizes) > 4 and max(sizes.values()) <= 2 * 20_000
    assert sum(sizes.values()) == sum(map(len, ids.values()))
    seen = np.bincount(np.concatenate([np.unique(x) for x in ids.values()]), minlength=1 << 16)
    idf, mean = np.log1p((800 - seen + 0.5) / (seen + 0.5)), np.mean([len(x) for x in ids.values()])
    index = packing.Index([ids[i] for i in range(800)], idf, mean)
    best = {i: [j for j in index.neighbours(i, np.ones(800, bool)).tolist() if j != i][:5] for i in range(0, 800, 7)}
    found = [shard[i] == shard[j] for i, near in best.items() for j in near]
    assert sum(found) >= 0.5 * len(found) > 2 * len(found) / len(sizes)


def test_every_term_of_a_seed_counts():
    from tagloom.llm.packing import Index

    docs = [np.arange(10, 74), np.array([73]), *[np.array([t, t]) for t in range(10, 50)]]
    rare = np.where(np.arange(1 << 16) < 50, 9.0, 0.1)
    assert 1 in Index(docs, rare, 8.0).neighbours(0, np.ones(len(docs), bool))


def test_apostrophes_and_white_space_encode_alike():
    import public_tokenizers
    import pyarrow as pa
    from tagloom.llm import textcols as T
    from tagloom.llm.bpe import encoder

    coder = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = ["", " ", "  a", "a  b", "a \n b", "a\n\nb", "it's 'so'", "x  y", "1²½ ß!? ...  ", " \t", "日本 語", "àb"]
    got = [r for s in T.slices(pa.array(rows), 9) for r in coder.rows(s)]
    assert [g.tolist() for g in got] == [coder.encoding.encode_ordinary(r) for r in rows]


def test_repeated_passages_go_and_nothing_else(spark, texts):
    got = {r.doc_id: r.text or "" for r in registry.QUERIES["op3_sentence_span_dedup"](spark, SF).collect()}

    def runs(rows, k):
        out = collections.Counter()
        for t in rows.values():
            w = WORD.findall(_lower(t))
            out.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        return out

    assert max(runs(got, 50).values()) == 1
    shared = {g for g, n in runs(texts, 24).items() if n > 1}
    for i, t in texts.items():
        if got[i] != t:
            w = WORD.findall(_lower(t))
            assert any(tuple(w[j : j + 24]) in shared for j in range(len(w)))


def test_passages_of_51_words_within_lines(spark):
    """Without punctuation, between other words on both sides, beginning anywhere."""
    from tagloom.llm.repeated_spans import without_repeated_spans

    rng = np.random.default_rng(11)
    some = lambda n: [f"w{x}" for x in rng.integers(0, 10**7, n)]
    passages = [some(51) for _ in range(400)]
    texts = [" ".join([*some(rng.integers(1, 90)), *p, *some(rng.integers(1, 90))]) for _ in range(2) for p in passages]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in without_repeated_spans(docs).collect()}
    assert all(got[i].text == texts[i] for i in range(400))
    assert [i for i in range(400, 800) if got[i].n_removed == 0] == []


def test_similar_lines(spark, texts):
    lines = [(i, k, _lower(x.strip(" \t\n\v\f\r"))) for i, t in sorted(texts.items()) for k, x in enumerate(t.split("\n"))]
    lines = [x for x in lines if x[2]]
    # Lines without a whole shingle are like their exact copies alone.
    sets = {x: frozenset(x[j : j + 8] for j in range(len(x) - 7)) or frozenset([(x,)]) for _, _, x in lines}
    held = collections.defaultdict(list)
    parent = {x: x for x in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, s in sets.items():
        for y, n in collections.Counter(y for g in s for y in held[g]).items():
            if 100 * n >= 80 * (len(s) + len(sets[y]) - n):
                parent[root(x)] = root(y)
        for g in s:
            held[g].append(x)
    first, dropped = {}, collections.Counter()
    for i, k, x in lines:
        dropped[i] += first.setdefault(root(x), (i, k)) != (i, k)
    got = {r.doc_id: r.n_removed for r in registry.QUERIES["op10_fuzzy_line_dedup"](spark, SF).collect()}
    assert got == {i: dropped[i] for i in texts}


def test_short_lines_of_the_pipeline(spark, texts):
    """No line is left twice, however short; near copies of 8 to 15 characters go as well."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = collections.Counter()
    for r in corpus_pipeline.line_dedup(spark, docs, SF).collect():
        kept.update(filter(None, (_lower(x.strip(" \t\n\v\f\r")) for x in (r.text or "").split("\n"))))
    assert max(kept.values()) == 1
    assert {x for x in kept if len(x) < 8} == {
        y for t in texts.values() for x in t.split("\n") if 0 < len(y := _lower(x.strip(" \t\n\v\f\r"))) < 8
    }
    rows = [(1, "Les.\nabcdefghijklmno\nab\n"), (2, "les. \nzabcdefghijklmno\nabcdefgxijklmno\nac"), (3, "ab\n\nLes.")]
    small = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, small, SF).collect()}
    assert got == {1: rows[0][1], 2: "abcdefgxijklmno\nac"}


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.execute(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = [r for r in registry.QUERIES["op8_rule_ensemble_quality"](spark, sf).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_pages(spark):
    pages = duckdb.execute(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r.page_id: r.text for r in registry.QUERIES["op9_main_text"](spark, SF).collect()}
    for i, page in pages:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        article = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", article))
        assert got[i] == " ".join(html.unescape(article).split())


def test_main_text_by_learnt_weights_alone(spark):
    """Without the listed elements and class words, and on pages whose article mark is taken away."""
    from tagloom.llm.main_text import extract, learnt

    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for weights in (learnt(table), learnt(table, starts=lambda feature: 0.0)):
        assert all(w <= 0 for w in weights.features.values()) and weights.features[".ad"] < -1
        for r in table.collect():
            article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
            article = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", article))
            want = " ".join(html.unescape(article).split())
            assert extract(r.html, weights) == want
            assert extract(re.sub("</?article>", "", r.html), weights) == want


def test_main_text_leaves_out_what_lies_inside(spark):
    from tagloom.llm.main_text import extract, learnt

    weights = learnt(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    body = "<h2>Head line</h2><p>First words of the text here.</p><ul><li>one item of it</li><li>two</li></ul><div><p>a plain part</p></div>"
    body += "<p>See <a href=x>the linked words of a page</a> and more.</p>"
    want = "Head line First words of the text here. one item of it two a plain part See the linked words of a page and more."
    side = '<div class="sidebar"><h3>Other</h3><p>some words that are beside it all</p></div>'
    said = '<section id="comments"><div class="comment"><p>Great text, thanks for all of it</p></div></section>'
    half = body.index("<ul>")
    for page in (
        f"<body class='has-sidebar'><nav><a href=a>home</a></nav><article>{body}</article>{side}{said}<footer>foot</footer></body>",
        f"<article>{side}{body[:half]}{side}<form><label>mail</label></form>{body[half:]}{said}<aside>beside</aside></article>",
        f"<body><header><h1>Site</h1></header><div class='content'>{body}</div>{side}{said}<div class='cookie-notice'>we use them</div>",
    ):
        assert extract(page, weights) == want
    deep = "".join(f"<div class=a{'b' * (i % 50)}{chr(97 + i % 26)}>w " for i in range(60_000))
    assert extract(deep, weights).startswith("w w")


def test_mixture_meets_its_weights(spark):
    from tagloom.llm.mixing import mixture

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    rows = mixture(docs, repetition=1.2, block_tokens=20_000).collect()
    taken, epochs, total = collections.Counter(), {}, collections.Counter()
    for r in rows:
        taken[r.source] += r.n_tokens
        epochs[r.source] = r.epochs
        total[r.source] += r.n_tokens * (r.copy == 1)
        assert r.n_tokens == words[r.doc_id]
    assert {r.doc_id for r in rows} == set(words)
    assert 1 <= min(epochs.values()) and max(epochs.values()) <= 1.2 + 1e-9
    for source, n in taken.items():
        assert abs(n - epochs[source] * total[source]) <= max(words.values()) * -(-total[source] // 20_000)


def test_small_sources_are_repeated_up_to_the_limit(spark):
    from tagloom.llm.mixing import REPETITION_LIMIT, mixture, temperature

    sizes = {"hot": 600, "mid": 150, "small": 60, "least": 20}
    rows = [(f"{s}{i}", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame([(i, s, f"a few words of {x}") for i, (x, s) in enumerate(rows)], "doc_id long, source string, text string")
    for options, limit in (({}, REPETITION_LIMIT), ({"repetition": 4.0}, 4.0)):
        got = mixture(docs, **options).collect()
        epochs = {r.source: r.epochs for r in got}
        assert epochs["hot"] == pytest.approx(1) and epochs["least"] == max(epochs.values())
        assert limit * (1 - 1e-4) <= max(epochs.values()) / min(epochs.values()) <= limit * (1 + 1e-9)
        copies = collections.Counter(r.source for r in got)
        assert {r.doc_id for r in got} == set(range(len(rows)))
        assert all(abs(copies[s] - epochs[s] * n) <= 1 for s, n in sizes.items()) and copies["least"] > sizes["least"]
    even = spark.createDataFrame([(0.6,), (0.25,), (0.15,)], "share double")
    assert temperature(even, None, 10.0) == 0 and temperature(even, None, 1.0) == 1 and temperature(even, None, None) == 1
    some, both = temperature(even, 1.0, None), temperature(even, 1.0, 1.1)
    assert 0 < some < both == temperature(even, None, 1.1) < 1 and temperature(even, 9.0, None) == 0


def test_pipeline_loses_only_what_its_stages_reject(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, SF)
        assert after.columns == docs.columns, name
        now = spark.createDataFrame(after.collect(), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in now.collect()}


def test_components_of_a_chain_and_a_hot_bucket(spark):
    """Every link of a bucket counts, also where the least member is like none of the others."""
    from pyspark.sql import functions as F

    from tagloom.llm.lsh import similar_components
    from tagloom.llm.scratch import Scratch

    rng = np.random.default_rng(5)
    core = list(range(100))
    sets = {0: list(range(1000, 1100))}
    for i in range(1, 150):
        s = core.copy()
        for j in rng.choice(100, size=int(rng.integers(0, 14)), replace=False):
            s[j] = 10_000 + (i * 100 + int(j) if i % 3 else int(j) * 7 + i % 6)
        sets[i] = sorted(set(s))
    items = spark.createDataFrame([(i, [7]) for i in sets], "id long, bands array<long>")
    members = spark.createDataFrame(list(sets.items()), "id long, members array<long>")
    found, _ = similar_components(items, lambda ids: members.join(ids, "id", "left_semi"), 80, Scratch(spark, "test"))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            n = len(set(sets[a]) & set(sets[b]))
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in found.select(F.col("node"), "component").collect()}
    assert {i: got.get(i, i) for i in sets} == {i: root(i) for i in sets}
