"""Main text of web pages as the best-scoring run of tokens (operator 9)."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of what the weights are learnt from: labelled pages, class words (those of most pages) and sets of open elements.
SAMPLE, CLASS_WORDS, SETS = 2_000, 1_000, 20_000

# HTML element names and words of class names.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "title", "select", "object")
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head"}
BLOCKS = {
    "address", "article", "blockquote", "body", "br", "dd", "div", "dl", "dt", "figcaption", "figure", "footer",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "aside", "form", "details", "summary",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
NESTING = BLOCKS - VOID - {"p", "li", "dd", "dt", "tr", "td", "th", "tbody", "thead", "tfoot"} | ASIDE
WHOLE = {"html", "body"}
OPTIONAL_END = {"p", "li", "dd", "dt", "tr", "td", "th", "tbody", "thead", "tfoot"}
#: Class words that speak against content before any page is seen.
MARKED = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|popup|modal|comments?|"
    r"replies|disqus|sidebar|menu|navbar|nav|navigation|breadcrumbs?|footer|share|sharing|social|related|"
    r"recommended|newsletter|subscribe|signup|login|pagination|toolbar|masthead"
)
#: Attributes end at the next tag where their own is not closed, so a broken page is read once.
_ATTRIBUTES = r"(?:\"[^\"]*\"|'[^']*'|[^'\"<>]++)*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(" + "|".join(RAW) + r")\b" + _ATTRIBUTES + r">.*?(?:</\1\s*>|$)|<[!?][^>]*(?:>|$)|"
    r"<(/?)([a-z][a-z0-9-]*)(" + _ATTRIBUTES + r")>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"\S+")

#: Scores before any page is seen: of a word, of a word in a link, of an element or class word listed above, of a tag
#: and of a tag of an article or main element, which are the labels themselves and so are not learnt.
WORD_START, LINK_START, LISTED, TAG_START, EDGE = 1.0, -3.0, -6.0, -0.5, -8.0
#: So many pages weigh as much as the starting values.
PRIOR = 10
#: A word scores between these, a tag between those.
WORD_RANGE, TAG_RANGE = (0.5, 3.0), (-1.0, -0.1)
#: A run of text beside the content, which is left out of the result anyway, or of a link costs no more than this.
ASIDE_COST = -1.0


def start(feature: str) -> float:
    """The score of a feature before any page is seen."""
    if feature == "link":
        return LINK_START
    return LISTED if feature in ASIDE or feature[0] == "." and MARKED.fullmatch(feature[1:]) else 0.0


def class_words(names: str) -> set[str]:
    """`.word` of each word of the class names, ids and roles, and of each whole name without its marks."""
    found = set()
    for name in names.lower().split():
        words = re.findall("[a-z]+", name)
        found.update("." + word for word in words)
        if words:
            found.add("." + "".join(words))
    return found


def tokens(page: str, value: Callable[[str], float | int]) -> Iterator[tuple[str, str, bool, bool, float | int]]:
    """(kind, text, begins a block, lies in a labelled article, sum of the open features' values) in page order.

    Kinds: word (a run of text), link (text of a link), tag, edge (a tag of an article or main element). The features of
    a text are the names of the elements that hold it and their class words, each counted once however often it is open.
    Elements left open end with what holds them. Each feature is added and taken away once per element, so the time is
    linear in the page.
    """
    held: list[tuple[str, set[str]]] = []
    opened: dict[str, int] = {}
    link = articles = total = 0
    new_block, at = True, 0

    def close(depth: int) -> None:
        nonlocal articles, total
        while len(held) > depth:
            name, features = held.pop()
            articles -= name in ("article", "main")
            for feature in features:
                opened[feature] -= 1
                if not opened[feature]:
                    total -= value(feature)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            yield "link" if link else "word", text, new_block, articles > 0, total
            new_block = new_block and not text.strip()
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name == "a":
            link = 0 if m[2] else 1
        if name in BLOCKS:
            new_block = True
            link = 0
        if m[2]:
            for i in range(len(held) - 1, -1, -1):
                if held[i][0] == name:
                    close(i)
                    break
        elif name not in VOID and not m[4].rstrip().endswith("/"):
            features = class_words(" ".join(x or y or z for x, y, z in ATTRIBUTE.findall(m[4])))
            if name in OPTIONAL_END and held and held[-1][0] == name:
                close(len(held) - 1)
            if name in NESTING or (name in OPTIONAL_END or name == "span") and features:
                if name not in OPTIONAL_END:
                    while held and held[-1][0] in OPTIONAL_END and name in BLOCKS:
                        close(len(held) - 1)
                if name in WHOLE:
                    features = set()
                elif name in NESTING and name not in ("article", "main"):
                    features.add("inner header" if name == "header" and articles else name)
                held.append((name, features))
                articles += name in ("article", "main")
                for feature in features:
                    opened[feature] = opened.get(feature, 0) + 1
                    if opened[feature] == 1:
                        total += value(feature)
        yield "edge" if name in ("article", "main") else "tag", name, name in BLOCKS, articles > 0, 0
    if at < len(page):
        yield "link" if link else "word", page[at:], new_block, articles > 0, total


class Weights:
    """Scores of words, tags and features; a feature that was not learnt has its starting score."""

    def __init__(self, word: float, tags: dict[str, float], features: dict[str, float], starts: Callable[[str], float] = start):
        self.word, self.tags, self.features, self.starts = word, tags, features, starts

    def __call__(self, feature: str) -> float:
        found = self.features.get(feature)
        return self.starts(feature) if found is None else found


def fitted(sets: np.ndarray, pages: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Logistic weights of the columns of `sets` (the first is the word itself), drawn towards `starts`.

    Words speak for content and elements against it: the first weight stays within WORD_RANGE, the others at most 0.
    Each step is bounded by the greatest curvature, so the loss never rises.
    """
    weights = starts.copy()
    step = 1 / (PRIOR + 0.25 * (sets * (pages * sets.sum(axis=1))[:, None]).sum(axis=0))
    for _ in range(2_000):
        chance = 1 / (1 + np.exp(-np.clip(sets @ weights, -50, 50)))
        moved = weights - step * (sets.T @ (pages * (chance - inside)) + PRIOR * (weights - starts))
        moved[0], moved[1:] = np.clip(moved[0], *WORD_RANGE), np.minimum(moved[1:], 0.0)
        done = np.abs(moved - weights).max() < 1e-6
        weights = moved
        if done:
            break
    return weights


def learnt(pages: DataFrame, sample: int = SAMPLE, starts: Callable[[str], float] = start) -> Weights:
    """Scores of words, tags, element names and class words, from pages whose publisher marks the article.

    A logistic fit of whether text lies inside the marked article by the elements that hold it, where a page counts once
    per set of open features; a tag scores its name's log-odds of lying inside. At most `sample` pages, those of least hash, are read, and of them the CLASS_WORDS
    words and SETS sets of most pages; repeated pages among them count once.
    """
    marked = pages.select("page_id", F.col("html").cast("string").alias("html")).where("lower(html) LIKE '%<article%'")
    marked = marked.select("html", F.xxhash64("page_id", "html").alias("_hash"))
    # Only hashes are ranked: no page leaves its task before it is known to be in the sample.
    last = marked.select("_hash").orderBy("_hash").limit(sample).agg(F.max("_hash")).first()[0]
    chosen = marked.where(F.col("_hash") <= F.lit(last)).select("html").distinct()

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page in batch["html"]:
                seen: set[str] = set()
                for _ in tokens(page, lambda f: seen.add(f) or 0):
                    pass
                yield pd.DataFrame({"feature": sorted(seen)}, dtype="str")

    found = chosen.mapInPandas(words, "feature string").groupBy("feature").count()
    common = found.orderBy(F.desc("count"), "feature").limit(CLASS_WORDS).collect()
    names = ["link", *(r["feature"] for r in common)]
    bits = {name: 1 << i for i, name in enumerate(names)}

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(names) // 8 + 1
        for batch in batches:
            seen: dict[tuple[str, int, bool], int] = {}
            for page in batch["html"]:
                own = set()
                for kind, text, _, inside, mask in tokens(page, lambda f: bits.get(f, 0)):
                    if kind == "tag":
                        seen[text, 0, inside] = seen.get((text, 0, inside), 0) + 1
                    elif kind != "edge" and text.strip():
                        own.add((None, mask | (kind == "link"), inside))
                for key in own:
                    seen[key] = seen.get(key, 0) + 1
            rows = [(k, mask.to_bytes(size, "little"), i, n) for (k, mask, i), n in seen.items()]
            yield pd.DataFrame(rows, columns=["tag", "mask", "inside", "n"])

    found = chosen.mapInPandas(sets, "tag string, mask binary, inside boolean, n long")
    found = found.groupBy("tag", "mask", "inside").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "tag", "mask", "inside").limit(SETS).collect()
    counts: dict[str, list[int]] = {}
    for row in rows:
        if row.tag is not None:
            counts.setdefault(row.tag, [0, 0])[row.inside] += row.n
    tags = {}
    for name, (outside, inside) in counts.items():
        odds, n = math.log((inside + 1) / (outside + 1)), inside + outside
        tags[name] = min(max((PRIOR * TAG_START + n * odds) / (PRIOR + n), TAG_RANGE[0]), TAG_RANGE[1])
    rows = [r for r in rows if r.tag is None]
    first = np.array([WORD_START, *(starts(name) for name in names)])
    if not rows:
        return Weights(WORD_START, tags, {}, starts)
    masks = np.array([np.frombuffer(r["mask"], dtype=np.uint8) for r in rows])
    open_now = np.unpackbits(masks, axis=1, bitorder="little")[:, : len(names)]
    matrix = np.hstack([np.ones((len(rows), 1)), open_now])
    weights = fitted(matrix, np.array([r.n for r in rows], dtype=float), np.array([r.inside for r in rows], dtype=float), first)
    return Weights(float(weights[0]), tags, dict(zip(names, weights[1:].tolist())), starts)


def extract(page: str | None, weights: Weights) -> str:
    """The text of the contiguous run of tokens with the greatest sum of scores, in one scan.

    Text whose elements outweigh its words scores below zero; where it lies inside the run it is left out.
    Character references are decoded, white space becomes one space, blocks are joined by one.
    """
    if not page:
        return ""
    listed = []
    best = total = 0.0
    first = begin = 0
    stop = -1
    link = weights("link")
    for i, (kind, text, block, _, held) in enumerate(tokens(page, weights)):
        score = weights.word + held
        if kind in ("tag", "edge"):
            total += weights.tags.get(text, TAG_START) if kind == "tag" else EDGE
            text = " " if block else ""
        elif score <= 0:
            total += max(score * len(WORD.findall(text)), ASIDE_COST)
            text = ""
        else:
            total += max((score + link * (kind == "link")) * len(WORD.findall(text)), ASIDE_COST)
            text = entities.unescape(text)
        listed.append(text)
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, first, stop = total, begin, i
    return " ".join("".join(listed[first : stop + 1]).split())


def main_text(pages: DataFrame, sample: int = SAMPLE, starts: Callable[[str], float] = start) -> DataFrame:
    """page_id, url, text and n_chars (code points): one row per row of `pages`.

    `starts` gives the score of an element name or `.word` of a class before any page is seen.
    Null and empty pages, and pages without words, have an empty text. Markup that is left open
    ends with the page. Repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    weights = learnt(pages, sample, starts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["html"] = [extract(page, weights) for page in batch["html"]]
            yield batch

    kinds = dict(pages.dtypes)
    out = pages.select("page_id", "url", F.col("html").cast("string")).mapInPandas(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, html string"
    )
    return out.select("page_id", "url", F.col("html").alias("text"), F.length("html").cast("long").alias("n_chars"))
