"""Main text of web pages by the maximum-scoring run of tokens.

A page is read once into tokens: tags and stretches of words. Scripts, styles, forms and subtrees that are marked as
menus, page headers, footers, sidebars, notices, adverts or reader comments are left out. A class, id or role marks only
if it says nothing but the mark and its place, so headings and paragraphs with names of their own stay. A marked subtree or a form
stays if the page's article or most of its words would go with it (``_kept``). Every other token has a weight, the logarithm of how much likelier it is inside an article than outside; so words and paragraph tags mostly
add, list and link tags subtract. One linear scan finds the run of tokens with the highest sum, and the blocks of
that run are the text.

The weights are learned from labelled pages: those with exactly one ``<article>``, whose inside is the label. At most
``SAMPLE`` of them, of lowest hashed id, are read for it; there are a few hundred features at most.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 2000
CLIP = 2.0
#: The borders of the labels themselves are never seen outside; their ratio has no bound but this one.
BORDER = 40.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|object|canvas|title)(?![\w-])[^>]*+>"
    r"|<(?P<close>/)?(?P<name>[a-zA-Z][\w:-]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?][^>]*+>"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_MARK = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: HTML element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot "
    "thead tr ul".split()
)
DROPPED = frozenset("head nav footer aside button dialog menu select option input".split())
ARTICLE = frozenset("article main".split())
CLOSES_ITSELF = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr", ("table",))}
#: Words that mark a subtree as no part of the article, where a class, id or role says nothing else.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription signup login paywall sidebar sidebars sidenav widget widgets "
    "related recommended recommendations trending share sharing social comment comments commentlist disqus respond replies reply "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer footers contentinfo complementary search "
    "skip toolbar dialog alert disclaimer copyright tags".split()
)
HEADERS = frozenset("header masthead topbar".split())
#: Words that say where or how a mark is set, not of what: "left-sidebar", "share-buttons", "related-posts". Any
#: other word makes a name of its own: "related-work", "search-algorithms", "market-share", "no-banner", "ad-free".
SETTINGS = frozenset(
    "a area article articles aside bar block body bottom box button buttons card cards column container content entry fixed foot form "
    "global group head icon icons inner item items js left link links list main message mobile outer page panel post posts primary "
    "right row secondary section site slot small stories sticky story text title top unit wrap wrapper zone".split()
)
#: Left out by name alone, but a whole page may stand in them.
FORMS = frozenset("form fieldset label".split())
#: Foreign elements that are no text; in them "/>" ends the element, as in XML.
FOREIGN = frozenset(["svg"])


def _words_of(attrs: str) -> tuple[set[str], bool]:
    """The marks of an element, and whether it is hidden."""
    marks, hidden = set(), False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden = hidden or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE) is not None
        elif name in ("class", "id", "role"):
            for token in value.split():
                parts = {part.lower() for part in _MARK.findall(token)}
                said = parts - SETTINGS
                if said <= MARKS | HEADERS:
                    marks |= said
    return marks, hidden


@dataclass
class _Doubtful:
    """A marked subtree or form: the one around it, whether it begins in an article, and its words: all of them, those
    that are in an article and in no doubtful subtree further in, and those of its longest article."""

    parent: int
    in_article: bool
    words: int = 0
    own: int = 0
    longest: int = 0


def _kept(subtrees: list[_Doubtful]) -> list[bool]:
    """Which doubtful subtrees are read; the first one stands for the page, the others follow those around them.

    One is read if an article in it is longer than what the articles around and outside it keep without it, so that
    cards of related articles still go. It is also read if it has most of the page's words and stands in an article, or
    no article outside it has words, so that long comments below an article still go."""
    kept, safe = [True], [subtrees[0].own]  # safe: article words that stay whatever becomes of this subtree
    for tree in subtrees[1:]:
        outside = safe[tree.parent]
        most = 2 * tree.words > subtrees[0].words and (tree.in_article or not outside)
        kept.append(kept[tree.parent] and (tree.longest > outside or most))
        safe.append(outside + tree.own)
    return kept


def read_tokens(page: str, everything: bool = False) -> list[tuple[str, str]]:
    """(feature, text) of a page in order. A tag's feature is ``<name`` or ``>name``, its text is empty; words have
    ``word`` or, in a link, ``link``; ``br`` is white space. What is left out makes no token but still ends blocks;
    with ``everything``, marked subtrees are read like the rest."""
    tokens: list[tuple[str, str]] = []
    owners: list[int] = []  # of each token: the doubtful subtree it stands in
    subtrees = [_Doubtful(0, False)]
    stack: list[tuple[str, bool, int, int]] = []  # name, whether it begins a subtree that is left out, owner and words before it
    standing: Counter[str] = Counter()  # how many of a name are open, so that no stray tag looks through the whole stack
    out = articles = links = owner = words = 0
    at, size = 0, len(page)

    def leave(index: int) -> None:
        nonlocal out, articles, links, owner
        while len(stack) > index:
            name, dropped, around, before = stack.pop()
            standing[name] -= 1
            if name in ARTICLE and not out:
                subtrees[owner].longest = max(subtrees[owner].longest, words - before)
            if owner != around:
                subtrees[owner].words = words - before
                subtrees[around].longest = max(subtrees[around].longest, subtrees[owner].longest)
            owner = around
            out -= dropped
            articles -= name in ARTICLE
            links -= name == "a"

    def add(feature: str, text: str, tree: int) -> None:
        tokens.append((feature, text))
        owners.append(tree)

    def innermost(names, stops=()) -> int:
        if not any(standing[name] for name in names):
            return -1
        for index in range(len(stack) - 1, -1, -1):
            if stack[index][0] in names:
                return index
            if stack[index][0] in stops:
                break
        return -1

    while at < size:
        found = _TOKEN.match(page, at)
        if not found:  # an unfinished tag ends the page
            break
        at = found.end()
        if text := found["text"]:
            if not out:
                add("link" if links else "word", text, owner)
                count = len(text.split())
                words += count
                subtrees[owner].own += count if articles else 0
            continue
        if raw := found["raw"]:
            if raw.lower() in FOREIGN and page[at - 2] == "/":
                continue
            ending = re.compile(rf"</{raw}\s*>", re.IGNORECASE).search(page, at)
            at = ending.end() if ending else size
            continue
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            index = innermost((name,))
            if index >= 0:
                leave(index)
            if not out:
                add(f">{name}", "", owner)
            continue
        if name in BLOCK and (index := innermost(("p",), ARTICLE | {"div", "section", "li", "td", "body"})) >= 0:
            leave(index)
        if name in CLOSES_ITSELF:
            same, stops = CLOSES_ITSELF[name]
            if (index := innermost(same.split(), stops)) >= 0:
                leave(index)
        marks, hidden = _words_of(found["attrs"]) if "=" in found["attrs"] or "hidden" in found["attrs"] else ((), False)
        if name in ARTICLE:
            dropped, doubtful = hidden or "comment" in marks, False
        elif name in ("html", "body"):
            dropped = doubtful = False
        else:
            dropped = hidden or name in DROPPED or name == "header" and not articles
            doubtful = name in FORMS or not MARKS.isdisjoint(marks) or not articles and not HEADERS.isdisjoint(marks)
        dropped = dropped and not everything
        doubtful = doubtful and not dropped and not out and not everything
        opens = name not in VOID and not found["attrs"].endswith("/")
        inner = owner
        if doubtful:
            inner = len(subtrees)
            subtrees.append(_Doubtful(owner, articles > 0))
        if not out and (not dropped or name in BLOCK):
            add(f"<{name}", "", owner if name in BLOCK else inner)
        if opens:
            stack.append((name, dropped, owner, words))
            standing[name] += 1
            owner = inner
            out += dropped
            articles += name in ARTICLE
            links += name == "a"
    leave(0)
    subtrees[0].words = words
    if len(subtrees) == 1:
        return tokens
    kept = _kept(subtrees)
    return [token for token, tree in zip(tokens, owners) if kept[tree]]


def _size(feature: str, text: str) -> int:
    return len(text.split()) if text else feature[0] in "<>"


def best_run(tokens: list[tuple[str, str]], weights: dict[str, float]) -> tuple[int, int]:
    """First and one past the last token of the run with the highest positive sum; the first such run on a tie.

    An unknown tag weighs nothing. (0, 0) if no sum is positive."""
    best, run = 0.0, 0.0
    start, where = 0, (0, 0)
    for index, (feature, text) in enumerate(tokens):
        if run <= 0:
            run, start = 0.0, index
        run += weights.get(feature, 0.0) * _size(feature, text)
        if run > best:
            best, where = run, (start, index + 1)
    return where


def whole_blocks(tokens: list[tuple[str, str]], first: int, last: int) -> tuple[int, int]:
    """The run widened to the block tags around it, so that no block is cut."""
    def inner(index: int) -> bool:
        return bool(tokens[index][1]) or tokens[index][0][1:] not in BLOCK

    while 0 < first < last and inner(first) and inner(first - 1):
        first -= 1
    while first < last < len(tokens) and inner(last):
        last += 1
    return first, last


def blocks(tokens: list[tuple[str, str]]) -> list[str]:
    """The texts between the block tags, references decoded, white space as single blanks, empty ones left out."""
    found, current = [], []
    for feature, text in [*tokens, ("<p", "")]:
        if text:
            current.append(references.unescape(text))
        elif feature[1:] in BLOCK:
            block = " ".join("".join(current).split())
            if block:
                found.append(block)
            current = []
        elif feature[1:] in ("br", "td", "th", "img"):
            current.append(" ")
    return found


def main_text(page: str, weights: dict[str, float]) -> str:
    tokens = read_tokens(page)
    first, last = whole_blocks(tokens, *best_run(tokens, weights))
    return "\n\n".join(blocks(tokens[first:last]))


def _counts(batches):
    """Tokens of each feature inside and outside the article of the labelled pages."""
    import pyarrow as pa

    for batch in batches:
        inside, outside = Counter(), Counter()
        for page in batch.column("_html").to_pylist():
            tokens = read_tokens(page, everything=True)
            opens = [i for i, (feature, _) in enumerate(tokens) if feature == "<article"]
            closes = [i for i, (feature, _) in enumerate(tokens) if feature == ">article"]
            if len(opens) != 1 or len(closes) != 1:
                continue
            for i, (feature, text) in enumerate(tokens):
                (inside if opens[0] <= i <= closes[0] else outside)[feature] += _size(feature, text)
        names = sorted(inside | outside)
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(names, pa.string()),
            "inside": pa.array([inside[n] for n in names], pa.int64()),
            "outside": pa.array([outside[n] for n in names], pa.int64()),
        })


#: Used where no page is labelled.
DEFAULT_WEIGHTS = {"word": 0.5, "link": -1.0, "<p": 1.0, ">p": 1.0, "<li": -1.0, "<a": -1.0, **{f"{sign}{name}": BORDER for sign in "<>" for name in sorted(ARTICLE)}}
#: Tags that weights are learned for; the rest weigh nothing, so what is collected is bounded.
LEARNED = frozenset("a b blockquote body br dd div dl dt em figcaption figure h1 h2 h3 h4 h5 h6 hr html i img li ol p pre section span strong table td th tr u ul".split())


def learn_weights(pages: DataFrame, id_col="page_id", html_col="html", sample: int = SAMPLE) -> dict[str, float]:
    """Feature to ``ln(P(feature | inside) / P(feature | outside))``, with one added to every count, cut at +-CLIP."""
    labelled = pages.filter(F.col(html_col).rlike("(?i)<article[ >]")).select(F.col(id_col).alias("_id"))
    chosen = labelled.filter("_id IS NOT NULL").distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html")).join(F.broadcast(chosen), "_id").select("_html")
    features = ["word", "link", *[f"{sign}{name}" for name in sorted(LEARNED) for sign in "<>"]]
    rows = (
        texts.filter("_html IS NOT NULL").mapInArrow(_counts, "feature string, inside long, outside long")
        .filter(F.col("feature").isin(features)).groupBy("feature").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect()
    )
    ins, outs = sum(r["i"] for r in rows), sum(r["o"] for r in rows)
    if not rows or not ins:
        return dict(DEFAULT_WEIGHTS)
    weights = {}
    for r in rows:
        value = math.log((r["i"] + 1) / (ins + len(rows))) - math.log((r["o"] + 1) / (outs + len(rows)))
        weights[r["feature"]] = max(-CLIP, min(CLIP, value))
    borders = {f"{sign}{name}": BORDER for sign in "<>" for name in ARTICLE}
    return {**DEFAULT_WEIGHTS, **weights, **borders, "word": max(weights.get("word", 0.5), 0.05)}


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html", weights: dict[str, float] | None = None) -> DataFrame:
    """One row per input row: ``id, url, text, n_chars``. A null or empty page, or one without a positive run, has an
    empty text. Whole pages are read; repeated rows are read each; other columns are ignored."""
    weights = learn_weights(pages, id_col, html_col) if weights is None else weights
    lean = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(html_col, F.lit("")).alias("_html"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(page, weights) for page in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string())], names=["_id", "_url", "_text"]
            )

    schema = lean.select("_id", "_url", F.lit("").alias("_text")).schema
    return lean.mapInArrow(run, schema).select(
        F.col("_id").alias(id_col), F.col("_url").alias(url_col), F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars")
    )
