"""Each operator against a plain version, on small and awkward tables."""

import hashlib
import html as references
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from machpulse.sources.storage import stored
from machpulse.llm import archive, bpe, fingerprints, html, lm, mixing, neardup, passages, quality, urls
from machpulse.llm.graph import components
from machpulse.llm.queries import archive_records, rank_file, split_pattern
from tests.llm.cases import documents, lower, messy, prose, words


def by_id(rows):
    return {r.doc_id: r for r in rows}


# 1. Byte-level BPE


def test_ids_equal_those_of_the_library(spark):
    import tiktoken

    coder = tiktoken.Encoding("own", pat_str=split_pattern(), mergeable_ranks=bpe.read_ranks(rank_file()), special_tokens={})
    texts = [*[t for _, t, _ in messy()], "a" * 5000, "y" * 256, "y" * 257, "  \n\n  x", "don't it'S   ok", "é" * 400, "<|endoftext|>", "\x85\u2028 \u3000x"]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    rows = bpe.encode(docs, rank_file(), split_pattern()).withColumn("raw", bpe.decode(F.col("ids"), rank_file())).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == coder.encode_ordinary(texts[r.doc_id] or ""), texts[r.doc_id]
        assert bytes(r.raw).decode() == (texts[r.doc_id] or "")
    assert bpe.encode(docs.limit(0), rank_file(), split_pattern()).count() == 0


def test_blocks_share_and_renew_their_numbering(spark, monkeypatch):
    docs = documents(spark, [(i, prose(random.Random(i), 80), "s") for i in range(60)], clash=False).coalesce(1)
    want = {r.doc_id: r.ids for r in bpe.encode(docs, rank_file(), split_pattern()).collect()}
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(bpe, "PIECES", 150)
    rows = docs.selectExpr("doc_id AS _id", "text AS _text").mapInArrow(
        bpe._segment(split_pattern(), bpe.read_ranks(rank_file())),
        "ids array<long>, counts array<int>, places array<int>, pieces array<array<bigint>>, known int",
    ).select("known").collect()
    assert len(rows) > 10 and len({r.known for r in rows}) > 2 and sum(r.known == 0 for r in rows) > 1
    assert {r.doc_id: r.ids for r in bpe.encode(docs, rank_file(), split_pattern()).collect()} == want


def test_long_pieces_merge_as_the_fold_does():
    ranks = bpe.read_ranks(rank_file())
    pairs = bpe.pair_ranks(ranks)
    rng = random.Random(3)
    for _ in range(200):
        parts = [ranks[bytes([rng.choice(b"abethn ")])] for _ in range(rng.randint(0, 60))]
        slow = list(parts)
        while True:
            best = min(((pairs[p], i) for i, p in enumerate(zip(slow, slow[1:])) if p in pairs), default=None)
            if best is None:
                break
            slow[best[1]: best[1] + 2] = [best[0]]
        assert bpe.merge_long(parts, pairs) == slow


def test_every_pair_is_found_in_one_slot_of_its_left_id():
    ranks = bpe.read_ranks(rank_file())
    pairs, (moves, slots) = bpe.pair_ranks(ranks), bpe._displaced(ranks)
    assert len(moves) == bpe.IDS and len(slots) < 4 * len(pairs)

    def rank(left, right):
        at = moves[left] + right
        return min(abs(slots[at] - left * bpe.PLACE), bpe.NO_RANK) if 0 <= at < len(slots) else bpe.NO_RANK

    assert all(rank(*pair) == r for pair, r in pairs.items())
    rng = random.Random(5)
    others = {(rng.randrange(len(ranks)), rng.randrange(len(ranks))) for _ in range(50_000)} - set(pairs)
    assert all(rank(*pair) >= bpe.IDS for pair in others)


def test_pieces_are_sent_with_the_ranks_of_their_byte_pairs(spark):
    ranks = bpe.read_ranks(rank_file())
    docs = documents(spark, [(1, "the " + "a" * 300 + " x", "s")], clash=False)
    (row,) = docs.selectExpr("doc_id AS _id", "text AS _text").mapInArrow(
        bpe._segment(split_pattern(), ranks),
        "ids array<long>, counts array<int>, places array<int>, pieces array<array<bigint>>, known int",
    ).collect()
    first, long, last = ([(x >> 36, x >> 17 & bpe.NO_RANK, x & bpe.NO_RANK) for x in piece] for piece in row.pieces)
    assert first == [
        (ranks[b"th"], 0, ranks[b"t"]), (ranks[b"he"], 1, ranks[b"h"]), (bpe.NO_RANK, 2, ranks[b"e"]),
    ]
    # A long piece comes joined; the place starts anew in the piece after it.
    assert {rank for rank, _, _ in long} == {bpe.NO_RANK} and len(long) < 300
    assert [(place, part) for _, place, part in last] == [(0, ranks[b" "]), (1, ranks[b"x"])]


def test_slots_part_pairs_by_their_bits_alone(spark):
    ranks = bpe.read_ranks(rank_file())
    pairs, (moves, slots) = bpe.pair_ranks(ranks), bpe._displaced(ranks)
    rng = random.Random(11)
    some = rng.sample(sorted(pairs), 2000) + [(rng.randrange(len(ranks)), rng.randrange(len(ranks))) for _ in range(2000)]
    assert min(slots) >= 0
    for left, right in some:
        at = moves[left] + right
        left_over = slots[at] ^ left << 17 if 0 <= at < len(slots) else bpe.NO_RANK
        assert left_over == pairs[left, right] if (left, right) in pairs else left_over >= bpe.NO_RANK


def test_decoding_refuses_ids_beyond_the_ranks(spark):
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        spark.range(1).select(bpe.decode(F.array(F.lit(1 << 20)), rank_file())).collect()


# 2. Mix


def plain_targets(sizes, passes=3, weights=(1, 2, 3)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in stopped]
        share = total - sum(stopped.values())
        target = {s: share * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if target[s] > passes * sizes[s]]
        if not over:
            return {**stopped, **target}
        stopped |= {s: passes * sizes[s] for s in over}


def test_mix_meets_targets_and_budget(spark):
    rows = messy(count=300)
    got = mixing.mix(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.size, r.source or "") for r in got) == sorted((str(i), len(words(t)), s or "") for i, t, s in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    targets, taken = plain_targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken in {c * r.size for c in range(4)} and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    total, longest = sum(sizes.values()), defaultdict(int)
    for r in got:
        longest[r.source] = max(longest[r.source], r.size)
    assert total - max(longest.values()) <= sum(taken.values()) <= total
    for s in sizes:
        # What a long document leaves open, the other sources fill.
        assert abs(taken[s] - targets[s]) <= longest[s] + max(longest.values()) * targets[s] / total + 1
    again = mixing.mix(documents(spark, rows).repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.source or "", r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_takes_in_order_of_finish_time(spark):
    """The shuffled order of each source is Spark's hash; everything after it is done again here."""
    rows = [r for r in messy(count=120) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    docs = documents(spark, rows)
    key = F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source"))
    size = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")
    hashed = docs.select("doc_id", "source", key.alias("k"), size.alias("z"))
    order = {r.doc_id: r for r in hashed.withColumn("h", F.xxhash64(F.lit(7), "k", "doc_id", "z")).collect()}
    sizes = Counter()
    for r in order.values():
        sizes[r.source] += r.z
    targets, copies = plain_targets(sizes), []
    for s in sizes:
        run = 0
        for r in sorted((r for r in order.values() if r.source == s), key=lambda r: (r.h % (1 << 64), r.doc_id)):
            run += r.z
            if r.z and targets[s]:
                copies += [((run + turn * sizes[s]) / targets[s], r.k, r.h, r.doc_id, r.z) for turn in range(3)]
    left, want = sum(sizes.values()), Counter()
    for _, _, _, i, z in sorted(copies):
        if z > left:
            break
        left -= z
        want[i] += z
    assert {r.doc_id: r.taken for r in mixing.mix(docs).collect()} == {i: want[i] for i in order}


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [(1, "a", "s")]).limit(0)).count() == 0
    only = mixing.mix(documents(spark, [(1, None, "s"), (2, " ", None)])).collect()
    assert [(r.size, r.taken, r.target) for r in only] == [(0, 0, 0.0)] * 2


# 3. URLs


def test_cascade_is_exact_for_its_universe(spark):
    universe = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.filter("crc32(key) % 7 = 0").unionByName(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    cascade = urls.build_cascade(listed, universe)
    wrong = universe.filter(cascade.listed(F.col("key")) != F.expr("crc32(key) % 7 = 0")).count()
    assert wrong == 0 and len(cascade.levels) > 1
    nothing = urls.build_cascade(listed.limit(0), universe)
    assert universe.filter(nothing.listed(F.col("key"))).count() == 0
    with pytest.raises(ValueError):
        urls.build_cascade(listed, universe, max_bytes=8)


def test_urls_by_rule_list_and_edge_cases(spark):
    cases = {
        "https://a.example.net/en/x": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "HTTP://A.Example.NET/de/": ("a.example.net", "/de/", "net/", "block"),
        "http://example.com/de/1?q#f": ("example.com", "/de/1", "example.com/de/", "block"),
        "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"),
        "http://spam.org/fr/": ("spam.org", "/fr/", "org/fr/", "allow"),
        "http://x.bad.org/en/": ("x.bad.org", "/en/", None, "block"),
        "http://verybad.org/en/": ("verybad.org", "/en/", None, "allow"),
        "http://a.net?x": ("a.net", "", None, "allow"),
        "http://a.net#/x": ("a.net", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "x://y://z/p": ("y:", "//z/p", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://" + "a." * 20_000 + "bad.org/" + "p" * 50_000: ("a." * 20_000 + "bad.org", "/" + "p" * 50_000, None, "block"),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(0, next(iter(cases)))]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS key")
    from machpulse.llm.queries import URL_RULES

    listed = spark.createDataFrame([("bad.org",)], "key string")
    got = urls.filter_urls(pages, listed, URL_RULES).collect()
    want = list(cases.values())
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == want[r.page_id]
    assert urls.filter_urls(pages.limit(0), listed, URL_RULES).count() == 0


# 4. Revisits


def plain_revisits(records):
    out = []
    for rid, kind, url, ts, headers, _ in records:
        if kind != "revisit":
            continue
        before = [r for r in records if r[1] == "response" and r[2] == url and r[3] is not None and ts is not None and url is not None and r[3] < ts]
        best = max(before, key=lambda r: (r[3], r[0]), default=None)
        status, ref = "no earlier response", None
        if best:
            tag, date = [(headers or {}).get(n) for n in ("etag", "last-modified")], [(best[4] or {}).get(n) for n in ("etag", "last-modified")]
            strip = lambda t: t.removeprefix("W/")
            same = strip(tag[0]) == strip(date[0]) if tag[0] and date[0] else tag[1] is not None and tag[1] == date[1]
            status = "resolved" if same else "validators differ"
            ref = best[0] if same else None
        out.append((rid, ts, status, ref))
    return sorted(out, key=str)


def test_listed_keys_of_many_labels(spark):
    long = ".".join("abcdefghijk")
    pages = spark.createDataFrame([(1, f"http://{long}/"), (2, f"http://www.{long}/x"), (3, f"http://{long[2:]}/")], "page_id long, url string")
    got = urls.filter_urls(pages, spark.createDataFrame([(long,), (None,)], "key string"), ())
    assert {r.page_id: r.verdict for r in got.collect()} == {1: "block", 2: "block", 3: "allow"}


def test_url_lists_beyond_the_filter_bound(spark):
    keys = [f"k{i}.example.com" for i in range(3000)]
    hosts = [k for k in keys if zlib.crc32(k.encode()) % 3 == 0]
    pages = [(i, f"http://{'www.' * (i % 2)}{k}/x") for i, k in enumerate(keys)] + [(-1, None), (-2, f"http://{hosts[0]}/"), (-2, f"http://{hosts[0]}/")]
    frame = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "true AS _known", "'x' AS key")
    listed = spark.createDataFrame([(h,) for h in [*hosts, hosts[1], None]], "key string")
    assert urls.parts_needed(len(hosts), 4000, 1000) > 1 == urls.parts_needed(len(hosts), 4000, 1 << 20)
    want = sorted((i, "block" if u and u[7:].split("/")[0].removeprefix("www.") in set(hosts) else "allow") for i, u in pages)
    for bound in (1000, 1 << 20):
        got = urls.filter_urls(frame, listed, (), max_bytes=bound).collect()
        assert sorted((r.page_id, r.verdict) for r in got) == want
        assert all(r.listed == (r.verdict == "block") for r in got)


def test_revisits_as_of(spark):
    rng = random.Random(5)
    records = []
    for i in range(600):
        url = rng.choice(["hot.org/a"] * 6 + ["b.org/x", "c.org", None])
        headers = {n: rng.choice(v) for n, v in (("etag", ['"1"', 'W/"1"', '"2"']), ("last-modified", ["d1", "d2"])) if rng.random() < 0.7}
        records.append((i, rng.choice(["response", "revisit"]), url, rng.choice([None, *range(200)]), headers or None, "p"))
    records += [records[0], records[1]]
    schema = "record_id long, kind string, url string, ts long, headers map<string,string>, payload_digest string"
    frame = spark.createDataFrame(records, schema).selectExpr("*", "1 AS slice", "2 AS id", "3 AS status")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = sorted(((r.record_id, r.ts, r.status, r.refers_to) for r in archive.resolve_revisits(frame).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert got == plain_revisits(records)
    assert archive.resolve_revisits(frame.limit(0)).count() == 0


def test_canonical_urls_and_merged_headers(spark):
    urls_in = {
        "HTTP://WWW.A.org:80/x/?utm_source=f&b=2&a=1#top": "a.org/x?a=1&b=2", "https://a.org": "a.org", "https://a.org/?ref=x": "a.org",
        "a.org/x": "a.org/x", "": "", None: None,
    }
    frame = spark.createDataFrame([(u,) for u in urls_in], "url string").select("url", archive.canonical_url(F.col("url")).alias("c"))
    assert {r.url: r.c for r in frame.collect()} == urls_in
    pair = spark.createDataFrame([({"date": "2", "content-length": "0", "expires": None}, {"date": "1", "content-length": "9"})], "a map<string,string>, b map<string,string>")
    assert pair.select(archive.merged(F.col("a"), F.col("b"))).first()[0] == {"date": "2", "content-length": "9"}


# 5. Main text


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div id="cookie-notice">We use cookies here</div><!-- <p>no</p> --><div class="left sidebar"><p>Side words</p></div>
<article><h1>Title &eacute;&amp;&#x27;</h1><p>First   part with <a href="x">a link</a>
and&nbsp;more.<p><b>Second<br>part.</b><div class="ad">Buy now</div><script>if (a<b) w("<p>no</p>")</script>
<ul><li>item one<li>item two</ul><form><input name="q"><label>Search</label></form><table><tr><td>c1</td><td>c2</td></tr></table>
<p>Last.</p></article><section class="comments"><p>I am a reader and this is a long comment by me.</p></section>
<footer>&copy; foot</footer></body></html>"""


def test_main_text_of_a_page(spark):
    weights = html.DEFAULT_WEIGHTS
    assert html.main_text(PAGE, weights).split("\n\n") == [
        "Title é&'", "First part with a link and more.", "Second part.", "item one", "item two", "c1 c2", "Last.",
    ]
    bare = PAGE.replace("<article>", '<div class="content">').replace("</article>", "</div>")
    assert "Second part." in html.main_text(bare, weights) and "Two" not in html.main_text(bare, weights)
    for broken in ("", "<", "<p", "<p>a <b c", "text only", "<script>x", "<a href='", "<!--", "</div></p>", "&#xZZ; &amp"):
        html.main_text(broken, weights)
    assert html.main_text("<article>" + "<p>ab cd" * 50_000, weights).count("\n\n") == 49_999


WRAPPERS = [
    '<div class="with-sidebar">', '<div class="site has-sidebar">', '<div class="comments-open">', '<div class="noBanner">', '<div id="ad-free">',
    '<div class="widget"><div class="banner">', '<form id="page"><fieldset>', '<main><div class="content sidebar-right">', '<div class="header-layout">',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_main_text_in_marked_subtrees_and_forms(wrapper):
    weights = html.DEFAULT_WEIGHTS
    want = html.main_text(PAGE, weights)
    ending = "".join(f"</{x.split()[0]}>" for x in reversed(wrapper.replace(">", "").split("<")[1:]))
    around = PAGE.replace("<article>", f"{wrapper}<article>").replace("</article>", f"</article>{ending}")
    assert html.main_text(around, weights) == want
    whole = PAGE.replace("<body>", f"<body>{wrapper}").replace("</body>", f"{ending}</body>")
    assert html.main_text(whole, weights).endswith(want) and ("<main>" in wrapper or html.main_text(whole, weights) == want)
    plain = f"<body><p>Hi</p>{wrapper}<p>{'All of the text. ' * 9}</p><div class='share'>Send</div>{ending}<footer>foot</footer></body>"
    assert "All of the text." in html.main_text(plain, weights) and "Send" not in html.main_text(plain, weights)


def test_cards_and_long_comments_still_go():
    weights = html.DEFAULT_WEIGHTS
    want = html.main_text(PAGE, weights)
    cards = '<div class="related"><article><p>Another story.</p></article><article><p>And one more.</p></article></div>'
    comments = '<div id="comments"><p>' + "I do not agree. " * 100 + "</p></div>"
    assert html.main_text(PAGE.replace("<footer>", f"{cards}{comments}<footer>"), weights) == want
    wide = PAGE.replace("<article>", '<div class="has-sidebar banner"><article>').replace("</article>", f"</article>{cards}</div>")
    assert html.main_text(wide, weights) == want


OWN_NAMES = [
    '<h2 id="related-work">Related work here</h2>', '<section id="search-algorithms"><p>How to search.</p></section>',
    '<p class="notice-period">A notice period of a month.</p>', '<div class="tasting-menu"><p>Five courses.</p></div>',
    '<figure class="market-share"><figcaption>Share of the market.</figcaption></figure>', '<p>The sum <math><mi>x</mi><mo>+</mo><mi>y</mi></math> grows.</p>',
    '<p>Read <span aria-hidden="true">this sign</span> too.</p>', '<p data-class="ad" id="adverbs">On adverbs.</p>',
]


@pytest.mark.parametrize("part", OWN_NAMES)
def test_parts_with_names_of_their_own_stay(part):
    import re

    weights = html.DEFAULT_WEIGHTS
    words_of = " ".join(re.sub(r"<[^>]*>", " ", part).split())
    found = " ".join(html.main_text(PAGE.replace("<p>Last.", f"{part}<p>Last."), weights).split())
    assert words_of.replace(" ", "") in found.replace(" ", "") and "Buy now" not in found and "reader" not in found


@pytest.mark.parametrize("mark", [
    'class="ad-slot-1"', 'id="left_sidebar"', 'class="x shareButtons"', 'class="related-posts"', 'id="comments-section"', 'role="navigation"',
    'class="newsletter-signup-box"', 'class="cookie-notice"',
])
def test_marked_parts_go(mark):
    weights = html.DEFAULT_WEIGHTS
    assert html.main_text(PAGE.replace("<p>Last.", f"<div {mark}><p>Not this one.</p></div><p>Last."), weights) == html.main_text(PAGE, weights)


def test_hostile_pages_take_linear_time():
    import time

    weights = html.DEFAULT_WEIGHTS
    began = time.process_time()
    pages = [
        "<div><i>" * 20_000 + "x" + "</p>" * 20_000, "<p>" + "<i>" * 40_000 + "</b>" * 40_000, "<i>" * 30_000 + "<li>a" * 30_000, "<div>" * 60_000 + "y",
        "<ul>" + "<li><a href=x>b" * 30_000, "<svg>" * 30_000, "<a b='" * 30_000, "<!--" * 30_000, "<" * 100_000, "&amp" * 50_000,
    ]
    for page in pages:
        html.main_text(page, weights)
    assert time.process_time() - began < 20


@pytest.mark.parametrize("icon", ['<svg class="i"/>', '<svg viewBox="0 0 1 1" />', "<math/>", "<SVG />"])
def test_self_closed_icons_end_at_once(icon):
    weights = html.DEFAULT_WEIGHTS
    assert html.main_text(PAGE.replace("<h1>Title", f"{icon}<h1>Title"), weights) == html.main_text(PAGE, weights)
    later = PAGE.replace("<h1>Title", f"{icon}<h1>Title").replace("Last.", "<svg><text>no</text></svg>Last.")
    assert html.main_text(later, weights) == html.main_text(PAGE, weights)


def test_best_run_is_the_best(spark):
    rng = random.Random(2)
    weights = {"word": 1.0, "<li": -2.0, "<p": 0.5}
    for _ in range(100):
        tokens = [(f, "x" if f == "word" else "") for f in rng.choices(list(weights), k=rng.randint(0, 12))]
        sums = {(i, j): sum(weights[f] for f, _ in tokens[i:j]) for i in range(len(tokens)) for j in range(i + 1, len(tokens) + 1)}
        i, j = html.best_run(tokens, weights)
        assert sum(weights[f] for f, _ in tokens[i:j]) == max([0.0, *sums.values()])


def test_extraction_of_a_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>a b c</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars", "2 AS _id")
    got = html.extract(pages).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (2, 3)] == ["", ""]
    assert html.extract(pages.limit(0)).count() == 0
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    import re

    want = {
        r.page_id: "\n\n".join(b for b in (
            " ".join(references.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split())
            for x in re.split(r"</?(?:p|h1|h2)>", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        ) if b)
        for r in given.collect()
    }
    assert {r.page_id: r.text for r in html.extract(given).collect()} == want


# 6. Near-duplicates


def plain_components(rows, width, percent=80):
    sets, parent = [], {i: i for i, _, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, text, _ in rows:
        w = words(lower(text))
        sets.append((i, {tuple(w[k: k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()))
    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1:]:
            if x and y and i is not None and j is not None and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i in parent}, sets


def copies(rng, text, share):
    w = text.split()
    for _ in range(max(0, round(len(w) * share))):
        w[rng.randrange(len(w))] = f"new{rng.randrange(60)}"
    return " ".join(w)


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_brute_force(spark, width):
    rng = random.Random(width)
    rows = messy(count=40)
    for group in range(4):
        base = prose(rng, rng.choice([12, 60, 200]))
        rows += [(1000 * (group + 1) + i, copies(rng, base, rng.choice([0, 0.01, 0.02, 0.03, 0.05, 0.1])), "s") for i in range(60)]
    chain = prose(rng, 100)
    for i in range(30):
        chain = copies(rng, chain, 0.02)
        rows.append((9000 - i, chain.upper() if i % 3 == 0 else chain, "s"))
    passage = prose(rng, 30)
    rows += [(9500 + i, passage + " " + prose(rng, rng.randint(1, 60)), "s") for i in range(60)]
    want, sets = plain_components(rows, width)
    got = neardup.near_duplicates(documents(spark, rows), width=width).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sorted((str(i), len(s)) for i, s in sets)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    assert neardup.near_duplicates(documents(spark, rows).limit(0)).count() == 0


def test_pairs_under_a_hub_grow_with_its_members(spark):
    """Excerpts of one long text, and texts with edits of their own, all members of one hub and none linked yet."""
    def pairs(kind, count):
        rng = random.Random(count)
        rows = [(0, list(range(1000, 2000)))]
        for i in range(1, count + 1):
            if kind == "excerpts":
                begin = rng.randrange(2000)
                rows.append((i, list(range(begin, begin + 1000))))
            else:
                changed = {p + k for p in rng.sample(range(1000, 1996), 60) for k in range(4)}
                rows.append((i, [s + 10_000 * rng.randrange(1, 10**9) if s in changed else s for s in range(1000, 2000)]))
        sets = spark.createDataFrame([(i, len(h), h) for i, h in rows], "_id long, n long, hashes array<long>")
        full = {i: set(h) for i, h in rows}

        def alike(a, b):
            return 100 * len(full[a] & full[b]) >= 80 * len(full[a] | full[b])

        # Every member has met the hub before.
        root = {i: 0 if alike(i, 0) else i for i in full}
        marked = spark.createDataFrame(
            [(0, i, len(h), root[i], 0) for i, h in rows], "hub long, rep long, n long, component long, hub_component long"
        )
        placed = stored(neardup._meeting(marked, sets, 80), "test-meeting")
        near = neardup._nearest_pairs(placed, 80)
        assert near.count() <= count + 1
        links = stored(neardup._confirmed(near, sets, 80), "test-links")
        rest = neardup._open_pairs(stored(neardup._joined_components(placed, links), "test-meeting"), 80)
        for a, b in [tuple(r) for r in links.collect()] + [tuple(r) for r in neardup._confirmed(rest, sets, 80).collect()]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
        assert all(root[a] == root[b] for a in full for b in full if alike(a, b))
        return rest.count()

    assert max(pairs("excerpts", 100), pairs("excerpts", 200)) <= 200
    assert pairs("edits", 200) <= 20


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 100), (7, 7), (200, 201), (201, 202), (202, 200)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**dict.fromkeys(range(1, 61), 1), 90: 90, 100: 90, 200: 200, 201: 200, 202: 200}


# 7. Language model


def plain_scores(rows, strength, order=2):
    """Every word by recursion over its history."""
    texts = [(i, [*words(lower(t)), "\x00end"]) for i, t, _ in rows]
    learn = [w for i, w in texts if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    grams = Counter()
    for w in learn:
        w = ["\x00s", *w]
        grams.update(tuple(w[at - k: at]) for k in range(1, order + 1) for at in range(k, len(w) + 1))
    n = sum(len(w) for w in learn)
    v = len({x for w in learn for x in w})

    def base(x):
        return (grams[x,] + 0.1) / (n + 0.1 * (v + 1))

    def weight(history, x):
        if not history:
            return base(x)
        lower_weight = weight(history[1:], x)
        return (grams[(*history, x)] + strength * lower_weight) / (grams[history] + strength)

    out = []
    for i, w in texts:
        full = ["\x00s", *w]
        score = sum(math.log10(weight(tuple(full[max(0, at - order + 1): at]), full[at])) for at in range(1, len(full)))
        out.append((str(i), len(w), sum(grams[x,] > 0 for x in w), n, sum(math.log10(base(x)) for x in w), score))
    return sorted(out)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_brute_force(spark, order):
    rows = messy()
    frame = lm.score(documents(spark, rows), block_bytes=20_000, order=order)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in frame.collect())
    want = plain_scores(rows, lm.STRENGTH, order)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-6)
    assert lm.score(documents(spark, rows).limit(0), order=order).count() == 0
    alone = lm.score(documents(spark, [(1, "a b", "s")]).withColumn("doc_id", F.lit(None).cast("long")), order=order).first()
    assert alone.held_out and alone.train_tokens == 0


def test_scores_over_several_hops(spark):
    rows = messy()
    frame = lm.score(documents(spark, rows).repartition(3), block_bytes=20_000, fan_out=2)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in frame.collect())
    want = plain_scores(rows, lm.STRENGTH)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-6)


@pytest.mark.parametrize("blocks,fan_out", [(1, 4), (4, 4), (5, 4), (17, 4), (64, 4), (65, 4), (3840, 4096), (13_000_000, 4096)])
def test_hops_join_all_blocks_and_stay_linear(blocks, fan_out):
    fans = lm.hops(blocks, fan_out)
    groups, ranges = blocks, 1
    for fan in fans:
        assert fan <= fan_out
        assert groups * ranges * fan <= 2 * blocks * fan_out + fan_out ** 2  # messages of the hop
        groups, ranges = -(-groups // fan), ranges * fan
    assert groups == 1 and blocks <= ranges <= 2 * blocks


def test_messages_keep_every_key_in_its_range():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    keys[0] = 0
    first = lm._messages(keys, np.arange(len(keys), dtype=np.uint32), sender=9, part=0, parts=1, fan=5)
    assert first.column("_group").to_pylist() == [1] * 5 and first.column("_part").to_pylist() == list(range(5))
    assert np.array_equal(np.concatenate([lm._unpack(k, np.uint64) for k in first.column("_keys").to_pylist()]), keys)
    second = []
    for row in first.to_pylist():
        again = lm._messages(lm._unpack(row["_keys"], np.uint64), lm._unpack(row["_counts"], "u4"), row["_group"], row["_part"], 5, 4)
        second += again.to_pylist()
    assert [r["_part"] for r in second] == list(range(20))
    for row in second:
        found = lm._unpack(row["_keys"], np.uint64).tolist()
        assert all(k * 20 >> 64 == row["_part"] for k in found)


def test_equal_rows_are_dealt_to_several_blocks(spark):
    rows = [(None, "a b c", "s")] * 400
    frame = documents(spark, rows).repartition(8)
    got = lm.score(frame, block_bytes=200).collect()
    assert len(got) == 400 and len({r.score for r in got}) == 1
    blocks = frame.select(lm.block_of(40, "doc_id", "text").alias("b")).groupBy("b").count().collect()
    assert len(blocks) > 1 and max(r["count"] for r in blocks) < 400


@pytest.mark.parametrize("order", [2, 3])
def test_arcs_of_a_state_sum_to_one(spark, order):
    rows = [(i, prose(random.Random(i), 40, 20), "s") for i in range(30)]
    learn = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 10]
    vocabulary = sorted({w for _, t, _ in learn for w in words(lower(t))})
    # Probes must not be learned from: ids whose checksum is divisible by 10.
    ids = iter(i for i in range(10**5, 10**7) if zlib.crc32(str(i).encode()) % 10 == 0)
    texts = ["zzz", "w3", "zzz w3", "w3 zzz", *[f"{p}{w}" for w in vocabulary for p in ("", "zzz ", "w3 ")]]
    probes = {t: next(ids) for t in dict.fromkeys(texts)}
    frame = lm.score(documents(spark, learn + [(i, t, "s") for t, i in probes.items()]), order=order)
    got = by_id(frame.collect())
    score, plain = ({t: getattr(got[i], name) for t, i in probes.items()} for name in ("score", "base_score"))
    # "zzz" is in no training text: after it the automaton is at its root.
    n, v = got[probes["zzz"]].train_tokens, len(vocabulary) + 1
    end = math.log10((len(learn) + 0.1) / (n + 0.1 * (v + 1)))
    zzz_first = score["zzz"] - end

    def end_after(w):
        return score[f"zzz {w}"] - zzz_first - (plain[w] - end)

    w3_first = score["w3"] - end_after("w3")
    total = 10 ** end_after("w3") + 10 ** (score["w3 zzz"] - w3_first - end)
    if order == 2:
        total += sum(10 ** (score[f"w3 {w}"] - w3_first - end_after(w)) for w in vocabulary)
        assert total == pytest.approx(1, abs=1e-9)
    # Of any order: all arcs and failures out of one state, added up on the automaton itself.
    grams = Counter()
    for _, t, _ in learn:
        w = ["^", *words(lower(t)), "$"]
        grams.update(tuple(w[at - k: at]) for k in range(1, order + 1) for at in range(k, len(w) + 1))
    history = max((g for g in grams if len(g) == order - 1 and "$" not in g), key=lambda g: grams[g])
    import numpy as np

    mass = 0.0
    for x in [*vocabulary, "$", "zzz"]:
        line = [*history, x]
        count = np.array([[grams[tuple(line[max(0, at - k + 1): at + 1])] if at >= k - 1 else 0 for at in range(len(line))] for k in range(1, order + 1)], float)
        base = (count[0] + 0.1) / (n + 0.1 * (v + 1))
        arcs, fails, known = lm.automaton(count, base, lm.STRENGTH)
        k, weight, at = order - 1, 0.0, len(line) - 1
        assert known[k, at - 1]
        while np.isneginf(arcs[k, at]):
            weight += fails[k, at]
            k -= 1
        mass += 10 ** (weight + arcs[k, at])
    assert mass == pytest.approx(1, abs=1e-9)


# 8. Quality


def plain_facts(text):
    w = words(text)
    windows = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i: i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_facts_and_verdicts(spark):
    rng = random.Random(4)
    rows = messy() + [
        (300, "a b c " * 30, "s"), (301, "x x x x", "s"), (302, "a b\nA b\na b\n \n\na b", "s"), (303, "#|# <b> $5 &&", "s"),
        (304, prose(rng, 60) + "\n" + prose(rng, 3) * 2, "s"), (305, " ".join(f"zq{i}***" for i in range(200)), "s"),
    ]
    labels = spark.createDataFrame([(i, int(i != 305), 0) for i, _, _ in rows if i is not None], "doc_id long, quality int, toxic int")
    got = quality.judge(documents(spark, rows), labels).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r.doc_id), *[r[f] for f in fields]) for r in got) == sorted((str(i), *plain_facts(t)) for i, t, _ in rows)
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    verdict = {r.doc_id: r for r in got}
    assert not verdict[305].base_failed and not verdict[305].kept and verdict[103].kept
    again = quality.judge(documents(spark, rows).repartition(5), labels).collect()
    assert sorted((str(r.doc_id), r.score) for r in again) == sorted((str(r.doc_id), r.score) for r in got)
    assert quality.judge(documents(spark, rows).limit(0), labels).count() == 0
    unlabelled = quality.judge(documents(spark, rows), labels.limit(0)).collect()
    assert len(unlabelled) == len(rows) and all(r.kept != r.base_failed and r.score == 0 for r in unlabelled)


def test_quality_score_is_the_mean_ratio(spark):
    rows = [(i, prose(random.Random(i), 60, 30), "s") for i in range(20)]
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(20)], "doc_id long, quality int, toxic int")
    buckets = 1 << 16
    every = spark.createDataFrame([(w,) for w in {w for _, t, _ in rows for w in words(t)}], "w string")
    place = {r.w: r.b for r in every.select("w", F.pmod(F.xxhash64("w"), F.lit(buckets)).alias("b")).collect()}
    raw, good = Counter(), Counter()
    for i, t, _ in rows:
        raw.update(place[w] for w in words(t))
        if i % 2:
            good.update(place[w] for w in words(t))
    ns, gs = sum(raw.values()) + buckets, sum(good.values()) + buckets
    for r in quality.judge(documents(spark, rows), labels).collect():
        w = [place[x] for x in words(rows[r.doc_id][1])]
        want = sum(math.log((good[b] + 1) / gs) - math.log((raw[b] + 1) / ns) for b in w) / len(w)
        assert r.score == pytest.approx(want, abs=1e-8)


# 9. Shared passages


def test_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(8)
    fresh = lambda n: " ".join(f"{rng.randrange(10**9):x}" for _ in range(n))
    passage, rows = fresh(60), []
    for i in range(40):
        rows.append((i, fresh(rng.randint(1, 200)), "s"))
    for i in range(40, 60):
        rows.append((i, fresh(rng.randint(1, 50)) + "\n" + passage + " " + fresh(rng.randint(0, 50)), "s"))
    rows += [(70, rows[3][1], "s"), (None, rows[3][1], "s"), rows[50], (71, None, "s"), (72, "", "s"), (73, "é" * 5, "s")]
    rows += [(74, fresh(40) + "\n" + passage + "\n" + passage, "s"), (75, fresh(300_000), "s")]
    got = passages.remove_repeats(documents(spark, rows), carry=("lang", "value")).collect()
    assert len(got) == len(rows) and {(r.lang, r.value) for r in got} == {("en", "x")}
    texts = dict((i, t) for i, t, _ in rows)
    for r in got:
        before = (texts[r.doc_id] or "").encode()
        kept, at = b"", 0
        for span in r.removed_spans:
            kept, at = kept + before[at: span.begin], span.end
        assert r.text == (None if texts[r.doc_id] is None else (kept + before[at:]).decode())
        if r.doc_id is not None and (r.doc_id <= 40 or r.doc_id in (71, 72, 73, 75)):
            assert r.text == texts[r.doc_id] and r.first_ids == []
        elif r.doc_id in range(41, 60) or r.doc_id == 74:
            assert r.removed_bytes > 0.5 * len(passage) and 40 in r.first_ids
        elif r.doc_id != 40:
            assert r.text == "" or len(r.text) < 60
    assert passages.remove_repeats(documents(spark, rows).limit(0)).count() == 0


def test_chunks_survive_insertions():
    import numpy as np

    rng = random.Random(1)
    text = " ".join(f"{rng.randrange(10**6)}" for _ in range(400)).encode()
    cuts = lambda raw: {raw[a:b] for a, b in zip([0, *passages.borders(np.frombuffer(raw, np.uint8))], passages.borders(np.frombuffer(raw, np.uint8)))}
    moved = text[:1000] + b"inserted" + text[1000:]
    assert len(cuts(text) - cuts(moved)) <= 2
    whole = passages.borders(np.frombuffer(text, np.uint8))
    old, passages.PIECE_BYTES = passages.PIECE_BYTES, 37
    try:
        assert list(passages.borders(np.frombuffer(text, np.uint8))) == list(whole)
        assert list(passages.chunk_digests(np.frombuffer(text, np.uint8))[1]) == list(passages.chunk_digests(np.frombuffer(text, np.uint8))[1])
    finally:
        passages.PIECE_BYTES = old


def test_groups_of_texts_are_cut_like_single_ones():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(12)
    texts = ["", "a", "é", "日本語テキスト" * 40, "x" * 500, "ab " * 300, prose(rng, 3000), None, "\n"] + [prose(rng, rng.randint(0, 120)) for _ in range(200)]
    old, passages.GROUP_BYTES = passages.GROUP_BYTES, 5000
    try:
        row = 0
        for first, ends, digests, firsts in passages._groups(pa.array(texts)):
            assert first == row
            for k in range(len(firsts) - 1):
                want = passages.chunk_digests(np.frombuffer((texts[row] or "").encode(), np.uint8))
                assert list(ends[firsts[k]: firsts[k + 1]]) == list(want[0]) and list(digests[firsts[k]: firsts[k + 1]]) == list(want[1])
                row += 1
        assert row == len(texts)
    finally:
        passages.GROUP_BYTES = old


def plain_removal(rows, min_words):
    """Text and removed spans per row, by comparing the bytes of all chunks."""
    import numpy as np

    def pieces(text):
        raw = (text or "").encode()
        ends = [0, *passages.borders(np.frombuffer(raw, np.uint8))]
        return raw, [raw[a:b] for a, b in zip(ends, ends[1:])]

    lowest = {}
    for i, text in rows:
        for piece in pieces(text)[1]:
            if i is not None:
                lowest[piece] = min(i, lowest.get(piece, i))
    found = []
    for i, text in rows:
        raw, cut_at = pieces(text)
        seen, runs, at = set(), [], 0
        for piece in cut_at:
            elsewhere = piece in lowest and (i is None or lowest[piece] < i)
            if elsewhere or piece in seen:
                if runs and runs[-1][1] == at:
                    runs[-1] = (runs[-1][0], at + len(piece))
                else:
                    runs.append((at, at + len(piece)))
            seen.add(piece)
            at += len(piece)
        runs = [(a, b) for a, b in runs if len(raw[a:b].split()) >= min_words]
        kept, at = b"", 0
        for a, b in runs:
            kept, at = kept + raw[at:a], b
        found.append((i, None if text is None else (kept + raw[at:]).decode(), tuple(runs)))
    return found


def test_removal_equals_brute_force(spark):
    rng = random.Random(21)
    shared = [prose(rng, 70, 4000) for _ in range(6)]
    rows = [(i, t) for i, t, _ in messy(seed=3)]
    for i in range(200, 320):
        parts = [prose(rng, rng.randint(5, 60), 4000)]
        if rng.random() < 0.6:
            passage = rng.choice(shared).split()
            begin = rng.randint(0, 30)
            parts.insert(rng.randint(0, 1), " ".join(passage[begin: begin + rng.randint(20, 70)]))
        rows.append((i, "\n".join(parts)))
    # One id, and no id, for many rows with unlike and equal texts.
    rows += [(400, rng.choice(shared) + " " + prose(rng, 20)) for _ in range(30)] + [(None, rng.choice(shared)) for _ in range(10)]
    got = passages.remove_repeats(documents(spark, [(i, t, "s") for i, t in rows])).collect()
    found = [(r.doc_id, r.text, tuple((s.begin, s.end) for s in r.removed_spans)) for r in got]
    assert sorted(found, key=str) == sorted(plain_removal(rows, passages.MIN_WORDS), key=str)


def test_passages_without_borders_are_cut():
    """Passages of few distinct words, each in two texts; some hold no byte window with five zero bits."""
    import numpy as np

    rng = random.Random(4)
    fresh = lambda n: " ".join(f"{rng.randrange(10**9):x}" for _ in range(n))
    for kind in range(400):
        some = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randint(1, 7))) for _ in range(1 + kind % 3)]
        passage = " ".join(some * 150)[: rng.randint(300, 700)]
        first, second = (f"{fresh(30)} {passage} {fresh(30)}".encode() for _ in range(2))
        left, spans, count = passages.cut(second, passages.chunk_digests(np.frombuffer(first, np.uint8))[1], 16)
        if len(passage.split()) >= 40:
            assert sum(b - a for a, b in spans) > 0.5 * len(passage.encode()), passage
        assert np.diff([0, *passages.borders(np.frombuffer(first, np.uint8))]).max() < 300


# 10. Fingerprints


def test_fingerprints_do_not_depend_on_paragraph_order(spark):
    rng = random.Random(6)
    paragraphs = [prose(rng, 20) for _ in range(6)]
    rows = [(1, "\n".join(paragraphs), "s"), (2, "\n".join(paragraphs[::-1]), "s"), (3, "\n".join(paragraphs[:-1]), "s"), (4, None, "s"), (5, "", "s"),
            (6, "\n", "s"), (7, "x" * 100_000 + " " + "y z " * 40_000, "s"), (None, "a", "s"), (1, "\n".join(paragraphs), "s")]
    got = fingerprints.fingerprints(documents(spark, rows)).collect()
    print_of = {r.doc_id: r.fingerprint for r in got}
    assert len(got) == len(rows)
    assert print_of[1] == print_of[2] and print_of[4] == print_of[5]
    assert len({print_of[i] for i in (1, 3, 4, 6, 7)}) == 5
    left = fingerprints.fingerprints(documents(spark, [(1, "\n".join(paragraphs), "s")]))
    right = fingerprints.fingerprints(documents(spark, [(1, paragraphs[-1], "s")]))
    less = fingerprints.combine(left, right, "doc_id", delete=True)
    assert less.first().fingerprint == print_of[3]
    assert fingerprints.combine(less, right, "doc_id").first().fingerprint == print_of[1]


def test_edited_texts(spark):
    rows = [r for r in messy() if r[0] is not None]
    unique = dict((i, t or "") for i, t, _ in rows)
    ids = sorted(unique, reverse=True)
    follower = {a: ids[(k + 1) % len(ids)] for k, a in enumerate(ids)}
    docs = documents(spark, rows)
    got = fingerprints.edited(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _, _ in rows)
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    edits = {}
    for r in got:
        text = unique[r.doc_id]
        cut = len(text) // 3
        edits[r.doc_id] = text[: len(text) - cut] + unique[follower[r.doc_id]][:cut]
        assert r.n_chars == len(text) and r.fingerprint == prints[r.doc_id]
        assert r.edited_sha256 == hashlib.sha256(edits[r.doc_id].encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_next == 1) == (prints[r.doc_id] == prints[follower[r.doc_id]]) or r.near_next > 0.9
    again = fingerprints.fingerprints(documents(spark, [(i, t, "s") for i, t in edits.items()])).collect()
    changed = {r.doc_id: r.fingerprint for r in again}
    assert all(r.edited_fingerprint == changed[r.doc_id] for r in got)
    long = [r for r in got if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in long) >= 0.9 * len([r for r in long if unique[r.doc_id] != unique[follower[r.doc_id]]])
    single = fingerprints.edited(documents(spark, [(1, "a b c", "s")])).first()
    assert single.near_next == 1 and fingerprints.edited(docs.limit(0)).count() == 0
    with_null = fingerprints.edited(documents(spark, [(None, "x y", "s"), (5, "p q r", "s")])).collect()
    assert {(r.doc_id, r.next_id) for r in with_null} == {(None, 5), (5, None)}


def shingle_counts(text):
    found = Counter()
    for line in (text or "").split("\n"):
        w = words(line)
        found.update(zip(w, w[1:]))
    return found


def test_likeness_estimates_the_cosine_of_shingle_counts(spark):
    rng = random.Random(17)
    rows = []
    for i in range(60):
        text = "\n".join(prose(rng, rng.randint(60, 120), 3000) for _ in range(6))
        if rows and rng.random() < 0.5:
            lines, own = rows[-1][1].split("\n"), text.split("\n")
            keep = rng.randint(1, 5)
            text = "\n".join(lines[:keep] + own[keep:])
        rows.append((i, text, "s"))
    texts = {i: t for i, t, _ in rows}

    def cosine(a, b):
        x, y = shingle_counts(a), shingle_counts(b)
        norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
        return sum(v * y[k] for k, v in x.items()) / norm

    errors = []
    for r in fingerprints.edited(documents(spark, rows)).collect():
        own, following = texts[r.doc_id], texts[r.doc_id - 1 if r.doc_id else len(rows) - 1]
        cut = len(own) // 3
        changed = own[: len(own) - cut] + following[:cut]
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        errors += [r.near_edited - cosine(own, changed), r.near_next - cosine(own, following)]
    assert max(map(abs, errors)) < 0.45 and math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.13


def test_fingerprints_take_ids_of_any_type(spark):
    rows = [(f"d{i:02d}", f"line {i}\nsame words here", "s") for i in range(12)] + [(None, "x y", "s")]
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id string, text string")
    got = {r.doc_id: r for r in fingerprints.edited(frame).collect()}
    assert len(got) == 13 and got["d05"].next_id == "d04" and got["d00"].next_id is None and got[None].next_id == "d11"
    dates = frame.filter("doc_id IS NOT NULL").selectExpr("date_add(date'2024-01-28', cast(substr(doc_id, 2) AS int)) AS doc_id", "text")
    follow = {str(r.doc_id): str(r.next_id) for r in fingerprints.edited(dates).collect()}
    assert follow["2024-02-01"] == "2024-01-31" and follow["2024-01-28"] == "2024-02-08"


def test_lanes_of_long_repeated_texts_do_not_wrap(spark):
    """550,000 word pairs of one line; its edited form keeps two thirds and borrows 500 other words."""
    rng = random.Random(8)
    line = " ".join(f"u{i}" for i in range(12))
    rows = [(2, "\n".join([line] * 50_000), "s"), (1, " ".join(f"v{rng.randrange(10_000)}" for _ in range(500)), "s")]
    got = by_id(fingerprints.edited(documents(spark, rows)).collect())
    assert got[2].near_edited > 0.99 and got[2].near_next < 0.5
    assert len(got[2].fingerprint) == 8 * (1 + fingerprints.DIGESTS + fingerprints.LANES)


def test_filters_stay_above_the_facts(spark):
    """Pushed into the sorted windows they would make a long text quadratic."""
    rows = [(i, prose(random.Random(i), 20_000), "s") for i in range(4)]
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    kept = quality.judge(documents(spark, rows), labels).filter("kept AND n_repeat_words >= 0")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("array_sort" in line or "arrays_zip" in line for line in filters)
    assert kept.count() <= 4
