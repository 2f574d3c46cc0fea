"""HTML extraction, URL verdicts and language identification."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnkit.llm.html_extract import extract_pages, host_paths, host_of
from tarnkit.llm.html_pages import Page
from tarnkit.llm.language_id import Model, held_out, identify_languages, kernel, letter_codes, mark_grams, presence, train
from tarnkit.llm import language_id
from tarnkit.llm.url_filter import LONGEST_WORD, best_split, classify_urls, filter_urls, segment
from tarnkit.llm.workers import importable
from tests.llm.brute import best_unigram_split


def text_of(source):
    return Page(source, Page(source).best()).text()


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("<", "<"),
        ("just text", "just text"),
        ("<p>a<p>b", "a b"),
        ("<article>a<b>b</b> c<br>d</article>", "ab c d"),
        ("<article><p><b>un<br><p>closed</article>", "un closed"),
        ("<article>x &amp; y &eacute;&#233;&nbsp; z</article>", "x & y éé z"),
        ("<article>a<script>var x = '</p>' + '<b>';</script>b<style>p{}</style>c</article>", "abc"),
        ("<article>a<!-- no <p>x</p> -->b</article>", "ab"),
        ("<nav>menu</nav><header>top</header><article>it</article><aside>side</aside><footer>end</footer>", "it"),
        ('<article>it<div class="ad-slot">buy</div><div id="userComments">nice</div><form>f</form></article>', "it"),
        ('<body class="has-sidebar"><div class="content">it is here</div><div class="cookie-notice">ok?</div></body>', "it is here"),
        ('<article>a<span hidden>no</span><div role="navigation">no</div><i style="display: none">no</i>b</article>', "a b"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
        ("<article><ul><li>a<li>b</ul>c</article>", "a b c"),
        ("<article>a</b></i>b</article>", "ab"),
        ('<article title="a > b">x</article>', "x"),
        ("<ARTICLE><P>x</P></ARTICLE>", "x"),
    ],
)
def test_text_of_a_page(source, text):
    assert text_of(source) == text


PROSE = "words of the article, one after the other, " * 6
SAID = "<p>what a reader has to say about it, and more of that</p>"


@pytest.mark.parametrize("name", ["post-comments", "comment-list", "comments-area", "comments", "respond", "disqus-thread"])
@pytest.mark.parametrize("many", [1, 8, 60])
def test_comments_are_no_article_however_long(name, many):
    said = f"<section class='{name}'>{SAID * many}</section>"
    replies = f"<section id='{name}'>{f'<article>{SAID}</article>' * many}</section>"
    for source in (
        f"<body><article><p>{PROSE}</p>{said}</article></body>",
        f"<body><article><p>{PROSE}</p></article>{said}</body>",
        f"<body><div><p>{PROSE}</p></div>{said}</body>",
        f"<body><main><article><p>{PROSE}</p></article>{replies}</main></body>",
    ):
        assert text_of(source) == PROSE.strip()


@pytest.mark.parametrize(
    "opening", ["<form>", "<form id='aspnetForm' action='x'>", "<div aria-hidden='true'>", "<div style='display:none'>", "<div role='dialog'>", "<header>", "<div hidden>"]
)
def test_what_encloses_the_article_is_not_dropped(opening):
    closing = f"</{opening[1:].split(' ')[0].rstrip('>')}>"
    field = "<label>your name</label><input name='q'><select><option>one</option></select><button>go</button>"
    for source in (
        f"<body>{opening}<article><p>{PROSE}</p></article>{field}{closing}</body>",
        f"<body><article>{opening}<p>{PROSE}</p>{field}{closing}</article></body>",
        f"<body>{opening}<div><p>{PROSE}</p></div>{field}{closing}<div class='cookie-notice'>ok?</div></body>",
    ):
        assert text_of(source) == PROSE.strip()
    beside = f"<body><article><p>{PROSE}</p></article>{opening}<p>not of the article</p>{closing}</body>"
    assert text_of(beside) == PROSE.strip()


def test_a_hidden_body_shows_its_article():
    assert text_of(f"<body style='display:none'><div><p>{PROSE}</p></div><nav>menu</nav></body>") == PROSE.strip()


def test_deep_containers_keep_their_outer_steps_apart():
    deep = lambda name: f"<div class='{name}'>" + "<div>" * 30 + f"<p>{PROSE} {name}</p>" + "</div>" * 31
    source = f"<body>{deep('a')}{deep('b')}</body>"
    paths = {path for path, size in Page(source).direct.items() if size}
    assert len(paths) == 2 and all(path.count(">") <= 16 for path in paths)
    assert {Page(source, path).text() for path in paths} == {f"{PROSE}{name}" for name in "ab"}


@pytest.mark.parametrize(
    "name", ["class='overflow-hidden'", "id='content-sidebar-wrap'", "class='layout-with-sidebar'", "class='sidebar-right'", "class='header-fixed'",
             "class='share-price'", "class='page-with-comments'", "class='sm:hidden'"],
)
def test_names_of_wrappers_drop_no_article(name):
    prose = "words of the article " * 20
    for body in (f"<article><p>{prose}</p></article>", f"<div><p>{prose}</p></div>", f"<p>{prose}</p>"):
        source = f"<body><div {name}>{body}<div class='sidebar'>not this</div></div><div class='cookie-notice'>ok?</div></body>"
        assert text_of(source) == prose.strip()


def test_names_of_parts_drop_them():
    for name in ("comments", "user-comments", "sidebar-left", "ad"):
        for inner in ("they said " * 30, "<article>they said</article>"):
            assert text_of(f"<article>{'own words ' * 20}</article><div class='{name}'>{inner}</div>") == ("own words " * 20).strip()


def test_difficult_pages_end():
    for source in ["<b" * 5000, "<div>" * 5000 + "x", "<p><b>" * 5000 + "y", "</p>" * 5000, "<a href='" * 500, "<!--" * 1000, "&" * 5000]:
        text_of(source)
    assert text_of("<article>" + "word " * 200_000 + "</article>").count("word") == 200_000


PAGES = "page_id bigint, url string, html string, host string, n int"


def page(body):
    return f"<html><head><title>T</title></head><body><nav>m</nav>{body}<footer>f</footer></body></html>"


def test_hosts_vote(spark):
    """A page with more words beside its article than in it follows the other pages of its host."""
    importable(spark)
    usual = [page(f'<div class="post-{k} entry"><p>{"article words here " * 20}</p></div><div class="box">beside</div>') for k in range(9)]
    odd = page('<div class="post-77 entry"><p>short article</p></div><div class="box">' + "much more beside it " * 30 + "</div>")
    rows = [(k, f"https://A.example.com/{k}", h, "x", k) for k, h in enumerate([*usual, odd])]
    rows += [(50, "http://b.org", page("<div class='box'><p>only this one</p></div>"), "x", 1), (51, None, "<p>no address</p>", None, None), (52, "http://b.org", None, "x", 2)]
    rows += [(53, "http://b.org", page("<main>another kind of page</main>"), "x", 3), (53, "http://b.org", page("<main>another kind of page</main>"), "x", 3)]
    source = spark.createDataFrame(rows, PAGES)
    out = {r.page_id: r for r in extract_pages(source).collect()}
    assert out[9].text == "short article" and out[9].host == "a.example.com"
    assert out[0].text == ("article words here " * 20).strip() and out[0].path.endswith("div.entry.post-#")
    assert (out[50].text, out[51].text, out[52].text, out[52].path) == ("only this one", "no address", "", None)
    assert out[53].text == "another kind of page"
    assert extract_pages(source).count() == len(rows) and out[3].n == 3
    assert extract_pages(source.limit(0)).count() == 0
    paths = {r.host: r.path for r in host_paths(source, "html", host_of(F.col("url"))).collect()}
    assert paths["a.example.com"] == "html>body>div.entry.post-#"


def words(n, name):
    return " ".join(f"{name}{k}" for k in range(n))


PARTED = [
    f"<article><div class='intro'>{words(50, 'i')}</div><div class='body'>{words(100, 'b')}</div><div class='end'>{words(20, 'e')}</div></article>",
    f"<article><h1>title</h1><p>{words(60, 'p')}</p><blockquote>{words(150, 'q')}</blockquote></article>",
    f"<main><h1>title</h1><section>{words(60, 'p')}</section><section class='x'>{words(150, 'q')}</section></main>",
    f"<div class='post'><div class='intro'>{words(50, 'i')}</div><div class='body'>{words(100, 'b')}</div><div class='end'>{words(20, 'e')}</div></div>",
    f"<div class='post'><p>{words(60, 'p')}</p><div><figure>{words(150, 'q')}</figure></div></div>",
]


@pytest.mark.parametrize("body", PARTED)
def test_parted_articles_are_whole(spark, body):
    import re

    importable(spark)
    rows = [(k, url, page(body), "x", k) for k, url in enumerate(["http://a.org/1", "http://a.org/2", None, "no address"])]
    want = " ".join(re.sub("<[^>]*>", " ", body).split())
    assert {r.text for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()} == {want}


def test_two_layouts_of_a_host(spark):
    """Pages laid out in another way, with a few words where the others have their article."""
    importable(spark)
    usual = [page(f"<div class='entry'><p>{words(90, 'a')}</p></div><div class='box'>beside</div>") for _ in range(9)]
    other = page(f"<div class='entry'>teaser</div><section><h1>title</h1><p>{words(200, 'o')}</p></section>")
    for url in ("http://a.org/1", None):
        rows = [(k, url, h, "x", k) for k, h in enumerate([*usual, other])]
        out = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, PAGES)).collect()}
        assert out[0] == words(90, "a") and out[9] == "title " + words(200, "o")


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


@pytest.mark.parametrize("name", ["", "a", "casino", "cheapcasino", "thetion", "winbets", "zzzz", "freethebets"])
def test_segmentation_is_the_likeliest(name):
    import math

    counts = {"casino": 5, "cheap": 9, "the": 500, "tion": 40, "win": 30, "bets": 7, "free": 50, "he": 60}
    words = best_split(name, counts, 1000)
    assert "".join(words) == name
    score = sum(math.log(counts[w] / 1000) if w in counts else math.log(10 / 1000) - len(w) * math.log(10) for w in words)
    assert score == pytest.approx(best_unigram_split(name, counts, 1000, LONGEST_WORD))


def test_url_verdicts(spark):
    importable(spark)
    texts = spark.createDataFrame([("the house of garden news " * 50,), (None,), ("Garden, shop! Straße",)], "text string")
    urls = {
        1: "http://example.com/en/1", 2: "https://WWW.Example.com/en/2?x#y", 3: "http://a.net/fr/", 4: "http://a.net/de/1", 5: "http://com/x",
        6: "http://xcom/", 7: "http://casinogarden.org/b", 8: "http://gardenhouse.org/a", 9: None, 10: "no address", 11: "http://e.com", 12: "", 13: "x://y.net/es/?q",
    }
    # the classifier needs several examples of either class
    more = [(8, urls[8], "mine")] * 30 + [(20 + k, f"http://casino{'abcdefghij'[k % 10]}.org/b", "mine") for k in range(30)]
    pages = spark.createDataFrame([(k, u, "mine") for k, u in urls.items()] + more, "page_id bigint, url string, rule string")
    found = filter_urls(pages, texts, RULES).collect()
    assert len(found) == len(urls) + 60
    out = {r.page_id: r for r in found}
    assert [out[k].rule for k in (1, 2, 3, 4, 5, 6, 11, 13)] == ["example.com/en/", "www.example.com/en/", "net/fr/", None, "com/", None, None, "net/es/"]
    assert [out[k].verdict for k in (1, 2, 3, 5)] == ["block", "allow", "block", "allow"]
    assert (out[2].host, out[2].path) == ("www.example.com", "/en/2")
    assert all((out[k].host, out[k].path) == ("", "") for k in (9, 10, 12))
    assert out[7].verdict == "block" and out[8].verdict == "allow"
    names = spark.createDataFrame([("casinogarden",), ("gardenhouse",)], "name string")
    split = {r.name: r.words for r in segment(names, texts, ["casino"]).collect()}
    assert split == {"casinogarden": ["casino", "garden"], "gardenhouse": ["garden", "house"]}


def _urls(seed, n):
    """(host, path, decision): paths of some words are blocked, those of others allowed; a quarter is undecided."""
    rng = np.random.default_rng(seed)
    words = {"block": ["deal", "offer", "win", "prize"], "allow": ["news", "guide", "science", "travel"]}
    rows = []
    for k in range(n):
        kind = ("block", "allow")[k % 2]
        mixed = [*rng.choice(words[kind], 3), *rng.choice([*words["block"], *words["allow"]], 1)]
        rows.append((f"site{k % 9}.org", "/" + "/".join(mixed), kind, k // 2 % 4 < 3))
    return rows


def test_naive_bayes_is_that_of_a_plain_count(spark):
    rows = _urls(1, 60) + [("casino.org", "/a", "block", False), ("casino.org", "/a", "block", False), ("", "", "allow", False)]
    urls = spark.createDataFrame([(h, p, d if known else None) for h, p, d, known in rows], "host string, path string, decision string")
    texts = spark.createDataFrame([("casino site org " * 5,)], "text string")
    found = {(r.host, r.kind): r for r in classify_urls(urls, texts).collect()}
    split = {"casino": ["casino"], "site": ["site"], "org": ["org"]}
    tokens = lambda h, p: [f"h:{w}" for name in re.findall("[a-z]+", h) for w in split[name]] + [f"p:{w}" for w in p.split("/") if w]
    counts = {"block": Counter(), "allow": Counter()}
    pages = Counter()
    for h, p, d, known in rows:
        label = d if known else "block" if "casino" in h else "allow"
        pages[label] += 1
        counts[label].update(tokens(h, p))
    vocabulary = len(set(counts["block"]) | set(counts["allow"]))
    for (h, p), r in found.items():
        odds = math.log((pages["block"] + 1) / (pages["allow"] + 1))
        for t in tokens(h, p):
            chance = {c: (counts[c][t] + 1) / (sum(counts[c].values()) + vocabulary + 1) for c in counts}
            odds += math.log(chance["block"]) - math.log(chance["allow"])
        assert r.log_odds == pytest.approx(odds, abs=1e-6) and r.block == (odds > 0)


def test_what_rules_decide_teaches_the_rest(spark):
    """Decided URLs alone tell both classes apart: at most one in ten of the undecided is judged wrong, and both verdicts occur."""
    rows = _urls(2, 800)
    urls = spark.createDataFrame([(h, p, d if known else None) for h, p, d, known in rows], "host string, path string, decision string")
    judged = {(r.host, r.kind): r.block for r in classify_urls(urls, spark.createDataFrame([("a",)], "text string")).collect()}
    held = [(judged[h, p], d == "block") for h, p, d, known in rows if not known]
    assert sum(a != b for a, b in held) <= len(held) / 10 and {a for a, _ in held} == {True, False}


def test_url_tables_without_rows(spark):
    texts, pages = spark.createDataFrame([], "text string"), spark.createDataFrame([], "page_id bigint, url string")
    assert filter_urls(pages, texts, RULES).count() == 0
    some = spark.createDataFrame([(1, "http://poker.org/x")], "page_id bigint, url string")
    assert filter_urls(some, texts, RULES).count() == 1
    kinds = classify_urls(spark.createDataFrame([("poker.org", "/a1/22")], "host string, path string"), texts).collect()
    assert [(k.host, k.kind, k.block) for k in kinds] == [("poker.org", "/a#/#", True)]


def test_letters_and_grams():
    assert letter_codes("aB, 1 ç!").tolist() == [0, ord("a"), ord("b"), 0, ord("ç"), 0]
    assert letter_codes("").tolist() == [0] and letter_codes("12 !").tolist() == [0]
    assert len(letter_codes("𐐀")) == 3
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefg  .") for _ in range(2000))
    whole = np.zeros(language_id.BUCKETS, bool)
    mark_grams(letter_codes(text), whole)
    cut, language_id.SEGMENT = language_id.SEGMENT, 37
    try:
        parts = np.zeros(language_id.BUCKETS, bool)
        mark_grams(letter_codes(text), parts)
    finally:
        language_id.SEGMENT = cut
    assert (whole == parts).all()
    rows, lettered = presence(["abc", None, "12", "abc abc"])
    assert lettered.tolist() == [True, False, False, True]
    assert kernel(rows, rows)[0, 0] == pytest.approx(1) and kernel(rows, rows)[0, 3] > kernel(rows, rows)[0, 1]


WORDS = {"en": "the of and to house water", "de": "der die und das haus wasser", "fr": "le la et les maison eau"}


def labelled(n, seed=1):
    rng = random.Random(seed)
    return [(k, " ".join(rng.choice(WORDS[lang].split()) for _ in range(12)), lang) for k in range(n) for lang in [rng.choice(sorted(WORDS))]]


def test_held_out_accuracy(spark):
    importable(spark)
    rows = labelled(600)
    source = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = train(source)
    assert model.languages == ["de", "en", "fr"]
    found = identify_languages(source, model).withColumn("out", held_out(F.col("doc_id"))).filter("out").collect()
    assert len(found) > 100
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_is_learnt_from_held_out_rows(spark):
    importable(spark)
    source = spark.createDataFrame(labelled(300), "doc_id bigint, text string, lang string")
    other = source.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = train(source), train(other)
    assert b.languages == a.languages and np.allclose(a.weights, b.weights)


def test_language_edge_cases(spark):
    importable(spark)
    rows = [*labelled(200), (900, None, "en"), (901, "", None), (902, "12 %%", "de"), (903, "the water " * 30_000, None), (None, "der die und", "de"), (5, "le la", "fr")]
    source = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("mine")).withColumn("a.b", F.lit(1))
    out = identify_languages(source, train(source)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert all((by_id[k].lang_pred, by_id[k].score) == ("und", 0.0) for k in (900, 901, 902))
    assert by_id[903].lang_pred == "en" and by_id[None].lang_pred == "de"
    none = train(source.limit(0))
    assert {r.lang_pred for r in identify_languages(source, none).collect()} == {"und"}
    assert isinstance(none, Model)


def test_a_repeated_id_does_not_fill_the_sample(spark, monkeypatch):
    """Two thousand rows of one id, of two texts: each text is learnt from once, and the driver gets no more."""
    words = {"en": ["the", "of", "with", "house"], "de": ["und", "der", "nicht", "haus"]}
    rows = [(k, f"{' '.join(v[(k + j) % 4] for j in range(8))} {k}", lang) for lang, v in words.items() for k in range(60)]
    rows += [(1, ("same text again" if k % 2 else "the other text") if k % 4 else None, "en") for k in range(2000)]
    source = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    collected = []
    frame = type(source)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    model = train(source)
    assert model.languages == ["de", "en"]
    assert max(map(len, collected)) <= 122


def test_ridge_is_that_of_a_plain_solution():
    rng = np.random.default_rng(3)
    rows = np.zeros((30, language_id.BUCKETS), bool)
    labels = []
    for k in range(30):
        rows[k, rng.choice(200 + 100 * (k % 3), 60, replace=False)] = True
        labels.append("abc"[k % 3])
    landmark = np.arange(30) % 5 < 2
    model = Model.fit(rows, labels, landmark)
    plain = lambda a, b: len(set(a) & set(b)) / (len(a) * len(b)) ** 0.5
    grams = [np.flatnonzero(r).tolist() for r in rows]
    marks = [g for g, m in zip(grams, landmark) if m]
    within = np.array([[plain(a, b) for b in marks] for a in marks])
    across = np.array([[plain(a, b) for b in marks] for a in grams])
    values, vectors = np.linalg.eigh(within)
    keep = values > 1e-6
    features = across @ vectors[:, keep] @ np.diag(values[keep] ** -0.5)
    for column, language in enumerate("abc"):
        wanted = np.array([1.0 if x == language else -1.0 for x in labels])
        weight = np.array([1 / labels.count(x) for x in labels])
        # minimise the weighted squared error plus the ridge, as an ordinary least squares problem
        tall = np.vstack([features * np.sqrt(weight)[:, None], np.sqrt(language_id.RIDGE) * np.eye(features.shape[1])])
        beta = np.linalg.lstsq(tall, np.r_[wanted * np.sqrt(weight), np.zeros(features.shape[1])], rcond=None)[0]
        assert np.allclose(features @ beta, across @ model.weights[:, column], atol=1e-4)
