"""Embeddings, chat formatting, URL filters, HTML extraction and the pipeline against brute force, and on odd tables."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from guidemill.llm import chat, embed_dedup, html_extract, url_filter

VECTORS = "vec_id long, embedding array<float>, label int, node long, cell int"


def brute_links(table, threshold):
    good = [(k, np.array(v, float)) for k, (i, v) in enumerate(table) if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8]
    out = [(i, 0, i, i is not None) for i, _ in table]
    label = {k: k for k, _ in good}
    links = defaultdict(int)
    unit = {k: v / np.linalg.norm(v) for k, v in good}
    pairs = [(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= threshold]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in range(len(unit)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    least = {x: min(table[k][0] for k in label if label[k] == x) for x in set(label.values())}
    for k in unit:
        i = table[k][0]
        out[k] = (i, links[k], least[label[k]], i == least[label[k]])
    return sorted(out, key=str)


def odd_vectors():
    chance = np.random.default_rng(3)
    centres = chance.standard_normal((12, 8))
    table = [(k, [float(np.float32(x)) for x in centres[k % 12] + chance.standard_normal(8) * (0.25 if k % 3 else 0.6)]) for k in range(240)]
    table += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None, *[0.0] * 6]), (304, [float("nan")] * 8), (305, [float("inf")] * 8), (306, [1.0] * 3), (None, table[0][1])]
    return table + [(400 + k, table[5][1]) for k in range(4)] + [(5, table[5][1]), (410, [2 * x for x in table[5][1]])]


def test_embeddings_are_brute_force(spark):
    table = odd_vectors()
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in table], VECTORS).repartition(3)
    want = brute_links(table, 0.9)
    assert sorted((tuple(r) for r in embed_dedup.embedding_near_duplicates(df, recall=1).collect()), key=str) == want
    got = sorted((tuple(r) for r in embed_dedup.embedding_near_duplicates(df).collect()), key=str)
    assert len(got) == len(want)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.97 * true <= found <= true
    assert [r for r in got if r[0] in (None, *range(300, 307))] == [r for r in want if r[0] in (None, *range(300, 307))]


def kinds_of_vectors(kind, n=2400, dim=64):
    chance = np.random.default_rng(11)
    normal = chance.standard_normal
    if kind == "isotropic pairs":
        one, away = normal((n // 2, dim)), normal((n // 2, dim))
        away -= (away * one).sum(1)[:, None] * one / (one * one).sum(1)[:, None]
        away *= (np.linalg.norm(one, axis=1) / np.linalg.norm(away, axis=1))[:, None]
        cosine = chance.uniform(0.88, 0.97, n // 2)[:, None]
        x = np.concatenate([one, cosine * one + np.sqrt(1 - cosine**2) * away])
    elif kind == "rank 6":
        x = normal((n, 6)) @ normal((6, dim))
    elif kind == "rank 10 and noise":
        x = normal((n, 10)) @ normal((10, dim)) + 0.3 * normal((n, dim))
    elif kind == "topics":
        x = normal((50, dim))[chance.integers(0, 50, n)] + 0.33 * normal((n, dim))
    else:  # a third of all are near copies of one
        x = normal((n, dim))
        x[: n // 3] = x[0] + 0.1 * normal((n // 3, dim))
        x[n // 3 : n // 2] = x[n // 2 : 2 * (n // 2) - n // 3] + 0.45 * normal((n // 2 - n // 3, dim))
    x = x.astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    return x, unit @ unit.T >= 0.9


@pytest.mark.parametrize("kind", ["isotropic pairs", "rank 6", "rank 10 and noise", "topics", "hot group"])
def test_recall_of_links_on_kinds_of_vectors(spark, monkeypatch, kind):
    monkeypatch.setattr(embed_dedup, "BLOCK", 100)
    monkeypatch.setattr(embed_dedup, "GUESTS", 300)
    x, linked = kinds_of_vectors(kind)
    want = linked.sum(1) - 1
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = np.array([r.n_links for r in embed_dedup.embedding_near_duplicates(df).orderBy("vec_id").collect()])
    assert (got <= want).all() and got.sum() >= 0.95 * want.sum()
    some = want > 0
    assert (got[some] / want[some]).mean() >= 0.95


def test_exact_traversal_finds_every_link(spark):
    x, linked = kinds_of_vectors("rank 6", 1000)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = [r.n_links for r in embed_dedup.embedding_near_duplicates(df, recall=1).orderBy("vec_id").collect()]
    assert got == (linked.sum(1) - 1).tolist()


def test_embeddings_without_rows_or_usable_rows(spark):
    assert embed_dedup.embedding_near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []
    none = embed_dedup.embedding_near_duplicates(spark.createDataFrame([(1, None, 0, 0, 0), (None, [0.0], 0, 0, 0)], VECTORS)).collect()
    assert sorted(map(tuple, none), key=str) == [(1, 0, 1, True), (None, 0, None, False)]
    double = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in embed_dedup.embedding_near_duplicates(double).orderBy("vec_id").collect()] == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_traversal_visits_what_the_stop_allows():
    chance = np.random.default_rng(5)
    x = chance.standard_normal((400, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = embed_dedup.Index(x, 0.9, 0.9, 8)
    a, b = index.sides(x)
    for k, visits in enumerate(index.visited(x)):
        sums = (a[k][:, None] + b[k][None, :]).ravel()
        assert set(visits.tolist()) == set(np.flatnonzero(sums <= index.stop).tolist())
        assert len(set(visits.tolist())) == len(visits)
        assert index.cells(x[k : k + 1])[0] in visits


# ---------------------------------------------------------------- chat
EVENTS = "conv_id long, seq long, kind string, role string, text string, place long, turns string"


def formatted(spark, events):
    out = chat.format_conversations(spark.createDataFrame([(*e, 1, "x") for e in events], EVENTS).repartition(3))
    return {r.conv_id: r for r in out.withColumns({"turns": chat.read_back(F.col("formatted")), "loss": chat.masked(F.col("formatted"), F.col("loss_spans"))}).collect()}


def test_fold_deltas_edits_and_regenerations(spark):
    log = [
        (1, 1, "message", "user", "hi"), (1, 2, "message", "assistant", "a"), (1, 3, "delta", None, "b"), (1, 4, "regenerate", "assistant", "x"), (1, 5, "delta", "assistant", "y"),
        (1, 6, "message", "user", "q"), (1, 7, "edit", "user", "Q"), (1, 8, "message", "assistant", None), (1, 9, "delta", "assistant", "z"),
        (2, 1, "delta", "assistant", "lost"), (2, 2, "delta", "assistant", " start"), (3, None, None, None, None), (None, 1, "message", "user", "u"),
    ]
    got = formatted(spark, log)
    assert [tuple(t) for t in got[1].turns] == [("user", "hi"), ("assistant", "xy"), ("user", "Q"), ("assistant", "z")]
    assert got[1].loss == "xyz"
    assert [tuple(t) for t in got[2].turns] == [("assistant", "lost start")]
    assert [tuple(t) for t in got[3].turns] == [("", "")]
    assert [tuple(t) for t in got[None].turns] == [("user", "u")]
    assert formatted(spark, []) == {}


def test_round_trip_of_control_strings(spark):
    chance = random.Random(6)
    parts = [*chat.CONTROL, "\\", "\\\\", "\n", "[", "<", "$1", "<|", "|>", " ", "é🙂", "INST]", "\\n"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 12))) for _ in range(150)]
    roles = ["user", "assistant", "us\ner", "a\\", "<s>", "", "[INST]\n\\"]
    log = [(k // 3, k, "message", roles[chance.randrange(len(roles))], t) for k, t in enumerate(texts)]
    got = formatted(spark, log)
    for conv, r in got.items():
        said = [(e[3], e[4]) for e in log if e[0] == conv]
        assert [tuple(t) for t in r.turns] == said
        assert r.loss == "".join(t for role, t in said if role == "assistant")
        bare = r.formatted.replace(chat.OPEN, "").replace(chat.CLOSE, "")
        assert not any(x in bare for x in chat.CONTROL if x not in (chat.OPEN, chat.CLOSE))
        assert r.formatted.count(chat.OPEN) == r.formatted.count(chat.CLOSE) == len(said)


def test_equal_events_and_long_conversations_stay(spark):
    log = [(1, 1, "message", "user", "same")] * 3 + [(2, k, "message", "assistant" if k % 2 else "user", "t" * (k % 50)) for k in range(600)]
    got = formatted(spark, log)
    assert len(got[1].turns) == 3 and len(got[2].turns) == 600


# ---------------------------------------------------------------- urls
def test_hosts_paths_and_written_rules(spark):
    urls = ["HTTP://A.Com/en/x?y#z", "https://com/en/", "x://b.example.com/en/70", "no scheme", None, "", "a://b://c/d", "https://notexample.com/en/7", "https://É.com/En/", "https://h", "https://h#f", "https://u@h:8/p"]
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow")]
    df = spark.createDataFrame([(k, u, "h", 1) for k, u in enumerate(urls)], "k int, url string, host string, rule int")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = {r.k: r for r in url_filter.filter_urls(df, none, rules).collect()}
    assert len(got) == len(urls)
    for k, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
        fit = [(len(h + p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, max(fit)[2] if fit else None, max(fit)[1] if fit else "allow")


def test_mined_rules_are_brute_force(spark):
    chance = random.Random(9)
    hosts = ["good.site.org", "spam.farm.net", "a.spam.farm.net", "mixed.com"]
    rows = []
    for k in range(400):
        host = chance.choice(hosts)
        bad = "farm" in host and chance.random() < 0.9 or host == "mixed.com" and k % 2 == 0
        rows.append((f"https://{host}/{'ads' if bad and chance.random() < 0.7 else 'en'}/{k}", bad))
    labelled = spark.createDataFrame([*rows, (None, True), ("https://good.site.org/en/1", None)], "url string, bad boolean")
    rules = url_filter.mine_rules(labelled, 0.02, 0.7).collect()
    tokens = {r[0]: set(r[1]) for r in labelled.where("url is not null").select("url", url_filter.tokens_of(F.col("url"))).collect()}
    assert rules and {r.verdict for r in rules} == {"allow", "block"}
    for r in rules:  # no rule says what one with fewer of its tokens says as surely
        assert not any(set(x.tokens) < set(r.tokens) and x.verdict == r.verdict and x.confidence >= r.confidence for x in rules)
    for r in rules:
        met = [bad for url, bad in rows if set(r.tokens) <= tokens[url]]
        right = sum(bad == (r.verdict == "block") for bad in met)
        assert right / len(met) == pytest.approx(r.confidence) and r.confidence >= 0.7 and right / len(rows) == pytest.approx(r.support) and r.support >= 0.02
        assert r.key in r.tokens
    urls = spark.createDataFrame([("https://b.spam.farm.net/ads/9",), ("https://good.site.org/en/5",), ("zzz",), ("https://new.place/en/",)], "url string")
    want = {}
    for (url,) in urls.collect():
        mine = set(urls.where(F.col("url") == url).select(url_filter.tokens_of(F.col("url"))).first()[0])
        fit = [(r.confidence, r.support, r.verdict) for r in rules if set(r.tokens) <= mine]
        want[url] = max(fit)[2] if fit else "allow"
    assert {r.url: r.verdict for r in url_filter.filter_urls(urls, labelled, support=0.02, confidence=0.7).collect()} == want
    assert want["https://b.spam.farm.net/ads/9"] == "block"


def test_rules_on_late_keys_and_deep_segments(spark):
    late = "https://a.org/x/shop?utm_a=1&utm_b=2&utm_c=3&{}=4"
    rows = [(late.format("affid"), True), (late.format("id"), False), ("https://a.org/x/y/casino/3", True), ("https://a.org/x/y/news/3", False)] * 20
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    urls = ["https://b.net/z?q=1&p=2&o=3&n=4&affid=5", "https://b.net/z?affid=5&n=4&o=3&p=2&q=1", "https://b.net/q/r/s/casino/", "https://b.net/q/r/s/"]
    got = {r.url: r.verdict for r in url_filter.filter_urls(spark.createDataFrame([(u,) for u in urls], "url string"), labelled, support=0.1, confidence=0.9).collect()}
    assert [got[u] for u in urls] == ["block", "block", "block", "allow"]


# ---------------------------------------------------------------- html
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div id="cookie-notice">We use cookies.</div>
<div class="main-menu"><a href=x>Menu</a></div>{body}<div class="ad">Buy</div><form><p>Sign up</p><input><button>Go</button></form>
<section class="comments"><p>A reader writes a very long comment that is longer than the article itself, over and over, over and over, over and over.</p></section>
<aside>Side</aside><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", "{}"])
def test_article_is_kept_whole(wrap):
    inner = '<h2>Ti&amp;tle &lt;b&gt;</h2><p>First <b>bo</b>ld&nbsp;text\n here.<br><p>S.<!-- ad --><div class="advert">Buy now</div><p>Second &eacute; &#8364; end.</p><ul><li>one<li>two</ul><script>x("</p>")</script><p>Last one with a <a href=z>link</a>.'
    want = "Ti&tle <b> First bold text here. S. Second é € end. one two Last one with a link."
    assert html_extract.main_text(PAGE.replace("{body}", wrap.format(inner))) == want


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>"])
@pytest.mark.parametrize("midst", ["<aside><ul><li>x<li>y<li>z<li>w</ul></aside>", "<form><p>a<p>b<p>c<p>d</form>", '<div class="related"><p>1<p>2<p>3<p>4</div>'])
def test_what_is_left_out_does_not_cut_an_article(wrap, midst):
    inner = f"<p>A first part.</p>{midst}<p>A second part, which is the longer one.</p>{midst}<p>End.</p>"
    assert html_extract.main_text(PAGE.replace("{body}", wrap.format(inner))) == "A first part. A second part, which is the longer one. End."


@pytest.mark.parametrize("size", [1, 2, 5, 20])
@pytest.mark.parametrize("midst", ["<aside><ul>{}</ul></aside>", '<div class="advert">{}</div>', "<form>{}</form>", '<div id="newsletter-signup">{}</div>', '<section class="related-articles"><ul>{}</ul></section>', '<article class="comment">{}</article>'])
def test_blocks_of_any_size_in_the_midst_are_left_out_alone(midst, size):
    blocks = midst.format("".join(f"<li>block {k} of what is not the article, and long enough" for k in range(size)))
    inner = f"<p>A first part.</p>{blocks}<p>A second part, which is the longer one.</p>{blocks}<p>End.</p>"
    for wrap in ("<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", '<div itemprop="articleBody">{}</div>'):
        assert html_extract.main_text(PAGE.replace("{body}", wrap.format(inner))) == "A first part. A second part, which is the longer one. End."


def test_comments_teasers_and_nested_articles_are_not_the_article():
    long = "<p>" + "a reader's or another article's many words " * 20 + "</p>"
    real = "<article><h1>T</h1><p>The real text of this page.</p>{}<p>It ends.</p></article>"
    want = "T The real text of this page. It ends."
    assert html_extract.main_text(f'{real.format("")}<article class="comment">{long}</article><article id="reply-3">{long}</article>') == want
    assert html_extract.main_text(real.format(f"<article>{long}</article>")) == want
    assert html_extract.main_text("<main>" + "".join(f'<article class="teaser"><h2>{k}</h2><p>Read on</p></article>' for k in range(9)) + real.format("") + "</main>") == want
    assert html_extract.main_text("<article><header>H</header><article><p>The inner one is the text.</p></article></article>") == "The inner one is the text."


def test_names_that_only_hold_a_word_of_another_meaning_stay():
    page = "".join(f'<p class="{x}">{x}.</p>' for x in ("notice-period", "form-of-life", "search-and-rescue", "skip-intro-x", "shareholder", "adhere", "navigation-history-of-ships"))
    for wrap in ("<article>{}</article>", "<div>{}</div>"):
        assert html_extract.main_text(wrap.format(page)) == "notice-period. form-of-life. search-and-rescue. skip-intro-x. shareholder. adhere. navigation-history-of-ships."
    gone = "".join(f'<p class="{x}">{x}.</p>' for x in ("notice", "ad-slot-2", "siteHeader", "cookie_notice", "post share-buttons", "comments-list"))
    assert html_extract.main_text(f"<article><p>a</p>{gone}</article>") == "a"
    assert html_extract.main_text('<article><p>x <span class="ad">Buy</span>y <button>B</button>z <svg><text>t</text></svg>w</p><p hidden>h</p></article>') == "x y z w"


@pytest.mark.parametrize("page", ["<div>{}</span>", "<i><div><b>{}</i>", '<p a="x>{}', '<a b=">" {}', "<x{}", "<!{}", "<{}>", "<li>{}", "<div>x{}", "<!--{}", "<td>{}</div>", "<p><ul>{}</p></ul>"])
def test_broken_and_deep_pages_take_linear_time(page):
    import time

    def seconds(n):
        before, after = page.split("{}")
        began = time.process_time()
        html_extract.main_text(before * n + after * n)
        return time.process_time() - began

    seconds(100)
    assert seconds(32_000) < 8 * max(seconds(8_000), 0.02)


def test_html_odd_pages(spark):
    assert html_extract.main_text("") == "" and html_extract.main_text("<html></html>") == ""
    assert html_extract.main_text("just text &amp; more") == "just text & more"
    assert html_extract.main_text("<p>cut <b>off") == "cut off"
    assert html_extract.main_text("<p title='a > b'>x</p>") == "x"
    assert html_extract.main_text("<nav>only a menu</nav>") == ""
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    assert html_extract.main_text(long) == " ".join(["word"] * 20_000)
    df = spark.createDataFrame([(1, "u", "<p>a</p>", "old"), (1, "u", "<p>a</p>", "old"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted((str(r.page_id), r.text) for r in html_extract.extract_main_text(df).collect()) == [("1", "a"), ("1", "a"), ("None", "")]
    assert html_extract.extract_main_text(df.limit(0)).collect() == []


def test_pages_of_the_table_are_their_articles(spark):
    import html

    got = html_extract.extract_main_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    assert got
    for r in got:
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        assert r.text == " ".join(html.unescape("".join(x for x in re.split(r"<(?:p|/p|h1|/h1|br|/?b)>", inner) if x is not None and True)).split()) or r.text == " ".join(" ".join(html.unescape(x) for x in re.split(r"<(?:p|/p|h1|/h1|br|/?b)>", inner)).split())


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages_keep_columns_and_decide(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    seen = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs.count())
        if k == 0:
            gone = before.select("doc_id").subtract(docs.select("doc_id")).collect()
            assert gone and all(labels[r[0]].quality == 0 for r in gone if r[0] in labels)
    assert seen[0] > seen[1] >= seen[2] > seen[3] > 0
    tokens = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in tokens)


def labels_at(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


ODD = "doc_id long, text string, lang string, source string, n_chars long, keep string, toxic int, copies long, row string, key int, target double, expected_grade int"


def odd_documents(spark):
    near = [f"w{k}" for k in range(60)]
    texts = [(1, " ".join(near)), (2, " ".join([*near[:-1], "z"])), (3, None), (3, None), (4, ""), (None, " ".join(near)), (5, "a b c"), (5, "other words of the same id"), (6, "a b c"), (None, None), (7, "long " * 20_000), (8, "one two three"), (8, "one two three")]
    return spark.createDataFrame([(i, t, None, f"s{k % 2}" if k % 3 else None, None, "x", 1, 2, "y", 3, 4.0, 5) for k, (i, t) in enumerate(texts)], ODD)


def test_pipeline_stages_on_odd_tables(spark, tmp_path):
    import corpus_pipeline

    sf = labels_at(spark, tmp_path, [(1, 1, 0), (2, 1, 0), (5, 0, 1), (None, 1, 1), (9, None, None)])
    docs = odd_documents(spark)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, docs.limit(0), sf).collect() == [], name
        got = stage(spark, docs, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert got.dtypes == docs.dtypes, name
            rows = [tuple(r) for r in got.collect()]
            assert set(rows) <= {tuple(r) for r in docs.collect()}, name
    kept = [(r.doc_id, (r.text or "")[:9]) for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf).collect()]
    assert sorted(kept, key=str) == sorted([(1, "w0 w1 w2 "), (3, ""), (3, ""), (4, ""), (None, ""), (5, "a b c"), (5, "other wor"), (7, "long long"), (8, "one two t")], key=str)
    packed = corpus_pipeline.packing_stage(spark, docs, sf).collect()
    assert sorted((r.doc_id for r in packed if r.piece == 0), key=str) == sorted((r.doc_id for r in docs.collect()), key=str)


def test_near_duplicates_of_the_stage_are_brute_force(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) for r in docs.collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in texts.items()}
    label = {i: i for i in sets}
    for _ in sets:
        before = dict(label)
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    got = corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted({*label.values()})
