import itertools
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row

from fleetmart.llm import block_labeller, url_rules
from fleetmart.llm.block_labeller import BiLstm, Labeller, extract_main_text
from fleetmart.llm.blocks import blocks
from fleetmart.llm.queries import QUERIES
from fleetmart.llm.url_rules import UrlMining, judge_urls

TINY = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert texts("<p>a <b>b</b>\n c<p>d<br>e</p>f<!-- x <p>y --><script>'</p>z'</script>") == ["a b c", "d e", "f"]
    assert texts("x &amp;lt; &eacute;&nbsp;&#33; 1 < 2") == ["x &lt; é ! 1 < 2"]
    assert texts("<html><head><title>t<p></title><style>p{}</style><body>b") == ["b"]
    assert texts('<div title="a > b">c</div><p cla') == ["c"]
    assert texts("<ul><li>a<li>b</ul><!-- open <p>gone") == ["a", "b"]
    assert texts(None) == texts("") == texts("<>") [:0] == []
    assert texts("<textarea>no</textarea><p>yes") == ["yes"]
    paths = {b.text: b.path for b in blocks('<div class="postBody main-col" id=x1><p>in</p></div><p>out')}
    assert paths["in"] == ("div", ".post", ".body", ".main", ".col", ".x", "p") and paths["out"] == ("p",)
    assert [b.link_chars for b in blocks("<p><a>all</a><p>no")] == [3, 0]


def test_path_vectors_equal_the_sum_over_the_path():
    rng = random.Random(2)
    names = ["div", 'div class="post body"', "nav", "section id=mainCol", "ul", "table", "p", "li"]
    p = Labeller()
    for _ in range(30):
        page = "".join(rng.choice([f"<{rng.choice(names)}>", f"</{rng.choice(names).split()[0]}>", "text "]) for _ in range(200))
        read = blocks(page)
        x = block_labeller.features(read, p)
        for i, b in enumerate(read):
            want = np.zeros(p.path_size)
            for k, token in enumerate(reversed(b.path)):
                slot = block_labeller._slot(token)
                want[slot % p.path_size] += (1 if slot >> 16 & 1 else -1) * max(0.25, 1 - 0.1 * k)
            assert np.allclose(x[i, : p.path_size], want, atol=1e-5) and x[i, -2] == pytest.approx(len(b.path) / 10)
        assert block_labeller.taught_blocks(read) == [block_labeller.taught(b.path) for b in read]


def test_deep_pages_are_read_fast():
    began = time.time()
    for page in ("<div class=a>x" * 20_000, "<div>x" * 20_000 + "</p></ul>" * 20_000, "<div><p>x" * 10_000 + "</div>y" * 10_000):
        read = blocks(page)
        assert len(read) >= 20_000 and block_labeller.features(read, Labeller()).shape[0] == len(read) and len(block_labeller.taught_blocks(read)) == len(read)
    assert time.time() - began < 15


def test_gradients():
    rng = np.random.default_rng(0)
    net = BiLstm(5, 3, rng)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, mask = rng.standard_normal((4, 3, 5)), np.ones((4, 3), bool)
    mask[2:, 1] = False
    y = (rng.random((4, 3)) > 0.5) * mask

    def loss():
        s = net.scores(x, mask).astype(float)
        return (np.logaddexp(0, s) - y * s)[mask].mean()

    grads = net.gradients(x, mask, y.astype(float))
    for name, g in grads.items():
        at = tuple(int(rng.integers(n)) for n in g.shape)
        old = net.w[name][at]
        net.w[name][at] = old + 1e-3
        up = loss()
        net.w[name][at] = old - 1e-3
        slope = (up - loss()) / 2e-3
        net.w[name][at] = old
        assert g[at] == pytest.approx(slope, abs=2e-4)


@pytest.fixture(scope="module")
def articles(spark):
    return {r["page_id"]: r["text"] for r in QUERIES["op1_block_labeller"](spark, TINY).collect()}


def test_articles_of_the_table(articles):
    pages = dict(duckdb.connect().execute(f"SELECT page_id, html FROM '{TINY}/pages.parquet'").fetchall())
    assert set(pages) == set(articles)
    for page_id, page in pages.items():
        inner = re.search("<article>(.*?)(</article>|$)", page, re.S).group(1)
        assert articles[page_id] == "\n".join(texts(inner))


#: Layouts that the training pages do not have.
STRANGE = [
    '<body><div id="top-header"><h2>{o}</h2><ul class="main-menu"><li><a>{o}</a><li><a>{o}</a></ul></div><div class="col"><main><h1>{t}</h1><p>{a}</p><div class="ad">{o}</div><p>{b}</p></main><aside><p>{o}</p></aside></div>'
    '<section class="reader-comments"><p>{c}</p><p>{c}</p></section><footer>{o}</footer>',
    '<body><nav><a>{o}</a> <a>{o}</a></nav><div class="cookie-bar"><p>{o}</p><button>{o}</button></div><article class="post"><header><h1>{t}</h1></header><p>{a}</p><p>{b}</p><form><label>{o}</label></form></article>'
    '<div id="comments"><ol><li>{c}</li></ol></div><div class="site-footer">{o}</div>',
    '<body><table><tr><td><ul class="nav"><li>{o}</li><li>{o}</li></ul></td><td class="content"><h1>{t}</h1><p>{a}</p><p>{b}</p></td></tr></table><div class="footer"><p>{o}</p></div>',
]


def test_held_out_layouts(spark, articles):
    """Trained on the table, applied to pages of other layouts; words right over words found and over words wanted."""
    pages = [r["html"] for r in spark.read.parquet(f"{TINY}/pages.parquet").orderBy("page_id").collect()]
    p = Labeller()
    net = block_labeller.train(pages[:150], p)
    rng, right, found, wanted = random.Random(2), 0, 0, 0
    lines = [x for t in articles.values() for x in t.split("\n") if len(x.split()) > 3]
    short = [b.text for page in pages[150:200] for b in blocks(page) if "nav" in b.path or ".ad" in b.path]
    for layout in STRANGE * 20:
        t, a, b = (rng.choice(lines) for _ in range(3))
        page = re.sub(r"\{(\w)\}", lambda m: {"t": t, "a": a, "b": b}.get(m.group(1)) or (rng.choice(short) if m.group(1) == "o" else rng.choice(lines)), layout)
        page_blocks = blocks(page)
        main = [x.text for x, keep in zip(page_blocks, block_labeller.label([page_blocks], net, p)[0]) if keep]
        got = " ".join(main).split()
        want = set(t.split()) | set(a.split()) | set(b.split())
        right += sum(w in want for w in got)
        found += len(got)
        wanted += len((t + " " + a + " " + b).split())
    assert right / found > 0.85 and right / wanted > 0.9


def test_pages_of_odd_rows(spark):
    main = "<article><p>hello world</p></article>"
    rows = [Row(1, "u", f"<nav>menu</nav>{main}<footer>end</footer>", "x"), Row(1, "u", f"<nav>menu</nav>{main}<footer>end</footer>", "x"), Row(2, None, None, "x"), Row(None, "v", "", "x"),
            Row(3, "w", "<p>word</p>" * 20_000, "x"), Row(4, "w", "<nav>only</nav>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(df).collect()
    assert len(got) == 6 and {r["text"] for r in got if r["page_id"] in (2, None)} == {""} and all(r["n_chars"] == len(r["text"]) for r in got)
    assert extract_main_text(df.where("page_id = 2")).first()["text"] == "" and extract_main_text(df.limit(0)).count() == 0


# urls


def brute_rule(host, path):
    best = None
    for r in url_rules.HOST_RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.name) > len(best.name)):
            best = r
    return best


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    return host, re.split("[?#]", rest[n:], maxsplit=1)[0]


ODD_URLS = [
    None, "", "net", "://", "http://NET", "http://net/", "http://x.NET/en/", "https://example.net/en/1", "https://a.example.net/en", "https://notexample.net/en/", "http://Example.COM/de/x?y#z", "http://example.com/DE/",
    "http://org/fr/1", "http://w.org?/fr/", "http://w.org/fr/://example.net/en/", "a://b://net/", "http://é.org/fr/", "http://x.org/fr/" + "a" * 9000, "http:// net/", "//x.net/", "http://x.net#/", "http://x.net:80/",
]


@pytest.fixture
def pages(spark):
    return lambda urls: spark.createDataFrame([Row(i, u, "h", "r", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, verdict string")


def test_rules_equal_brute_force(spark, pages):
    labels = spark.createDataFrame([], "id long, verdict string")
    got = {r["page_id"]: r for r in judge_urls(pages(ODD_URLS), labels).collect()}
    for i, url in enumerate(ODD_URLS):
        host, path = brute_parts(url)
        rule = brute_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule.name if rule else None), url
        assert got[i]["verdict"] == rule.verdict if rule else got[i]["verdict"] in ("allow", "block")


def brute_mined(rows, params):
    """Rules by trying all token sets; {tokens: (verdict, confidence, support)}."""
    labelled = [(frozenset(t), v) for t, v in rows if v]
    floor = params.support * len(labelled)
    seen = {}
    for t, v in labelled:
        for k in range(1, len(t) + 1):
            for part in itertools.combinations(sorted(t), k):
                seen.setdefault(part, {}).setdefault(v, 0)
                seen[part][v] += 1
    rules = {}
    for part, by in seen.items():
        for v, n in by.items():
            # A frequent set is counted up to the next whole row.
            if n >= np.ceil(floor) and n / sum(by.values()) >= params.confidence:
                rules[part] = (v, n / sum(by.values()), n / len(labelled))
    return {p: r for p, r in rules.items() if not any(rules.get(tuple(x for x in p if x != t), (0, -1))[1] >= r[1] for t in p)}


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        t = sorted({rng.choice("abcdefg") for _ in range(rng.randrange(0, 5))})
        bad = ("a" in t and "b" in t) or "g" in t
        rows.append((t, rng.choice([None, "block" if bad ^ (rng.random() < 0.1) else "allow"])))
    params = UrlMining(support=0.03, confidence=0.75)
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    index = url_rules.mine_rules(df, url_rules.Workspace(spark, "t"), params)
    got = {tuple(r["wants"]): (r["verdict"], pytest.approx(r["confidence"]), pytest.approx(r["support"])) for r in index.collect()}
    want = brute_mined(rows, params)
    assert got == want and len(want) > 5
    urls = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(rows)], "url string, tokens array<string>")
    verdicts = {r["url"]: r["mined_verdict"] for r in url_rules.match_rules(urls, index).collect()}
    for i, (t, _) in enumerate(rows):
        fits = [(c, s, " ".join(p), v) for p, (v, c, s) in want.items() if set(p) <= set(t)]
        assert verdicts.get(str(i)) == (max(fits)[3] if fits else None)


def test_urls_of_the_table(spark):
    got = QUERIES["op2_url_rules"](spark, TINY).collect()
    urls = dict(duckdb.connect().execute(f"SELECT page_id, url FROM '{TINY}/pages.parquet'").fetchall())
    assert len(got) == len(urls)
    for r in got:
        host, path = brute_parts(urls[r["page_id"]])
        rule = brute_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.name if rule else None) and r["verdict"] in ("allow", "block")
    assert any(r["rule"] is None and r["mined"] for r in got)


def test_tokens(spark, pages):
    url = "HTTPS://Blog.a-b.Example.com/De/12/x9.html?p=1&utm=2#top"
    got = set(pages([url]).select(url_rules.tokens().alias("t")).first()["t"])
    assert got == {"scheme:https", "top:com", "domain:example.com", "host:blog", "host:a-b", "word:blog", "word:a", "word:b", "path:de", "path:#", "path:x#", "ending:html", "asks:p", "asks:utm", "fragment"}


def test_urls_of_an_empty_table(spark, pages):
    assert judge_urls(pages([]), spark.createDataFrame([], "id long, verdict string")).count() == 0
