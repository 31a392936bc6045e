"""URL filters, WARC archives, HTML extraction and top-k."""
import hashlib
import os
import random

import duckdb
import numpy as np
import pytest

from tidemark.llm import htmltext, topk, urlfilter, warc


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    for c in "?#":
        path = path.split(c, 1)[0]
    fits = [r for r, _ in urlfilter.RULES
            if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return host, path, max(fits, key=len, default=None)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "http://NET/x", "http://anet/x", "http://www.Example.NET/en/1?x#y",
            "https://example.net/en", "https://example.net/de/?://q", "http://x.example.com/de/1", "http://example.com/fr", "http://w.org/fr/?a=b",
            "http://w.org?fr/", "ftp://É.Org/fr/x", "a\nb://C.net/x\ny", "x://y://z.net/", "http://u:p@h.net:80/"]
    rng = random.Random(2)
    urls += [f"http://{rng.choice(['casino-win', 'site', 'blog9'])}{rng.randrange(9)}.example.{rng.choice(['com', 'org', 'net', 'info'])}"
             f"/{rng.choice(['de', 'en', 'fr'])}/{rng.randrange(999)}" for _ in range(300)]
    rows = [(i, u, "h", "r") for i, u in enumerate(urls)] + [(None, urls[8], "h", "r"), (3, urls[3], "h", "r"), (900, "http://h.info/" + "9" * 50000, "h", "r")]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string, host string, rule string")).collect()
    key = lambda x: tuple((v is None, v or "") for v in map(lambda y: None if y is None else str(y), x))
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=key) == sorted(((i, *brute_url(u)) for i, u, *_ in rows), key=key)
    verdicts = dict(urlfilter.RULES)
    assert all(r.verdict == verdicts[r.rule] for r in got if r.rule)
    assert {r.verdict for r in got} <= {"allow", "block"}
    few = spark.createDataFrame([(1, "http://a.info/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urlfilter.judge(few).collect()} == {"allow"}
    assert urlfilter.judge(few.limit(0)).collect() == []


def test_trees_learn_from_labels(spark):
    """Held out: urls of unseen hosts that look like the blocked ones are blocked."""
    rng = random.Random(6)
    rows = []
    for i in range(1200):
        bad = i % 3 == 0
        host = f"{'win-cash' if bad else 'news'}{rng.randrange(1000) if bad else ''}.s{i}.{'net' if i < 800 and bad else 'org' if i < 800 else 'info'}"
        path = "/fr/" + (f"{rng.randrange(10**9)}?a=1&b=2&c=3" if bad else "about/us")
        rows.append((i, f"http://{host}{path}"))
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string")).where("rule is null").collect()
    assert len(got) == 400
    assert sum((r.verdict == "block") == (r.page_id % 3 == 0) for r in got) / len(got) > 0.95


def test_labels_are_not_in_their_own_features(spark):
    """Suffixes with allowed and blocked urls: the rate says nothing of a row's label, so lexical features decide."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        bad = i % 2 == 0
        rows.append((i, f"http://h{rng.randrange(400)}.{'example.net' if not bad else 'shop.net'}/{'en' if not bad else 'x'}/"
                        + ("a" * 30 + f"/{rng.randrange(9**9)}?q={i}" if bad else "about")))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rated = urlfilter.featured(pages)
    rates = {(r.label, r.suffix): r for r in rated.groupBy("label", "suffix").agg({"suffix_rate": "avg"}).collect()}
    one, other = (rates[y, "net"]["avg(suffix_rate)"] for y in (0.0, 1.0))
    assert abs(one - other) < 0.02
    # The rates are those of other folds' labels.
    all_rows = rated.collect()
    for r in all_rows[:40]:
        others = [x.label for x in all_rows if x.suffix == r.suffix and x.fold != r.fold]
        base = sum(x.label for x in all_rows) / len(all_rows)
        assert r.suffix_rate == pytest.approx((sum(others) + 20 * base) / (len(others) + 20))
    sample = urlfilter.sample_rows(rated, urlfilter.class_sizes(rated))
    model = urlfilter.fit_trees(sample)
    weight = dict(zip(urlfilter.FEATURES, model.featureImportances.toArray()))
    assert sum(w for f, w in weight.items() if f not in urlfilter.RATES) > 0.5
    assert "Window" not in sample._jdf.queryExecution().executedPlan().toString()
    right, common = urlfilter.held_out_accuracy(pages)
    assert right > 0.98 and common < 0.6


def test_rules_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.01/pages.parquet"
    urls = duckdb.sql(f"SELECT page_id, url FROM '{folder}'").fetchall()
    got = urlfilter.judge(spark.read.parquet(folder)).collect()
    want = {i: brute_url(u) for i, u in urls}
    assert {r.page_id: (r.host, r.path, r.rule) for r in got} == want and len(got) == len(urls)
    verdicts = dict(urlfilter.RULES)
    assert all(r.verdict == verdicts[r.rule] for r in got if r.rule) and any(r.rule for r in got)


def test_warc_round_trip(spark, tmp_dir):
    rng = random.Random(1)
    big = "".join(rng.choice("abcdefghij <>&é") for _ in range(200_000))
    same = "copy " * 40
    rows = [(i, f"http://h/{i}", same if i % 4 == 0 else f"page {i} " * rng.randrange(1, 60)) for i in range(200)]
    rows += [(500, None, None), (501, "u\r\nWARC-Type: x", ""), (502, "u", "short"), (503, "u", "short"), (504, "u", big), (505, "u", big),
             (None, "u", "unique without id " * 9), (506, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9),
             (507, "u", "a\r\n\r\nb" * 50), (7, "http://h/7", rows[7][2]), (0, "http://h/0", same)]
    pages = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, digest string, bytes int")
    folder = os.path.join(tmp_dir, "a")
    got = warc.archive_round_trip(pages, "file://" + folder, range_bytes=700).collect()
    first = {}
    for i, _, h in rows:
        if h and len(h.encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = first.get(h) if h and len(b) >= 100 else None
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if to is None or to == i else "revisit", None if to == i else to))
    key = lambda x: tuple((v is None, str(v)) for v in x)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert warc.archive_round_trip(pages.limit(0), "file://" + folder + "2").collect() == []


def test_warc_ranges_own_each_record_once(spark, tmp_dir):
    rng = random.Random(4)
    noise = [bytes(rng.randrange(256) for _ in range(rng.randrange(400))) + b"\x1f\x8b\x08\x00" + bytes(9) for _ in range(60)]
    path = os.path.join(tmp_dir, "x.warc.gz")
    with open(path, "wb") as f:
        for i, n in enumerate(noise):
            f.write(warc._member(warc._record("response", f"urn:page:{i}", "u", hashlib.sha256(n).hexdigest(), len(n), n, None)))
        f.write(warc._member(b"not a record"))
        f.write(warc._member(warc._record("response", "urn:page:99", "u", "", 0, b"", None))[:-20])  # cut off
    size = os.path.getsize(path)
    for step in (1, 97, 1000, size):
        found = [(at, f["warc-record-id"]) for a in range(0, size, step) for f, _, at in warc.read_range(path, a, min(a + step, size))] if step > 1 else None
        if found is not None:
            assert [x[1] for x in sorted(found)] == [f"<urn:page:{i}>" for i in range(60)]
            assert len(set(found)) == 60


def test_warc_long_headers(spark, tmp_dir):
    """Urls of any length are read back, and a read that loses a record fails."""
    rng = random.Random(6)
    noise = "".join(rng.choice("abcdefghij0123456789") for _ in range(400_000))
    rows = [(1, "http://h/" + noise, "short"), (2, "http://h/" + "x" * 65_500, "page " * 50), (3, "http://h/" + noise, "page " * 50), (4, "http://h/4", "four")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    uri = "file://" + os.path.join(tmp_dir, "long")
    got = warc.archive_round_trip(pages, uri, range_bytes=5000).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in got) == [(1, 5, "response"), (2, 250, "response"), (3, 250, "revisit"), (4, 4, "response")]
    files = warc.write_archives(pages, uri + "2")
    assert {r.record_id: r.url for r in warc.read_archives(spark, files).collect()} == {f"urn:page:{i}": u for i, u, _ in rows}
    with pytest.raises(ValueError, match="records read of"):
        warc.read_archives(spark, files.selectExpr("path", "bytes", "records + 1 as records"))


def page(body, title="T"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><script>var x='<p>no</p>';</script><style>p{{}}</style></head><body>{body}</body></html>"


def test_html(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(40):
        text = [" ".join(rng.choice(["one", "two", "thé", "x &amp; y", "a&lt;b"]) for _ in range(rng.randrange(3, 30))) for _ in range(rng.randrange(1, 5))]
        plain = [t.replace("&amp;", "&").replace("&lt;", "<") for t in text]
        body = ("<nav><ul>" + "".join(f"<li><a href='/{k}'>menu {k}</a>" for k in range(rng.randrange(1, 6))) + "</ul></nav><header>Site name</header>"
                f"<div class='cookie-notice'>We use cookies {i}</div><aside>Side {i}</aside><!-- c <p>x</p> --><div class=\"ad\">Buy {i}</div>")
        if i % 2:
            body += "<article><h1>Head &eacute; " + str(i) + "</h1>" + "".join(f"<p>{t.replace(' ', '  ', 1)}\n<br>" for t in text) + (
                "<form><input><label>Mail</label></form><div id=comments><p>First!</p></div></article>")
        else:
            body += "<div id=main-content><h1>Head é " + str(i) + "</h1>" + "".join(f"<p><b>{t}</b></p>" for t in text) + "<section class='comments'>hm</section></div>"
        body += "<footer>&copy; site</footer>"
        rows.append((i, f"http://{'A' if i % 2 else 'b'}.example/{i}", page(body)))
        want[i] = "\n".join([f"Head é {i}", *plain])
    rows += [(100, "http://c.example/", None), (101, None, ""), (102, "http://d.example/", page("<article><p>Only one</p></article>")),
             (103, "http://e.example", "plain text & more"), (104, "http://e.example", "<p>unclosed <b>bold<div>next"), (None, None, "<p>x"),
             (1, rows[1][1], rows[1][2]), (105, "http://f.example", page("<article>" + "<p>word</p>" * 20000 + "</article>")),
             (106, "http://g.example", "<" * 2000 + "<a b='" * 500)]
    want |= {100: "", 101: "", 102: "Only one", 103: "plain text & more", 104: "unclosed bold\nnext", None: "x", 105: "\n".join(["word"] * 20000)}
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, host string, main int")
    got = htmltext.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id in want:
            assert r.text == want[r.page_id], r.page_id
        assert r.n_chars == len(r.text)
    found = {r.host: r for r in htmltext.templates(pages.selectExpr("lower(split(url, '/')[2]) host", "cast(html as binary) html").where("host in ('a.example', 'b.example') and html is not null")).collect()}
    assert found["a.example"].main == "html/body/article" and found["b.example"].main == "html/body/div"
    assert "html/body/article/h1" in found["a.example"].template and "html/body/article/p" not in found["a.example"].template
    assert htmltext.extract(pages.limit(0)).collect() == []


def test_html_signatures_of_large_hashes(spark, monkeypatch):
    """The vectors of a host's pages add up to more than a long holds."""
    monkeypatch.setattr(htmltext, "_vector", lambda page, count: (1 << 63) - 1 - count)
    rows = [("h", page(f"<article><p>text {i}</p></article>").encode()) for i in range(20)]
    found = htmltext.templates(spark.createDataFrame(rows, "host string, html binary")).collect()
    assert [r.main for r in found] == ["html/body/article"]


def test_html_copies_count_once(spark):
    """A third of a host's rows are copies of a page of another layout."""
    def body(i):
        return f"<div class=box><p>Story {i} told at length</p><p>and ended {i}</p></div><div class=side>Side text {i}</div>"

    rows = [(i, "http://h.example/", page(body(i))) for i in range(20)]
    rows += [(100 + i, "http://h.example/", page("<section>Error, try again</section>")) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract(pages).collect()}
    assert len(got) == 30
    assert all(got[i] == f"Story {i} told at length\nand ended {i}" for i in range(20))
    one = htmltext.distinct_pages(pages.selectExpr("'h' host", "cast(html as binary) html"))
    assert one.count() == 21


def test_html_text_of_the_template(spark):
    """A text that stands on all pages of a host is template; one on few pages, or of few pages, is not."""
    def body(i):
        shared = "<p>Told in parts</p>" if i % 2 else ""
        return (f"<article><h1>Head {i}</h1><p>Story {i} begins &amp; <b>goes on</b></p><div>Read our <b>offers</b> &amp; save</div>"
                f"<p>the story {i} ends here</p>{shared}<p>You may  like\nthis site</p></article>")

    rows = [(i, "http://h.example/", page(body(i))) for i in range(20)]
    rows += [(100 + i, "http://two.example/", page(f"<article><p>Same</p><p>own {i}</p></article>")) for i in range(2)]
    rows += [(200 + i, "http://links.example/", page(f"<div><p>Notice</p><a href=x>link {i}</a></div>")) for i in range(4)]
    rows += [(300, "http://h.example/", page("<section><p>Other layout</p></section>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract(pages).collect()}
    for i in range(20):
        told = "\nTold in parts" if i % 2 else ""
        assert got[i] == f"Head {i}\nStory {i} begins & goes on\nthe story {i} ends here{told}"
    assert got[100] == "Same\nown 0" and got[203] == "link 3" and got[300] == "Other layout"


def test_html_words_in_longer_names_take_nothing(spark):
    """A listed word in a name that says more is no sign of an aside; alone, or with a word of place, it is."""
    def body(i):
        return (f"<article><h1>Head {i}</h1><section id='header-files'><p>Files {i} with headers</p></section>"
                f"<div class='form-factor'>Factor {i}</div><p class='social-history'>History {i}</p>"
                f"<div class='share-buttons'>Share {i}</div><div class='lead ad-300'>Ad {i}</div><p id=related-posts>More {i}</p></article>")

    pages = spark.createDataFrame([(i, "http://h.example/", page(body(i))) for i in range(8)], "page_id long, url string, html string")
    for r in htmltext.extract(pages).collect():
        assert r.text == f"Head {r.page_id}\nFiles {r.page_id} with headers\nFactor {r.page_id}\nHistory {r.page_id}"


def test_html_class_names(spark):
    """Class names hold slashes and dots, and siblings differ only in a later one."""
    def body(i):
        return (f"<div class='a b c main-x'><p>Story {i} told at some length</p><p>and ended {i}</p></div>"
                f"<div class='a b c side-x'>Side {i}</div>")

    rows = [(i, "http://h.example/", page(body(i))) for i in range(6)]
    rows += [(100 + i, "http://slash.example/", page(f"<div class='w-2/3 p.4'><p>Long text {i} of the page</p><p>more {i}</p></div><div class=w-1/3>Side {i}</div>"))
             for i in range(6)]
    rows += [(200, "http://slash.example/", page("<section class='w-2/3'><div class='x/y'><p>Of its own layout</p><p>whole</p></div></section>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract(pages).collect()}
    assert all(got[i] == f"Story {i} told at some length\nand ended {i}" for i in range(6))
    assert all(got[100 + i] == f"Long text {i} of the page\nmore {i}" for i in range(6))
    assert got[200] == "Of its own layout\nwhole"
    names = [htmltext._name("div", c) for c in ("a.b", "a b", "a/b", "a%2Fb", "x " * 99 + "y" * 99, "x " * 99 + "y" * 98 + "z")]
    assert len(set(names)) == 6 and not any("/" in n for n in names) and max(map(len, names)) <= 3 + htmltext.NAME_CHARS
    assert htmltext._name("div", "b a b") == htmltext._name("div", "a b")


def brute_top(rows, k):
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 20 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 3000.0])
def test_top_k(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "TILE_SCORES", 100)
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-1, 1) * scale for _ in range(5)]) for i in range(400)]
    rows += [(i, rows[20][1]) for i in range(400, 500)]  # a common vector: ties
    rows += [(600, None), (620, [1.0, None, 1.0, 1.0, 1.0]), (640, [float("nan")] * 5), (660, [float("inf")] * 5), (680, []), (701, [1.0, 2.0]), (None, [1.0] * 5)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, block string, score int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, k=20).collect())
    assert got == brute_top(rows, 20)
    few = df.where("vec_id in (0, 1, 2)")
    assert sorted(tuple(r) for r in topk.top_k(few, k=20).collect()) == brute_top(rows[:3], 20)
    assert topk.top_k(df.where("vec_id = 20")).collect() == [] and topk.top_k(df.limit(0)).collect() == []


def test_oracles(spark):
    """Queries with SQL equal it on the smallest tables."""
    import glob

    from tidemark.llm.oracle import ORACLE
    from tidemark.llm.queries import QUERIES
    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for p in glob.glob(folder + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    for name, sql in ORACLE.items():
        rows = QUERIES[name](spark, folder)
        want = con.execute(f"SELECT {', '.join(rows.columns)} FROM ({sql})").fetchall()
        assert sorted(map(str, (tuple(r) for r in rows.collect()))) == sorted(map(str, want)), name
