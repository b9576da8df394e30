import pytest
from pyspark.sql import functions as F

from tidepool.functions import html as H
from tidepool.functions import urls
from tidepool.operators import web


def _pages(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page_id long, html string")


def test_walker_tolerates_broken_html():
    root = H.parse('<script>var t="</p>";</script><div id="a"><p>x<br>y<p>z</div><a href="q">w</a>')
    assert H.select_first(root, "#a").text() == "x y z"
    assert [n.attrs["href"] for n in H.select_all(root, "a")] == ["q"]
    assert H.extract(None, H.Rule(scope=(("#a",),), items="p")) == []


def test_w1_links_filter(spark):
    html = '<div id="vContent"><a href="/archives/1">T1</a><a href="/about">x</a></div><a href="/archives/9">o</a>'
    out = web.extract_links(_pages(spark, html, "", None)).collect()
    assert [(r.text, r.href) for r in out] == [("T1", "/archives/1")]


def test_w2_fallback(spark):
    post = '<div id="post"><div class="contents"><a href="/1">T</a></div></div>'
    recent = '<div id="recent-post"><div class="contents"><a href="/r">R</a></div></div>'
    out = web.extract_links(_pages(spark, post, recent + post), web.RULE_LINKS_FALLBACK,
                            href_contains=None).collect()
    assert sorted((r.page_id, r.href) for r in out) == [(0, "/1"), (1, "/r")]


def test_w3_images(spark):
    html = ('<div id="primary"><img src="a.JPG"><img src="x.svg" data-src="b.png">'
            '<img src="c.gif" data-src="d"><img src="e.webp"></div>')
    out = web.extract_images(_pages(spark, html)).orderBy("item_pos").collect()
    assert [r.image_src for r in out] == ["a.JPG", "b.png", "d"]


def test_w4_fallback_no_fall_through(spark):
    outer = '<div class="main-outer"><div class="post-body"><img src="a.png"></div></div>'
    post_only = '<div id="post"><p>x</p></div>' + outer
    out = web.extract_images(_pages(spark, outer, post_only), web.RULE_IMAGES_FALLBACK).collect()
    assert [(r.page_id, r.image_src) for r in out] == [(0, "a.png")]


def test_w5_pager(spark):
    html = ('<div class="gtb"><table class="ptt"><tr><td><a href="u1">1</a></td>'
            '<td><a href="u2">&gt;</a></td><td><a href="u3">1234</a></td></tr></table></div>')
    out = web.extract_pager(_pages(spark, html)).orderBy("pos").collect()
    assert [(r.label, r.href) for r in out] == [("001", "u1"), ("234", "u3")]


def test_w6_w7(spark):
    html6 = '<div id="gdt"><a href="s/1">i</a></div>'
    assert [r.href for r in web.extract_containers(_pages(spark, html6)).collect()] == ["s/1"]
    html7 = ('<div class="sni"><div class="sn">n</div><div>01.jpg :: 10 KB</div>'
             '<img style="x" src="i/01.jpg"><img src="no"></div>')
    out = web.extract_named_images(_pages(spark, html7, "<p>none</p>")).collect()
    assert [(r.name, r.src) for r in out] == [("01.jpg", "i/01.jpg")]


def test_site_rules_unknown_site_fails(spark):
    p = spark.createDataFrame([(1, "x.org", "<a href='a'>t</a>")], "page_id long, site string, html string")
    with pytest.raises(Exception, match="no extractor"):
        web.extract_by_site(p, "site", {"y.org": H.Rule(items="a")}).collect()


@pytest.mark.parametrize("base,target,expected", [
    ("http://h.com/a/b?x=1", "http://o.com/z", "http://o.com/z"),
    ("http://h.com/a/b?x=1", "/r", "http://h.com/r"),
    ("http://h.com/a/b?x=1", "rel", "http://h.com/a/b/rel"),
    ("http://h.com:8080/a", "/r", "http://h.com:8080/r"),
    ("http://h.com", "rel", "http://h.com/rel"),
    ("http://h.com/a", "httpfoo", "httpfoo"),
])
def test_resolve_url(spark, base, target, expected):
    df = spark.createDataFrame([(base, target)], "base string, target string")
    assert df.select(urls.resolve_url("target", "base")).first()[0] == expected


def test_unwrap_and_request_path(spark):
    rows = [("http://h/proxy?x=1&url=http%3A%2F%2Fa%2Fb.png%3Fq%3D1",),
            ("http://h:81/p/a.png?x=1#f",), ("http://h/proxy?x=1&url=%zz",), ("http://h/proxy",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(urls.unwrap_source_url("s")).collect()]
    assert got == ["http://a/b.png?q=1", "http://h/p/a.png", None, None]
    paths = spark.createDataFrame([("http://h",), ("http://h/a b/c/",), ("http://h/x?q=1",)], "u string")
    got = [r[0] for r in paths.select(urls.request_path("u")).collect()]
    assert got == ["/", "/a+b/c/", "/x?q=1"]


def test_title_and_file_names(spark):
    df = spark.createDataFrame([(0, "[한글] Title: é-1~x!", "/a/b.c/img.PNG"), (4, "x", "noext")],
                               "p int, t string, path string")
    out = df.select(urls.title_slug("p", "t"), urls.image_file_name("p", "path")).collect()
    assert tuple(out[0]) == ("001.한글 Title -1~x", "00000.PNG")
    assert tuple(out[1]) == ("005.x", None)


def test_resolve_redirects(spark):
    log = spark.createDataFrame([
        ("http://a/1", 200, None), ("http://a/2", 302, "/1"), ("http://a/3", 301, "http://a/2"),
        ("http://a/4", 302, "/4"), ("http://a/5", 404, None), ("http://a/6", 302, None),
        ("http://a/7", 302, "/8"), ("http://a/8", 302, "/9"), ("http://a/9", 302, "/10"),
        ("http://a/10", 302, "/1")], "url string, status int, location string")
    out = {r.url: (r.final_url, r.hops, r.outcome) for r in web.resolve_redirects(log, 2).collect()}
    assert out["http://a/1"] == ("http://a/1", 0, "ok")
    assert out["http://a/2"] == ("http://a/1", 1, "ok")
    assert out["http://a/3"] == ("http://a/1", 2, "ok")
    assert out["http://a/4"][2] == "loop"
    assert out["http://a/5"][2] == "error" and out["http://a/6"][2] == "error"
    assert out["http://a/7"][2] == "too_many_hops"
    free = {r.url: (r.final_url, r.hops, r.outcome) for r in web.resolve_redirects(log).collect()}
    assert free["http://a/7"] == ("http://a/1", 4, "ok")
    assert {u: v for u, v in free.items() if u != "http://a/7" and u != "http://a/8"} == \
        {u: v for u, v in out.items() if u != "http://a/7" and u != "http://a/8"}


def test_redirects_against_a_walk(spark):
    """Random logs, with retries, body links, loops and tails, against a plain walk."""
    import random
    rng = random.Random(11)
    rows, n = [], 60
    for i in range(n):
        kind = rng.random()
        to = f"http://h/{rng.randrange(n + 5)}"
        if kind < 0.75:
            rows.append((f"http://h/{i}", 302, to, None, 1))
        elif kind < 0.8:
            rows.append((f"http://h/{i}", 301, None, f"<p><A class=q HREF='{to}'>x</a>", 1))
        else:
            rows.append((f"http://h/{i}", rng.choice([200, 404]), None, None, 1))
        if rng.random() < 0.2:
            rows.append((f"http://h/{i}", 503, None, None, 0))
    rows += [(f"http://c/{i}", 302, f"/{i + 1}", None, 1) for i in range(40)] + [("http://c/40", 200, None, None, 1)]
    # large loops: names in an order, two small ones far apart, and shuffled, with tails
    for ring, order in (("r", list(range(64))), ("s", [0, *range(99, 50, -1), 1, *range(50, 1, -1)]),
                        ("t", rng.sample(range(97), 97))):
        names = [f"http://{ring}/{k:03}" for k in order]
        rows += [(a, 302, b, None, 1) for a, b in zip(names, names[1:] + names[:1])]
        rows += [(f"http://{ring}/x{k}", 302, f"http://{ring}/x{k - 1}" if k else names[5], None, 1) for k in range(7)]
    log = spark.createDataFrame(rows, "url string, status int, location string, body string, attempt int")
    last = {}
    for u, s, to, body, at in sorted(rows, key=lambda r: r[4]):
        to = to or (body.split("'")[1] if body else None)
        if to and to.startswith("/"):
            to = "http://c" + to
        last[u] = (s, to if s in (301, 302) else None)
    want = {}
    for u in last:
        path = [u]
        while True:
            status, to = last.get(path[-1], (None, None))
            if to is None:
                want[u] = (path[-1], status, len(path) - 1, "ok" if status == 200 else "error")
                break
            if to in path:
                want[u] = (to, status, len(path), "loop")
                break
            path.append(to)
    got = {r.url: (r.final_url, r.final_status, r.hops, r.outcome)
           for r in web.resolve_redirects(log, attempt="attempt").collect()}
    assert got == want
    limited = {r.url: r for r in web.resolve_redirects(log, max_hops=5, attempt="attempt").collect()}
    for u, (end, status, hops, outcome) in want.items():
        if hops <= 5:
            assert (limited[u].final_url, limited[u].final_status, limited[u].hops, limited[u].outcome) == want[u]
        else:
            assert limited[u].outcome == "too_many_hops" and limited[u].hops == 5


def test_positions_need_an_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "g string, t long")
    with pytest.raises(Exception, match="no position"):
        web.positional_index(df, ["g"], "t").collect()


def test_paths_of_any_scheme(spark):
    m = spark.createDataFrame([("/d/a", 1), ("/d/b", 1), ("/d/c", 1)], "path string, expected long")
    lst = spark.createDataFrame([("hdfs://host:8020/d/a", 1), ("file:/d/b", 1)], "path string, length long")
    assert [r.path for r in web.fetch_worklist(m, lst).collect()] == ["/d/c"]


def test_fetch_worklist(spark):
    m = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10), ("d", 10)], "path string, expected long")
    lst = spark.createDataFrame([("b", 9), ("c", 10), ("d", 11)], "path string, length long")
    out = sorted((r.path, r.reason) for r in web.fetch_worklist(m, lst).collect())
    assert out == [("a", "missing"), ("b", "short")]


def test_ordered_fold(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, None), (1, 9000, "z"), (2, 1, "x")],
                               "k int, seq long, chunk string")
    out = dict(web.ordered_fold(df, ["k"], "seq", "chunk", seq_chunk=2).collect())
    assert out == {1: "acz", 2: "x"}
    b = spark.createDataFrame([(1, 1, bytearray(b"\xe2\x82")), (1, 2, bytearray(b"\xac")),
                               (2, 1, bytearray(b"\xff"))], "k int, seq long, chunk binary")
    out = dict(web.ordered_fold(b, ["k"], "seq", "chunk", binary=True).collect())
    assert out == {1: "€", 2: ""}


def test_positional_index(spark):
    df = spark.createDataFrame([(1, t) for t in (5, 1, 9, 3, 100)] + [(2, 7)], "g int, t long")
    out = sorted((r.g, r.t, r.pos) for r in web.positional_index(df, ["g"], "t", chunk_width=4).collect())
    assert out == [(1, 1, 0), (1, 3, 1), (1, 5, 2), (1, 9, 3), (1, 100, 4), (2, 7, 0)]


def test_python_workers_import_package_outside_repo(tmp_path):
    """Python tasks must find the package on executors (shipped with
    addPyFile), not rely on the driver's working directory."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from tidepool.functions import html as H
from tidepool.operators import web
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
p = s.createDataFrame([(1, '<nav><a href="/x">X</a></nav>')], "page_id long, html string")
print("ROWS", web.extract_items(p, H.Rule(scope=(("nav",),), items="a")).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]


def test_unwrap_empty_url_item_keeps_jvm_split(spark):
    df = spark.createDataFrame([("http://h/proxy?a=1&url=",), ("http://h/proxy?myurl=x%2Fy&url=z",)], "s string")
    got = [r[0] for r in df.select(urls.unwrap_source_url("s")).collect()]
    assert got == ["url", "x/y"]


def test_prefilter_keeps_results_exact(spark):
    """The JVM-side container prefilter never drops a page the parser would
    extract from (entity-encoded ids and upper-case tags included)."""
    pages = _pages(spark,
                   '<div id="vContent"><a href="/archives/1">a</a></div>',
                   '<div id="v&#67;ontent"><a href="/archives/2">b</a></div>',
                   '<p>no container</p><a href="/archives/3">c</a>',
                   '<NAV><A HREF="/archives/4">d</A></NAV>')
    got = sorted(r.href for r in web.extract_links(pages).collect())
    assert got == ["/archives/1", "/archives/2"]
    nav = H.Rule(scope=(("nav",),), items="a")
    assert [r.href for r in web.extract_links(pages, nav, href_contains=None).collect()] == ["/archives/4"]
    plan = web.extract_links(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "vContent" in plan


def test_urls_are_lenient_like_jvm_url(spark):
    df = spark.createDataFrame([("http://user@h.com:8080/a b/c?x=1 2#f", "/r", "rel")],
                               "base string, rooted string, rel string")
    r = df.select(urls.resolve_url("rooted", "base"), urls.resolve_url("rel", "base"),
                  urls.unwrap_source_url("base"), urls.request_path("base")).first()
    assert tuple(r) == ("http://h.com:8080/r", "http://h.com:8080/a b/c/rel", "http://h.com/a b/c",
                        "/a+b/c?x=1 2")
    bad = spark.createDataFrame([("not a url",)], "u string").select(urls.url_origin("u")).first()[0]
    assert bad is None


def test_walker_implied_end_tags():
    root = H.parse("<div class='a'><p>one<p>two<div class='b'>x</div><ul><li>1<li>2</ul>"
                   "<table><tr><td>p<td>q<tr><td>r</table></div>")
    assert [p.text() for p in H.select_all(root, "p")] == ["one", "two"]
    assert [n.text() for n in H.select_all(root, "li")] == ["1", "2"]
    assert [n.text() for n in H.select_all(root, "td")] == ["p", "q", "r"]
    assert H.select_first(root, "p + div").attrs["class"] == "b"


def test_fetch_worklist_with_real_listing(spark, tmp_path):
    from tidepool.sources.tables import list_files
    (tmp_path / "a.txt").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"12")
    m = spark.createDataFrame([(str(tmp_path / n), 5) for n in ("a.txt", "b.txt", "c.txt")],
                              "path string, expected long")
    out = sorted((r.path.rsplit("/", 1)[-1], r.reason)
                 for r in web.fetch_worklist(m, list_files(spark, str(tmp_path))).collect())
    assert out == [("b.txt", "short"), ("c.txt", "missing")]


def test_positions_count_kept_items(spark):
    html = ('<div id="vContent"><a href="/about">x</a><a href="/archives/1">T1</a>'
            '<a href="/archives/2">T2</a></div>')
    out = web.extract_links(_pages(spark, html)).orderBy("pos").collect()
    assert [(r.pos, r.href) for r in out] == [(0, "/archives/1"), (1, "/archives/2")]
    imgs = '<div id="primary"><img src="x.svg"><img src="a.png"></div>'
    assert [r.item_pos for r in web.extract_images(_pages(spark, imgs)).collect()] == [0]


def test_url_functions_against_python_model(spark):
    """Randomized URLs: resolve_url / url_origin / request_path vs a model
    built on urllib.parse and the reference's resolution rule."""
    import random
    from urllib.parse import quote_plus, urlsplit
    rnd = random.Random(11)
    segs = ["a", "bb", "c-d", "e.f", "", "x_y"]

    def rand_url():
        host = rnd.choice(["h.com", "www.ex-ample.org", "k8s.io"])
        auth = (rnd.choice(["", "u@", "u:p@"]) + host + rnd.choice(["", ":80", ":8443"]))
        path = "".join("/" + rnd.choice(segs) for _ in range(rnd.randrange(0, 4)))
        query = rnd.choice(["", "?q=1", "?a=b&c=d"])
        frag = rnd.choice(["", "#top"])
        return rnd.choice(["http", "https"]) + "://" + auth + path + query + frag

    def model_origin(u):
        p = urlsplit(u)
        return f"{p.scheme}://{p.hostname}" + (f":{p.port}" if p.port else "")

    def model_resolve(target, base):
        if target.startswith("http"):
            return target
        if target.startswith("/"):
            return model_origin(base) + target
        return model_origin(base) + urlsplit(base).path + "/" + target

    def model_request_path(u):
        p = urlsplit(u)
        if p.path == "":
            out = "/"
        else:
            core = p.path.rstrip("/")
            out = "/".join(quote_plus(x, safe="*") for x in core.split("/"))
            if p.path.endswith("/"):
                out += "/"
        return out + (f"?{p.query}" if "?" in u else "")

    cases = [(rand_url(), rnd.choice(["/r", "rel/x", "http://o.com/z", "q"])) for _ in range(500)]
    df = spark.createDataFrame(cases, "base string, target string")
    got = df.select("base", "target", urls.url_origin("base").alias("o"),
                    urls.resolve_url("target", "base").alias("r"),
                    urls.request_path("base").alias("p")).collect()
    for row in got:
        assert row.o == model_origin(row.base), row
        assert row.r == model_resolve(row.target, row.base), row
        assert row.p == model_request_path(row.base), row
