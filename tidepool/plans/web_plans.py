"""Driver queries for page, link and URL jobs (W1-W17, G8) and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import jsonx, urls
from ..operators import web
from ..sources.tables import read_table
from .registry import register

NAV = H.Rule(scope=(("nav",),), items="a")
_ORIGIN_SQL = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_PATH_SQL = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_LINK_RX = "'<a href=\"([^\"]*)\">([^<]*)</a>'"


def _pages(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "pages", list(cols) if cols else None)


@register("extract_links", f"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, texts[i] AS text, hrefs[i] AS href
FROM (SELECT page_id, regexp_extract_all(html, {_LINK_RX}, 2) AS texts,
             regexp_extract_all(html, {_LINK_RX}, 1) AS hrefs FROM pages) p,
     generate_series(1, len(p.hrefs)) AS g(i)
""")
def extract_links(spark, sf_dir):
    return web.extract_links(_pages(spark, sf_dir, "page_id", "html"), NAV, href_contains=None)


@register("extract_links_filtered", f"""
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos,
       text, href
FROM (
  SELECT page_id, i, texts[i] AS text, hrefs[i] AS href
  FROM (SELECT page_id, regexp_extract_all(html, {_LINK_RX}, 2) AS texts,
               regexp_extract_all(html, {_LINK_RX}, 1) AS hrefs FROM pages) p,
       generate_series(1, len(p.hrefs)) AS g(i))
WHERE contains(href, 'th')
""")
def extract_links_filtered(spark, sf_dir):
    return web.extract_links(_pages(spark, sf_dir, "page_id", "html"), NAV, href_contains="th")


# Pages shaped after the reference's sites, built from every pages row.
def _fixture_pages(spark, sf_dir, kind):
    p = _pages(spark, sf_dir, "page_id")
    i = F.col("page_id").cast("string")
    if kind == "fallback_links":
        recent = F.when(F.col("page_id") % 2 == 0, F.concat(
            F.lit('<div id="recent-post"><div class="contents"><a href="/r'), i,
            F.lit('">R '), i, F.lit('</a></div></div>'))).otherwise(F.lit(""))
        html = F.concat(recent, F.lit('<div id="post"><div class="contents"><a href="/p'), i,
                        F.lit('">P '), i, F.lit('</a><a href="/q'), i,
                        F.lit('">Q</a></div></div>'))
    elif kind == "images":
        html = F.concat(F.lit('<div id="primary"><img src="a'), i, F.lit('.JPG">'),
                        F.lit('<img src="x.svg" data-src="b'), i, F.lit('.png">'),
                        F.lit('<img src="c.gif" data-src="d'), i, F.lit('">'),
                        F.lit('<img src="e.webp"></div><img src="out'), i, F.lit('.png">'))
    elif kind == "images_fallback":
        html = (F.when(F.col("page_id") % 3 == 0, F.concat(
            F.lit('<div class="main-outer"><div class="post-body"><img src="m'), i,
            F.lit('.png"><img src="n.txt"></div></div>')))
            .when(F.col("page_id") % 3 == 1, F.concat(
                F.lit('<div id="post"><p>no contents</p></div>'
                      '<div class="main-outer"><div class="post-body"><img src="z'), i,
                F.lit('.png"></div></div>')))
            .otherwise(F.concat(F.lit('<div id="recent-post"><div class="contents"><img src="r'), i,
                                F.lit('.gif"><img data-src="s'), i, F.lit('.jpg" src="t"></div></div>'))))
    elif kind == "pager":
        html = F.concat(F.lit('<div class="gtb"><table class="ptt"><tr><td><a href="u'), i,
                        F.lit('">'), i, F.lit('</a></td><td><a href="w'), i,
                        F.lit('">'), (F.col("page_id") + 1000).cast("string"),
                        F.lit('</a></td><td><a href="v">&gt;</a></td></tr></table></div>'))
    elif kind == "containers":
        html = F.concat(F.lit('<div id="gdt"><a href="s/'), i, F.lit('">i</a><a href="t/'), i,
                        F.lit('">j</a></div><a href="outside">o</a>'))
    elif kind == "named_images":
        html = F.concat(F.lit('<div class="sni"><div class="sn">n</div><div>'), i,
                        F.lit('.jpg :: 10 KB</div><img style="x" src="i/'), i,
                        F.lit('.jpg"><img src="no"></div>'))
    else:
        raise ValueError(kind)
    return p.select("page_id", html.alias("html"))


@register("extract_links_fallback", """
SELECT page_id, 0 AS pos, 'R ' || page_id AS text, '/r' || page_id AS href FROM pages
 WHERE page_id % 2 = 0
UNION ALL SELECT page_id, 0, 'P ' || page_id, '/p' || page_id FROM pages WHERE page_id % 2 = 1
UNION ALL SELECT page_id, 1, 'Q', '/q' || page_id FROM pages WHERE page_id % 2 = 1
""")
def extract_links_fallback(spark, sf_dir):
    return web.extract_links(_fixture_pages(spark, sf_dir, "fallback_links"),
                             web.RULE_LINKS_FALLBACK, href_contains=None)


@register("extract_images", """
SELECT page_id, 0 AS item_pos, 'a' || page_id || '.JPG' AS image_src FROM pages
UNION ALL SELECT page_id, 1, 'b' || page_id || '.png' FROM pages
UNION ALL SELECT page_id, 2, 'd' || page_id FROM pages
""")
def extract_images(spark, sf_dir):
    return web.extract_images(_fixture_pages(spark, sf_dir, "images"))


@register("extract_images_fallback", """
SELECT page_id, 0 AS item_pos, 'm' || page_id || '.png' AS image_src FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT page_id, 0, 'r' || page_id || '.gif' FROM pages WHERE page_id % 3 = 2
UNION ALL SELECT page_id, 1, 's' || page_id || '.jpg' FROM pages WHERE page_id % 3 = 2
""")
def extract_images_fallback(spark, sf_dir):
    return web.extract_images(_fixture_pages(spark, sf_dir, "images_fallback"),
                              web.RULE_IMAGES_FALLBACK)


@register("extract_pager", """
SELECT page_id, 0 AS pos, right('000' || page_id, 3) AS label, 'u' || page_id AS href FROM pages
UNION ALL SELECT page_id, 1, right('000' || (page_id + 1000), 3), 'w' || page_id FROM pages
""")
def extract_pager(spark, sf_dir):
    return web.extract_pager(_fixture_pages(spark, sf_dir, "pager"))


@register("extract_containers", """
SELECT page_id, 0 AS pos, 's/' || page_id AS href FROM pages
UNION ALL SELECT page_id, 1, 't/' || page_id FROM pages
""")
def extract_containers(spark, sf_dir):
    return web.extract_containers(_fixture_pages(spark, sf_dir, "containers"))


@register("extract_named_images", """
SELECT page_id, 0 AS pos, page_id || '.jpg' AS name, 'i/' || page_id || '.jpg' AS src FROM pages
""")
def extract_named_images(spark, sf_dir):
    return web.extract_named_images(_fixture_pages(spark, sf_dir, "named_images"))


@register("resolve_url", f"""
SELECT page_id, 'rooted' AS kind, '/p/' || page_id AS target,
       {_ORIGIN_SQL} || '/p/' || page_id AS resolved FROM pages
UNION ALL SELECT page_id, 'relative', 'rel' || page_id,
       {_ORIGIN_SQL} || {_PATH_SQL} || '/rel' || page_id FROM pages
UNION ALL SELECT page_id, 'absolute', 'https://cdn.example.com/' || page_id,
       'https://cdn.example.com/' || page_id FROM pages
""")
def resolve_url(spark, sf_dir):
    p = _pages(spark, sf_dir, "page_id", "url")
    i = F.col("page_id").cast("string")
    t = F.explode(F.array(
        F.struct(F.lit("rooted").alias("kind"), F.concat(F.lit("/p/"), i).alias("target")),
        F.struct(F.lit("relative").alias("kind"), F.concat(F.lit("rel"), i).alias("target")),
        F.struct(F.lit("absolute").alias("kind"),
                 F.concat(F.lit("https://cdn.example.com/"), i).alias("target"))))
    x = p.select("page_id", "url", t.alias("t")).select("page_id", "url", "t.*")
    return x.select("page_id", "kind", "target",
                    urls.resolve_url(F.col("target"), F.col("url")).alias("resolved"))


@register("unwrap_source_url", f"""
SELECT page_id,
       CASE WHEN page_id % 3 = 0 THEN 'http://p.example.com/proxy?x=1&url=' || url_encode(url)
            ELSE url END AS src,
       CASE WHEN page_id % 3 = 0 THEN url ELSE {_ORIGIN_SQL} || {_PATH_SQL} END AS unwrapped
FROM pages
""")
def unwrap_source_url(spark, sf_dir):
    p = _pages(spark, sf_dir, "page_id", "url")
    src = F.when(F.col("page_id") % 3 == 0,
                 F.concat(F.lit("http://p.example.com/proxy?x=1&url="), F.url_encode("url"))
                 ).otherwise(F.col("url"))
    return p.select("page_id", src.alias("src")).select(
        "page_id", "src", urls.unwrap_source_url(F.col("src")).alias("unwrapped"))


@register("request_path", f"""
SELECT page_id, CASE WHEN {_PATH_SQL} = '' THEN '/' ELSE {_PATH_SQL} END
       || coalesce('?' || nullif(regexp_extract(url, '\\?([^#]*)', 1), ''), '') AS request_path
FROM pages
""")
def request_path(spark, sf_dir):
    p = _pages(spark, sf_dir, "page_id", "url")
    return p.select("page_id", urls.request_path(F.col("url")).alias("request_path"))


@register("request_path_legacy", f"""
SELECT page_id, CASE WHEN {_PATH_SQL} = '/' THEN '/' ELSE rtrim({_PATH_SQL}, '/') END
       || coalesce('?' || nullif(regexp_extract(url, '\\?([^#]*)', 1), ''), '') AS request_path
FROM pages
""")
def request_path_legacy(spark, sf_dir):
    p = _pages(spark, sf_dir, "page_id", "url")
    return p.select("page_id", urls.request_path(F.col("url"), keep_trailing_slash=False)
                    .alias("request_path"))


@register("title_slug", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_pos,
       printf('%03d.%s', i, regexp_replace(lines[i], '[^ㄱ-ㅎ가-힣0-9a-zA-Z.\\-~ ]', '', 'g')) AS slug
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) d,
     generate_series(1, len(d.lines)) AS g(i)
""")
def title_slug(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    lines = d.select("doc_id", F.posexplode(F.split(F.col("text"), "\n")).alias("line_pos", "line"))
    return lines.select("doc_id", "line_pos", urls.title_slug(F.col("line_pos"), F.col("line")).alias("slug"))


@register("image_file_name", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, hrefs[i] AS path,
       printf('%05d', i - 1) || nullif(regexp_extract(hrefs[i], '(\\.[^.]*)$', 1), '') AS file_name
FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages) p,
     generate_series(1, len(p.hrefs)) AS g(i)
""")
def image_file_name(spark, sf_dir):
    p = _pages(spark, sf_dir, "page_id", "html")
    x = p.select("page_id", F.posexplode(F.regexp_extract_all(
        F.col("html"), F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "path"))
    return x.select("page_id", "pos", "path",
                    urls.image_file_name(F.col("pos"), F.col("path")).alias("file_name"))


def _index_pages(spark, sf_dir):
    """A container page per page linking to the next page's URL (absolute)
    and to a path not in the table."""
    p = _pages(spark, sf_dir, "page_id", "url")
    nxt = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    j = p.join(nxt, "page_id")
    html = F.concat(F.lit('<div id="gdt"><a href="'), F.col("next_url"),
                    F.lit('">next</a><a href="/missing">x</a></div>'))
    return j.select("page_id", "url", html.alias("html"))


@register("crawl_expand", f"""
WITH nxt AS (SELECT a.page_id AS root_id, b.page_id AS target_id, b.url, b.html
               FROM pages a JOIN pages b ON b.page_id = a.page_id + 1)
SELECT root_id, 0 AS hop1_pos, target_id, CAST(i - 1 AS INTEGER) AS hop2_pos,
       {_ORIGIN_SQL} || hrefs[i] AS item_url
FROM (SELECT *, regexp_extract_all(html, {_LINK_RX}, 1) AS hrefs FROM nxt) x,
     generate_series(1, len(x.hrefs)) AS g(i)
""")
def crawl_expand(spark, sf_dir):
    roots = _index_pages(spark, sf_dir)
    pages = _pages(spark, sf_dir, "page_id", "url", "html")
    return web.crawl_expand(roots, pages, web.RULE_CONTAINERS, NAV)


_SITE_SQL = "regexp_extract(url, '^[a-z]+://[^/?#]*?([a-z0-9-]+[.][a-z]+)(?:[/?#]|$)', 1)"
_SITE_RULES = {
    "example.com": NAV,
    "example.net": H.Rule(scope=(("article",),), items="h1"),
    "example.org": H.Rule(scope=(), items="div.ad"),
}


@register("site_rules", f"""
WITH s AS (SELECT page_id, html, {_SITE_SQL} AS site FROM pages)
SELECT page_id, site, CAST(i - 1 AS INTEGER) AS pos, texts[i] AS text, hrefs[i] AS href
FROM (SELECT *, regexp_extract_all(html, {_LINK_RX}, 2) AS texts,
             regexp_extract_all(html, {_LINK_RX}, 1) AS hrefs FROM s WHERE site = 'example.com') p,
     generate_series(1, len(p.hrefs)) AS g(i)
UNION ALL
SELECT page_id, site, 0, trim(regexp_replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1),
       '&amp;', '&'), '[ \t\r\n]+', ' ', 'g')), NULL
  FROM s WHERE site = 'example.net'
UNION ALL
SELECT page_id, site, 0, trim(regexp_replace(replace(regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1),
       '&amp;', '&'), '[ \t\r\n]+', ' ', 'g')), NULL FROM s WHERE site = 'example.org'
""")
def site_rules(spark, sf_dir):
    p = _pages(spark, sf_dir, "page_id", "url", "html")
    p = p.withColumn("site", F.regexp_extract(
        "url", r"^[a-z]+://[^/?#]*?([a-z0-9-]+[.][a-z]+)(?:[/?#]|$)", 1))
    return web.extract_by_site(p, "site", _SITE_RULES)


def _response_log(spark, sf_dir):
    """Each page's answer: chains of up to 28 redirects, a loop of one page, one
    of two with pages that lead into it, a redirect that only its body tells, one
    to nowhere, and a page that failed before it was fetched again."""
    p = _pages(spark, sf_dir, "page_id", "url").groupBy("url").agg(F.min("page_id").alias("page_id"))
    nxt = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    prev = p.select((F.col("page_id") + 1).alias("page_id"), F.col("url").alias("prev_url"))
    j = p.join(nxt, "page_id", "left").join(prev, "page_id", "left")
    k = F.col("page_id") % 60
    status = (F.when((k < 28) | k.isin(42, 43, 44, 45, 50, 51), F.lit(302)).when(k == 40, F.lit(301))
              .when(k % 7 == 3, F.lit(404)).otherwise(F.lit(200)))
    loc = (F.when((k < 28) | k.isin(42, 43, 44), F.col("next_url")).when(k == 45, F.col("prev_url"))
           .when(k == 40, F.col("url")))
    body = F.when(k == 50, F.concat(F.lit('<p>Moved <a class="x" href="'), F.col("next_url"), F.lit('">here</a>.')))
    log = j.select("url", (F.col("page_id") * 2 + 1).alias("attempt"), status.alias("status"),
                   loc.alias("location"), body.alias("body"))
    failed = log.where((F.col("attempt") - 1) / 2 % 60 == 55).select(
        "url", (F.col("attempt") - 1).alias("attempt"), F.lit(503).alias("status"), "location", "body")
    return log.unionByName(failed)


@register("resolve_redirects", """
WITH RECURSIVE
pg AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url),
nx AS (SELECT a.page_id, a.page_id % 60 AS k, a.url, b.url AS next_url, c.url AS prev_url FROM pg a
         LEFT JOIN pg b ON b.page_id = a.page_id + 1 LEFT JOIN pg c ON c.page_id = a.page_id - 1),
lg AS (SELECT url,
         CASE WHEN k < 28 OR k IN (42, 43, 44, 45, 50, 51) THEN 302 WHEN k = 40 THEN 301
              WHEN k % 7 = 3 THEN 404 ELSE 200 END AS status,
         CASE WHEN k < 28 OR k IN (42, 43, 44, 50) THEN next_url WHEN k = 45 THEN prev_url
              WHEN k = 40 THEN url END AS location FROM nx),
walk(url, cur, status, loc, hops, seen, outcome) AS (
  SELECT l.url, l.url, l.status, l.location, 0, [l.url],
         CASE WHEN l.status = 200 THEN 'ok'
              WHEN l.status BETWEEN 300 AND 399 AND l.location IS NOT NULL THEN 'follow'
              ELSE 'error' END
    FROM lg l
  UNION ALL
  SELECT w.url, w.loc, CASE WHEN list_contains(w.seen, w.loc) THEN w.status ELSE l.status END,
         CASE WHEN list_contains(w.seen, w.loc) THEN w.loc ELSE l.location END,
         w.hops + 1, list_append(w.seen, w.loc),
         CASE WHEN list_contains(w.seen, w.loc) THEN 'loop'
              WHEN l.status IS NULL THEN 'error'
              WHEN l.status = 200 THEN 'ok'
              WHEN l.status BETWEEN 300 AND 399 AND l.location IS NOT NULL THEN 'follow'
              ELSE 'error' END
    FROM walk w LEFT JOIN lg l ON l.url = w.loc
   WHERE w.outcome = 'follow'
)
SELECT url, cur AS final_url, status AS final_status, hops, outcome FROM walk WHERE outcome <> 'follow'
""")
def resolve_redirects(spark, sf_dir):
    return web.resolve_redirects(_response_log(spark, sf_dir), attempt="attempt")


@register("fetch_worklist", """
WITH m AS (SELECT '/docs/' || doc_id || '.txt' AS path, n_chars AS expected FROM documents),
     l AS (SELECT '/docs/' || doc_id || '.txt' AS path,
                  CASE WHEN doc_id % 4 = 1 THEN n_chars - 1 WHEN doc_id % 4 = 2 THEN n_chars + 1
                       ELSE n_chars END AS length
             FROM documents WHERE doc_id % 4 <> 0)
SELECT m.path, m.expected, l.length AS have_length,
       CASE WHEN l.length IS NULL THEN 'missing' ELSE 'short' END AS reason
  FROM m LEFT JOIN l ON m.path = l.path
 WHERE l.length IS NULL OR l.length < m.expected
""")
def fetch_worklist(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    path = F.concat(F.lit("/docs/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    manifest = d.select(path.alias("path"), F.col("n_chars").alias("expected"))
    k = F.col("doc_id") % 4
    listing = d.where(k != 0).select(path.alias("path"), F.when(k == 1, F.col("n_chars") - 1)
                                     .when(k == 2, F.col("n_chars") + 1)
                                     .otherwise(F.col("n_chars")).alias("length"))
    return web.fetch_worklist(manifest, listing)


@register("ordered_fold", """
SELECT conv_id, string_agg(text, '' ORDER BY turn) AS content FROM conversations
 WHERE text IS NOT NULL GROUP BY conv_id
""")
def ordered_fold(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    return web.ordered_fold(c, ["conv_id"], "turn", "text")


@register("ordered_fold_bytes", """
SELECT conv_id, string_agg(text, '' ORDER BY turn) AS content FROM conversations
 WHERE text IS NOT NULL GROUP BY conv_id
""")
def ordered_fold_bytes(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    b = c.select("conv_id", "turn", F.encode("text", "UTF-8").alias("chunk"))
    return web.ordered_fold(b, ["conv_id"], "turn", "chunk", binary=True, seq_chunk=2)


@register("positional_index", """
SELECT conv_id, turn, role, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos
  FROM conversations
""")
def positional_index(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role"])
    return web.positional_index(c, ["conv_id"], "turn", chunk_width=4)


# ------------------------------------------------------------------ JSON

@register("json_map_read", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(json_array_length(json_keys(props)) AS INTEGER) AS n_keys FROM events
""")
def json_map_read(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "props"])
    m = jsonx.json_map_read(F.col("props"), "string", "int")
    return e.select("event_id", m.alias("m")).select(
        "event_id", F.col("m")["k"].alias("k"), F.size("m").alias("n_keys"))


@register("json_list_read", """
SELECT event_id, event_type AS first, CAST(user_id AS VARCHAR) AS second, 3 AS n FROM events
""")
def json_list_read(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "event_type", "user_id"])
    js = F.concat(F.lit("['"), F.col("event_type"), F.lit("', '"), F.col("user_id").cast("string"),
                  F.lit("', \"x\"]"))
    lst = jsonx.json_list_read(js, "string")
    return e.select("event_id", lst.alias("l")).select(
        "event_id", F.col("l")[0].alias("first"), F.col("l")[1].alias("second"),
        F.size("l").alias("n"))


@register("json_map_write", """
SELECT event_id, '{"k":' || CAST(json_extract(props, '$.k') AS INTEGER) || ',"u":' || user_id || '}'
       AS js FROM events
""")
def json_map_write(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "user_id", "props"])
    m = jsonx.json_map_read(F.col("props"), "string", "long")
    out = F.map_concat(m, F.create_map(F.lit("u"), F.col("user_id")))
    return e.select("event_id", jsonx.json_map_write(out).alias("js"))


@register("json_list_write", """
SELECT event_id, '["' || event_type || '","' || upper(event_type) || '"]' AS js FROM events
""")
def json_list_write(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "event_type"])
    return e.select("event_id", jsonx.json_list_write(
        F.array(F.col("event_type"), F.upper("event_type"))).alias("js"))
