"""Page jobs over a table of HTML pages.

Parsing is the only Python step: one ``mapInPandas`` pass over
``(id columns, html)`` emits one flat row per extracted item with its
0-based position. Filtering, URL resolution, joins, redirect following and
folds are native Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions.text import contains_ci
from ..functions.urls import pager_label, resolve_url
from ..session import cut_lineage, ensure_parallelism, ship_package
from ..sources.tables import strip_scheme

# Fixed values of the reference's extractors (selectors and filters).
RULE_LINKS = H.Rule(scope=(("#vContent",),), items="a")                       # W1
LINK_FILTER = "archives"
RULE_LINKS_FALLBACK = H.Rule(scope=(("#recent-post", "#post"), (".contents",)), items="a")  # W2
RULE_IMAGES = H.Rule(scope=(("#primary",),), items="img")                     # W3
RULE_IMAGES_FALLBACK = H.Rule(scope=(("#recent-post", "#post"), (".contents",)), items="img",
                              fallback=((".main-outer",), (".post-body",)))   # W4
IMAGE_EXTENSIONS = (".png", ".jpg", ".gif")
RULE_PAGER = H.Rule(scope=((".gtb",), (".ptt",)), items="a")                  # W5
PAGER_SKIP_TEXT = ">"
RULE_CONTAINERS = H.Rule(scope=(("#gdt",),), items="a")                       # W6
RULE_IMAGE_NAMES = H.Rule(scope=((".sni",),), items=".sn + div", items_from_root=True)  # W7
RULE_NAMED_IMAGES = H.Rule(scope=((".sni",),), items="img[style]")            # W7


def _field_name(attr: str) -> str:
    return attr.replace("-", "_")


def _may_match(html: Column, rules: list[H.Rule]) -> Column | None:
    """JVM-side necessary condition for every rule to yield items: one of its
    container tokens occurs in the page (a tag as ``<tag``, any case). Pages
    with ``&`` are always kept, since a character reference could spell a
    token. None when some rule has no safe token."""
    conds = []
    for rule in rules:
        toks = H.required_tokens(rule)
        if toks is None:
            return None
        alts = [F.lower(html).contains("<" + t) if kind == "tag" else html.contains(t)
                for kind, t in toks]
        conds.append(reduce(lambda a, b: a | b, alts))
    return html.contains("&") | reduce(lambda a, b: a & b, conds)


def extract_items(pages: DataFrame, rule: H.Rule, fields: Sequence[str] = ("text", "href"),
                  id_cols: Sequence[str] = ("page_id",), html_col: str = "html") -> DataFrame:
    """Items selected by ``rule`` in every page: ``id_cols, pos, <fields>``.

    ``fields`` are ``text`` or attribute names; an absent attribute is NULL
    (so "attribute exists" is ``isNotNull``). Names with ``-`` become ``_``.
    """
    id_cols = list(id_cols)
    ship_package(pages.sparkSession)
    src = pages.select(*id_cols, F.col(html_col).alias("_html"))
    pre = _may_match(F.col("_html"), [rule])
    if pre is not None:
        src = src.where(pre)
    src = ensure_parallelism(src)
    id_fields = [src.schema[c] for c in id_cols]
    out_fields = [*id_fields, T.StructField("pos", T.IntegerType(), False),
                  *[T.StructField(_field_name(f), T.StringType(), True) for f in fields]]
    schema = T.StructType(out_fields)
    fields = tuple(fields)

    def run(batches):
        for pdf in batches:
            rows = []
            ids = pdf[id_cols].itertuples(index=False, name=None)
            for key, html in zip(ids, pdf["_html"]):
                for pos, item in enumerate(H.extract(html, rule)):
                    rows.append((*key, pos, *[item.get(f) for f in fields]))
            yield pd.DataFrame(rows, columns=schema.fieldNames())

    return src.mapInPandas(run, schema)


def extract_zipped(pages: DataFrame, lists: dict[str, tuple[H.Rule, str]],
                   id_cols: Sequence[str] = ("page_id",), html_col: str = "html") -> DataFrame:
    """Several item lists per page, zipped by position and cut to the
    shortest: ``id_cols, pos, <one column per list>``. One parse per page."""
    id_cols = list(id_cols)
    ship_package(pages.sparkSession)
    src = pages.select(*id_cols, F.col(html_col).alias("_html"))
    pre = _may_match(F.col("_html"), [r for r, _ in lists.values()])
    if pre is not None:
        src = src.where(pre)
    src = ensure_parallelism(src)
    names = list(lists)
    schema = T.StructType([*[src.schema[c] for c in id_cols],
                           T.StructField("pos", T.IntegerType(), False),
                           *[T.StructField(n, T.StringType(), True) for n in names]])
    specs = [lists[n] for n in names]

    def run(batches):
        for pdf in batches:
            rows = []
            ids = pdf[id_cols].itertuples(index=False, name=None)
            for key, html in zip(ids, pdf["_html"]):
                root_lists = [[it.get(f) for it in H.extract(html, r)] for r, f in specs]
                for pos, vals in enumerate(zip(*root_lists)):
                    rows.append((*key, pos, *vals))
            yield pd.DataFrame(rows, columns=schema.fieldNames())

    return src.mapInPandas(run, schema)


# ------------------------------------------------------------------- W1-W7

def _renumber(df: DataFrame, id_cols: Sequence[str], pos_col: str = "pos") -> DataFrame:
    """Positions 0.. among the items kept by a filter (the reference numbers
    the filtered list). A window per page: bounded by one page's items."""
    w = Window.partitionBy(*id_cols).orderBy(pos_col)
    return df.withColumn(pos_col, (F.row_number().over(w) - 1).cast("int"))


def extract_links(pages: DataFrame, rule: H.Rule = RULE_LINKS,
                  href_contains: str | None = LINK_FILTER, **kw) -> DataFrame:
    """``(text, href)`` of the links in the rule's container; with
    ``href_contains`` only hrefs containing it (W1 keeps ``archives``)."""
    out = extract_items(pages, rule, ("text", "href"), **kw)
    if href_contains:
        out = out.where(F.coalesce(F.col("href"), F.lit("")).contains(href_contains))
        out = _renumber(out, list(kw.get("id_cols", ("page_id",))))
    return out


def extract_images(pages: DataFrame, rule: H.Rule = RULE_IMAGES, **kw) -> DataFrame:
    """Image sources: keep an ``img`` when ``src`` or ``data-src``
    contains .png/.jpg/.gif (case-blind, anywhere); the value is ``data-src``
    when that attribute exists, else ``src``."""
    items = extract_items(pages, rule, ("src", "data-src"), **kw)

    def has_ext(c: Column) -> Column:
        c = F.coalesce(c, F.lit(""))
        return reduce(lambda a, b: a | b, [contains_ci(c, e) for e in IMAGE_EXTENSIONS])

    keep = has_ext(F.col("src")) | (F.col("data_src").isNotNull() & has_ext(F.col("data_src")))
    kept = _renumber(items.where(keep), list(kw.get("id_cols", ("page_id",))))
    return kept.select(*kw.get("id_cols", ("page_id",)), F.col("pos").alias("item_pos"),
                       F.coalesce(F.col("data_src"), F.coalesce(F.col("src"), F.lit(""))).alias("image_src"))


def extract_pager(pages: DataFrame, **kw) -> DataFrame:
    """Pager links; text ``>`` dropped; label = last 3 chars of
    ``"000" + text``."""
    items = extract_items(pages, RULE_PAGER, ("text", "href"), **kw)
    id_cols = list(kw.get("id_cols", ("page_id",)))
    kept = _renumber(items.where(F.col("text") != PAGER_SKIP_TEXT), id_cols)
    return kept.select(*id_cols, "pos", pager_label(F.col("text")).alias("label"), "href")


def extract_containers(pages: DataFrame, **kw) -> DataFrame:
    """Hrefs of all links in ``#gdt``."""
    id_cols = list(kw.get("id_cols", ("page_id",)))
    return extract_items(pages, RULE_CONTAINERS, ("href",), **kw).select(*id_cols, "pos", "href")


def extract_named_images(pages: DataFrame, **kw) -> DataFrame:
    """If ``.sni`` exists: names = text up to the first space of each
    ``.sn + div`` (whole page), sources = ``src`` of ``img[style]`` in
    ``.sni``; zipped, the shorter list wins."""
    z = extract_zipped(pages, {"_name_text": (RULE_IMAGE_NAMES, "text"),
                               "src": (RULE_NAMED_IMAGES, "src")}, **kw)
    id_cols = list(kw.get("id_cols", ("page_id",)))
    return z.select(*id_cols, "pos",
                    F.element_at(F.split(F.col("_name_text"), " "), 1).alias("name"), "src")


def extract_by_site(pages: DataFrame, site_col: str, rules: dict[str, H.Rule],
                    fields: Sequence[str] = ("text", "href"),
                    id_cols: Sequence[str] = ("page_id",), html_col: str = "html") -> DataFrame:
    """The extractor is chosen per row by its site; an unknown site
    fails the job. The rules map is small and fixed by the caller."""
    id_cols = list(id_cols)
    ship_package(pages.sparkSession)
    src = pages.select(*id_cols, F.col(site_col).alias("_site"), F.col(html_col).alias("_html"))
    # per-site container prefilter; unknown sites are kept so the job fails on them
    keep = ~F.col("_site").isin(list(rules)) | F.col("_site").isNull()
    for site, rule in rules.items():
        pre = _may_match(F.col("_html"), [rule])
        keep = keep | ((F.col("_site") == site) & (pre if pre is not None else F.lit(True)))
    src = ensure_parallelism(src.where(keep))
    schema = T.StructType([*[src.schema[c] for c in id_cols],
                           T.StructField("site", T.StringType(), True),
                           T.StructField("pos", T.IntegerType(), False),
                           *[T.StructField(_field_name(f), T.StringType(), True) for f in fields]])
    rules = dict(rules)
    fields = tuple(fields)

    def run(batches):
        for pdf in batches:
            rows = []
            ids = pdf[id_cols].itertuples(index=False, name=None)
            for key, site, html in zip(ids, pdf["_site"], pdf["_html"]):
                if site not in rules:
                    raise ValueError(f"no extractor for site {site!r}")
                for pos, item in enumerate(H.extract(html, rules[site])):
                    rows.append((*key, site, pos, *[item.get(f) for f in fields]))
            yield pd.DataFrame(rows, columns=schema.fieldNames())

    return src.mapInPandas(run, schema)


# --------------------------------------------------------------------- W13

def crawl_expand(roots: DataFrame, pages: DataFrame, hop1: H.Rule, hop2: H.Rule,
                 hop2_field: str = "href", root_id: str = "page_id",
                 page_id: str = "page_id") -> DataFrame:
    """Two-hop crawl over an already fetched page table.

    Root page -> links of ``hop1`` resolved against the root URL -> the
    page with that URL (join, no fetching) -> items of ``hop2`` resolved
    against that page's own URL. Output: ``root_id, hop1_pos, target_id,
    hop2_pos, item_url``.

    Each target page is parsed once however many links point at it: the
    distinct target URLs (partial aggregation collapses popular targets)
    select the pages to parse, and the narrow item rows are joined back to
    the links.
    """
    r = roots.select(F.col(root_id).alias("root_id"), F.col("url"), "html")
    links = extract_items(r, hop1, ("href",), id_cols=("root_id", "url"))
    resolved = links.select("root_id", F.col("pos").alias("hop1_pos"),
                            resolve_url(F.col("href"), F.col("url")).alias("target_url"))
    # read twice (distinct targets, final join): parse the roots once
    resolved = cut_lineage(resolved, "crawl-links")
    wanted = resolved.select("target_url").distinct()
    targets = (pages.select(F.col(page_id).alias("target_id"), F.col("url").alias("target_url"), "html")
               .join(wanted, "target_url", "left_semi"))
    items = extract_items(targets.withColumnRenamed("target_url", "url"), hop2, (hop2_field,),
                          id_cols=("target_id", "url"))
    items = items.select("target_id", F.col("url").alias("target_url"), F.col("pos").alias("hop2_pos"),
                         resolve_url(F.col(_field_name(hop2_field)), F.col("url")).alias("item_url"))
    return (resolved.join(items, "target_url")
            .select("root_id", "hop1_pos", "target_id", "hop2_pos", "item_url"))


# --------------------------------------------------------------------- W15

def _first_link(body: Column) -> Column:
    """href of the first ``<a>`` of an HTML body; NULL without one."""
    href = F.regexp_extract(body, r"""(?is)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)""", 1)
    return F.when(href != "", href)


def _doubled(rows: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """``rows`` (u, at, hops, low) one doubling further: each jumps to where its
    target has got to. ``known`` has (at, at2, hops2, low2, done2); ``same``
    tells whether both halves of the way have one smallest name."""
    return cut_lineage(rows.join(known, "at").select(
        "u", F.col("at2").alias("at"), (F.col("hops") + F.col("hops2")).alias("hops"),
        F.least("low", "low2").alias("low"), F.col("done2").alias("done"), (F.col("low") == F.col("low2")).alias("same")), name)


def _known(rows: DataFrame, done: bool) -> DataFrame:
    return rows.select(F.col("u").alias("at"), F.col("at").alias("at2"), F.col("hops").alias("hops2"),
                       F.col("low").alias("low2"), F.lit(done).alias("done2"))


def _chase(nodes: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``nodes`` (u, next, stop): where each one's chain ends, as (u, at, hops,
    low), and the same of those that lead into loops, as far as they have got.
    ``at`` is reached after ``hops`` steps, ``low`` is the smallest name on the
    way. A round is one join, and nodes that have ended take no part in later ones. In a
    round without an end no chain is longer than those that ended: the rest loops."""
    first = nodes.select("u", F.when(F.col("stop"), F.col("u")).otherwise(F.col("next")).alias("at"),
                         F.when(F.col("stop"), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("hops"),
                         F.col("u").alias("low"), "stop")
    cols = ["u", "at", "hops", "low"]
    ended, live = first.where("stop").select(*cols), first.where("NOT stop").select(*cols)
    n = live.count()
    while n:
        step = _doubled(live, _known(ended, True).unionByName(_known(live, False)), "redirect-jumps")
        ended, live = ended.unionByName(step.where("done").select(*cols)), step.where("NOT done").select(*cols)
        was, n = n, live.count()
        if n == was:
            break
    return ended, live, n


def _loops(live: DataFrame, n: int) -> DataFrame:
    """Nodes that all lead into loops, as ``_chase`` leaves them -> (u, size) of
    the nodes on loops. Jumps end on loops alone once the set of their ends no longer
    shrinks. Then the nodes of the loops go on by themselves until every one has the
    smallest name of its loop: two halves of a way with one smallest name overlap."""
    cols = ["u", "at", "hops", "low"]
    ends = live.select(F.col("at").alias("u")).distinct()
    now = ends.count()
    while True:
        if now == n:  # every node is some jump's end
            break
        live = _doubled(live, _known(live, False), "redirect-loops").select(*cols)
        ends = live.select(F.col("at").alias("u")).distinct()
        was, now = now, ends.count()
        if was == now:
            live = live.join(ends, "u", "left_semi")
            break
    while True:
        step = _doubled(live, _known(live, False), "redirect-labels")
        live = step.select(*cols)
        if step.where("NOT same").isEmpty():
            break
    sizes = live.groupBy("low").agg(F.count(F.lit(1)).alias("size"))
    return cut_lineage(live.join(sizes, "low").select("u", "size"), "redirect-sizes")


def resolve_redirects(log: DataFrame, max_hops: int | None = None, start: DataFrame | None = None,
                      attempt: str | None = None) -> DataFrame:
    """Follow redirects through a response log ``(url, status, location)``,
    with ``body`` if the log has it.

    From each start URL (default: every logged URL): status 200 -> ``ok``;
    300-399 -> follow ``location`` or, without one, the first link of ``body``
    (resolved against the URL that answered); anything else, a redirect to
    nowhere or an unlogged URL -> ``error``; a URL already on the path ->
    ``loop``. Chains are followed to their end; with ``max_hops`` one still
    redirecting after so many hops is ``too_many_hops`` at the URL it got to.
    A URL logged more than once counts as its last ``attempt`` (a column), or
    without one as its best answer: 200, then a redirect, then anything else.
    Output: ``url, final_url, final_status, hops, outcome``.
    """
    where = F.col("location")
    if "body" in log.columns:
        where = F.coalesce(where, _first_link(F.col("body")))
    redirect = F.col("status").between(300, 399) & where.isNotNull()
    answer = F.struct("status", F.when(redirect, resolve_url(where, F.col("url"))).alias("next"))
    rank = F.struct(F.when(F.col("status") == 200, 0).when(redirect, 1).otherwise(2), "status", where)
    best = F.max_by(answer, F.col(attempt)) if attempt else F.min_by(answer, rank)
    # one written row for each URL, read by every round
    edges = cut_lineage(log.groupBy("url").agg(best.alias("a")).select("url", "a.status", "a.next"), "redirect-edges")
    starts = edges.select("url") if start is None else start.select("url").distinct()
    names = starts.unionByName(edges.where(F.col("next").isNotNull()).select(F.col("next").alias("url"))).distinct()
    nodes = cut_lineage(
        names.join(edges, "url", "left").select(F.col("url").alias("u"), "next", "status",
                                                F.col("next").isNull().alias("stop")), "redirect-nodes")
    status = nodes.select(F.col("u").alias("end"), "status", "stop")
    if max_hops is not None:
        at = starts.select("url", F.col("url").alias("u"), F.array("url").alias("path"), F.lit(False).alias("loop"))
        for _ in range(max_hops):
            at = cut_lineage(at.join(nodes.select("u", "next").hint("merge"), "u").select(
                "url", F.when(F.col("loop") | F.col("next").isNull(), F.col("u")).otherwise(F.col("next")).alias("u"),
                F.when(F.col("loop") | F.col("next").isNull(), F.col("path"))
                .otherwise(F.concat("path", F.array("next"))).alias("path"),
                (F.col("loop") | F.coalesce(F.array_contains("path", F.col("next")), F.lit(False))).alias("loop")),
                "redirect-steps")
        last = F.when(F.col("loop"), F.element_at("path", -2)).otherwise(F.col("u"))
        return (at.withColumn("end", last).join(status.hint("merge"), "end").select(
            "url", F.col("u").alias("final_url"), F.col("status").alias("final_status"),
            (F.size("path") - 1).alias("hops"),
            F.when(F.col("loop"), "loop").when(~F.col("stop"), "too_many_hops")
            .when(F.col("status") == 200, "ok").otherwise("error").alias("outcome")))

    ended, live, n_live = _chase(nodes)
    out = ended.withColumnRenamed("at", "end").join(status, "end").select(
        "u", "end", "status", "hops", F.when(F.col("status") == 200, "ok").otherwise("error").alias("outcome"))
    if n_live:
        loops = _loops(live, n_live)
        lost = nodes.join(live.select("u"), "u", "left_semi")
        entry, _, _ = _chase(lost.join(loops, "u", "left").select("u", "next", F.col("size").isNotNull().alias("stop")))
        # the loop is closed by the redirect that leads back to its entry
        back = loops.join(lost, "u").select(F.col("next").alias("end"), "status", "size")
        out = out.unionByName(entry.withColumnRenamed("at", "end").join(back, "end").select(
            "u", "end", "status", (F.col("hops") + F.col("size")).alias("hops"), F.lit("loop").alias("outcome")))
    return (out.join(starts.toDF("u"), "u", "left_semi")
            .select(F.col("u").alias("url"), F.col("end").alias("final_url"), F.col("status").alias("final_status"),
                    F.col("hops").cast("int").alias("hops"), "outcome"))


# --------------------------------------------------------------------- W16

def fetch_worklist(manifest: DataFrame, listing: DataFrame, path_col: str = "path",
                   expected_col: str = "expected", length_col: str = "length") -> DataFrame:
    """Work still to do: the file is missing, or shorter than expected.
    ``listing`` may be ``sources.tables.list_files`` output: scheme and
    authority of its paths are dropped before matching."""
    lst = listing.select(strip_scheme(F.col(path_col)).alias("_p"),
                         F.col(length_col).alias("_len"))
    j = manifest.join(lst, manifest[path_col] == lst._p, "left")
    return (j.where(F.col("_len").isNull() | (F.col("_len") < F.col(expected_col)))
            .select(*[manifest[c] for c in manifest.columns], F.col("_len").alias("have_length"))
            .withColumn("reason", F.when(F.col("have_length").isNull(), F.lit("missing"))
                        .otherwise(F.lit("short"))))


# ------------------------------------------------------------------ W17, G8

def ordered_fold(df: DataFrame, key_cols: Sequence[str], seq_col: str, chunk_col: str,
                 out_col: str = "content", binary: bool = False,
                 seq_chunk: int = 4096) -> DataFrame:
    """Concatenate chunks per key in ``seq`` order.

    Two levels so sorting is split: chunks are first concatenated inside
    ``(key, seq div seq_chunk)`` groups, then those pieces per key. With
    ``binary`` the bytes are joined and decoded as UTF-8; invalid UTF-8 gives
    the empty string. NULL chunks are skipped.
    """
    key_cols = list(key_cols)
    piece = F.floor(F.col(seq_col) / F.lit(seq_chunk)).alias("_piece")
    d = df.select(*key_cols, F.col(seq_col).alias("_seq"), piece,
                  F.col(chunk_col).alias("_chunk")).where(F.col("_chunk").isNotNull())
    def join_sorted(arr: Column) -> Column:
        # linear joins: array_join for text; bytes via hex text and back
        vals = F.transform(F.array_sort(arr), lambda x: x.getField("v"))
        if binary:
            return F.unhex(F.array_join(F.transform(vals, lambda x: F.hex(x)), ""))
        return F.array_join(vals, "")

    lvl1 = (d.groupBy(*key_cols, "_piece")
            .agg(join_sorted(F.collect_list(F.struct(F.col("_seq").alias("k"),
                                                     F.col("_chunk").alias("v")))).alias("_part")))
    lvl2 = (lvl1.groupBy(*key_cols)
            .agg(join_sorted(F.collect_list(F.struct(F.col("_piece").alias("k"),
                                                     F.col("_part").alias("v")))).alias("_all")))
    if binary:
        s = F.col("_all").cast("string")
        text = F.when(F.is_valid_utf8(s), s).otherwise(F.lit(""))
    else:
        text = F.col("_all")
    return lvl2.select(*key_cols, text.alias(out_col))


def positional_index(df: DataFrame, group_cols: Sequence[str], order_col: str,
                     out_col: str = "pos", base: int = 0, chunk_width: int = 1 << 16) -> DataFrame:
    """G8 across rows: position of each row in its group by ``order_col``.

    Skew-safe two-level form: ``row_number`` inside ``(group, order div
    chunk_width)`` plus the number of rows in earlier chunks of the group.
    The chunk sizes come from the same Window operator (read on each
    chunk's last row), so the rows are shuffled once; only one row per
    chunk is shuffled again to sum the earlier chunks. A hot group is split
    by chunk. ``order_col`` must be integral and unique in its group; a
    NULL in it fails the job.
    """
    g = list(group_cols)
    ordered = F.when(F.col(order_col).isNull(), F.raise_error(F.lit(f"{order_col} is NULL: no position"))) \
        .otherwise(F.col(order_col))
    d = df.withColumn("_ck", F.floor(ordered / F.lit(chunk_width)).cast("long"))
    w = Window.partitionBy(*g, "_ck").orderBy(order_col)
    d = (d.withColumn("_local", F.row_number().over(w))
         .withColumn("_n", F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding,
                                                                 Window.unboundedFollowing)))
         .withColumn("_nx", F.lead(order_col).over(w)))
    w_off = Window.partitionBy(*g).orderBy("_ck").rowsBetween(Window.unboundedPreceding, -1)
    offs = (d.where(F.col("_nx").isNull())
            .select(*g, "_ck", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off")))
    return (d.drop("_n", "_nx").join(offs, [*g, "_ck"], "left")
            .withColumn(out_col, (F.col("_off") + F.col("_local") - 1 + base).cast("long"))
            .drop("_ck", "_local", "_off"))
