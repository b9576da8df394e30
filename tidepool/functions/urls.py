"""URL and file-name column functions (W8-W12, F10), JVM-side.

URL parts are taken with regular expressions, as leniently as a JVM ``URL``
(spaces and other raw characters are kept). A text that is not
``scheme://...`` gives NULL parts, and a bad percent escape gives NULL
(``try_url_decode``), where the reference would throw.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SLUG_DROP_PATTERN, extension, zero_pad


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# scheme, optional user info, host[:port]
_AUTH_RX = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#]*)"


def _is_url(url) -> Column:
    return _c(url).rlike(_AUTH_RX)


def url_protocol(url) -> Column:
    return F.when(_is_url(url), F.regexp_extract(_c(url), _AUTH_RX, 1))


def url_host_port(url) -> Column:
    return F.when(_is_url(url), F.regexp_extract(_c(url), _AUTH_RX, 2))


def url_host(url) -> Column:
    """Host without port."""
    return F.regexp_replace(url_host_port(url), r":\d*$", "")


def url_port(url) -> Column:
    """Port digits, NULL when absent."""
    return F.nullif(F.regexp_extract(url_host_port(url), r":(\d+)$", 1), F.lit(""))


def url_origin(url, keep_port: bool = True) -> Column:
    """``protocol://host[:port]``; an absent port is left out."""
    base = F.concat(url_protocol(url), F.lit("://"), url_host(url))
    if not keep_port:
        return base
    port = url_port(url)
    return F.when(port.isNull(), base).otherwise(F.concat(base, F.lit(":"), port))


_PATH_RX = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"
_QUERY_RX = r"^[^?#]*\?([^#]*)"


def url_path(url) -> Column:
    """Path of a URL (lenient like a JVM ``URL``: spaces are kept)."""
    return F.regexp_extract(_c(url), _PATH_RX, 1)


def url_query(url) -> Column:
    """Query of a URL, NULL when there is none."""
    q = F.regexp_extract(_c(url), _QUERY_RX, 1)
    return F.when(_c(url).contains("?"), q)


def resolve_url(target, base) -> Column:
    """``target`` starting with ``http`` as is; starting with ``/`` on the
    base origin; otherwise appended to the base's full path after ``/``."""
    t, b = _c(target), _c(base)
    origin = url_origin(b)
    return (F.when(t.startswith("http"), t)
            .when(t.startswith("/"), F.concat(origin, t))
            .otherwise(F.concat(origin, url_path(b), F.lit("/"), t)))


def unwrap_source_url(src) -> Column:
    """A URL containing ``proxy`` -> the first query item containing
    ``url``, its text after the last ``=``, URL-decoded (query of that URL
    kept); any other URL -> ``protocol://host`` + path (port, query and
    fragment dropped)."""
    s = _c(src)
    items = F.split(url_query(s), "&")
    item = F.element_at(F.filter(items, lambda x: x.contains("url")), 1)
    # a JVM split drops trailing empty items, so "url=" yields "url"
    value = F.element_at(F.split(F.regexp_replace(item, "=+$", ""), "="), -1)
    proxied = F.try_url_decode(value)
    plain = F.concat(url_protocol(s), F.lit("://"), url_host(s), url_path(s))
    return F.when(s.contains("proxy"), proxied).otherwise(plain)


def request_path(url, keep_trailing_slash: bool = True) -> Column:
    """Request path: empty path -> ``/``; each segment URL-encoded;
    a trailing ``/`` kept (``keep_trailing_slash``); ``?query`` appended.
    ``keep_trailing_slash=False`` is the older form where only ``/`` itself
    is special."""
    u = _c(url)
    path = url_path(u)
    core = F.regexp_replace(path, "/+$", "")
    encoded = F.array_join(F.transform(F.split(core, "/"), lambda seg: F.url_encode(seg)), "/")
    if keep_trailing_slash:
        p = (F.when(path == "", F.lit("/"))
             .when(path.endswith("/"), F.concat(encoded, F.lit("/")))
             .otherwise(encoded))
    else:
        p = F.when(path == "/", F.lit("/")).otherwise(encoded)
    query = url_query(u)
    return F.when(query.isNull(), p).otherwise(F.concat(p, F.lit("?"), query))


def title_slug(position0, title) -> Column:
    """``%03d`` of (position + 1), ``.``, the title with every character
    outside the kept set removed."""
    return F.format_string("%03d.%s", _c(position0) + 1,
                           F.regexp_replace(_c(title), SLUG_DROP_PATTERN, ""))


def image_file_name(position0, path) -> Column:
    """``%05d`` of the 0-based position + extension from the last ``.``
    of the path; NULL when the path has no dot."""
    return F.concat(zero_pad(_c(position0), 5), extension(_c(path)))


def pager_label(text) -> Column:
    """W5 label: last 3 characters of ``"000" + text``."""
    return F.right(F.concat(F.lit("000"), _c(text)), F.lit(3))
