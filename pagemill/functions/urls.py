"""URL expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_url(url: Column, keep_params: tuple[str, ...] = ()) -> Column:
    """Address without query, fragment, scheme, ``www.``/``m.``, ``.html`` and one trailing slash.

    Parameters named in keep_params stay, in the order given, as ``?name=value&...``: a forum whose
    threads span pages needs ``page`` kept, else all pages of a thread collapse to one key.
    """
    bare = F.regexp_replace(url, r"[?#].*$", "")
    bare = F.regexp_replace(bare, r"^https?://(www\.|m\.)?", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"\.html$", ""), r"/$", "")
    if not keep_params:
        return bare
    found = [F.nullif(F.regexp_extract(url, rf"[?&]({p}=[^&#]*)", 1), F.lit("")) for p in keep_params]
    query = F.concat_ws("&", *found)
    return F.concat(bare, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def url_host(url: Column) -> Column:
    """Host of a URL, null if the URL can't be parsed."""
    return F.try_parse_url(url, F.lit("HOST"))


def url_origin(url: Column) -> Column:
    """``scheme://host[:port]``, null for anything that isn't an absolute http(s) URL."""
    return F.nullif(F.regexp_extract(url, r"^(https?://[^/?#]+)", 1), F.lit(""))


def resolve_href(base: Column, href: Column) -> Column:
    """Absolute form of a link: absolute, ``//host/x``, ``/x``, ``x``, ``../x``, ``?q`` or ``#f`` against its page's address.

    Dot segments are resolved; what climbs above the root stays at it. Null for links of other schemes, such as
    ``mailto:``, and where a relative link's page has no http(s) address. White space around the link doesn't count.
    """
    href = F.regexp_replace(href, r"^\s+|\s+$", "")
    origin, bare = url_origin(base), F.regexp_replace(base, r"[?#].*$", "")
    path, tail = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"([?#].*)$", 1)
    below = F.regexp_replace(F.substring(bare, F.length(origin) + 1, F.length(bare)), r"[^/]*$", "")
    below = F.when(below == "", "/").otherwise(below)
    own = F.when(href.startswith("#"), F.regexp_replace(base, "#.*$", "")).otherwise(bare)
    return (
        F.when(href.rlike(r"(?i)^https?://"), href)
        .when(href.rlike(r"^//[^/]"), F.concat(F.regexp_extract(origin, r"^(https?:)", 1), href))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | href.startswith("//"), F.lit(None))
        .when(path == "", F.when(origin.isNotNull(), F.concat(own, tail)))
        .when(href.startswith("/"), F.concat(origin, _without_dots(path), tail))
        .otherwise(F.concat(origin, _without_dots(F.concat(below, path)), tail))
    )


def _without_dots(path: Column) -> Column:
    """An absolute path with its dot segments resolved."""
    segments = F.split(F.substring(path, 2, 1 << 30), "/", -1)
    last = F.element_at(segments, -1)
    segments = F.when(last.isin(".", ".."), F.concat(segments, F.array(F.lit("")))).otherwise(segments)

    def add(done: Column, s: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(s == "..", up).when(s == ".", done).otherwise(F.concat(done, F.array(s)))

    folded = F.aggregate(segments, F.array().cast("array<string>"), add)
    return F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(folded, "/"))).otherwise(path)
