"""URLs as Column expressions: canonical form, domain, links resolved against their page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import constants as C

_STRIPPED = "(?i)^(" + "|".join(C.STRIP_PARAMS) + ")$"


def any_of(patterns: list[str]) -> str:
    return "(?i)(?:" + "|".join(patterns) + ")"


def normalize_domain(host: Column) -> Column:
    """Lower case, without one leading ``www.``."""
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def is_http(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)).isin("http", "https"), F.lit(False))


def domain(url: Column) -> Column:
    """Normalised host; null where there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(normalize_domain(host), F.lit(""))


def path(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(found == "", F.lit("/")).otherwise(found)


#: What is written as it is in a path, and in a parameter's name or value (fixed values of the URL standard).
_PATH_PLAIN, _FORM_PLAIN = r"^[!-~&&[^\"<>`{}\\]]*$", r"^[A-Za-z0-9*._+-]*$"


def encoded_path(p: Column) -> Column:
    """A path with backslashes as slashes, and blanks, non-ASCII and unsafe characters as UTF-8 percent escapes; escapes that are there stay."""
    slashed = F.replace(p, F.lit("\\"), F.lit("/"))
    one = F.transform(F.split(slashed, ""), lambda c: F.when(F.rlike(c, F.lit(_PATH_PLAIN)), c).otherwise(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))))
    return F.when(F.rlike(p, F.lit(_PATH_PLAIN)), p).otherwise(F.array_join(one, ""))


def encoded_form(x: Column) -> Column:
    """A parameter's name or value, decoded and written anew: blanks as ``+``, all but letters, digits and ``*-._`` as escapes. What isn't an escape stays as it was said."""
    return F.when(F.rlike(x, F.lit(_FORM_PLAIN)), x).otherwise(F.url_encode(F.coalesce(F.try_url_decode(x), x)))


def canonicalize(url: Column) -> Column:
    """Canonical form of an absolute http(s) URL; null for anything else.

    Lower-case scheme and host without ``www.`` and default port, no fragment, tracking parameters
    gone, the others sorted by name (order kept within a name) and form-encoded, the path
    percent-encoded, one leading /amp/ or /m/ and one trailing slash cut off. Hosts beyond ASCII stay
    as they are.
    """
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = normalize_domain(F.regexp_extract(url, r"^[^:]+://(?:[^/?#@]*@)?([^/?#]+)", 1))
    host = F.regexp_replace(host, F.when(scheme == "https", F.lit(":443$")).otherwise(F.lit(":80$")), F.lit(""))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    name = lambda p: F.substring_index(p, "=", 1)
    said = lambda x: F.when(F.rlike(x, F.lit("[%+]")), F.coalesce(F.try_url_decode(x), x)).otherwise(x)
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.rlike(said(name(p)), F.lit(_STRIPPED)))
    written = lambda p: F.concat(encoded_form(name(p)), F.lit("="), encoded_form(F.substr(p, F.length(name(p)) + 2)))
    keyed = F.array_sort(F.transform(pairs, lambda p, i: F.struct(said(name(p)).alias("name"), i.alias("at"), written(p).alias("pair"))))
    rest = F.array_join(F.transform(keyed, lambda s: s["pair"]), "&")
    p = F.regexp_replace(encoded_path(path(url)), r"^/(?:amp|m)/", "/")
    p = F.when(p == "/", p).otherwise(F.regexp_replace(p, "/$", ""))
    return F.when(is_http(url) & (host != ""), F.concat(scheme, F.lit("://"), host, p, F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("?"), rest))))


def without_dots(url: Column) -> Column:
    """The URL with ``.`` and ``..`` segments of its path worked out."""
    head, path_, tail = (F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^?#]*)(.*)$", i) for i in (1, 2, 3))
    parts = F.split(F.substring(path_, 2, 1 << 30), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(p == ".", done).otherwise(F.concat(done, F.array(p))))
    last = F.element_at(parts, -1)
    whole = F.concat(head, F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""), tail)
    return F.when(F.rlike(path_, F.lit(r"/\.\.?(?:/|$)")), whole).otherwise(url)


def resolve(href: Column, base: Column) -> Column:
    """An href, without white space at its ends, against the URL of its page."""
    href = F.regexp_replace(href, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    folder = F.regexp_extract(path(base), r"^(.*/)", 1)
    bare = F.regexp_extract(base, r"^([^?#]*)", 1)
    return without_dots(
        F.when(F.rlike(href, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href == "", F.regexp_extract(base, r"^([^#]*)", 1))
        .when(href.startswith("?"), F.concat(bare, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(F.concat(origin, folder, href))
    )


def is_recipe_like(url: Column) -> Column:
    return F.coalesce(F.rlike(path(url), F.lit(any_of(C.RECIPE_PATHS))), F.lit(False))


def storage_key(text: Column) -> Column:
    """Runs of unsafe characters become one dash, dashes are collapsed and trimmed once; ``run`` if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(text, "[^a-zA-Z0-9._-]+", "-"), "-+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(s, "^-|-$", ""), F.lit("")), F.lit("run"))


def run_id(given: Column, started: Column) -> Column:
    """The given id without blanks at its ends, or else the start (a timestamp) as ISO time in UTC; as a storage key."""
    iso = F.date_format(F.to_utc_timestamp(started, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return storage_key(F.coalesce(F.nullif(F.trim(given), F.lit("")), iso))


#: Names that belong to one run.
RUN_NAMES = ["cheerio-queue", "playwright-queue", "link-filter-state", "cheerio-sitemap-request-list", "playwright-sitemap-request-list"]


def run_names(run: Column) -> Column:
    """The names of a run's queues and states, in an array."""
    return F.transform(F.array(*map(F.lit, RUN_NAMES)), lambda n: F.concat(n, F.lit("-"), storage_key(run)))
