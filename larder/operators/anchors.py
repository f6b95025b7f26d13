"""Anchors of a page by one pass over its tags, and the table function ``extract_links`` for SQL.

The pass knows comments, raw text (scripts, styles, titles, text areas, ...), quoted values, unclosed tags
and character references. It goes forward only, so a page costs its length: what is not closed at the end
of the page ends the pass. An anchor ends at its end tag, at the next anchor or at the end of the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

#: Elements whose content is text, whatever it looks like (fixed values of HTML).
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"[\s/]*+([^\s/>][^\s=/>]*+)(\s*+=\s*+)?+")
_UNQUOTED = re.compile(r"[^\s>]*+")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}


def tags(html: str) -> Iterator[tuple[int, int, str, dict[str, str] | None]]:
    """(start, end, name, attributes) of each tag, in order; of an end tag the name has a slash and the attributes are None. Comments have none; the end of raw text is an end tag."""
    at = html.find("<")
    while at >= 0:
        if html.startswith("<!--", at):
            # <!--> and <!---> are whole comments
            end = html.find("-->", at + 2)
            if end < 0:
                yield at, len(html), "!", None
                return
            yield at, end + 3, "!", None
            at = html.find("<", end + 3)
            continue
        named = _NAME.match(html, at)
        if named is None:
            if html.startswith(("<!", "<?", "</"), at):  # a comment of the old kind
                end = html.find(">", at)
                if end < 0:
                    yield at, len(html), "!", None
                    return
                yield at, end + 1, "!", None
                at = html.find("<", end + 1)
            else:
                at = html.find("<", at + 1)
            continue
        name = named[1].lower()
        end, attributes = _attributes(html, named.end())
        if end < 0:  # the page ends within the tag
            yield at, len(html), "!", None
            return
        closing = html[at + 1] == "/"
        yield at, end, f"/{name}" if closing else name, None if closing else attributes
        if name in RAW and not closing:
            found = _CLOSE[name].search(html, end)
            if found is None:
                return
            at = found.start()
        else:
            at = html.find("<", end)


def _attributes(html: str, at: int) -> tuple[int, dict[str, str]]:
    """Where a tag ends, -1 if it doesn't, and its attributes; of a repeated name the first counts."""
    found: dict[str, str] = {}
    while True:
        attribute = _ATTRIBUTE.match(html, at)
        if attribute is None:
            end = html.find(">", at)
            return (end + 1 if end >= 0 else -1), found
        name, value, at = attribute[1].lower(), "", attribute.end()
        if attribute[2]:
            quote = html[at : at + 1]
            if quote in ('"', "'") and quote:
                end = html.find(quote, at + 1)
                if end < 0:
                    return -1, found
                value, at = html[at + 1 : end], end + 1
            else:
                plain = _UNQUOTED.match(html, at)
                value, at = plain[0], plain.end()
        found.setdefault(name, value)


def anchors(html: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    """(base, [(href, text)]): the href of the first base tag, and of each anchor with an href that and its text, character references decoded."""
    base, out = None, []
    href, parts, low = None, [], 0
    html = html or ""
    for start, end, name, attributes in tags(html):
        if href is not None:
            parts.append(html[low:start])
            low = end
            if name in ("a", "/a"):
                out.append((unescape(href), unescape("".join(parts))))
                href = None
        if name == "a" and "href" in attributes:
            href, parts, low = attributes["href"], [], end
        elif name == "base" and base is None and "href" in attributes:
            base = unescape(attributes["href"])
    if href is not None:
        out.append((unescape(href), unescape("".join([*parts, html[low:]]))))
    return base, out


def against(base: str | None, url: str | None) -> str | None:
    """A base tag's href as an absolute URL; null where it has none."""
    if base is None:
        return None
    try:
        joined = urljoin(url or "", base.strip())
    except ValueError:
        return None
    return joined if re.match(r"https?://[^/?#]", joined, re.IGNORECASE) else None


@udtf(returnType="pos int, href string, anchor_text string, base string", useArrow=True)
class ExtractLinks:
    """A row for each anchor of a page, in its order; with what the page's base tag makes of its URL, null without one."""

    def eval(self, html: str, url: str):
        base, found = anchors(html)
        base = against(base, url)
        for pos, (href, text) in enumerate(found):
            yield pos, href, text, base


def register(spark: SparkSession) -> None:
    """``extract_links(html, url)`` in SQL, for ``LATERAL``."""
    spark.udtf.register("extract_links", ExtractLinks)
