"""Layouts of single sites: from the DOM of a page to one recipe.

A layout gives the recipe's fields; name, ingredients and instructions are counted for the
confidence. Other layouts can be added with ``register``.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from larder.operators.dom import HEADINGS, Node, clean, distinct, text_with_breaks

Recipe = dict[str, object]
COUNTED = ("name", "recipeIngredient", "recipeInstructions")
#: Older names that a field is given under, too.
OLDER = {"name": "title", "recipeIngredient": "ingredients", "recipeInstructions": "instructions"}
_CUT = re.compile(r"\n+|(?<=\.)\s+(?=[A-ZÆØÅ])")


@dataclass(frozen=True)
class Site:
    """Domains, the layout, what is added to the confidence, and the signals."""

    domains: tuple[str, ...]
    layout: Callable[[Node], Recipe]
    bonus: float
    signals: tuple[str, ...]


SITES: list[Site] = []


def register(site: Site) -> None:
    SITES.insert(0, site)


def site_of(domain: str | None) -> Site | None:
    return next((s for s in SITES if domain and any(domain == d or domain.endswith("." + d) for d in s.domains)), None)


def with_older(recipe: Recipe) -> Recipe:
    """Empty fields go; fields with an older name have it as well."""
    kept = {k: v for k, v in recipe.items() if v}
    return kept | {old: kept[new] for new, old in OLDER.items() if new in kept}


def fields(recipe: Recipe) -> int:
    return sum(k in recipe for k in COUNTED)


# pieces of layouts


def first_text(root: Node, *tags: str) -> str:
    return next((clean(n.text()) for n in root.find(*tags)), "")


def titled(root: Node, *titles: str) -> Node | None:
    """The first heading with exactly one of the titles."""
    wanted = [t.lower() for t in titles]
    return next((h for h in root.find(*HEADINGS) if clean(h.text()).lower() in wanted), None)


def below(heading: Node) -> list[Node]:
    """Siblings after a heading, up to the next heading; the very next one is always among them."""
    after = heading.following()
    stop = next((i for i, n in enumerate(after) if n.tag in HEADINGS), len(after))
    return after[: max(stop, 1)]


def section_items(root: Node, *titles: str) -> list[str]:
    """List items below a heading without their check boxes, or else the lines of what stands there."""
    heading = titled(root, *titles)
    if heading is None:
        return []
    part, bare = below(heading), lambda n: clean(re.sub(r"^▢\s*", "", n.text()))
    return distinct(bare(i) for n in part for i in n.find("li")) or distinct(x for n in part for x in _CUT.split(bare(n)))


def after_label(root: Node, *labels: str) -> str:
    """What an element says after its label, or the element next to it; the first in the page that says anything."""
    body = next(iter(root.find("body")), root)
    for node in body.walk():
        if node is body:
            continue
        text = clean(node.text())
        if text.startswith(labels):
            for label in labels:
                text = text.replace(label, "", 1)
            follower = node.following()[:1]
            if found := clean(text) or clean("".join(n.text() for n in follower)):
                return found
    return ""


def lines_between(text: str, start: str, ends: tuple[str, ...]) -> str:
    """The lines after the first that begins with ``start``, up to one that begins with an end."""
    lines = [x for x in map(clean, text.split("\n")) if x]
    first = next((i for i, x in enumerate(lines) if x.startswith(start)), None)
    if first is None:
        return ""
    last = next((i for i in range(first + 1, len(lines)) if lines[i].startswith(ends)), len(lines))
    return " ".join(lines[first + 1 : last])


def text_value(text: str, label: str) -> str:
    """The rest of the line after ``label :``."""
    found = re.search(rf"{re.escape(label)}\s*:\s*([^\n]+)", text, re.I)
    return clean(found[1]) if found else ""


def text_section(text: str, start: str, ends: tuple[str, ...], cut: str) -> list[str]:
    """Parts of the text between ``start :`` and the line of an end label; parts of one character go."""
    begin = re.search(rf"{re.escape(start)}\s*:", text, re.I)
    if not begin:
        return []
    rest = text[begin.end() :]
    end = re.search(r"\n(?:" + "|".join(map(re.escape, ends)) + r")\s*:", rest, re.I)
    rest = rest[: end.start()] if end else rest
    rest = re.sub(r"\n[ \t]+", "\n", re.sub(r"[ \t]+\n", "\n", rest.replace("\r", "")))
    parts: list[str] = []
    for part in filter(lambda x: len(x) > 1, map(clean, re.split(cut, re.sub(r"\n{3,}", "\n\n", rest).strip()))):
        if part.lower().startswith(tuple(f"{e.lower()}:" for e in ends)):
            break
        parts.append(part)
    return distinct(parts)


def as_string(value: object) -> str:
    return clean(value) if isinstance(value, str) else ""


def as_number(value: object) -> float | None:
    """A finite number, or a string of one; an empty string is zero."""
    if isinstance(value, bool) or not isinstance(value, (int, float, str)):
        return None
    try:
        number = float(value or 0) if not isinstance(value, str) else float(value.strip() or 0)
    except ValueError:
        return None
    return number if math.isfinite(number) else None


def shown(value: object) -> str:
    """A number without useless zeros; nothing for anything else."""
    number = as_number(value)
    return "" if number is None else str(int(number)) if number == int(number) else repr(number)


def minutes(value: object) -> str:
    return f"{shown(value)} min" if as_number(value) is not None else ""


def record(value: object) -> dict:
    return value if isinstance(value, dict) else {}


def entries(value: object, key: str) -> list:
    """All members of the lists that the groups of a list hold under ``key``."""
    groups = value if isinstance(value, list) else []
    return [x for g in groups if isinstance(record(g).get(key), list) for x in record(g)[key]]


# layouts


def _arla(root: Node) -> Recipe:
    heading, before = titled(root, "Ingredienser"), []
    if heading is not None and heading.parent is not None:
        own = [c for c in heading.parent.children if isinstance(c, Node)]
        before = [clean(n.text()) for n in own[: own.index(heading)] if n.tag == "p"]
    body = next(iter(root.find("body")), root)
    times = (x for x in map(clean, body.text().split("\n")) if re.fullmatch(r"\d+\s*(?:min(?:utter)?|time(?:r)?(?:\s+\d+\s*min(?:utter)?)?)", x, re.I))
    return {
        "name": first_text(root, "h1"),
        "description": " ".join(x for x in before if x),
        "totalTime": next(times, ""),
        "recipeIngredient": section_items(root, "Ingredienser"),
        "recipeInstructions": section_items(root, "Sådan gør du"),
    }


def _spisbedre(root: Node) -> Recipe:
    raw = next((n.attrs["data-page"] for n in root.walk() if n.attrs.get("id") == "app" and n.attrs.get("data-page")), "")
    page: dict = {}
    for candidate in (raw, raw.replace("&quot;", '"').replace("&#039;", "'").replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")):
        try:
            page = record(json.loads(candidate))
            break
        except ValueError:
            continue
    data = record(record(page.get("props")).get("recipe"))
    if not data or as_string(page.get("component")) != "app/pages/Recipes/Details":
        return {}

    def ingredient(x: object) -> str:
        unit, what = record(record(x).get("unit")), record(record(x).get("ingredient"))
        singular, plural = as_string(what.get("name_singular")), as_string(what.get("name_plural"))
        name = plural if record(x).get("ingredient_inflection") == "plural" else singular or plural
        unit_name = as_string(unit.get("abbreviation")) or as_string(unit.get("name_singular")) or as_string(unit.get("name_plural"))
        return " ".join(p for p in (shown(record(x).get("amount")), unit_name, as_string(record(x).get("prefix")), name, as_string(record(x).get("suffix"))) if p)

    size, kind = as_number(data.get("serving_size")), record(data.get("serving_size_type"))
    singular, plural = as_string(kind.get("name_singular")), as_string(kind.get("name_plural"))
    return {
        "name": as_string(data.get("title")),
        "description": " ".join(x for x in (as_string(data.get(k)) for k in ("description", "note_message", "tip_message")) if x),
        "prepTime": minutes(data.get("preparation_time")),
        "totalTime": minutes(data.get("total_time")),
        "recipeYield": "" if size is None else clean(f"{shown(size)} {singular if size == 1 else plural or singular}"),
        "author": as_string(data.get("author")),
        "recipeIngredient": distinct(map(ingredient, entries(data.get("grouped_ingredients"), "ingredients"))),
        "recipeInstructions": distinct(as_string(record(x).get("instruction")) for x in entries(data.get("grouped_instructions"), "instructions")),
    }


def _madensverden(root: Node) -> Recipe:
    return {
        "name": first_text(root, "h1"),
        "description": lines_between(text_with_breaks(root), "Samlet tid:", ("Antal:", "Ret:")),
        "prepTime": after_label(root, "Forb. tid:", "Forberedelsestid:"),
        "cookTime": after_label(root, "Tilb. tid:", "Tilberedningstid:"),
        "totalTime": after_label(root, "Samlet tid:"),
        "recipeYield": after_label(root, "Antal:"),
        "recipeCategory": after_label(root, "Ret:"),
        "recipeCuisine": after_label(root, "Køkken:"),
        "recipeIngredient": section_items(root, "Ingredienser"),
        "recipeInstructions": section_items(root, "Fremgangsmåde"),
    }


def _kogebogen(root: Node) -> Recipe:
    text, paragraphs = text_with_breaks(root), r"\n{2,}|\n(?=[A-ZÆØÅ])"
    return {
        "name": first_text(root, "h1") or next((x for x in map(clean, text.split("\n")) if x), ""),
        "recipeYield": text_value(text, "Antal"),
        "recipeCategory": text_value(text, "Ret"),
        "recipeCuisine": text_value(text, "Oprindelsesland"),
        "recipeIngredient": text_section(text, "Ingredienser", ("Opskrift", "Tips", "karakterer"), r"\n"),
        "recipeInstructions": text_section(text, "Opskrift", ("Tips", "karakterer"), paragraphs),
        "description": " ".join(text_section(text, "Tips", ("karakterer",), paragraphs)),
    }


SITES += [
    Site(("arla.dk",), _arla, 0.15, ("site-specific-arla",)),
    Site(("spisbedre.dk",), _spisbedre, 0.25, ("site-specific-spisbedre", "spisbedre-page-data")),
    Site(("madensverden.dk",), _madensverden, 0.2, ("site-specific-madensverden",)),
    Site(("dk-kogebogen.dk",), _kogebogen, 0.2, ("site-specific-dk-kogebogen",)),
]


def extract_site(root: Node, domain: str | None) -> tuple[Recipe, float, list[str]] | None:
    """(recipe, confidence, signals) by the layout of the page's site; None without one, or if it finds no counted field."""
    site = site_of(domain)
    recipe = with_older(site.layout(root)) if site else {}
    n = fields(recipe)
    return (recipe, min(n / 3 + site.bonus, 1.0), list(site.signals)) if n else None
