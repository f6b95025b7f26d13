"""Recipe extraction: one parse of a page gives its recipes, method, confidence and signals.

The cascade is JSON-LD (confidence 1), microdata, site layouts, then headings and labels
(confidence: fields found over three). Everything about one page is in plain Python on the DOM; the
DataFrame operator runs it in Arrow batches and explodes the recipes to rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import constants as C
from larder.operators.dom import HEADINGS, Node, clean, distinct, parse
from larder.operators.sites import Recipe, below, extract_site, fields, with_older

# Types, holders of nested recipes and their signals.
_TYPES = {"Recipe", "http://schema.org/Recipe", "https://schema.org/Recipe"}
_HOLDERS = {"mainEntity": "main-entity-wrapper", "mainEntityOfPage": "main-entity-of-page-wrapper", "hasPart": "has-part-wrapper", "subjectOf": "subject-of-wrapper", "about": "about-wrapper"}


def _lines(text: str) -> list[str]:
    return distinct(re.split(r"\n+|•|(?<=\.)\s+(?=[A-ZÆØÅ])", text))


def _strings(value: object) -> list[str]:
    """Instruction or ingredient lines of a string, list, step or section."""
    if isinstance(value, str):
        return _lines(value)
    if isinstance(value, list):
        return [s for v in value for s in _strings(v)]
    if isinstance(value, dict):
        if isinstance(value.get("itemListElement"), list):
            return _strings(value["itemListElement"])
        return next((_lines(value[k]) for k in ("text", "name") if isinstance(value.get(k), str) and clean(value[k])), [])
    return []


def find_recipes(data: object, signals: list[str] | None = None) -> list[Recipe]:
    """Recipe objects anywhere in JSON-LD; what nested holders have goes before the object itself. Wrappers are told in ``signals``."""
    signals = [] if signals is None else signals
    inside = lambda x: find_recipes(x, signals)
    if isinstance(data, list):
        return [r for d in data for r in inside(d)]
    if not isinstance(data, dict):
        return []
    if isinstance(data.get("@graph"), list):
        signals.append("graph-wrapper")
        return inside(data["@graph"])
    for holder, signal in _HOLDERS.items():
        if isinstance(data.get(holder), (dict, list)):
            signals.append(signal)
            if found := inside(data[holder]):
                return found
    if isinstance(items := data.get("itemListElement"), list):
        signals.append("item-list-wrapper")
        if found := [r for i in items for r in inside(i if not isinstance(i, dict) or i.get("item") is None else i["item"])]:
            return found
    kinds = data.get("@type")
    return [data] if any(isinstance(k, str) and k in _TYPES for k in (kinds if isinstance(kinds, list) else [kinds])) else []


def _image(value: object) -> object:
    if isinstance(value, list):
        urls = [u for u in map(_image, value) if isinstance(u, str)]
        return urls[0] if len(urls) == 1 else urls or None
    if isinstance(value, dict):
        value = value.get("url") or value.get("contentUrl")
    return clean(value) or None if isinstance(value, str) else None


def normalize(recipe: Recipe, signals: list[str] | None = None) -> Recipe:
    """Cleaned standard fields; unknown ones stay. A present but empty list hides its older name."""
    out = dict(recipe)
    first = lambda *keys: next((clean(recipe[k]) for k in keys if isinstance(recipe.get(k), str) and clean(recipe[k])), None)
    held = lambda *keys: next((recipe[k] for k in keys if recipe.get(k) is not None), None)
    standard = {
        "name": first("name", "headline", "title"),
        "recipeIngredient": distinct(_strings(held("recipeIngredient", "ingredients"))),
        "recipeInstructions": distinct(_strings(recipe.get("recipeInstructions"))),
        "image": _image(recipe.get("image")),
        "recipeYield": first("recipeYield", "yield"),
        **{k: first(k) for k in ("description", "prepTime", "cookTime", "totalTime")},
    }
    if signals is not None and any(standard[k] for k in ("recipeIngredient", "recipeInstructions", "image", "recipeYield")):
        signals.append("json-ld-normalized-fields")
    out |= {k: v for k, v in standard.items() if v}
    for new, old in (("recipeIngredient", "ingredients"), ("recipeInstructions", "instructions")):
        if standard[new]:
            out.setdefault(old, standard[new])
    return out


def json_ld(html: str) -> tuple[list[Recipe], list[str]]:
    """(recipes, signals) of the JSON-LD scripts; trailing commas are repaired once."""
    recipes, signals = [], []
    for raw in re.findall(r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>", html):
        for entity, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
            raw = raw.replace(entity, char)
        try:
            data = json.loads(raw)
        except ValueError:
            try:
                data = json.loads(re.sub(r",(\s*[}\]])", r"\1", raw))
                signals.append("malformed-json-recovered")
            except ValueError:
                signals.append("malformed-json-failed")
                continue
        recipes += [normalize(r, signals) for r in find_recipes(data, signals)]
    signals += ["json-ld-found"] * bool(recipes) + ["multiple-recipes"] * (len(recipes) > 1)
    return recipes, list(dict.fromkeys(signals))


def microdata(root: Node) -> tuple[Recipe, int] | None:
    """All elements typed as recipes, merged into one; (recipe, fields of name, ingredients, instructions)."""
    scopes = [n for n in root.walk() if "schema.org/Recipe" in n.attrs.get("itemtype", "")]
    props: dict[str, list[str]] = {}
    for n in {id(n): n for s in scopes for n in s.walk() if n is not s}.values():
        for prop in n.attrs.get("itemprop", "").split():
            value = next((x for k in ("content", "datetime", "href", "src") if (x := clean(n.attrs.get(k)))), "") or clean(n.text())
            parts = distinct(li.text() for li in n.find("li")) or _blocks(n.text()) if prop == "recipeInstructions" else [value]
            props.setdefault(prop, []).extend(parts)
    first = lambda k: next(iter(distinct(props.get(k, []))), "")
    recipe: Recipe = {
        "name": first("name") or next((t for s in scopes if (t := clean(next((h.text() for h in s.find("h1", "h2")), "")))), ""),
        "recipeIngredient": distinct(v for k in ("recipeIngredient", "ingredients") for v in props.get(k, [])),
        "recipeInstructions": distinct(props.get("recipeInstructions", [])),
        **{k: first(k) for k in ("image", "description", "prepTime", "cookTime", "totalTime", "recipeYield")},
    }
    recipe = with_older(recipe)
    return (recipe, n) if (n := fields(recipe)) else None


def _blocks(text: str) -> list[str]:
    return distinct(re.split(r"\n+|(?<=\.)\s+(?=[A-ZÆØÅ])", clean(text)))


def text_blocks(nodes: list[Node]) -> list[str]:
    """Paragraphs, then divisions, of a section: their own text and that of such elements inside; parts of over three characters."""
    parts: list[str] = []
    for tag in ("p", "div"):
        for node in nodes:
            if node.tag in ("ul", "ol"):
                continue
            if node.tag == tag:
                parts += _blocks(" ".join(c for c in node.children if isinstance(c, str)))
            parts += [x for n in node.find(tag) for x in _blocks(n.text())]
    return [x for x in distinct(parts) if len(x) > 3]


def near_heading(root: Node, words: list[str]) -> list[str]:
    """Items under the first heading that holds a word and has any: list items, else blocks of text."""
    for heading in root.find(*HEADINGS) if words else ():
        said = clean(heading.text()).lower()
        if any(w in said for w in words):
            part = below(heading)
            if items := distinct(i.text() for n in part for i in n.find("li")) or text_blocks(part):
                return items
    return []


_LABELS = {*HEADINGS, "dt", "strong", "b"}


def near_label(root: Node, words: list[str]) -> str:
    """What stands next to, or else around, the first label that holds a word: headings, terms, labels by class, bold text."""
    for node in root.walk() if words else ():
        kind = node.attrs.get("class", "")
        if node.tag in _LABELS or "label" in kind or "meta" in kind:
            own = node.text()
            said = clean(own).lower()
            if any(w in said for w in words):
                follower = "".join(n.text() for n in node.following()[:1])
                if found := clean(follower) or clean(node.parent.text().replace(own, "", 1) if node.parent else ""):
                    return found
    return ""


def _meta(root: Node, key: str, value: str) -> str:
    return next((clean(n.attrs.get("content")) for n in root.find("meta") if n.attrs.get(key) == value), "")


def heuristics(root: Node) -> tuple[Recipe, float, list[str]]:
    """(recipe, confidence, signals) from headings and labels of any page."""
    h1 = clean(next((n.text() for n in root.find("h1")), ""))
    # what no text of the page holds, no heading or label does
    page = clean(root.text()).lower()
    held = lambda words: [w for w in words if w in page]
    recipe: Recipe = {
        "name": h1 or _meta(root, "property", "og:title") or _meta(root, "name", "twitter:title"),
        "recipeIngredient": near_heading(root, held(C.INGREDIENT_KEYWORDS)),
        "recipeInstructions": near_heading(root, held(C.INSTRUCTION_KEYWORDS)),
        **{k: near_label(root, held(words)) for k, words in C.VALUE_KEYWORDS.items()},
    }
    seen = lambda k, yes, no: [yes if recipe[k] else no]
    signals = seen("name", "heuristic-title-from-h1" if h1 else "heuristic-title-from-meta", "missing-title")
    signals += seen("recipeIngredient", "heuristic-ingredients-from-nearby-content", "missing-ingredients")
    signals += seen("recipeInstructions", "heuristic-instructions-from-nearby-content", "missing-instructions")
    signals += [s for k, s in (("prepTime", "heuristic-prep-time"), ("cookTime", "heuristic-cook-time"), ("totalTime", "heuristic-total-time"), ("recipeYield", "heuristic-yield")) if recipe[k]]
    recipe = with_older(recipe)
    return recipe, fields(recipe) / 3, signals


def site_domain(root: Node) -> str | None:
    """Host of the canonical link, or else of og:url."""
    link = next((n.attrs.get("href") for n in root.find("link") if n.attrs.get("rel") == "canonical"), None)
    url = link if link is not None else next((n.attrs.get("content") for n in root.find("meta") if n.attrs.get("property") == "og:url"), None)
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return found[1].lower() if found else None


def extract(html: str | None, domain: str | None) -> tuple[list[Recipe], str, float, list[str]]:
    """(recipes, method, confidence, signals) of one page; ``domain`` is asked for a layout where the page names no site."""
    html = html or ""
    recipes, signals = json_ld(html)
    if recipes:
        return recipes, "json-ld", 1.0, signals
    root = parse(html)
    if found := microdata(root):
        return [found[0]], "html-parsing", min(found[1] / 3, 1.0), [*signals, "microdata-found"]
    if found := extract_site(root, site_domain(root) or domain):
        return [found[0]], "html-parsing", found[1], [*signals, *found[2]]
    recipe, confidence, more = heuristics(root)
    return ([recipe], "html-parsing", confidence, [*signals, *more]) if confidence else ([], "partial", 0.0, [*signals, *more])


def recipe_language(recipe: Recipe | None) -> str | None:
    """The first language string of inLanguage: a string, or one in a list or in an object's alternateName, identifier or name."""

    def first(value: object) -> str | None:
        if isinstance(value, str):
            return value
        if isinstance(value, list):
            return next((x for x in map(first, value) if x), None)
        if isinstance(value, dict):
            return next((x for k in ("alternateName", "identifier", "name") if (x := first(value.get(k))) is not None), None)
        return None

    return first((recipe or {}).get("inLanguage"))


def recipe_text(recipe: Recipe | None) -> str:
    """All strings of the fields that say something of the language."""

    def strings(value: object) -> list[str]:
        if isinstance(value, str):
            return [value]
        inner = value if isinstance(value, list) else value.values() if isinstance(value, dict) else []
        return [s for v in inner for s in strings(v)]

    return " ".join(s for k in ("name", "headline", "title", "description", "recipeIngredient", "ingredients", "recipeInstructions", "instructions") for s in strings((recipe or {}).get(k)))


def canonical_json(value: object) -> str:
    """JSON with sorted keys and trimmed strings; the order of lists counts."""
    trim = lambda v: {k: trim(x) for k, x in v.items()} if isinstance(v, dict) else [trim(x) for x in v] if isinstance(v, list) else v.strip() if isinstance(v, str) else v
    return json.dumps(trim(value), sort_keys=True, ensure_ascii=False, separators=(",", ":"))


EXTRACTED = "page_id long, method string, confidence double, signals array<string>, recipes array<string>, recipe_languages array<string>, recipe_texts array<string>"


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, method, confidence, signals, recipes as canonical JSON, what they say of their language) of ``pages(page_id, domain, html)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [extract(h, d) for h, d in zip(batch.column("html").to_pylist(), batch.column("domain").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    pa.array([r[1] for r in rows]),
                    pa.array([r[2] for r in rows], pa.float64()),
                    pa.array([r[3] for r in rows], pa.list_(pa.string())),
                    *(pa.array([[f(x) for x in r[0]] for r in rows], pa.list_(pa.string())) for f in (canonical_json, recipe_language, recipe_text)),
                ],
                ["page_id", "method", "confidence", "signals", "recipes", "recipe_languages", "recipe_texts"],
            )

    return pages.select("page_id", "domain", "html").mapInArrow(run, EXTRACTED)


def explode_recipes(extracted: DataFrame) -> DataFrame:
    """One row per recipe with its content hash, the recipe as VARIANT, and its language's inputs."""
    each = F.posexplode(F.arrays_zip(F.col("recipes").alias("recipe_json"), F.col("recipe_languages").alias("recipe_language"), F.col("recipe_texts").alias("recipe_text")))
    rows = extracted.select("page_id", "method", "confidence", each.alias("pos", "r")).select("page_id", "method", "confidence", "pos", "r.*")
    return rows.withColumn("content_hash", F.sha2("recipe_json", 256)).withColumn("raw_recipe", F.try_parse_json("recipe_json"))


def content_hash(recipe: Recipe) -> str:
    return hashlib.sha256(canonical_json(recipe).encode()).hexdigest()
