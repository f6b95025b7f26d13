"""Fixed values of the crawl: patterns, keywords and limits that results depend on."""

from dataclasses import dataclass

# Fixed values, from here to the end.
EXTRACTOR_VERSION = "1.0.0"
RECRAWL_TTL_DAYS = 30
RUN_RETENTION_DAYS = 90
MIN_BODY_TEXT_LENGTH = 200


@dataclass(frozen=True)
class Limits:
    """Crawl limits of a profile."""

    pages_per_domain: int = 5000
    trusted_hops: int = 2
    off_domain_hops: int = 1
    min_cross_domain_score: int = 1
    global_queue: int = 50_000


DEFAULT = Limits()
HIGH_COVERAGE = Limits(20_000, 4, 2, 1, 250_000)

# Regular expressions on the path of a URL; all but DATE_PATH ignore case.
RECIPE_PATHS = ["/opskrift/", "/recipe/", "/opskrifter/", "/recipes/", "/bagning/", "/mad/", "/kog/", "/mat/", "/recept/", "/rezepte?/", "/oppskrift/", "/oppskrifter/", "/middagsretter?/", "/aftensmad/", "/desserts?/", "/kuchen/"]
HARD_DENY_PATHS = ["/search(?:$|[/?])", "/soeg(?:$|[/?])", "/sog(?:$|[/?])", "/login(?:$|[/?])", "/log-ind(?:$|[/?])", "/cart(?:$|[/?])", "/kurv(?:$|[/?])", "/print/", "/feed/", "/wp-json/", "/api(?:$|[/?])", "/webapi(?:$|[/?])", "/account(?:$|[/?])", "/konto(?:$|[/?])", "/checkout(?:$|[/?])", "/betaling(?:$|[/?])", "/privacy(?:$|[/?])", "/cookie(?:$|[/?])"]
SOFT_PATHS = ["/tag/", "/tags/", "/kategori/", "/kategorier/", "/category/", "/categories/", "/page/[0-9]+", "/side/[0-9]+"]
DATE_PATH = "/[0-9]{4}/[0-9]{2}/?$"
SKIP_EXTENSIONS = r"\.(jpe?g|png|gif|webp|svg|ico|bmp|avif|tiff?|mp4|webm|avi|mov|mp3|wav|ogg|pdf|zip|gz|css|js|woff2?|ttf|eot)$"
STRIP_PARAMS = ["utm_.*", "fbclid", "gclid", "ref", "print", "amp"]
ANCHOR_KEYWORDS = ["recipe", "recipes", "opskrift", "opskrifter", "mad", "bagning", "dessert", "middag", "dinner", "breakfast", "lunch", "cake", "kage", "soup", "salat", "salad", "recept", "recepten", "oppskrift", "oppskrifter", "zutaten", "zubereitung", "aftensmad", "frokost", "frukost", "morgonmad", "morgenmad", "desserts"]
JS_MARKERS = ["__NEXT_DATA__", "__NUXT__", "window.__INITIAL_STATE__"]
DOMAIN_LANGUAGES = [(".dk", "da"), (".se", "sv"), (".no", "no"), (".de", "de"), (".at", "de"), (".ch", "de"), (".uk", "en")]
TEXT_KEYWORDS = {
    "da": ["opskrift", "opskrifter", "ingredienser", "fremgangsmåde", "tilberedning", "portioner", "minutter", "sådan gør du", "aftensmad", "morgenmad"],
    "en": ["recipe", "recipes", "ingredients", "instructions", "method", "serves", "minutes", "tablespoon", "teaspoon", "bake"],
    "sv": ["recept", "ingredienser", "gör så här", "tillagning", "portioner", "minuter", "middag", "frukost"],
    "no": ["oppskrift", "oppskrifter", "ingredienser", "fremgangsmåte", "tilberedning", "porsjoner", "minutter", "middag"],
    "de": ["rezept", "rezepte", "zutaten", "zubereitung", "anleitung", "portionen", "minuten", "backen", "kochen"],
}
INGREDIENT_KEYWORDS = ["ingredienser", "ingrediens", "ingredients", "ingredient", "råvaror", "zutaten"]
INSTRUCTION_KEYWORDS = ["fremgangsmaade", "fremgangsmåde", "tilberedning", "sådan gør du", "instructions", "method", "steps", "gör så här", "saadan goer du", "sadan gor du", "fremgangsmåte", "oppskrift", "zubereitung", "anleitung", "zubereiten"]
#: Labels that times and yields stand next to, by field.
VALUE_KEYWORDS = {
    "prepTime": ["forberedelsestid", "prep time", "preparation time", "förberedelsetid", "vorbereitungszeit"],
    "cookTime": ["tilberedningstid", "cook time", "cooking time", "tillagningstid", "steketid", "kochzeit", "backzeit"],
    "totalTime": ["samlet tid", "total time", "tid i alt", "total tid", "gesamtdauer", "gesamtzeit"],
    "recipeYield": ["portioner", "serves", "serveringer", "udbytte", "portionen", "porsjoner", "antal portioner"],
}
#: (domain, sitemap, start URL) of the trusted seeds; none needs a browser, all respect robots.txt.
SEEDS = [
    ("arla.dk", "https://arla.dk/sitemap.xml", "https://arla.dk/opskrifter/"),
    ("dk-kogebogen.dk", "https://www.dk-kogebogen.dk/sitemap/sitemap.xml", "https://www.dk-kogebogen.dk/opskrifter/"),
    ("madensverden.dk", "https://madensverden.dk/sitemap.xml", "https://madensverden.dk/opskrifter/"),
    ("nemlig.com", None, "https://www.nemlig.com/opskrifter"),
    ("spisbedre.dk", "https://spisbedre.dk/sitemap.xml", "https://spisbedre.dk/opskrifter"),
    ("mummum.dk", "https://mummum.dk/sitemap_index.xml", "https://mummum.dk/opskrifter/"),
    ("juliebruun.com", "https://juliebruun.com/sitemap_index.xml", "https://juliebruun.com/opskrifter/"),
]
#: White space as browsers' scripts see it, as a character class of Java or RE2.
WHITE_CODES = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
