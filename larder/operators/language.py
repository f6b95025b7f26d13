"""The language of a page or recipe: the first tier that tells wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import text as T

#: Scripts, styles and all that is not in the body say nothing to readers.
_BODY = r"(?is)<body[^>]*>(.*?)(?:</body\s*>|\z)"


def body_text(html: Column) -> Column:
    """Text of the body, as it stands; all of it where there is no body tag. Tags go, the usual entities are decoded."""
    body = F.regexp_extract(html, _BODY, 1)
    text = F.regexp_replace(F.when(body == "", F.regexp_replace(html, r"(?is)<head[\s>].*?</head\s*>", "")).otherwise(body), r"(?s)<!--.*?-->|<[^>]+>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def detected(rows: DataFrame, *, recipe_language: str = "recipe_language", html: str = "html", domain: str = "domain", recipe_text: str = "recipe_text") -> DataFrame:
    """Adds language, language_confidence and language_signals.

    Tiers: the recipe's inLanguage (1), the html lang (0.95), og:locale (0.9) and meta language
    (0.85); keywords in the recipe's text, the body and the html, a tie going to the domain's
    language; that language alone (0.45); ``und``. All inputs may be null.
    """
    stated = T.language_code(F.col(recipe_language))
    hint = T.domain_language(F.col(domain))
    searched = F.concat_ws(" ", *(F.nullif(c, F.lit("")) for c in (F.col(recipe_text), body_text(F.col(html)), F.col(html))))
    rows = rows.withColumn("_t", T.normal_text(searched)).withColumn("_scores", T.language_scores(F.col("_t"), hint)).drop("_t")
    rows = rows.withColumns({"_meta": T.html_language(F.col(html)), "_text": T.text_language(F.col("_scores")), "_hint": hint, "_stated": stated})
    signal = F.concat(F.lit("domain-hint:"), "_hint")
    by_text = F.concat(F.lit("text-keywords:"), "_text.language", F.lit(":"), "_text.score")
    tell = lambda language, confidence, *signals: F.struct(language.alias("language"), confidence.cast("double").alias("confidence"), F.array(*signals).alias("signals"))
    found = (
        F.when(F.col("_stated").isNotNull(), tell(F.col("_stated"), F.lit(1.0), F.lit("recipe-inLanguage")))
        .when(F.col("_meta").isNotNull(), tell(F.col("_meta.language"), F.col("_meta.confidence"), F.col("_meta.signal")))
        .when(F.col("_text").isNotNull() & (F.col("_text.language") == F.col("_hint")), tell(F.col("_text.language"), F.col("_text.confidence"), by_text, signal))
        .when(F.col("_text").isNotNull(), tell(F.col("_text.language"), F.col("_text.confidence"), by_text))
        .when(F.col("_hint").isNotNull(), tell(F.col("_hint"), F.lit(0.45), signal))
        .otherwise(tell(F.lit("und"), F.lit(0.0), F.lit("language-undetected")))
    )
    rows = rows.withColumn("_found", found)
    return rows.withColumns({"language": F.col("_found.language"), "language_confidence": F.col("_found.confidence"), "language_signals": F.col("_found.signals")}).drop("_scores", "_meta", "_text", "_hint", "_stated", "_found")
