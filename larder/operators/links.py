"""From pages to the frontier: links, eligibility, admission, following, caps, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import text as T
from larder.functions import url as U
from larder.operators.anchors import ExtractLinks


def explode_links(pages: DataFrame, *keep: str) -> DataFrame:
    """(page_id, url, pos, href, anchor_text, base) of every anchor with an href, in the order of the page, and the columns ``keep``; ``base`` is the absolute URL that the page's base tag sets, if it has one."""
    rows = pages.select("page_id", "url", *keep, "html").lateralJoin(ExtractLinks(F.col("html").outer(), F.col("url").outer()))
    return rows.select("page_id", "url", *keep, "pos", "href", T.clean_text(F.col("anchor_text")).alias("anchor_text"), "base")


def candidates(links: DataFrame) -> DataFrame:
    """Links as absolute and canonical URLs with their domain, against the page's base tag or else its URL; those that aren't http(s) go."""
    absolute = U.resolve(F.col("href"), F.coalesce("base", "url"))
    rows = links.withColumn("absolute_url", absolute).withColumn("canonical_url", U.canonicalize(F.col("absolute_url")))
    return rows.withColumn("domain", U.domain(F.col("absolute_url"))).where("canonical_url is not null")


def first_seen(rows: DataFrame, *order: str) -> DataFrame:
    """One row per canonical URL, the first by ``order``: an aggregate, so it combines before the shuffle."""
    best = F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("r")
    return rows.groupBy("canonical_url").agg(best).select("r.*")


def eligibility(url: Column, allow_soft: Column, total: Column, admitted: Column, cap: Column, limits: C.Limits = C.DEFAULT) -> Column:
    """Struct (allowed, reason): the first rule that holds decides."""
    p = U.path(url)
    soft = F.rlike(p, F.lit(U.any_of(C.SOFT_PATHS))) | F.rlike(p, F.lit(C.DATE_PATH))
    reason = (
        F.when(total >= limits.global_queue, "global-queue-cap")
        .when(url.isNull() | ~F.rlike(url, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), "invalid-url")
        .when(~U.is_http(url), "unsupported-protocol")
        .when(F.rlike(p, F.lit("(?i)" + C.SKIP_EXTENSIONS)), "skip-extension")
        .when(F.rlike(p, F.lit(U.any_of(C.HARD_DENY_PATHS))), "hard-denylist-pattern")
        .when(soft & ~allow_soft, "soft-discovery-pattern")
        .when(admitted >= cap, "domain-page-cap")
        .otherwise("queue-eligible")
    )
    reasons = F.when(reason != "queue-eligible", F.array(reason)).when(soft, F.array(reason, F.lit("trusted-soft-discovery"))).otherwise(F.array(reason))
    return F.struct((reason == "queue-eligible").alias("allowed"), reasons.alias("reasons"))


def admission(rows: DataFrame, limits: C.Limits = C.DEFAULT) -> DataFrame:
    """Adds allowed, score, reasons and cross_domain to candidate rows.

    Needs domain, source_domain, source_trusted, domain_trusted, from_sitemap, source_is_recipe, anchor_text and
    absolute_url, and the eligibility struct ``eligible``.
    """
    cross = F.col("domain") != F.col("source_domain")
    signals = {
        "recipe-like-url": U.is_recipe_like(F.col("absolute_url")),
        "recipe-anchor-text": T.has_recipe_anchor(F.col("anchor_text")),
        "sitemap-source": F.col("from_sitemap"),
        "source-recipe-page": F.col("source_is_recipe"),
        "source-recipe-signals": F.col("source_is_recipe"),
    }
    score = sum((s.cast("int") for s in signals.values()), F.lit(0))
    fired = F.filter(F.array(*[F.when(s, n) for n, s in signals.items()]), lambda x: x.isNotNull())
    trusted = F.col("source_trusted")
    verdict = (
        F.when(~cross & trusted & F.col("domain_trusted"), "same-domain-trusted-seed")
        .when(~cross & (trusted | (score > 0)), "same-domain-admission")
        .when(~cross, "same-domain-insufficient-evidence")
        .when(~trusted, "cross-domain-untrusted-source")
        .when(score < limits.min_cross_domain_score, "cross-domain-insufficient-evidence")
        .otherwise("trusted-cross-domain-admission")
    )
    allowed = verdict.isin("same-domain-trusted-seed", "same-domain-admission", "trusted-cross-domain-admission")
    ok = F.col("eligible.allowed")
    return rows.select(
        "*",
        cross.alias("cross_domain"),
        (ok & allowed).alias("allowed"),
        F.when(~ok, 0).when(verdict == "same-domain-trusted-seed", F.greatest(score, F.lit(1))).otherwise(score).alias("score"),
        F.when(~ok, F.col("eligible.reasons")).otherwise(F.array_distinct(F.concat("eligible.reasons", fired, F.array(verdict)))).alias("reasons"),
    )


def follow(allowed: Column, recipe_like: Column, cross: Column, trusted: Column, hops: Column, limits: C.Limits = C.DEFAULT) -> Column:
    """Whether an admitted link is followed, by the hops since the last recipe page."""
    return F.when(~allowed, False).when(recipe_like, True).when(cross, hops < limits.off_domain_hops).when(trusted, hops < limits.trusted_hops).otherwise(False)


def follow_legacy(recipe_like: Column, from_recipe: Column, hops: Column, limits: C.Limits = C.DEFAULT) -> Column:
    """The older rule: recipe pages, and what they link to within the hops off their domain."""
    return recipe_like | (from_recipe & (hops < limits.off_domain_hops))


def cap(rows: DataFrame, per_domain: int, overall: int, *order: str, queued: DataFrame | None = None) -> DataFrame:
    """The first ``per_domain`` rows of each domain, less what ``queued(domain, queued)`` has of it already, then the first ``overall`` of those.

    Ranking by domain is cut to the cap within each task before the shuffle; the overall cap is a
    take-ordered limit.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(W.partitionBy("domain").orderBy(*order))).where(F.col("_rank") <= per_domain)
    if queued is not None:
        ranked = ranked.join(queued, "domain", "left").where(F.col("_rank") + F.coalesce("queued", F.lit(0)) <= per_domain).drop("queued")
    return ranked.drop("_rank").orderBy(*order).limit(overall)


def request_label(is_root: Column, from_sitemap: Column, retry: Column) -> Column:
    return F.when(is_root, "seed-root").when(from_sitemap, "sitemap").when(retry, "playwright-fallback").otherwise("discovered")


def fallback_reason(recipes: Column, body_length: Column, html: Column, from_sitemap: Column, score: Column) -> Column:
    """Why a page goes to the browser; null if it doesn't."""
    marked = F.rlike(html, F.lit("|".join(m.replace(".", r"\.") for m in C.JS_MARKERS)))
    return (
        F.when(recipes > 0, F.lit(None).cast("string"))
        .when(body_length < C.MIN_BODY_TEXT_LENGTH, "thin-content")
        .when(marked, "js-markers")
        .when(from_sitemap, "sitemap-page")
        .when(score >= 2, "high-value-discovery")
    )
