"""Queries over the driver's tables, one per operator or small group of operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import text as T
from larder.functions import url as U
from larder.operators import extract as X
from larder.operators import links as L
from larder.operators import metrics as M
from larder.operators import store as S

#: The domain that plays the trusted seed in the driver's pages.
TRUSTED = "example.com"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def url_canonical(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", U.canonicalize(F.col("url")).alias("canonical_url"), U.domain(F.col("url")).alias("domain"), U.is_http(F.col("url")).alias("is_http"))


def storage_keys(spark: SparkSession, d: str) -> DataFrame:
    key = U.storage_key(F.col("url"))
    return read(spark, d, "pages").select("page_id", key.alias("storage_key"), F.concat(F.lit("queue-"), key).alias("queue_key"))


def page_hash(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", F.sha2("html", 256).alias("page_content_hash"))


def page_language_meta(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "pages").withColumn("l", T.html_language(F.col("html")))
    return rows.select("page_id", F.coalesce("l.language", F.lit("und")).alias("language"), F.coalesce("l.confidence", F.lit(0.0)).alias("confidence"))


def text_language(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select("doc_id", T.normal_text(F.col("text")).alias("t")).select("doc_id", T.language_scores(F.col("t")).alias("scores")).withColumn("l", T.text_language(F.col("scores")))
    return rows.select("doc_id", F.coalesce("l.language", F.lit("und")).alias("language"), F.round(F.coalesce("l.confidence", F.lit(0.0)), 4).alias("confidence"), F.coalesce("l.score", F.lit(0)).alias("score"))


def language_counts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.sha2(T.clean_text(F.col("text")), 256).alias("clean_sha"))


def text_with_breaks(spark: SparkSession, d: str) -> DataFrame:
    t = T.text_with_breaks(F.col("html"))
    first = F.try_element_at(F.filter(F.transform(F.split(t, "\n"), T.clean_text), lambda x: x != ""), F.lit(1))
    return read(spark, d, "pages").select("page_id", F.sha2(t, 256).alias("text_sha"), first.alias("heading"))


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    parts = F.col("parts")
    return read(spark, d, "documents").select("doc_id", T.split_sentences(F.col("text")).alias("parts")).select("doc_id", F.size(parts).cast("long").alias("n_parts"), F.sha2(F.array_join(F.array_sort(parts), "|"), 256).alias("parts_sha"))


def title_heuristic(spark: SparkSession, d: str) -> DataFrame:
    h1 = T.clean_text(F.regexp_replace(F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]+>", ""))
    og = T.clean_text(F.regexp_extract("html", r"(?is)<meta[^>]*property=\"og:title\"[^>]*content=\"([^\"]*)\"", 1))
    return read(spark, d, "pages").select("page_id", F.coalesce(F.nullif(h1, F.lit("")), F.nullif(og, F.lit(""))).alias("title"))


def links(spark: SparkSession, d: str) -> DataFrame:
    return L.explode_links(read(spark, d, "pages"))


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return L.candidates(links(spark, d))


def links_explode(spark: SparkSession, d: str) -> DataFrame:
    return links(spark, d).select("page_id", F.col("pos").cast("long").alias("pos"), "href", "anchor_text")


def links_absolute(spark: SparkSession, d: str) -> DataFrame:
    return candidates(spark, d).select("page_id", F.col("pos").cast("long").alias("pos"), "absolute_url", "canonical_url", "domain")


def links_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return L.first_seen(candidates(spark, d), "page_id", "pos").select("canonical_url", "page_id", F.col("pos").cast("long").alias("pos"))


def anchor_keyword(spark: SparkSession, d: str) -> DataFrame:
    return links(spark, d).select("page_id", F.col("pos").cast("long").alias("pos"), T.has_recipe_anchor(F.col("anchor_text")).alias("recipe_anchor"))


def _eligible(rows: DataFrame, soft: Column) -> DataFrame:
    return rows.withColumn("eligible", L.eligibility(F.col("absolute_url"), soft, F.lit(0), F.lit(0), F.lit(C.DEFAULT.pages_per_domain)))


def queue_eligibility(spark: SparkSession, d: str) -> DataFrame:
    rows = _eligible(candidates(spark, d), F.col("page_id") % 2 == 0)
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), "eligible.allowed", F.array_join("eligible.reasons", ",").alias("reasons"))


def admitted(spark: SparkSession, d: str) -> DataFrame:
    rows = candidates(spark, d).withColumn("source_domain", U.domain(F.col("url")))
    trusted = F.col("source_domain").endswith(TRUSTED)
    rows = rows.withColumns({"source_trusted": trusted, "domain_trusted": F.col("domain").endswith(TRUSTED), "from_sitemap": F.col("page_id") % 3 == 0, "source_is_recipe": F.col("page_id") % 5 == 0})
    # a third of the links is taken to lead to another site
    rows = rows.withColumn("domain", F.when(F.col("pos") % 3 == 2, F.lit("other.example.org")).otherwise(F.col("domain"))).withColumn("domain_trusted", F.col("domain").endswith(TRUSTED))
    return L.admission(_eligible(rows, F.col("source_trusted"))).withColumn("hops", (F.col("page_id") % 4).cast("int"))


def admission(spark: SparkSession, d: str) -> DataFrame:
    return admitted(spark, d).select("page_id", F.col("pos").cast("long").alias("pos"), "allowed", "score", "cross_domain", F.array_join("reasons", ",").alias("reasons"))


def follow_links(spark: SparkSession, d: str) -> DataFrame:
    rows = admitted(spark, d)
    ok = L.follow(F.col("allowed"), U.is_recipe_like(F.col("absolute_url")), F.col("cross_domain"), F.col("source_trusted"), F.col("hops"))
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), ok.alias("follow"))


def request_label(spark: SparkSession, d: str) -> DataFrame:
    label = L.request_label(U.path(F.col("url")) == "/", F.col("page_id") % 3 == 0, F.col("page_id") % 5 == 0)
    return read(spark, d, "pages").select("page_id", label.alias("label"))


def blocked_reasons(spark: SparkSession, d: str) -> DataFrame:
    return M.reason_counts(admitted(spark, d).where("not allowed"), "domain")


def off_domain(spark: SparkSession, d: str) -> DataFrame:
    rows = admitted(spark, d).where("allowed and cross_domain")
    return rows.groupBy("source_domain").agg(F.count("*").alias("admissions"), F.array_join(F.array_sort(F.collect_set("domain")), ",").alias("new_domains"))


def domain_caps(spark: SparkSession, d: str) -> DataFrame:
    rows = L.first_seen(candidates(spark, d), "page_id", "pos")
    return L.cap(rows, C.DEFAULT.pages_per_domain, C.DEFAULT.global_queue, "page_id", "pos").select("canonical_url", "domain")


def fallback_reason(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    r = L.fallback_reason((F.col("doc_id") % 7 == 0).cast("int"), F.length("text"), F.col("text"), F.col("doc_id") % 3 == 0, (F.col("doc_id") % 4).cast("int"))
    return docs.select("doc_id", r.alias("reason"))


def _fetched(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select(U.canonicalize(F.col("url")).alias("canonical_url"), F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") % 60 * 86400).alias("fetched_at"))


def _cutoff() -> Column:
    return S.recrawl_cutoff(F.to_timestamp(F.lit("2024-02-20 00:00:00")), C.RECRAWL_TTL_DAYS)


def fresh_semi(spark: SparkSession, d: str) -> DataFrame:
    asked = read(spark, d, "pages").select(U.canonicalize(F.col("url")).alias("canonical_url")).distinct()
    return S.fresh(asked, _fetched(spark, d), _cutoff())


def fresh_anti(spark: SparkSession, d: str) -> DataFrame:
    asked = read(spark, d, "pages").select(U.canonicalize(F.col("url")).alias("canonical_url")).distinct()
    return S.stale(asked, _fetched(spark, d), _cutoff())


def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("user_id", "event_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    out = S.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "event_id", ("value",))
    return out.select("user_id", "event_id", "event_type", "value")


def recipes_keep_best(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select(F.sha2("text", 256).alias("content_hash"), "doc_id", (F.col("doc_id") % 4 / 4.0).alias("confidence"))
    return S.keep_best(rows, "content_hash", "confidence", "doc_id").select("content_hash", "doc_id", "confidence")


def recipes_per_page(spark: SparkSession, d: str) -> DataFrame:
    joined = read(spark, d, "documents").join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    return joined.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good"))


def _metric_events(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "fallback").when(F.col("event_type") == "signup", "skip").otherwise("page")
    return read(spark, d, "events").select(F.concat(F.lit("d"), (F.col("user_id") % 20).cast("string")).alias("domain"), kind.alias("kind"), F.when(F.col("event_id") % 4 == 0, "playwright").otherwise("cheerio").alias("mode"), (F.col("event_id") % 3).alias("recipes"))


def domain_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = M.domain_metrics(_metric_events(spark, d))
    return rows.withColumns({c: F.round(c, 6) for c in ("recipe_page_yield", "fallback_rate")})


def fallback_histogram(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").where("event_type = 'error'").select(F.when(F.col("event_id") % 2 == 0, F.array(F.lit("thin-content"))).otherwise(F.array().cast("array<string>")).alias("reasons"))
    return M.reason_counts(rows)


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run")).agg(F.count("*").alias("pages"), F.count_if(F.col("event_type") == "purchase").alias("recipes"), F.max("ts").alias("finished_at"))


def run_report(spark: SparkSession, d: str) -> DataFrame:
    return M.run_report(_runs(spark, d))


def run_delta(spark: SparkSession, d: str) -> DataFrame:
    return M.run_deltas(_runs(spark, d), "pages", "recipes")


def run_retention(spark: SparkSession, d: str) -> DataFrame:
    return S.retained(_runs(spark, d).withColumn("finished_at", F.col("finished_at").cast("timestamp")), F.to_timestamp(F.lit("2024-04-09 12:00:00")), C.RUN_RETENTION_DAYS).select("run", "pages")


def top_domains(spark: SparkSession, d: str) -> DataFrame:
    counted = read(spark, d, "events").groupBy((F.col("user_id") % 20).alias("domain")).agg(F.count("*").alias("processed"))
    return counted.orderBy(F.desc("processed"), "domain").limit(5)


def _requests(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select(F.col("event_type").alias("domain"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("id"))


def start_gaps(spark: SparkSession, d: str) -> DataFrame:
    return M.start_gaps(_requests(spark, d))


def nth_sample(spark: SparkSession, d: str) -> DataFrame:
    return M.every_nth(_requests(spark, d)).select("domain", "id", F.col("rn").cast("long").alias("rn"))


def props_variant(spark: SparkSession, d: str) -> DataFrame:
    v = F.try_parse_json("props")
    return read(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "long").alias("k"))


def extract_recipes(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "pages").select("page_id", U.domain(F.col("url")).alias("domain"), "html")
    found = X.extract_pages(pages)
    return X.explode_recipes(found).select("page_id", "method", F.round("confidence", 4).alias("confidence"), "content_hash")


def domain_yield(spark: SparkSession, d: str) -> DataFrame:
    """Pages, languages and link counts per domain with the total: the flagship plan."""
    pages = read(spark, d, "pages").withColumn("domain", U.domain(F.col("url")))
    counted = pages.select("domain", T.html_language(F.col("html"))["language"].alias("language")).rollup("domain").agg(F.count("*").alias("pages"), F.count_distinct("language").alias("languages"), F.grouping("domain").alias("g"))
    linked = L.explode_links(pages, "domain").rollup("domain").agg(F.count("*").alias("links"), F.grouping("domain").alias("g")).select(F.col("domain").alias("_domain"), F.col("g").alias("_g"), "links")
    out = counted.join(linked, F.col("domain").eqNullSafe(F.col("_domain")) & (F.col("g") == F.col("_g")), "left")
    return out.select(F.when(F.col("g") == 1, "all").otherwise(F.col("domain")).alias("domain"), "pages", "languages", F.coalesce("links", F.lit(0).cast("long")).alias("links"))
