"""Queries that stream the driver's tables in rounds, and update stored tables, with the SQL of what must come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import url as U
from larder.operators import links as L
from larder.operators.tables import Table
from larder.plans import oracles as O
from larder.plans import queries as Q
from larder.sources.folders import kept, scratch
from larder.streaming import admission, ingest, queue, retries
from larder.streaming.runs import Run

#: Rounds that the pages arrive in.
ROUNDS = 3
CAP, CAPS = 12, {"www2.example.com": 30, "example.com": 20}
#: Retries of a failed request, and the delay of the first.
TRIES, DELAY_MS = 2, 3_600_000


def _requests(spark: SparkSession, d: str) -> DataFrame:
    """Links with their round and their place in it."""
    rows = Q.candidates(spark, d).select("canonical_url", "domain", (F.col("page_id") % ROUNDS).alias("round"), "page_id", "pos", (F.col("page_id") * (1 << 20) + F.col("pos")).alias("seq"))
    return kept(rows, "requests")


def _capped(spark: SparkSession, d: str, run: str, rounds: range, base: str) -> Run:
    """The run of the capped stream over the links that are first seen, a new driver for each round."""
    first = kept(L.first_seen(_requests(spark, d), "round", "page_id", "pos"), "first")
    crawled = Q.read(spark, d, "pages").where("page_id % 10 = 0").groupBy(U.domain(F.col("url")).alias("domain")).agg(F.count("*").alias("admitted"))
    for i in rounds:
        on = Run(spark, base, run)
        on.append("caps", first.where(F.col("round") == i).select("domain", "seq", "canonical_url"))
        on.advance("caps", admission.LINKS, lambda s: admission.admitted(s, CAP, CAPS, crawled))
    return on


def stream_caps(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d, "caps", range(ROUNDS), scratch(spark, "runs")).result("caps", admission.ADMITTED).select("domain", "canonical_url", "rank")


def stream_state(spark: SparkSession, d: str) -> DataFrame:
    """The counters of a run that stopped after its first round and went on, read from its checkpoint."""
    base = scratch(spark, "runs")
    _capped(spark, d, "2024-04-24T21:45:10.123Z", range(1), base)
    run = _capped(spark, d, "2024-04-24T21:45:10.123Z", range(1, ROUNDS), base)
    return run.state("caps", "admitted").select(F.col("key.domain").alias("domain"), F.col("value.n").alias("admitted"))


def stream_queue(spark: SparkSession, d: str) -> DataFrame:
    """The status of each URL in each round; what is new in a round is handled in the next."""
    rows, run = _requests(spark, d), Run(spark, scratch(spark, "runs"), "queue")
    asked = F.lit(False).alias("handled")
    for i in range(ROUNDS):
        new = rows.where(F.col("round") == i).select("canonical_url", "seq", asked)
        before = run.result("queue", queue.STATUS).where("status = 'new'").select("canonical_url", "seq", F.lit(True).alias("handled"))
        run.append("queue", new.unionByName(before.where((F.col("seq") / (1 << 20)).cast("long") % ROUNDS == i - 1)))
        run.advance("queue", queue.EVENTS, lambda s: queue.queued(s, buckets=64))
    return run.result("queue", queue.STATUS).select("canonical_url", "seq", "status", "requests")


def stream_retries(spark: SparkSession, d: str) -> DataFrame:
    """Steps of the requests (one for each user) whose attempts the events are, in the order of time; a last row moves the watermark on."""
    events = Q.read(spark, d, "events").select(F.concat(F.lit("https://e.dk/"), "user_id").alias("request"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("id"), (F.col("event_type") != "error").alias("ok"))
    low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    run = Run(spark, scratch(spark, "runs"), "retries")
    if low is not None:
        number = F.least(F.lit(ROUNDS - 1), ((F.unix_micros("ts") - low) * ROUNDS / (high - low + 1)).cast("int"))
        end = spark.range(1).select(F.lit(None).cast("string").alias("request"), F.timestamp_micros(F.lit(high) + 10 * 86_400_000_000).alias("ts"), F.lit(-1).cast("long").alias("id"), F.lit(True).alias("ok"))
        for i in range(ROUNDS + 1):
            run.append("retries", events.where(number == i) if i < ROUNDS else end)
            run.advance("retries", retries.EVENTS, lambda s: retries.retried(s, tries=TRIES, delay_ms=DELAY_MS))
    steps = run.result("retries", retries.STEPS)
    return steps.select("request", F.unix_micros("at").alias("at_micros"), "kind", "attempt")


def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many candidates each batch queues and skips as fresh, as the stream observes it."""
    asked = Q.read(spark, d, "pages").select(U.canonicalize(F.col("url")).alias("canonical_url"), (F.col("page_id") % ROUNDS).alias("round")).distinct()
    run, counts = Run(spark, scratch(spark, "runs"), "counts"), []
    for i in range(ROUNDS):
        run.append("counts", asked.where(F.col("round") == i).select("canonical_url"))
        for p in run.advance("counts", "canonical_url string", lambda s: ingest.counted(s, Q._fetched(spark, d), Q._cutoff())):
            counts.append((i, p["rows"], p["counts.enqueued"], p["counts.skipped_fresh"]))
    return spark.createDataFrame(counts, "round int, candidates long, enqueued long, skipped_fresh long")


def table_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A stored table after three upserts in the order of events, the last of a few users only, read back."""
    table = Table(spark, scratch(spark, "table"), "user_id long, event_id long, event_type string, value double", "user_id", "event_id", parts=16, keep_old=("value",))
    e = Q.read(spark, d, "events").select("user_id", "event_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    few = F.col("user_id") % 50 == 7
    half = (e.agg(F.max("event_id")).first()[0] or 0) // 2
    table.upsert(e.where(~few & (F.col("event_id") <= half)))
    table.upsert(e.where(~few & (F.col("event_id") > half)))
    table.upsert(e.where(few))
    return table.rows()


def table_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Which of the users of error events have a row in a table of those that bought something."""
    table = Table(spark, scratch(spark, "table"), "user_id long, event_id long", "user_id", "event_id", parts=16)
    events = Q.read(spark, d, "events")
    table.upsert(events.where("event_type = 'purchase'"))
    return table.present(events.where("event_type = 'error'"))


_FIRST = f"""{O.LINKS}, f AS (SELECT *, page_id % {ROUNDS} AS round, row_number() OVER (PARTITION BY canonical_url ORDER BY page_id % {ROUNDS}, page_id, pos) AS rn FROM c),
i AS (SELECT {O.domain('url')} AS domain, count(*) AS n FROM pages WHERE page_id % 10 = 0 GROUP BY 1),
r AS (SELECT f.*, coalesce(i.n, 0) + row_number() OVER (PARTITION BY f.domain ORDER BY round, page_id, pos) AS rank, CASE f.domain {' '.join(f"WHEN '{k}' THEN {v}" for k, v in CAPS.items())} ELSE {CAP} END AS cap FROM f LEFT JOIN i ON i.domain = f.domain WHERE rn = 1)"""

QUERIES = {f.__name__: f for f in (stream_caps, stream_state, stream_queue, stream_retries, stream_counts, table_upsert, table_lookup)}

ORACLES = {
    "stream_caps": f"WITH {_FIRST} SELECT domain, canonical_url, rank FROM r WHERE rank <= cap",
    "stream_state": f"WITH {_FIRST}, g AS (SELECT domain, count(*) AS n FROM r WHERE rank <= cap GROUP BY domain) SELECT coalesce(g.domain, i.domain) AS domain, coalesce(i.n, 0) + coalesce(g.n, 0) AS admitted FROM g FULL JOIN i ON g.domain = i.domain",
    "stream_queue": f"""WITH {O.LINKS}, q AS (SELECT canonical_url, page_id % {ROUNDS} AS round, min(page_id * {1 << 20} + pos) AS seq, count(*) AS requests FROM c GROUP BY ALL),
      s AS (SELECT *, min(round) OVER (PARTITION BY canonical_url) AS first FROM q)
      SELECT canonical_url, seq, CASE round - first WHEN 0 THEN 'new' WHEN 1 THEN 'already-present' ELSE 'already-handled' END AS status, requests FROM s""",
    "stream_retries": f"""WITH e AS (SELECT 'https://e.dk/' || user_id AS request, epoch_us(ts) AS t, event_id, event_type <> 'error' AS ok FROM events),
      g AS (SELECT *, count(*) FILTER (ok) OVER w AS successes, lead(t) OVER w AS next FROM e WINDOW w AS (PARTITION BY request ORDER BY t, event_id)),
      a AS (SELECT *, (row_number() OVER (PARTITION BY request, successes ORDER BY t, event_id) - 1) % {TRIES + 1} + 1 AS attempt FROM g WHERE NOT ok),
      d AS (SELECT *, t + {DELAY_MS * 1000}::BIGINT * cast(pow(2, attempt - 1) AS BIGINT) AS due FROM a)
      SELECT request, t AS at_micros, 'failed' AS kind, cast(attempt AS INTEGER) AS attempt FROM d WHERE attempt > {TRIES}
      UNION ALL SELECT request, due, 'retry', cast(attempt AS INTEGER) FROM d WHERE attempt <= {TRIES} AND (next IS NULL OR due < next)""",
    "stream_counts": f"""WITH f AS (SELECT DISTINCT {O.canon('url')} AS canonical_url FROM pages WHERE TIMESTAMP '2024-01-01' + to_days(cast(page_id % 60 AS INTEGER)) >= TIMESTAMP '2024-02-20' - INTERVAL 30 DAY),
      a AS (SELECT DISTINCT {O.canon('url')} AS canonical_url, page_id % {ROUNDS} AS round FROM pages)
      SELECT cast(round AS INTEGER) AS round, count(*) AS candidates, count(*) FILTER (f.canonical_url IS NULL) AS enqueued, count(*) FILTER (f.canonical_url IS NOT NULL) AS skipped_fresh FROM a LEFT JOIN f ON f.canonical_url = a.canonical_url GROUP BY round""",
    "table_upsert": O.ORACLES["upsert_latest"],
    "table_lookup": "SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')",
}
