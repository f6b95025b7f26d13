from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from larder.operators.tables import Table
from larder.streaming import admission, queue, retries
from larder.streaming.runs import Run

SCHEMA = "url string, at long, title string, chain string"


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture()
def few(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def batches():
    """Links of three rounds: a hot domain with two thirds of them, domains with caps of their own, null domains."""
    for i in range(3):
        yield [(d, 1000 * i + j, f"https://{d}/{i}/{j}") for j in range(60) for d in (("hot.dk", "hot.dk", "a.dk") if j % 2 else ("hot.dk", f"d{j}.dk", None))]


def wanted(cap, caps, known):
    admitted, count = [], dict(known)
    for batch in batches():
        for d, seq, url in sorted((x for x in batch if x[0] is not None), key=lambda x: (x[1], x[2])):
            if count.get(d, 0) < caps.get(d, cap):
                count[d] = count.get(d, 0) + 1
                admitted.append((d, seq, url, count[d]))
    return sorted(admitted), count


def test_caps_resumed_after_a_lost_batch_equal_an_uninterrupted_run(spark, tmp_path, few):
    known = spark.createDataFrame([("a.dk", 5), ("never.dk", 3)], "domain string, admitted long")
    step = lambda s: admission.admitted(s, 40, {"a.dk": 7}, known)

    def lost(rows):
        boom = F.udf(lambda u: 1 / 0, "string")
        return step(rows.withColumn("canonical_url", boom("canonical_url")))

    for i, batch in enumerate(batches()):
        run = Run(spark, str(tmp_path), "run #1")  # a driver of its own each time
        run.append("caps", spark.createDataFrame(batch, admission.LINKS))
        if i == 1:
            with pytest.raises(Exception, match="ZeroDivision"):
                run.advance("caps", admission.LINKS, lost)
        assert run.advance("caps", admission.LINKS, step)[0]["rows"] == len(batch)
    assert run.folder.endswith("/run-1")
    found, counts = wanted(40, {"a.dk": 7}, {"a.dk": 5, "never.dk": 3})
    assert rows_of(run.result("caps", admission.ADMITTED), "domain", "seq", "canonical_url", "rank") == found
    assert dict(rows_of(run.state("caps", "admitted").select("key.domain", "value.n"), "domain", "n")) == counts
    assert run.advance("caps", admission.LINKS, step) == []


def test_tasks_send_at_most_the_cap_of_a_domain(spark):
    rows = spark.createDataFrame([("hot.dk", i, "u") for i in range(500)] + [("b.dk", 1, "v")], admission.LINKS).coalesce(2)
    cut = rows.mapInArrow(admission._cut(7), admission.LINKS)
    assert cut.where("domain = 'hot.dk'").count() <= 14 and rows_of(cut.where("domain = 'hot.dk'").orderBy("seq").limit(7), "seq") == [(i,) for i in range(7)]


def test_queue_forgets_after_its_time(spark, tmp_path, few):
    run = Run(spark, str(tmp_path), "q")
    event = [("https://a.dk/", 3, False), ("https://a.dk/", 1, False), (None, 2, False), ("https://seen.dk/", 5, True)]
    for ttl in (None, 1):
        name = f"q{ttl}"
        for rows in (event, [("https://a.dk/", 9, False), ("https://seen.dk/", 9, False)]):
            run.append(name, spark.createDataFrame(rows, queue.EVENTS))
            run.advance(name, queue.EVENTS, lambda s, ttl=ttl: queue.queued(s, buckets=4, ttl_ms=ttl), empty_batches=False)
        late = [("https://a.dk/", 9, "already-present", 1), ("https://seen.dk/", 9, "already-handled", 1)] if ttl is None else [("https://a.dk/", 9, "new", 1), ("https://seen.dk/", 9, "new", 1)]
        assert rows_of(run.result(name, queue.STATUS), "canonical_url", "seq", "status", "requests") == sorted([("https://a.dk/", 1, "new", 2), *late])


def test_retries_and_dead_letters(spark, tmp_path, few):
    from larder.operators.pages import failed_rows

    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    rounds = [
        [("x", at(0), 1, False), ("y", at(0), 2, False), ("y", at(1), 3, True), ("z", at(0), 4, False)],
        [("x", at(5), 5, False), ("x", at(6), 6, False), ("z", at(1), 7, True)],  # z at its due time, but late: the watermark has passed
        [("x", at(60), 8, False), (None, at(600), 9, True)],
    ]
    run = Run(spark, str(tmp_path), "r")
    for rows in rounds:
        run.append("r", spark.createDataFrame(rows, retries.EVENTS))
        run.advance("r", retries.EVENTS, lambda s: retries.retried(s, tries=2, delay_ms=60_000))
    steps = run.result("r", retries.STEPS)
    # the failure at 60 begins a new count, after the one at 6 gave x up
    assert rows_of(steps, "request", "at", "kind", "attempt") == [("x", at(1), "retry", 1), ("x", at(6), "failed", 3), ("x", at(61), "retry", 1), ("z", at(1), "retry", 1)]
    dead = failed_rows(retries.dead_letters(steps)).collect()
    assert [(r["fetched_at"], r["extraction_method"], r["http_status"]) for r in dead] == [(at(6), "failed", 0)]


def test_upsert_rewrites_only_the_partitions_it_touches(spark, tmp_path):
    table = Table(spark, str(tmp_path / "pages"), SCHEMA, "url", "at", parts=8, keep_old=("chain",))
    assert table.rows().count() == 0 and table.row("u1").count() == 0
    table.upsert(spark.createDataFrame([(f"u{i}", 1, f"t{i}", "c") for i in range(100)] + [(None, 1, "n", "n")], SCHEMA))
    before = table.files()
    assert len(before) == 8
    new = spark.createDataFrame([("u1", 2, "new", None, "x"), ("u1", 1, "older", "o", "x"), ("u1", 2, "new", None, "x")], SCHEMA + ", part string")
    touched = table.upsert(new)
    after = table.files()
    assert len(touched) == 1 and {k: v for k, v in after.items() if k not in touched} == {k: v for k, v in before.items() if k not in touched}
    assert after[touched[0]] != before[touched[0]]
    assert rows_of(table.row("u1"), "url", "at", "title", "chain") in ([("u1", 2, "new", "c")], [("u1", 2, "new", "o")])
    assert table.rows().count() == 100
    whole = rows_of(table.rows(), "url", "at", "title", "chain")
    assert table.upsert(new) == touched and rows_of(table.rows(), "url", "at", "title", "chain") == whole  # done again
    assert table.upsert(new.limit(0)) == [] and rows_of(table.rows(), "url", "at", "title", "chain") == whole
    assert rows_of(table.present(spark.createDataFrame([("u5",), ("u5",), ("none",), (None,)], "url string")), "url") == [("u5",)]
    table.compact(range(8))
    assert rows_of(table.rows(), "url", "at", "title", "chain") == whole
    plan = table.row("u1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: [IsNotNull(url), EqualTo(url,u1)]" in plan
