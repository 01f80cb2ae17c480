"""Literal vectors and invariants."""

import html.parser

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siteloom.functions import pages, topics, urls
from siteloom.operators import batching, cache, classify, fetch, upsert

HOSTS = [
    ("x.local.simpleviewcms.com", "s.com", "reserved_or_local"), ("a.cms30.localhost", "s.com", "reserved_or_local"), ("a.staging.simpleviewcms.com/x", "s.com", "internal_pattern"),
    ("/path", "primary12-x.simpleviewcms.com", "internal_pattern"), ("localhost/foo", "example.com", None), ("localhost:8080/foo", "example.com", "single_label_host"),
    ("foo.com:8080/x", "s.com", "explicit_port"), ("10.0.0.1/x", "s.com", "ipv4_literal"), ("10.0.0.1:80/x", "s.com", "explicit_port"), ("a_b.com", "s.com", "underscore_in_host"),
    ("www.com", "s.com", "single_label_host"), ("foo.test", "s.com", "reserved_or_local"), ("foo.com?a=b", "s.com", None), ("/p", "nodots", "single_label_host"), ("foo.com#a_b", "s.com", "underscore_in_host"),
]


def test_drop_reasons(spark):
    df = spark.createDataFrame([(u, s) for u, s, _ in HOSTS], "trimmed_page_url string, site string")
    got = {r.trimmed_page_url: r.drop_reason for r in urls.classify_hosts(df).collect()}
    assert got == {u: r for u, _, r in HOSTS}


def test_page_urls(spark):
    rows = {"//cdn.foo.com/x": "https://cdn.foo.com/x", "index.html": "https://index.html", "httpbin.org/x": "httpbin.org/x", "/a": "https://site.com/a", "page": "https://page"}
    df = spark.createDataFrame([(u, "www.site.com") for u in rows], "trimmed_page_url string, site string")
    assert {r.trimmed_page_url: r.page_url for r in urls.transform(df)[0].collect()} == rows


def test_homepage(spark):
    rows = [("a.com/", "www.a.com", True), ("www.a.com", "www.a.com", False), ("https://a.com", "a.com", False), ("a.com", "a.com/", False), ("", "a.com", False), ("acom", "awww.com", True), (None, "a.com", False)]
    df = spark.createDataFrame([r[:2] for r in rows], "u string, s string")
    assert [r[0] for r in df.select(urls.is_homepage(F.col("u"), F.col("s"))).collect()] == [r[2] for r in rows]


@pytest.mark.parametrize(("n", "size", "cap", "want"), [(0, 1000, 900, (1000, 0)), (2500, 1000, 900, (1000, 3)), (2500, 1, 900, (3, 834)), (1000, 1000, 900, (1000, 1))])
def test_batch_plan(n, size, cap, want):
    assert batching.plan(n, size, cap) == want


def test_batch_plan_refuses_zero():
    with pytest.raises(ValueError):
        batching.plan(1, 0, 1)


def test_upsert_by_confidence(spark):
    from siteloom.schemas import RESULT

    def row(key, sure, topic):
        return (key, None, None, None, None, None, topic, sure, None, None, None, None, 1)

    old = spark.createDataFrame([row("a", 0.5, "old"), row("b", 0.7, "old"), row("c", 0.7, "old"), row("d", None, None)], RESULT)
    new = spark.createDataFrame([row("a", 0.7, "new"), row("b", 0.7, "new"), row("c", 0.5, "new"), row("d", 0.6, "new"), row("e", 0.1, "new"), row("f", float("nan"), "new")], RESULT)
    got = {r.url_hash: (r.content_topic, r.prediction_confidence) for r in upsert.best_confidence(old, new, F.lit(None).cast("timestamp_ntz")).collect()}
    assert got == {"a": ("new", 0.7), "b": ("old", 0.7), "c": ("old", 0.7), "d": (None, 0.6), "e": ("new", 0.1)}


def test_null_keys_in_split(spark):
    rows = spark.createDataFrame([(None, "b"), (None, "a"), ("k", "x"), ("k", "y"), ("c", "z")], "url_hash string, page_url string")
    results = spark.createDataFrame([("c", "t"), ("k", None)], "url_hash string, content_topic string")
    fresh, touches = cache.split(rows, results)
    assert sorted(map(tuple, fresh.collect()), key=str) == sorted([(None, "a", None), ("k", "x", 2)], key=str)
    assert [tuple(r) for r in touches.collect()] == [("c", 1)]


R = fetch.Response


def raising(error):
    def get(url, attempt):
        raise error
    return get


def test_fetch_cascade():
    waits, calls = [], []

    def busy(url, attempt):
        calls.append(attempt)
        return R(503, retry_after=9.0 if attempt else 0.0)

    body = fetch.lenient(lambda u, a: R(200, "ok"))
    assert fetch.fetch_one("u", [fetch.Client(busy), body], waits.append) == "ok"
    assert calls == [0, 1, 2] and 0.375 <= waits[0] <= 1.125 and waits[1] == 9.0
    assert fetch.fetch_one("u", [fetch.Client(lambda u, a: R(404)), body]) == "[SKIP:404]"
    assert fetch.fetch_one("u", [fetch.Client(raising(fetch.CertificateError())), body]) == fetch.BAD_CERTIFICATE
    waits.clear()
    assert fetch.fetch_one("u", [fetch.Client(raising(TimeoutError()))], waits.append) == fetch.FAILED
    assert len(waits) == 2 and 0.25 <= waits[0] <= 0.75 and 0.5 <= waits[1] <= 1.5
    assert fetch.fetch_one("u", [fetch.Client(raising(ValueError())), body], waits.append) == "ok" and len(waits) == 2
    assert fetch.fetch_one("u", [fetch.Client(lambda u, a: R(200, "")), body]) == "ok"


def test_second_and_last_clients():
    seen = []

    def once(url, attempt):
        seen.append(attempt)
        return R(503) if attempt == 0 else R(404)

    show = lambda status, body: fetch.browser(lambda u, a: R(status, body))
    wait = lambda s: None
    assert fetch.fetch_one("u", [fetch.lenient(once), show(200, "page")], wait) == "page" and seen == [0, 1]
    assert fetch.fetch_one("u", [fetch.lenient(raising(OSError())), show(500, "page")], wait) == "page"
    assert fetch.fetch_one("u", [show(410, "gone")]) == "[SKIP:404]"
    assert fetch.fetch_one("u", [show(403, "no")]) == fetch.BLOCKED and fetch.fetch_one("u", [show(401, "x" * 20_000)]) == "x" * 20_000
    assert fetch.fetch_one("u", [show(403, "x" * 12_000 + "Captcha")]) == fetch.BLOCKED
    assert fetch.fetch_one("u", [show(200, "page")], public=False) == fetch.NOT_PUBLIC
    assert fetch.fetch_one("u", [fetch.lenient(lambda u, a: R(200, "ok")), show(200, "page")], public=False) == "ok"


def test_fetch_in_spark(spark):
    rows = spark.createDataFrame([("https://a.com/x",), ("https://a.com/x",), ("https://b.test/",), (None,)], "page_url string")
    plain, shown = fetch.Client(lambda u, a: R(200, "body of " + u) if "a.com" in u else R(503), retries=0), fetch.browser(lambda u, a: R(200, "shown"))
    got = {r.url: r.body for r in fetch.fetch(rows.where("page_url is not null"), [plain, shown]).collect()}
    assert got == {"https://a.com/x": "body of https://a.com/x", "https://b.test/": fetch.NOT_PUBLIC}
    assert sorted(r.body for r in fetch.fetched(rows.limit(3), [plain, shown]).collect()) == ["[ERROR] Internal/non-public domain", "body of https://a.com/x", "body of https://a.com/x"]


def test_a_host_at_a_time():
    """A task asks for eight addresses at a time, two of a host."""
    import threading
    import time as clock

    lock, now, most = threading.Lock(), {}, {}

    def get(url, attempt):
        host = url.split("/")[2]
        with lock:
            now[host] = now.get(host, 0) + 1
            now["all"] = now.get("all", 0) + 1
            for k in (host, "all"):
                most[k] = max(most.get(k, 0), now[k])
        clock.sleep(0.01)
        with lock:
            now[host] -= 1
            now["all"] -= 1
        return R(200, str(max([v for k, v in most.items() if k != "all"])) + " " + str(most["all"]))

    part = pd.DataFrame({"url": [f"https://h{i % 3}.com/{i}" for i in range(60)], "_public": True, "_host": [f"h{i % 3}.com" for i in range(60)]})
    got = [tuple(map(int, b.split())) for made in fetch.answers([fetch.Client(get)], lambda s: None)(iter([part, part])) for b in made["body"]]
    assert len(got) == 120 and max(a for a, _ in got) == 2 and 2 < max(b for _, b in got) <= 8


def test_answers_of_a_busy_classifier():
    now, calls = [0.0], []

    def late(text, seconds):
        calls.append(seconds)
        now[0] += 5
        raise classify.Busy

    wait = lambda s: now.__setitem__(0, now[0] + s)
    assert classify.answer("t", late, lambda: now[0], wait) is None and 2 < len(calls) <= 13 and now[0] < 66
    assert classify.answer("t", lambda t, s: [], lambda: now[0], wait) == []

    def wrong(text, seconds):
        raise ValueError

    assert classify.answer("t", wrong, lambda: now[0], wait) is None


def test_each_text_is_classified_once(spark, tmp_path):
    from siteloom.plans import pipeline

    log = spark.createDataFrame([("2024-01-07", f"s{i % 9}.com", f"s{i % 9}.com/p{i % 20}", "c") for i in range(200)], "date string, site string, trimmed_page_url string, client_id string").withColumn("date", F.to_date("date"))
    from siteloom.schemas import RESULT

    calls = spark.sparkContext.accumulator(0)

    def classifier(text, seconds):
        calls.add(1)
        return [{"name": "/Sports/", "confidence": 0.9}]

    page = "<html>" + "word " * 30 + "</html>"
    bodies = lambda rows: fetch.fetched(rows, [fetch.Client(lambda u, a: R(200, page))])
    run = lambda results, run_id: pipeline.run(log, results, bodies, lambda rows: classify.remote(rows, classifier, rps=1e6), pipeline.Config("2024-01-07", run_id=run_id), str(tmp_path))
    first = run(spark.createDataFrame([], RESULT), "a")
    n = log.select("trimmed_page_url").distinct().count()
    assert first.count() == n and {r.content_topic for r in first.collect()} == {"/Sports/"} and calls.value == n
    again = run(first, "b")
    assert again.count() == n and sum(r.view_count for r in again.collect()) == 200 and calls.value == n


def test_settings():
    import datetime

    from siteloom.plans import pipeline

    now = datetime.datetime(2024, 3, 1, 3, tzinfo=datetime.UTC)  # still February in the zone
    got = pipeline.resolved({"batch_size": "7"}, {"batch_size": 5, "end_date": "2024-02-20", "skip_reconcile": True}, now, "r")
    assert got == pipeline.Config("2024-02-19", "2024-02-20", "r", "2024-03-01 03:00:00", 7, 900, True)
    assert pipeline.resolved(now=now).end == "2024-02-29" and pipeline.new_run_id(now, "0123abcd") == "20240301T030000Z_0123abcd"


def test_repeated_source_keys_raise(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("a", 5), ("c", 6), ("c", 7), (None, 8), (None, 9)], "k string, v int")
    got = upsert.upsert(target, source, ["k"], {"v": F.col("s.v")}, {"k": F.col("s.k"), "v": F.col("s.v")})
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 5), ("b", 2), (None, 3), ("c", 6), ("c", 7), (None, 8), (None, 9)], key=str)
    with pytest.raises(Exception, match="several source rows"):
        upsert.upsert(target, source.union(source), ["k"], {"v": F.col("s.v")}).count()


def test_representative_row_and_plans(spark):
    from siteloom.operators import impressions

    log = spark.createDataFrame([("(Not Set)", "A.com/x", "c1"), (" a.com", "a.com/x ", "c2"), ("a.com", "a.com/x", "c1"), ("none", "b.com", "c"), ("x.com", None, "c")], "site string, trimmed_page_url string, client_id string").withColumn("date", F.to_date(F.lit("2024-01-07")))
    made = impressions.dedupe_with_hits(log)
    assert sorted((r.trimmed_page_url, r.site, r.client_id, r.access_hits) for r in made.collect()) == [("a.com/x", "a.com", "c1", 3), ("b.com", "none", "c", 1)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[trimmed_page_url" in plan
    keys = made.where("access_hits = 3")
    assert [r.lifetime_hits for r in impressions.lifetime_hits(log, keys).collect()] == [3]
    rows = spark.createDataFrame([("k", "x")], "url_hash string, page_url string")
    assert "Join" not in cache.with_dup_hits(rows)._jdf.queryExecution().executedPlan().toString()


class _Text(html.parser.HTMLParser):
    """Visible text by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.hidden = [""], []

    def handle_starttag(self, tag, attrs):
        self.nodes.append("")
        if tag in ("script", "style", "noscript"):
            self.hidden.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.nodes.append("")

    def handle_endtag(self, tag):
        self.nodes.append("")
        if self.hidden and tag in self.hidden:
            del self.hidden[self.hidden.index(tag) :]

    def handle_comment(self, data):
        self.nodes.append("")

    handle_decl = handle_comment

    def handle_data(self, data):
        if not self.hidden:
            self.nodes[-1] += data


def test_visible_text(spark):
    pages_ = [
        "<html><noscript><style>x</style>secret</noscript>a&hellip;b &#x27;c&#39; &eacute;t&eacute; &copy; 2020 &amp;lt; &#8212;&#150; &nosuch; &</html>", "<html><p>one<b>two</b> 3 < 4 & 5 > 2</p><!-- <p>no</p> --><script>if (a</b) '<p>x</p>'</script>end",
        "<html><body>&nbsp;<p> \u3000wide\xa0</p>\x1c</body>", "<html><br/>x<br>y<SCRIPT type='a'>z</SCRIPT >w&#0;&#xD800;&#1114112;&#128512;", "<html>open <style>rest", "no page", "[ERROR] <html>x", None, "",
    ]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(pages_)), "i int, b string").orderBy("i").select(pages.visible_text(F.col("b"))).collect()]

    def plain(body):
        if not body or body.startswith("[ERROR") or "<html" not in body:
            return ""
        parser = _Text()
        parser.feed(body)
        parser.close()
        return " ".join(x.strip() for x in parser.nodes if x.strip())

    assert got == [plain(b) for b in pages_]


def test_words_are_split_like_str(spark):
    texts = ["a\xa0b\u2003c\x1cd\x85e", "  ", "", None, "é x"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(pages.word_count(F.col("t"))).collect()]
    assert got == [len((t or "").split()) for t in texts]


def test_streams(spark, tmp_path):
    from siteloom import streaming

    rows = [("2024-01-07 10:00:00", "a.com", "a.com/x", "c"), ("2024-01-07 11:00:00", "a.com", "A.com/x", "c"), ("2024-01-09 10:00:00", "a.com", "a.com/y", "c"), ("2024-01-12 10:00:00", "a.com", None, "c")]
    log = spark.createDataFrame(rows, "ts string, site string, trimmed_page_url string, client_id string").withColumn("ts", F.to_timestamp("ts"))
    log.coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = lambda: spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    seen = []
    streaming.each_batch(stream(), lambda df, i: seen.append((i, df.count())), str(tmp_path / "c1")).awaitTermination()
    assert seen == [(0, 4)]
    hits = streaming.hits_by_window(stream()).writeStream.format("memory").queryName("hits").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    hits.awaitTermination()
    assert sorted((str(r.window.start.date()), r.hits) for r in spark.table("hits").collect()) == [("2024-01-07", 2), ("2024-01-09", 1)]


def test_rate_limiter():
    now = [0.0]
    limiter = classify.RateLimiter(5, 0, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(6):
        limiter.acquire()
    assert now[0] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        classify.RateLimiter(0)


def test_decoded(spark):
    import zlib
    packed = zlib.compress(b"<html>hello</html>")
    df = spark.createDataFrame([(0, bytearray(b"%PDF-1")), (1, bytearray("héllo".encode())), (2, None), (3, bytearray(packed))], "i int, b binary")
    assert [r[0] for r in df.orderBy("i").select(pages.decoded("b")).collect()] == ["", "héllo", "", ""]  # packed bytes hold control bytes, which count first


def test_longest_prefix(spark):
    df = spark.createDataFrame([("/Travel & Transportation/Transportation/Air Travel",)], "t string")
    assert df.select(topics.map_topic(F.col("t")), topics.map_topic(F.col("t"), longest_prefix=True)).first()[:] == ("Logistics & Planning", "Transportation")


def test_tables_that_are_there_or_not(spark, tmp_path):
    from siteloom import sources
    from siteloom.plans import pipeline
    from siteloom.schemas import RESULT_COLUMNS

    empty = sources.existing(spark, "no_such_table")
    assert empty.columns == RESULT_COLUMNS and empty.count() == 0
    spark.range(9).createOrReplaceTempView("some_table")
    assert sources.existing(spark, "some_table").count() == 9 and sources.preview(spark.table("some_table")).count() == 5
    path = pipeline.write_snapshot(empty, str(tmp_path), "1")
    assert spark.read.parquet(path).columns == RESULT_COLUMNS
    with pytest.raises(Exception, match="exist"):
        pipeline.write_snapshot(empty, str(tmp_path), "1")


def test_times_that_are_none(spark):
    rows = spark.createDataFrame([("2024-01-02 03:04:05", "2024-01-02"), ("soon", ""), (None, "2024-13-01")], "created_at string, last_accessed string")
    got = [tuple(map(str, r)) for r in upsert.with_times(rows).collect()]
    assert got == [("2024-01-02 03:04:05", "2024-01-02 00:00:00"), ("None", "None"), ("None", "None")]


def test_no_address_with_a_usable_site_is_lost(spark):
    """The whole log goes in: every address of the window that has a usable site comes out of the representative rows."""
    from siteloom.plans import catalog

    log = catalog.log_of(spark, "/root/testdata/sf0.001")
    usable = lambda c: ~urls.clean(F.col(c)).isin(*urls.PLACEHOLDERS)
    from siteloom.operators import impressions

    want = {r[0] for r in impressions.kept(log).where(usable("site") & usable("trimmed_page_url")).select(urls.url_key(urls.clean(F.col("trimmed_page_url")))).distinct().collect()}
    got = {r.url_hash for r in urls.classify_hosts(impressions.dedupe_with_hits(log)).select("url_hash").collect()}
    assert got == want
