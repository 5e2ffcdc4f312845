import json

import pytest
from pyspark.sql import functions as F

from loamwork import schemas
from loamwork.functions import hashing
from loamwork.sources import connectors, fetching, files


def post(i, **more):
    return {
        "id": i, "date": "2026-01-01T10:00:00", "date_gmt": "2026-01-01T09:00:00", "modified": "m", "link": f"https://x.org/{i}", "title": {"rendered": f"Title &amp; {i}"},
        "content": {"rendered": f"<p>Body {i}</p><p>Second</p>"}, "excerpt": {"rendered": "e"}, "deadline": " ", "application_deadline": "1 May",
        "_embedded": {"wp:term": [[{"taxonomy": "category", "id": 1, "name": "PhD", "slug": "phd"}, {"taxonomy": "category", "id": 2, "name": "Awards", "slug": "a"}], [{"taxonomy": "post_tag", "id": 3, "name": "t", "slug": "t"}]]},
    } | more


def responses(spark, pages):
    rows = [("k", "s", f"https://x.org/wp?page={n}", n, status, "t", 9, text) for n, status, text in pages]
    return spark.createDataFrame(rows, schemas.RESPONSE)


def test_wordpress_pages_end_without_fresh_records(spark):
    pages = [(1, 200, json.dumps([post(1), post(2)])), (2, 200, json.dumps([post(2), post(3)])), (3, 200, json.dumps([post(1)])), (4, 200, json.dumps([post(4)])), (5, 400, "{}")]
    found = connectors.wp_rest(responses(spark, pages)).orderBy("canonical_url").collect()
    assert [r["canonical_url"] for r in found] == [f"https://x.org/{i}" for i in (1, 2, 3)]
    assert found[0]["title"] == "Title & 1" and found[0]["clean_text"] == "Body 1\nSecond" and found[0]["deadline"] == "1 May"
    assert found[0]["extra"]["wp_categories"] == ["Awards", "PhD"] and found[0]["published_at"] == "2026-01-01T09:00:00"
    assert connectors.wp_rest(responses(spark, pages), cap=2).count() == 2


def test_feeds(spark):
    feed = '<rss><channel><item><title>A</title><link>https://x.org/a</link><description><![CDATA[<p>Short</p>]]></description></item><item><title>No link</title></item></channel></rss>'
    details = spark.createDataFrame([("k", "s", "https://x.org/a", 1, 200, "t", 1, '<body><nav>n</nav><article class="c">Long text</article><span class="deadline">2 May</span></body>')], schemas.RESPONSE)
    plain = connectors.rss(responses(spark, [(1, 200, feed), (2, 200, "broken <")])).collect()
    assert [(r["title"], r["clean_text"]) for r in plain] == [("A", "Short")]
    full = connectors.rss(responses(spark, [(1, 200, feed)]), details, "article.c", "span.deadline").first()
    assert full["clean_text"] == "DEADLINE: 2 May\nLong text"


def test_pages_targets_and_dates(spark):
    assert connectors.page_urls("https://a.org/x/", {"max_pages": 2, "path_template": "/page/{page}"}) == ["https://a.org/x/", "https://a.org/x/page/2"]
    assert connectors.page_urls("https://a.org/x?s=1", {"max_pages": 3, "start": 2, "page_param": "p"}) == ["https://a.org/x?s=1&p=2", "https://a.org/x?s=1&p=3"] and connectors.page_urls("u", {}) == ["u"]
    many = responses(spark, [(n, 200, json.dumps([post(n)])) for n in (1, 2, 3)])
    assert connectors.wp_rest(many.withColumn("total_pages", F.lit(2))).count() == 2 and connectors.wp_rest(many.withColumn("total_pages", F.lit(0))).count() == 3
    both = many.withColumn("target", F.lit("phd")).unionByName(many.withColumn("target", F.lit("12")))
    found = connectors.wp_rest_targeted(both, 2).collect()
    assert sorted((r["source_id"], r["target"], r["canonical_url"][-1]) for r in found) == [("s", "12", "1"), ("s", "12", "2"), ("s", "phd", "1"), ("s", "phd", "2")]
    assert connectors.utc_stamp("Mon, 05 Jan 2026 12:00:00 +0200") == connectors.utc_stamp("2026-01-05T10:00:00Z") == "2026-01-05T10:00:00+00:00" and connectors.utc_stamp("soon") == ""
    feed = "<rss><channel><item><title>A</title><link>https://x.org/a</link><pubDate>Mon, 05 Jan 2026 12:00:00 +0200</pubDate></item></channel></rss>"
    page = '<body><article>Long <nav>menu</nav>text<aside>ad</aside></article></body>'
    details = spark.createDataFrame([("k", "s", "https://x.org/a", 1, 200, "t", 1, page)], schemas.RESPONSE)
    one = connectors.rss(responses(spark, [(1, 200, feed)]), details).first()
    assert one["clean_text"] == "Long text" and one["published_at"] == "2026-01-05T10:00:00+00:00"


def test_polite_fetching():
    now, sent = [0.0], []
    answers = {"https://a.org/1": [fetching.Response(503), fetching.Response(429, retry_after="30"), fetching.Response(200, "x")], "https://a.org/2": [fetching.Response(404)], "https://b.org/1": [fetching.Response(403)], "https://c.org/1": [fetching.Response(None)] * 9}

    def send(url):
        sent.append((now[0], url))
        return answers[url].pop(0)

    urls = ["https://a.org/1", "https://a.org/2", "https://b.org/1", "https://b.org/2", "https://c.org/1", "https://c.org/private"]
    found = list(fetching.fetch(urls, send, lambda u: "private" not in u, clock=lambda: now[0], wait=lambda s: now.__setitem__(0, now[0] + s)))
    assert {u: w for u, _, w in found} == {urls[0]: "done", urls[1]: "failed", urls[2]: "refused", urls[3]: "refused", urls[4]: "failed", urls[5]: "disallowed"}
    to_a = [t for t, u in sent if "a.org" in u]
    assert all(b - a >= fetching.DELAY for a, b in zip(to_a, to_a[1:])) and any(b - a >= 30 for a, b in zip(to_a, to_a[1:]))
    assert sum("c.org" in u for _, u in sent) == 1 + fetching.RETRIES and len({t for t, u in sent[:3] if t == 0.0}) == 1


def test_listings(spark):
    page = "".join(f'<article><h2><a href="/p/{i}">Post {i}</a></h2></article>' for i in range(3)) + "<article><h2>none</h2></article>"
    found = connectors.html_listing(responses(spark, [(1, 200, page), (2, 404, page)]), {"item": "article", "title": "h2 a", "link": "h2 a"}).orderBy("canonical_url").collect()
    assert [(r["canonical_url"], r["title"]) for r in found] == [(f"https://x.org/p/{i}", f"Post {i}") for i in range(3)]


def test_methods_cache_and_robots(spark):
    with pytest.raises(ValueError):
        connectors.get_collector("ftp")
    assert connectors.provision_recipe("s", "html") is None and connectors.provision_recipe("s", "wp_rest")["per_page"] == 50
    wanted = spark.createDataFrame([(connectors.cache_key("https://x.org", {"p": "1"}),), ("missing",)], "key string")
    cache = spark.createDataFrame([(connectors.cache_key("https://x.org", {"p": "1"}), "s", "u", 1, 200, "t", 1, "x")], schemas.RESPONSE)
    assert sorted(str(r["error"]) for r in connectors.lookup(wanted, cache).collect()) == ["None", "not cached"]
    rules = spark.createDataFrame([("User-agent: *\nDisallow: /private", "https://x.org/private/a"), (None, "https://x.org/b")], "robots string, url string")
    assert [r["ok"] for r in rules.select(connectors.robots_allow("robots", "url").alias("ok")).collect()] == [False, True]


def test_raw_batches(spark, tmp_path):
    (tmp_path / "src_a").mkdir()
    (tmp_path / "src_a" / "b.jsonl").write_text('{"record_id": "1", "source_id": "other", "title": "t u"}\n\n{broken\n', encoding="utf-8")
    good, broken = files.read_raw(spark, str(tmp_path), "record_id string, source_id string, title string")
    assert [tuple(r) for r in good.select("source_id", "record_id", "title").collect()] == [("src_a", "1", "t u")] and broken.count() == 1
    assert files.read_jsonl(spark, str(tmp_path / "none"), "a string").count() == 0


def test_versions_are_written_once(spark, tmp_path):
    df = spark.range(5).withColumn("split", F.when(F.col("id") < 4, "train").otherwise("test"))
    manifest = files.write_frozen(df, str(tmp_path / "classifier" / "v1"), {"version": "v1"}, "split")
    assert manifest["rows"] == 5 and files.read_manifest(spark, str(tmp_path / "classifier" / "v1")) == manifest
    with pytest.raises(FileExistsError):
        files.write_frozen(df, str(tmp_path / "classifier" / "v1"), {})
    assert files.read_split(spark, str(tmp_path), "classifier", "v1", "train").count() == 4
    with pytest.raises(FileNotFoundError):
        files.read_split(spark, str(tmp_path), "classifier", "v2", "train")
    assert files.digest(df) == files.digest(df.orderBy(F.desc("id")))
    files.append_once(df, str(tmp_path / "log"), "1")
    files.append_once(df, str(tmp_path / "log"), "1")
    files.append_once(df, str(tmp_path / "log"), "2")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 10
    assert "| 0 | train |" in files.markdown(df.orderBy("id"), "T")


def test_new_records(spark):
    found = spark.createDataFrame([("a",), ("a",), ("b",)], "u string").select(hashing.record_id(F.col("u")).alias("record_id"))
    assert files.new_records(found, found.limit(0)).count() == 2
    assert files.new_records(found, found).count() == 0
