import json

import pytest
from pyspark.sql import functions as F

from loamwork import schemas
from loamwork.sources import connectors, readers
from tests.test_sources import post

FEED = "<rss><channel>{}</channel></rss>"
ENTRY = "<item><title>{0} &amp;amp; more</title><link>https://f.org/{0}</link><pubDate>Mon, 05 Jan 2026 12:00:00 +0200</pubDate><description><![CDATA[<p>About\x85 {0}</p><p>Two</p>]]></description></item>"
LISTED = '<article><h2><a href="/p/{0}">Post {0}</a></h2><time>2026</time></article>'
RECIPE = {"item": "article", "title": "h2 a", "link": "h2 a", "date": "time", "detail": {"content_selector": "div.body", "deadline_selector": "span.due"}}


def table(spark, pages):
    rows = [("k", source, f"https://{source}.org/l?page={n}", n, status, "t", total, text) for source, n, status, total, text in pages]
    return spark.createDataFrame(rows, schemas.RESPONSE)


def wordpress():
    return [
        ("a", 1, 200, 9, json.dumps([post(1), post(2), post(7, link=None), post(8, link="")])), ("a", 2, 200, 9, json.dumps([post(2), post(3, deadline=" 7 June\n", date_gmt=None, excerpt={"rendered": "<p>Short</p><p>&amp; sweet</p>"})])), ("a", 3, 200, 9, json.dumps([post(1)])), ("a", 4, 200, 9, json.dumps([post(4)])),
        ("b", 1, 200, 2, json.dumps([post(11)])), ("b", 2, 200, 2, json.dumps([post(12, title={"rendered": " ÄB  c "}, content=None, _embedded=None)])), ("b", 3, 200, 2, json.dumps([post(13)])),
        ("c", 1, 500, 0, "oops"), ("d", 1, 200, 0, "{broken"), ("e", 1, 200, 0, json.dumps([post(21)])), ("e", 3, 200, 0, json.dumps([post(23)])), ("f/g h", 1, 200, 0, json.dumps([post(31)])),
    ]


def same(found, expected):
    columns = expected.columns
    assert found.columns == columns
    key = lambda df: sorted(str(r.asDict(True)) for r in df.collect())
    assert key(found) == key(expected) and found.count() > 0


def test_wordpress_by_format_equals_the_collector(spark, tmp_path):
    responses, path = table(spark, wordpress()), str(tmp_path / "wp")
    readers.write_cache(responses, path)
    same(readers.collect(spark, "wp_rest", path), connectors.wp_rest(responses))
    same(readers.collect(spark, "wp_rest", path, maxRecords=2), connectors.wp_rest(responses, cap=2))
    assert readers.collect(spark, "wp_rest", path).rdd.getNumPartitions() == 6
    with pytest.raises(ValueError):
        readers.collect(spark, "ftp", path)


def test_a_filter_opens_only_its_source(spark, tmp_path):
    path = str(tmp_path / "wp")
    readers.write_cache(table(spark, wordpress()), path)
    for part in (tmp_path / "wp" / "source_id=a").glob("*/*.parquet"):
        part.write_bytes(b"no parquet")
    every = readers.collect(spark, "wp_rest", path)
    with pytest.raises(Exception, match="(?i)parquet"):
        every.count()
    assert [r["canonical_url"][-2:] for r in every.where("source_id = 'b'").orderBy("canonical_url").collect()] == ["11", "12"]
    assert every.where(F.col("source_id").isin("e", "b") & (F.col("source_id") != "b")).count() == 1
    assert every.where("source_id = 'none'").count() == 0 and every.where("source_id = 'f/g h'").count() == 1
    assert spark.read.format("wp_rest").option("pushdown", "false").option("source", "b,e").load(path).count() == 3


def test_reading_ends_where_collection_ends(spark, tmp_path):
    path = str(tmp_path / "wp")
    readers.write_cache(table(spark, wordpress()), path)
    for page in ("source_id=a/page=4", "source_id=e/page=3"):
        for part in (tmp_path / "wp" / page).glob("*.parquet"):
            part.write_bytes(b"no parquet")
    assert readers.collect(spark, "wp_rest", path).where("source_id = 'a'").count() == 3
    assert readers.collect(spark, "wp_rest", path, maxRecords=1).where("source_id IN ('a', 'b')").count() == 2


def test_feeds_and_listings_by_format(spark, tmp_path):
    feeds = table(spark, [("x", 1, 200, 0, FEED.format(ENTRY.format("a") + ENTRY.format("b") + "<item><title>none</title></item>")), ("x", 2, 200, 0, "<rss"), ("y", 1, 404, 0, FEED.format(ENTRY.format("c")))])
    pages = table(spark, [("h", 1, 200, 0, LISTED.format(1) + LISTED.format(2)), ("h", 2, 200, 0, LISTED.format(3)), ("h", 3, 404, 0, LISTED.format(4)), ("h", 4, 200, 0, LISTED.format(5))])
    page = '<body><nav>n</nav><div class="body">Long <aside>ad</aside> text</div><span class="due">2 May</span></body>'
    urls = ["https://f.org/a", "https://h.org/p/1", "https://h.org/p/3"]
    details = spark.createDataFrame([(connectors.cache_key(u), "s", u, 1, 200 if u[-1] != "3" else 500, "t", 1, page) for u in urls], schemas.RESPONSE)
    readers.write_cache(feeds, str(tmp_path / "rss"))
    readers.write_cache(pages, str(tmp_path / "html"))
    readers.write_details(details, str(tmp_path / "details"))
    same(readers.collect(spark, "rss", str(tmp_path / "rss")), connectors.rss(feeds))
    how = {"detail": RECIPE["detail"]}
    same(readers.collect(spark, "rss", str(tmp_path / "rss"), detailsPath=str(tmp_path / "details"), recipe=how), connectors.rss(feeds, details, "div.body", "span.due"))
    same(readers.collect(spark, "html", str(tmp_path / "html"), recipe=RECIPE), connectors.html_listing(pages, RECIPE))
    same(readers.collect(spark, "html", str(tmp_path / "html"), recipe=RECIPE, detailsPath=str(tmp_path / "details")), connectors.html_listing(pages, RECIPE, details))


def test_keys_equal_those_of_columns(spark):
    from loamwork.functions import hashing

    texts = ["https://x.org/ä?b=1", "A  \x85 B c\n", "", " İ x "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", hashing.record_id(F.col("t")).alias("id"), hashing.content_hash(F.col("t")).alias("hash")).collect()
    assert all(r["id"] == readers.record_id(r["t"]) and r["hash"] == readers.content_hash(r["t"]) for r in rows)
