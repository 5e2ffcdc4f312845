"""Collection from fetched responses: WordPress REST, RSS or Atom, and HTML listings.

Nothing here opens a connection. A collector reads a table of cached responses (see schemas.RESPONSE),
which any Spark reader can load, and gives raw records. Where the cache lacks a page, collection of
that source ends there, as it does at an error.
"""

from __future__ import annotations

import html
import json
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from hashlib import sha1
from urllib.parse import urljoin
from urllib.robotparser import RobotFileParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.types import BooleanType, StringType

from loamwork import constants as C
from loamwork.functions import arrow, hashing
from loamwork.functions.text import strip
from loamwork.sources.markup import parse

CAPS = {"wp_rest": 250, "rss": 120, "html": 100}
SHORT = 1200
_TERM = "struct<taxonomy:string,id:bigint,name:string,slug:string>"
POST = (
    "struct<id:bigint,date:string,date_gmt:string,modified:string,link:string,title:struct<rendered:string>,content:struct<rendered:string>,excerpt:struct<rendered:string>,"
    f"deadline:string,application_deadline:string,_embedded:struct<`wp:term`:array<array<{_TERM}>>>>"
)
ITEM = "place int, link string, title string, content string, published string"


def cache_key(url: str, params: dict | None = None) -> str:
    return sha1((url + json.dumps(params or {}, sort_keys=True)).encode()).hexdigest()


def lookup(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests with their cached response; what the cache lacks has an error."""
    found = requests.join(cache.drop(*[c for c in requests.columns if c != "key"]), "key", "left")
    return found.withColumn("error", F.when(F.col("status").isNull(), "not cached").when(F.col("status") >= 400, F.concat(F.lit("status "), F.col("status").cast("string"))))


@pandas_udf(BooleanType())
def robots_allow(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether a robots.txt lets any agent fetch a URL; one that is missing does."""
    for robots, urls in batches:
        out = []
        for rules, url in zip(robots, urls, strict=True):
            parser = RobotFileParser()
            parser.parse((rules or "").splitlines())
            out.append(parser.can_fetch("*", url))
        yield pd.Series(out, dtype=bool)


@pandas_udf(StringType())
def unescape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(lambda x: html.unescape(x or "").strip())


def utc_stamp(written: str) -> str:
    """A feed's date, in either of the two usual forms, as ISO in UTC; empty if it is none. Without a zone it is UTC."""
    for read in (parsedate_to_datetime, datetime.fromisoformat):
        try:
            found = read(written.strip())
        except (TypeError, ValueError):
            continue
        return (found if found.tzinfo else found.replace(tzinfo=UTC)).astimezone(UTC).replace(microsecond=0).isoformat()
    return ""


def entries(document: str | None) -> Iterator[dict]:
    """The entries of an RSS or Atom document; a broken document has none."""

    def child(node: ElementTree.Element, *names: str) -> str:
        for wanted in names:
            for c in node:
                if c.tag.rsplit("}", 1)[-1] == wanted:
                    if wanted == "link" and c.get("href"):
                        return c.get("href")
                    if (c.text or "").strip():
                        return c.text.strip()
        return ""

    try:
        root = ElementTree.fromstring((document or "").strip())
    except ElementTree.ParseError:
        return
    for n in root.iter():
        if n.tag.rsplit("}", 1)[-1] in ("item", "entry"):
            dated = utc_stamp(child(n, "pubDate", "published", "date") or child(n, "updated"))
            yield {"link": child(n, "link"), "title": child(n, "title"), "content": child(n, "encoded", "content", "description", "summary"), "published": dated}


def listed(page: str | None, url: str | None, recipe: dict) -> Iterator[dict]:
    """The items of a listing page by the recipe's selectors; what lacks a title or link is none."""
    for node in parse(page or "").select(recipe["item"]):
        titles, links = node.select(recipe.get("title", "a")), node.select(recipe.get("link", "a"))
        href = links[0].attrs.get("href") if links else None
        if href and titles:
            dated = node.select(recipe["date"]) if recipe.get("date") else []
            yield {"link": urljoin(url or "", href), "title": titles[0].text().strip(), "content": node.markup(), "published": dated[0].text().strip() if dated else ""}


@udtf(returnType=ITEM, useArrow=True)
class FeedItems:
    """A feed's entries as rows, for a lateral join."""

    def eval(self, document: str) -> Iterator[tuple]:
        for place, e in enumerate(entries(document)):
            yield place, e["link"], e["title"], e["content"], e["published"]


@udtf(returnType=ITEM, useArrow=True)
class ListedItems:
    """A listing page's items as rows; the recipe's selectors are the last argument, as JSON."""

    def eval(self, page: str, url: str, selectors: str) -> Iterator[tuple]:
        for place, e in enumerate(listed(page, url, json.loads(selectors))):
            yield place, e["link"], e["title"], e["content"], e["published"]


def _items(responses: DataFrame, found: DataFrame) -> DataFrame:
    """Pages that were fetched, each with the items that `found` gives of its columns; pages without any give no row."""
    pages = responses.where("status = 200").select("source_id", "page", F.col("url").alias("listing_url"), "text", "url")
    return pages.lateralJoin(found).drop("text", "url")


def detail(page: str | None, selector: str, deadline: str | None = None, without: tuple[str, ...] = ()) -> str:
    """The text of a detail page, after "DEADLINE: ..." where the page states one; tags in `without` are left out."""
    tree = parse(page or "")
    body = (tree.select(selector) or tree.select("body") or [tree])[0]
    stated = tree.select(deadline) if deadline else []
    head = f"DEADLINE: {stated[0].text().strip()}\n" if stated and stated[0].text().strip() else ""
    return head + arrow.html_text(body.markup(), without)


def detail_text(selector: str, deadline: str | None = None, without: tuple[str, ...] = ()) -> Callable:
    """detail() as an Arrow function."""

    @pandas_udf(StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda page: detail(page, selector, deadline, without))

    return run


def _records(items: DataFrame, cap: int) -> DataFrame:
    """Raw records of (source_id, page, place, link, title, content, published, deadline, listing_url, extra).

    Pages count up to the first that is missing, failed, or has no record that an earlier page lacks.
    """
    items = items.where("link IS NOT NULL AND link <> ''").withColumn("record_id", hashing.record_id(F.col("link")))
    source = Window.partitionBy("source_id")
    kept = items.withColumn("_n", F.row_number().over(Window.partitionBy("source_id", "record_id").orderBy("page", "place"))).where("_n = 1")
    pages = kept.groupBy("source_id", "page").agg(F.count("*").alias("fresh"))
    run = pages.withColumn("_k", F.row_number().over(source.orderBy("page"))).withColumn("_first", F.min("page").over(source)).where(F.col("page") == F.col("_first") + F.col("_k") - 1)
    taken = kept.join(run.select("source_id", "page"), ["source_id", "page"], "left_semi").withColumn("_k", F.row_number().over(source.orderBy("page", "place"))).where(F.col("_k") <= cap)
    clean = arrow.html_to_text(F.substring("content", 1, C.RAW_TEXT_LIMIT))
    made = taken.withColumn("title", unescape("title")).withColumn("raw_text", F.substring("content", 1, C.RAW_TEXT_LIMIT)).withColumn("clean_text", clean)
    hashed = made.withColumn("content_hash", hashing.content_hash(F.concat("title", F.lit("\n"), "clean_text")))
    return hashed.select("record_id", "source_id", F.col("link").alias("canonical_url"), "listing_url", "title", "raw_text", "clean_text", F.nullif("published", F.lit("")).alias("published_at"), "deadline", "content_hash", "extra")


def _terms(kind: str) -> Column:
    every = F.coalesce(F.flatten(F.col("p._embedded.`wp:term`")), F.array().cast(f"array<{_TERM}>"))
    names = F.transform(F.filter(every, lambda t: t["taxonomy"] == kind), lambda t: strip(F.coalesce(t["name"], F.lit(""))))
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: n != "")))


def page_urls(listing: str, pagination: dict) -> list[str]:
    """The pages of a listing: the first is the listing itself, the others follow a path template or a parameter."""
    start, end = int(pagination.get("start", 1)), int(pagination.get("max_pages", 1))
    template, parameter = pagination.get("path_template"), pagination.get("page_param", "page")

    def url(n: int) -> str:
        if n == 1:
            return listing
        return listing.rstrip("/") + template.format(page=n) if template else f"{listing}{'&' if '?' in listing else '?'}{parameter}={n}"

    return [url(n) for n in range(start, end + 1)]


def wp_rest_targeted(responses: DataFrame, per_target: int = 60, **how: object) -> DataFrame:
    """Records asked for by slug or category id, which `responses` has in column target: up to `per_target` of each.

    A record of several targets comes once for each.
    """
    own = responses.withColumn("_source", F.col("source_id")).withColumn("source_id", F.concat_ws("\n", "source_id", "target"))
    found = wp_rest(own.select(*[c for c in responses.columns if c != "target"]), cap=per_target, **how)
    return found.withColumn("target", F.element_at(F.split("source_id", "\n"), 2)).withColumn("source_id", F.substring_index("source_id", "\n", 1))


def wp_rest(responses: DataFrame, deadline_fields: tuple[str, ...] = ("deadline", "application_deadline"), cap: int = CAPS["wp_rest"]) -> DataFrame:
    # the first page says how many there are; what a server sends beyond that is not read
    within = responses.where("status = 200 AND (coalesce(total_pages, 0) < 1 OR page <= total_pages)")
    posts = within.select("source_id", "page", F.col("url").alias("listing_url"), F.posexplode(F.from_json("text", f"array<{POST}>")).alias("place", "p"))
    stated = F.get(F.filter(F.transform(F.array(*[F.col(f"p.{f}") for f in deadline_fields]), strip), lambda x: x != ""), F.lit(0))
    extra = F.struct(F.col("p.id").alias("wp_id"), F.col("p.modified").alias("wp_modified"), _terms("category").alias("wp_categories"), _terms("post_tag").alias("wp_tags"), F.substring(arrow.html_to_text(F.coalesce("p.excerpt.rendered", F.lit(""))), 1, 500).alias("excerpt"))
    return _records(posts.select("source_id", "page", "place", "listing_url", F.col("p.link").alias("link"), F.col("p.title.rendered").alias("title"), F.coalesce("p.content.rendered", F.lit("")).alias("content"), F.coalesce("p.date_gmt", "p.date").alias("published"), stated.alias("deadline"), extra.alias("extra")), cap)


def rss(responses: DataFrame, details: DataFrame | None = None, selector: str = "article", deadline: str | None = None, cap: int = CAPS["rss"]) -> DataFrame:
    """Feed entries; those with little text take the text of their page in `details` (url, text)."""
    out = _records(_items(responses, FeedItems(F.col("text").outer())).withColumns({"deadline": F.lit(None).cast("string"), "extra": F.lit(None).cast("struct<feed_title:string>")}), cap)
    return out if details is None else with_details(out, details, selector, deadline, SHORT, ("nav", "footer", "aside"))


def html_listing(responses: DataFrame, recipe: dict, details: DataFrame | None = None, cap: int = CAPS["html"]) -> DataFrame:
    """Items of listing pages by the recipe's selectors: item, title, link, date and detail.content_selector."""
    selectors = json.dumps({k: recipe[k] for k in ("item", "title", "link", "date") if recipe.get(k)})
    out = _records(_items(responses, ListedItems(F.col("text").outer(), F.col("url").outer(), F.lit(selectors))).withColumns({"deadline": F.lit(None).cast("string"), "extra": F.lit(None).cast("struct<feed_title:string>")}), cap)
    how = recipe.get("detail", {})
    return out if details is None else with_details(out, details, how.get("content_selector", "article"), how.get("deadline_selector"), None)


def with_details(records: DataFrame, details: DataFrame, selector: str, deadline: str | None, shorter_than: int | None, without: tuple[str, ...] = ()) -> DataFrame:
    pages = details.where("status = 200").select(F.col("url").alias("canonical_url"), detail_text(selector, deadline, without)("text").alias("_detail"))
    joined = records.join(pages, "canonical_url", "left")
    wanted = F.col("_detail").isNotNull() & (F.lit(True) if shorter_than is None else F.length("clean_text") < shorter_than)
    replaced = joined.withColumn("clean_text", F.when(wanted, F.col("_detail")).otherwise(F.col("clean_text"))).drop("_detail")
    return replaced.withColumn("content_hash", hashing.content_hash(F.concat("title", F.lit("\n"), "clean_text"))).select(*records.columns)


COLLECTORS: dict[str, Callable] = {"wp_rest": wp_rest, "rss": rss, "html": html_listing}


def get_collector(method: str) -> Callable:
    if method not in COLLECTORS:
        raise ValueError(f"unknown collection method: {method}")
    return COLLECTORS[method]


def feed_probe(responses: DataFrame) -> DataFrame:
    """(source_id, rss_url, kind, entries) of the first of a source's feed candidates that has entries."""
    pages = responses.where("status = 200").select("source_id", "url", "page", "text").lateralJoin(FeedItems(F.col("text").outer()))
    probed = pages.groupBy("source_id", "url", "page").agg(F.count("*").alias("entries"), F.first(F.when(F.col("text").contains("<rss"), "rss").otherwise("atom")).alias("kind"))
    ranked = probed.withColumn("_n", F.row_number().over(Window.partitionBy("source_id").orderBy("page")))
    return ranked.where("_n = 1").select("source_id", F.col("url").alias("rss_url"), "kind", "entries")


def provision_recipe(source_id: str, method: str, per_page: int = 50) -> dict | None:
    """A recipe for a source that has none; listings need selectors, which nobody can guess."""
    if method not in ("wp_rest", "rss"):
        return None
    return {"source_id": source_id, "method": method, "parser_version": 1, "max_records": CAPS[method]} | ({"per_page": per_page} if method == "wp_rest" else {})
