"""Collectors that spark.read.format() knows by their method: wp_rest, rss and html.

Each reads a folder of cached responses (see write_cache), one partition a source. Within a source pages
are read in order and reading ends where collection ends: at a page that is missing, failed or brings
nothing new, beyond the pages that the server announces, or at the cap. A filter on source_id decides
which sources are opened at all. Records are those of sources.connectors, column by column.

    readers.register(spark)
    spark.read.format("wp_rest").option("maxRecords", 100).load(folder).where("source_id = 'a'")

Filters reach a Python reader where spark.sql.python.filterPushdown.enabled is set, which register()
sets for its session; without it, option("source", "a,b") names the sources.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha1
from urllib.parse import unquote
from uuid import UUID, uuid5

import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from loamwork import constants as C
from loamwork.functions import arrow
from loamwork.sources import connectors

_RECORD = "record_id string, source_id string, canonical_url string, listing_url string, title string, raw_text string, clean_text string, published_at string, deadline string, content_hash string, extra "
_WP_EXTRA = "struct<wp_id:bigint,wp_modified:string,wp_categories:array<string>,wp_tags:array<string>,excerpt:string>"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def write_cache(responses: DataFrame, path: str, mode: str = "append") -> None:
    """Responses as the readers below expect them: a folder for each source, and one for each of its pages."""
    responses.write.mode(mode).partitionBy("source_id", "page").parquet(path)


def write_details(responses: DataFrame, path: str, mode: str = "append") -> None:
    """Detail pages, a folder for each key, where a reader finds a page by its URL."""
    responses.write.mode(mode).partitionBy("key").parquet(path)


def record_id(url: str) -> str:
    return str(uuid5(UUID(C.RECORD_NAMESPACE), url))


def content_hash(text: str) -> str:
    return sha1(re.sub(rf"[{re.escape(C.BLANKS)}]+", " ", text.lower()).strip(C.BLANKS).encode()).hexdigest()


class Cache:
    """A folder of cached responses in any store that pyarrow opens."""

    def __init__(self, path: str):
        where = re.sub(r"^file:/+", "/", path)
        self._fs, self._root = fs.FileSystem.from_uri(where) if "://" in where else (fs.LocalFileSystem(), where)

    def _folders(self, path: str, name: str) -> dict[str, str]:
        """Partition folders below `path`, by value."""
        found = self._fs.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return {unquote(f.base_name.split("=", 1)[1]): f.path for f in found if f.type == fs.FileType.Directory and f.base_name.startswith(f"{name}=")}

    def sources(self) -> list[str]:
        return sorted(self._folders(self._root, "source_id"))

    def pages(self, source: str) -> Iterator[tuple[int, list[dict]]]:
        """The pages of a source in order, each with its responses; a page is opened when its turn comes."""
        held = self._folders(self._root, "source_id").get(source)
        numbered = self._folders(held, "page") if held else {}
        for page, path in sorted((int(n), p) for n, p in numbered.items() if n != _NULL):
            yield page, ds.dataset(path, filesystem=self._fs, format="parquet", exclude_invalid_files=False).to_table().to_pylist()

    def by_key(self, key: str) -> dict | None:
        path = f"{self._root}/key={key}"
        if self._fs.get_file_info(path).type != fs.FileType.Directory:
            return None
        return next((r for r in ds.dataset(path, filesystem=self._fs, format="parquet").to_table().to_pylist() if r["status"] == 200), None)


@dataclass
class Source(InputPartition):
    source_id: str


def posts(text: str | None, deadline_fields: list[str]) -> Iterator[dict]:
    """The posts of a WordPress response as items; text that is no JSON has none."""
    try:
        found = json.loads(text or "")
    except ValueError:
        return
    for p in found if isinstance(found, list) else [found]:
        if not isinstance(p, dict):
            continue
        inner = lambda name, p=p: (p.get(name) or {}).get("rendered") if isinstance(p.get(name), dict) else None
        terms = [t for group in ((p.get("_embedded") or {}).get("wp:term") or []) for t in group or []]
        named = lambda kind, terms=terms: sorted({t.get("name").strip(C.BLANKS) for t in terms if t.get("taxonomy") == kind and (t.get("name") or "").strip(C.BLANKS)})
        extra = {"wp_id": p.get("id"), "wp_modified": p.get("modified"), "wp_categories": named("category"), "wp_tags": named("post_tag"), "excerpt": arrow.html_text(inner("excerpt"))[:500]}
        stated = next((p[f].strip(C.BLANKS) for f in deadline_fields if (p.get(f) or "").strip(C.BLANKS)), None)
        yield {"link": p.get("link"), "title": inner("title"), "content": inner("content") or "", "published": p.get("date_gmt") or p.get("date"), "deadline": stated, "extra": extra}


class CollectorReader(DataSourceReader):
    def __init__(self, options: dict, method: str):
        self.options, self.method = dict(options), method
        self.path = self.options["path"]
        self.cap = int(self.options.get("maxrecords", connectors.CAPS[method]))
        self.recipe = json.loads(self.options.get("recipe", "{}"))
        named = self.options.get("source")
        self.wanted = None if named is None else {s.strip() for s in named.split(",")}

    def partitions(self) -> list[Source]:
        found = [Source(s) for s in Cache(self.path).sources() if s != _NULL and (self.wanted is None or s in self.wanted)]
        return found or [Source("")]

    def _items(self, response: dict) -> Iterable[dict]:
        if self.method == "wp_rest":
            return posts(response["text"], self.recipe.get("deadline_fields", ["deadline", "application_deadline"]))
        if self.method == "rss":
            return connectors.entries(response["text"])
        return connectors.listed(response["text"], response["url"], self.recipe)

    def _within(self, page: int, response: dict) -> bool:
        announced = (response.get("total_pages") or 0) if self.method == "wp_rest" else 0
        return response["status"] == 200 and (announced < 1 or page <= announced)

    def _detailed(self, record: dict, details: Cache | None) -> dict:
        """The record with the text of its own page, where that is cached and wanted."""
        if details is None or self.method == "wp_rest" or (self.method == "rss" and len(record["clean_text"]) >= connectors.SHORT):
            return record
        page = details.by_key(connectors.cache_key(record["canonical_url"]))
        if page is None:
            return record
        how = self.recipe.get("detail", {})
        without = ("nav", "footer", "aside") if self.method == "rss" else ()
        text = connectors.detail(page["text"], how.get("content_selector", "article"), how.get("deadline_selector"), without)
        return record | {"clean_text": text, "content_hash": content_hash(f"{record['title']}\n{text}")}

    def read(self, partition: Source) -> Iterator[tuple]:
        details = Cache(self.options["detailspath"]) if "detailspath" in self.options else None
        seen: set[str] = set()
        last = None
        for page, responses in Cache(self.path).pages(partition.source_id):
            if seen and page != last + 1:
                return
            fresh = 0
            for response in responses:
                for item in self._items(response) if self._within(page, response) else ():
                    if not item["link"] or (key := record_id(item["link"])) in seen:
                        continue
                    seen.add(key)
                    fresh += 1
                    title, raw = html.unescape(item["title"] or "").strip(), item["content"][: C.RAW_TEXT_LIMIT]
                    clean = arrow.html_text(raw)
                    record = {
                        "record_id": key, "source_id": partition.source_id, "canonical_url": item["link"], "listing_url": response["url"], "title": title, "raw_text": raw, "clean_text": clean,
                        "published_at": item["published"] or None, "deadline": item.get("deadline"), "content_hash": content_hash(f"{title}\n{clean}"), "extra": item.get("extra"),
                    }
                    record = self._detailed(record, details)
                    extra = record["extra"]
                    yield (*list(record.values())[:-1], tuple(extra.values()) if extra else None)
                    if len(seen) >= self.cap:
                        return
            if seen and not fresh:
                return
            last = page


class PushedReader(CollectorReader):
    """The same where Spark hands filters down."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo | EqualNullSafe) else set(f.value) if isinstance(f, In) else None
            if values is None or tuple(f.attribute) != ("source_id",):
                yield f
            else:
                self.wanted = values if self.wanted is None else self.wanted & values


class _Collector(DataSource):
    method = ""
    extra = "struct<feed_title:string>"

    @classmethod
    def name(cls) -> str:
        return cls.method

    def schema(self) -> str:
        return _RECORD + self.extra

    def reader(self, schema: StructType) -> DataSourceReader:
        if "path" not in self.options:
            raise ValueError(f"{self.method} needs the folder of its cached responses")
        pushed = self.options.get("pushdown", "true").lower() == "true"
        return (PushedReader if pushed else CollectorReader)(self.options, self.method)


class WpRest(_Collector):
    """Options: maxRecords, source, and recipe (JSON with deadline_fields)."""

    method, extra = "wp_rest", _WP_EXTRA


class Rss(_Collector):
    """Options: maxRecords, source, detailsPath, and recipe (JSON with detail.content_selector and detail.deadline_selector)."""

    method = "rss"


class Html(_Collector):
    """Options: maxRecords, source, detailsPath, and recipe (JSON with item, title, link, date and detail's selectors)."""

    method = "html"


FORMATS = {c.method: c for c in (WpRest, Rss, Html)}


def register(spark: SparkSession) -> None:
    """Make the formats known to a session and let filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in FORMATS.values():
        spark.dataSource.register(source)


def collect(spark: SparkSession, method: str, path: str, **options: object) -> DataFrame:
    """The records of all sources in a folder by their method; an unknown method is an error."""
    connectors.get_collector(method)
    register(spark)
    reader = spark.read.format(method)
    for name, value in options.items():
        reader = reader.option(name, json.dumps(value) if isinstance(value, dict) else value)
    return reader.load(path)
