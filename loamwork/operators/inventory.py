"""Probes of sources, the collection method they recommend, and the source registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import text
from loamwork.runtime import cut


def occurrences(page: Column, tag: str) -> Column:
    return F.size(F.regexp_extract_all(page, F.lit(rf"(?i)<{tag}[\s>]"), F.lit(0)))


def page_probe(pages: DataFrame) -> DataFrame:
    """`pages` with html_bytes, article_tags, links, looks_like_wordpress, spa_markers and server_rendered_guess."""
    markers = F.array_compact(F.array(*[F.when(F.col("html").contains(m), F.lit(m)) for m in C.SPA_MARKERS]))
    probed = (
        pages.withColumn("html_bytes", F.octet_length("html")).withColumn("article_tags", occurrences(F.col("html"), "article")).withColumn("links", occurrences(F.col("html"), "a"))
        .withColumn("looks_like_wordpress", F.col("html").rlike(C.WORDPRESS)).withColumn("spa_markers", markers)
    )
    return probed.withColumn("server_rendered_guess", (F.length("html") > C.RENDERED_LENGTH) & (F.col("links") > C.RENDERED_LINKS) & (F.size("spa_markers") == 0))


def api_kind(status: Column, body: Column, url: Column) -> Column:
    """What answered an API probe: wp_rest, json_list, json_object, html, refused, error, or none without an endpoint."""
    bare = text.strip(F.coalesce(body, F.lit("")))
    parsed = F.try_parse_json(bare).isNotNull()
    wordpress = url.contains("/wp-json/")
    return F.when(F.coalesce(url, F.lit("")) == "", "none").when(status.isNull(), "error").when(status.isin(C.REFUSED_STATUS), "refused").when(parsed & (bare.startswith("[") | bare.startswith("{")) & wordpress, "wp_rest").when(parsed & bare.startswith("["), "json_list").when(parsed & bare.startswith("{"), "json_object").otherwise("html")


def recommended_method() -> Column:
    """From api_kind, rss_url, page_status, page_refused, robots_allowed and html_bytes."""
    no = F.lit(False)
    blocked = F.coalesce("page_refused", no) | (F.coalesce("robots_allowed", F.lit(True)) == no)
    return (
        F.when(blocked, "blocked_document").when(F.col("api_kind") == "wp_rest", "wp_rest").when(F.col("api_kind").isin("json_list", "json_object"), "api_json")
        .when(F.coalesce("rss_url", F.lit("")) != "", "rss").when((F.col("page_status") == 200) & (F.col("html_bytes") > C.PAGE_BYTES), "html").otherwise("needs_manual_review")
    )


def allowed_method(recipe: Column, recommended: Column) -> Column:
    """The recipe's method wins; methods that no collector has are null."""
    chosen = F.coalesce(recipe, recommended)
    return F.when(chosen.isin("wp_rest", "rss", "html"), chosen)


def registry(sources: DataFrame) -> DataFrame:
    """Source ids from names: in list order (column pos), the first free of slug, slug_2, slug_3 and on.

    Found without going through the list: each row claims an id, the first claimant in list order keeps
    it, and the others claim their next, as do the later rows of the same slug with them. A row's first
    claim counts the rows of its slug before it, as these hold as many ids. The first rows' claims never
    fall back, so the rounds end when no id is claimed twice.
    """
    k = F.row_number().over(Window.partitionBy("_slug").orderBy("pos"))
    named = sources.withColumn("name", text.strip(F.col("name"))).withColumn("_slug", text.slugify(F.col("name")))
    claims = cut(named.select("pos", "_slug", k.alias("_k"), k.alias("_n")))
    claim = F.when(F.col("_n") == 1, F.col("_slug")).otherwise(F.concat_ws("_", "_slug", F.col("_n").cast("string")))
    while True:
        held = claims.withColumn("source_id", claim)
        lost = held.withColumn("_lost", F.row_number().over(Window.partitionBy("source_id").orderBy("pos")) > 1)
        if lost.where("_lost").isEmpty():
            return named.join(held.select("pos", "source_id"), "pos").drop("_slug")
        upto = Window.partitionBy("_slug").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
        moved = F.col("_n") + F.col("_lost").cast("int") - F.col("_k")
        claims = cut(lost.select("pos", "_slug", "_k", (F.max(moved).over(upto) + F.col("_k")).alias("_n")))


def drift(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one of two registries has."""
    columns = sorted(left.columns)
    a, b = left.select(columns), right.select(columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def method_counts(sources: DataFrame) -> DataFrame:
    return sources.groupBy("recommended_method").agg(F.count("*").alias("n"))


def scope_counts(sources: DataFrame) -> DataFrame:
    return sources.select(F.explode("scope").alias("scope")).groupBy("scope").agg(F.count("*").alias("n"))


def category_ids(terms: DataFrame, keywords: list[str]) -> DataFrame:
    """(keyword, ids): category ids whose name or slug holds a keyword, over rows (id, name, slug)."""
    each = terms.select("id", F.lower(F.concat_ws(" ", "name", "slug")).alias("t"), F.explode(F.array(*map(F.lit, keywords))).alias("keyword"))
    return each.where(F.col("t").contains(F.col("keyword"))).groupBy("keyword").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def known_methods(registered: DataFrame, probes: DataFrame) -> DataFrame:
    """`registered` with recommended_method: the probe's, or what the endpoint says of a source without one."""
    guess = F.when(F.coalesce("api_endpoint", F.lit("")).contains("/wp-json/"), "wp_rest").otherwise("needs_manual_review")
    found = probes.select("source_id", F.col("recommended_method").alias("_probed"))
    return registered.join(found, "source_id", "left").withColumn("recommended_method", F.coalesce("_probed", guess)).drop("_probed")


def targets(registered: DataFrame, source: str | None = None, methods: list[str] | None = None) -> DataFrame:
    """The sources of a run: one by its id or all, of these only those of the methods asked for."""
    chosen = registered if source is None else registered.where(F.col("source_id") == source)
    return chosen if methods is None else chosen.where(F.col("recommended_method").isin(methods))
