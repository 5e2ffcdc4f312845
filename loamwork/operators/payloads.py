"""JSON whose shape is not known beforehand, as Variant: what an API answered, and a decision's response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import text

FIELDS = 25


def api_payload(body: Column, url: Column, status: Column) -> Column:
    """(kind, has_posts, items, sample_fields) of a probe's response.

    Kinds are those of inventory.api_kind(). A WordPress list says whether it has posts and the first
    post's fields, any other list how many items it has. A body that is no JSON is a page.
    """
    payload = F.try_parse_json(text.strip(F.coalesce(body, F.lit(""))))
    shape = F.schema_of_variant(payload)
    is_list, is_object = (F.coalesce(shape.startswith(s), F.lit(False)) for s in ("ARRAY<", "OBJECT<"))
    wordpress = url.contains("/wp-json/")
    kind = F.when(F.coalesce(url, F.lit("")) == "", "none").when(status.isNull(), "error").when(status.isin(C.REFUSED_STATUS), "refused").when((is_list | is_object) & wordpress, "wp_rest")
    kind = kind.when(is_list, "json_list").when(is_object, "json_object").otherwise("html")
    items = F.when(is_list, F.size(F.try_variant_get(payload, "$", "array<variant>")))
    first = F.try_variant_get(payload, "$[0]", "map<string,variant>")
    fields = F.when(is_list, F.coalesce(F.slice(F.array_sort(F.map_keys(first)), 1, FIELDS), F.array().cast("array<string>")))
    answered = kind.isin("wp_rest", "json_list")
    return F.struct(kind.alias("kind"), F.when((kind == "wp_rest") & is_list, items > 0).alias("has_posts"), F.when(answered & ~wordpress, items).alias("items"), F.when((kind == "wp_rest") & is_list, fields).alias("sample_fields"))


def with_response(answers: DataFrame) -> DataFrame:
    """Answers (see decision.answer) with `response`: what is sent back, in the shape of the question's kind.

    A yes-no question has {"noul"}, a choice {"choice", "probabilities"}; both have {"confidence": {..}}.
    """
    measures = F.struct("top_probability", "margin", "entropy", "confidence")
    noul = F.to_json(F.struct(F.col("noul"), measures.alias("confidence")))
    choice = F.to_json(F.struct(F.col("choice"), F.col("probabilities"), measures.alias("confidence")))
    return answers.withColumn("response", F.parse_json(F.when(F.col("kind") == "noul", noul).otherwise(choice)))


def read_response(responses: DataFrame) -> DataFrame:
    """`responses` with what their Variant says: shape, noul, choice, chosen (the choice's probability) and entropy. What a shape lacks is null."""
    r = F.col("response")
    get = lambda path, kind: F.try_variant_get(r, path, kind)
    chosen = F.element_at(F.try_variant_get(r, "$.probabilities", "map<string,double>"), get("$.choice", "string"))
    shape = F.when(get("$.noul", "double").isNotNull(), "noul").when(get("$.choice", "string").isNotNull(), "choice").otherwise("other")
    return responses.withColumns({"shape": shape, "noul": get("$.noul", "double"), "choice": get("$.choice", "string"), "chosen": chosen, "entropy": get("$.confidence.entropy", "double")})
