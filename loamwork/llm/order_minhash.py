"""Document fingerprints by Order MinHash, in SQL functions only.

A text's k-mers are numbered by occurrence: the second "of the" of a text is another element than the
first. Every element gets a hash; its top six bits choose one of 64 buckets (one permutation stands for
64), and each bucket keeps its two minimal elements. These are put back in the order in which they
stand in the text and hashed as a tuple, so that moving text changes a fingerprint as editing does.
The share of equal buckets falls with the edit distance.

K-mers are pairs of pieces in texts of every length. A piece is a word; words are cut after a few rare
characters and after twelve at most, and letters of scripts without blanks are pieces of their own, so
that an edit of a text without blanks changes the pieces near it only. Hashes are packed into longs with positions in the low
24 bits, which sorts as a primitive array; in a text of over 16.7 million pieces positions wrap, which
can only turn the order within a tuple.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamwork.llm.common import documents, text_or_empty

BUCKET_BITS = 6
_POSITION = (1 << 24) - 1
_ALONE = r"\\x{0E00}-\\x{0EFF}\\x{2E80}-\\x{D7AF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{3FFFF}"
_LAST = "05QXZqxz"
_PIECES = rf"[^\\x20\\x09-\\x0D{_ALONE}{_LAST}]{{1,11}}+[{_LAST}]?+|[{_ALONE}{_LAST}]"


def with_signature(df: DataFrame, text: str, to: str) -> DataFrame:
    """`df` with `to` array<long>: for each bucket that is not empty, its number above 32 bits of the hash of its tuple.

    The column `text` must not be null. An empty or blank text has an empty signature.
    """
    w, h, s, st, g, b, bs = (f"_{to}_{x}" for x in ("w", "h", "s", "st", "g", "b", "bs"))
    steps = [
        (w, f"regexp_extract_all({text}, '{_PIECES}', 0)"),
        (
            h,
            f"transform(slice({w}, 1, greatest(1, size({w}) - 1)), (x, i) -> xxhash64(x, get({w}, i + 1)))",
        ),
        (s, f"sort_array(transform({h}, (x, i) -> (x & {~_POSITION}L) | (i & {_POSITION}L)))"),
        (st, f"filter(sequence(0, greatest(0, size({s}) - 1)), j -> j < size({s}) AND (j = 0 OR shiftright(get({s}, j), 24) <> shiftright(get({s}, j - 1), 24)))"),
        (
            g,
            f"""sort_array(flatten(transform({st}, (a, r) -> transform(
                slice({s}, a + 1, coalesce(get({st}, r + 1), size({s})) - a),
                (x, o) -> (xxhash64(shiftright(x, 24), o) & {~_POSITION}L) | (x & {_POSITION}L)))))""",
        ),
        (bs, f"filter(sequence(0, greatest(0, size({g}) - 1)), j -> j < size({g}) AND (j = 0 OR shiftright(get({g}, j), {64 - BUCKET_BITS}) <> shiftright(get({g}, j - 1), {64 - BUCKET_BITS})))"),
        (
            to,
            f"""transform({bs}, j -> shiftleft(shiftrightunsigned(get({g}, j), {64 - BUCKET_BITS}), 32) | (4294967295L & CASE
                WHEN coalesce(shiftright(get({g}, j + 1), {64 - BUCKET_BITS}) <> shiftright(get({g}, j), {64 - BUCKET_BITS}), true) THEN xxhash64(shiftright(get({g}, j), 24))
                WHEN (get({g}, j) & {_POSITION}L) <= (get({g}, j + 1) & {_POSITION}L) THEN xxhash64(shiftright(get({g}, j), 24), shiftright(get({g}, j + 1), 24))
                ELSE xxhash64(shiftright(get({g}, j + 1), 24), shiftright(get({g}, j), 24)) END))""",
        ),
    ]
    for name, sql in steps:
        df = df.withColumn(name, F.expr(sql))
    return df.drop(w, h, s, st, g, b, bs)


def fingerprint(signature: str) -> Column:
    """A signature as text, ten hexadecimal digits a bucket."""
    return F.lower(F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 10, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """The share of buckets that are equal among those that either text fills; 1 if neither fills one."""
    used = F.size(F.array_union(F.transform(a, lambda x: F.shiftright(x, 32)), F.transform(b, lambda x: F.shiftright(x, 32))))
    return F.when(used == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / used).cast("double")


def _blocks(docs: DataFrame, n: int) -> tuple[Column, list[tuple[int, int]]]:
    """A column with the number of a document's range of ids, and each range that has documents with its least id."""
    splits = docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n)
    splits = sorted({int(x) for x in splits})
    table = F.array(*[F.lit(x) for x in splits]).cast("array<bigint>")
    if not splits:
        block = F.lit(0)
    else:
        # binary search for the last split that is not above the id
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(splits).bit_length()))])
        block = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at))
    first = docs.select(block.alias("block"), "doc_id").groupBy("block").agg(F.min("doc_id").alias("least")).orderBy("block").collect()
    return block, [(r["block"], r["least"]) for r in first]


def with_next(docs: DataFrame, columns: list[str], blocks_per_partition: int = 8) -> DataFrame:
    """`docs` with next_<column> of the following document by ascending doc_id; the first follows the last.

    Ids are dealt by ranges into blocks, so that no task sorts more than a few of them. Each block also
    gets a copy of the first document of the next one, which is dropped once the window has read it.
    """
    spark = docs.sparkSession
    n = blocks_per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    block, first = _blocks(docs, n)
    followers = [(first[(k + 1) % len(first)][1], first[k][0]) for k in range(len(first))]
    ends = spark.createDataFrame(followers, "doc_id long, block int")
    own = docs.select(block.cast("int").alias("block"), F.lit(0).alias("extra"), *docs.columns)
    # one row a block: the number of blocks bounds what is broadcast
    more = docs.join(F.broadcast(ends), "doc_id").select("block", F.lit(1).alias("extra"), *docs.columns)
    order = Window.partitionBy("block").orderBy("extra", "doc_id", *[c for c in columns if c == "text"])
    both = own.unionByName(more)
    for c in columns:
        both = both.withColumn(f"next_{c}", F.lead(c).over(order))
    return both.where("extra = 0").drop("block", "extra")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like it is to that and to the next document.

    The edited text has the last quarter of the code points (rounded down) replaced by the first as
    many of the next document, or all of it if it has fewer. Null texts count as empty; two texts that
    are both empty are alike to 1. Rows without a doc_id have no place in the order: an empty text
    counts as their next, and they are nobody's next. Rows that repeat an id follow each other by text.
    Texts are read whole. An empty table gives an empty result. Only doc_id and text are read.
    """
    texts = with_signature(docs.select("doc_id", text_or_empty().alias("text")), "text", "signature")
    last = texts.where("doc_id is null").withColumn("next_text", F.lit("")).withColumn("next_signature", F.array().cast("array<bigint>"))
    paired = with_next(texts.where("doc_id is not null"), ["text", "signature"]).unionByName(last)
    edited = paired.withColumn("_cut", F.floor(F.length("text") / 4).cast("int")).withColumn(
        "edited", F.concat(F.expr("left(text, length(text) - _cut)"), F.expr("left(next_text, _cut)"))
    )
    done = with_signature(edited.drop("next_text"), "edited", "edited_signature")
    return done.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("signature").alias("fingerprint"),
        fingerprint("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"),
        likeness("signature", "next_signature").alias("near_next"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))


QUERIES = {"op2_order_minhash": op2_order_minhash}
ORACLES: dict[str, str] = {}
