"""Collocations: frequent phrases whose words stand together more often than chance.

Counting is by pivots, as in MG-FSM. The pivot of a phrase is its rarest word. Each occurrence of a
word is sent, with the more frequent words around it that a phrase can reach, to the partition that owns
this word; words too rare to be part of a result are gaps that end such a fragment. A partition
counts the phrases of its fragments that hold their pivot, and nothing else, so that its counts are
final. Of a pivot that has more than a 1024th of all words, fragments are dealt to several partitions
and their counts are added up.

Pairs are counted first. A longer phrase can only be as frequent as each pair in it, so that fragments
end between words that make no frequent pair. A table of bits of fixed size says which ones do; bits
that pairs share only leave fragments longer than they need be.

Words travel as short codes in order of frequency. The lexicon of codes that tasks hold is bounded; if
there are more frequent words than that, the others travel spelled out, and count as rarer than all
with a code.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamwork.llm.common import documents, runs, text_bytes
from loamwork.runtime import written

LONGEST = 5
LEAST = 100
TOP = 2000
#: A phrase goes if a longer one around it has this share of its occurrences, in percent.
ABSORBED = 100
#: What takes the place of a null language.
NO_LANG = "und"
#: Words with a code at most, all languages together; this bounds what is broadcast.
LEXICON = 1 << 17
#: Parts that the fragments of all words would be dealt to; a pivot gets as many as its share of the words.
PARTS = 1024
#: Words of the corpus for each partition of the counting, and the most partitions.
PARTITION_WORDS = 1 << 20
MOST_PARTITIONS = 1 << 15
#: Bytes of text whose words, pairs and fragments are counted together before they are sent.
WORDS_TOGETHER = 12 << 20
FRAGMENTS_TOGETHER = 4 << 20
#: Bits of the table of frequent pairs.
PAIR_BITS = 1 << 24
#: Groups that the candidates of a language are dealt to before its first ones are taken.
SALTS = 256

_CUT = b"\xff"
_FROM = string.ascii_uppercase.encode() + b".,;:!?\n\x0b\x0c\r\t"
_TO = string.ascii_lowercase.encode() + _CUT * 10 + b" "
_TABLE = bytes.maketrans(_FROM, _TO)
_DIGITS = [chr(c) for c in range(0x21, 0x7F)]
_SPELLED = "\x01"
_GAP = np.iinfo(np.int64).min


def words(texts: list[bytes]) -> list[bytes]:
    """The words of texts in lower case; a cut stands where a piece or a text ends."""
    return _CUT.join(texts).translate(_TABLE).replace(_CUT, b" \xff ").split()


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    langs, texts = batch.column("lang").to_pylist(), text_bytes(batch)
    for lang in dict.fromkeys(langs):
        yield lang, [t for t, own in zip(texts, langs, strict=True) if own == lang]


def _coded(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of texts, and the text's words as places in that list."""
    encoded = pa.array(words(texts), pa.binary()).dictionary_encode()
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, WORDS_TOGETHER):
            for lang, texts in _by_lang(batch):
                distinct, codes = _coded(texts)
                counts = np.bincount(codes, minlength=len(distinct))
                kept = [i for i, w in enumerate(distinct) if w != _CUT]
                if kept:
                    found = pa.array([distinct[i] for i in kept], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(kept), pa.string()), found, pa.array(counts[kept])], names=["lang", "word", "n"])

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Lexicon:
    """Codes of the most frequent words: `codes` by language and word, 0 the most frequent; `parts` that the fragments of each are dealt to.

    `whole` says that every word that can be part of a result has a code.
    """

    codes: dict[str, dict[bytes, int]]
    words: list[str]
    parts: np.ndarray
    whole: bool


def code_text(code: int) -> str:
    out = ""
    while True:
        out = _DIGITS[code % len(_DIGITS)] + out
        code //= len(_DIGITS)
        if not code:
            return out


def lexicon(frequent: DataFrame, total: int, size: int | None = None) -> Lexicon:
    """The `size` most frequent words of (lang, word, n), which is what comes to the driver at most."""
    size = LEXICON if size is None else size
    rows = frequent.orderBy(F.desc("n"), "lang", "word").limit(size + 1).collect()
    codes: dict[str, dict[bytes, int]] = {}
    for i, r in enumerate(rows[:size]):
        codes.setdefault(r["lang"], {})[r["word"].encode()] = i
    parts = np.array([1 + r["n"] * PARTS // max(total, 1) for r in rows[:size]] or [1], np.int64)
    return Lexicon(codes, [r["word"] for r in rows[:size]], parts, len(rows) <= size)


@dataclass(frozen=True)
class Words:
    """Texts of one language as a row of words: for each distinct word its number, rank and token; `codes` has the words' places."""

    number: np.ndarray
    rank: np.ndarray
    tokens: pa.Array
    codes: np.ndarray

    @classmethod
    def of(cls, lang: str, texts: list[bytes], known: Lexicon) -> Words:
        distinct, codes = _coded(texts)
        own, size = known.codes.get(lang, {}), len(known.words)
        number = np.array([own.get(w, -1) for w in distinct], np.int64)
        # the more frequent a word, the higher its rank; words without a code follow in the order of their bytes
        rank = np.where(number >= 0, size - number, _GAP)
        if not known.whole:
            spelled = [i for i, w in enumerate(distinct) if number[i] < 0 and w != _CUT]
            for place, i in enumerate(sorted(spelled, key=distinct.__getitem__)):
                rank[i] = -1 - place
                number[i] = size + zlib.crc32(distinct[i])
        tokens = pa.array([code_text(c) if 0 <= c < size else _SPELLED + w.decode() if c >= 0 else None for c, w in zip(number.tolist(), distinct, strict=True)], pa.string())
        return cls(number, rank, tokens, codes)


def _owners(pivot: np.ndarray, mixed: np.ndarray, known: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """The partition key of each pivot, and whether the pivot has several, among which `mixed` chooses."""
    parts = known.parts[np.minimum(pivot, len(known.parts) - 1)]
    parts[pivot >= len(known.words)] = 1
    return pivot * (PARTS + 1) + ((mixed >> np.uint64(20)) % parts.astype(np.uint64)).astype(np.int64), parts > 1


def _mixed(*numbers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(numbers[0]), np.uint64)
    for x in numbers:
        out = (out ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def pairs_of(lang: str, texts: list[bytes], known: Lexicon) -> pa.Table:
    """(owner, split, lang, phrase, times) of the pairs of texts in one language, equal ones counted."""
    words_ = Words.of(lang, texts, known)
    codes, far = words_.codes, len(words_.number)
    open_ = words_.rank[codes] > _GAP
    both = np.flatnonzero(open_[:-1] & open_[1:])
    pairs, times = np.unique(codes[both] * far + codes[both + 1], return_counts=True)
    first, second = pairs // max(far, 1), pairs % max(far, 1)
    pivot = words_.number[np.where(words_.rank[second] < words_.rank[first], second, first)]
    owner, split = _owners(pivot, _mixed(words_.number[first], words_.number[second]), known)
    phrase = pc.binary_join_element_wise(words_.tokens.take(pa.array(first)), words_.tokens.take(pa.array(second)), " ")
    return pa.table({"owner": owner, "split": split, "lang": pa.array([lang] * len(pairs), pa.string()), "phrase": phrase, "times": times})


def _windows(rank: np.ndarray, linked: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words in a row, up to `reach`, are linked to and more frequent than each word: before it, and (or the same word) after it."""
    n = len(rank)
    none = np.zeros(reach, bool)
    padded = np.concatenate([np.full(reach, _GAP), rank, np.full(reach, _GAP)])
    chain = np.concatenate([none, linked, none])  # whether a word is linked to the next, from the first gap on
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    left = right = np.ones(n, bool)
    for k in range(1, reach + 1):
        left = left & chain[reach - k : reach - k + n] & (padded[reach - k : reach - k + n] > rank)
        right = right & chain[reach + k - 1 : reach + k - 1 + n] & (padded[reach + k : reach + k + n] >= rank)
        before += left
        after += right
    return before, after


def fragments_of(lang: str, texts: list[bytes], known: Lexicon, longest: int, bits: np.ndarray) -> pa.Table:
    """(owner, split, lang, before, fragment, times) of texts in one language, equal ones counted.

    `before` words of the fragment precede its pivot. Of equal pivots in a phrase the first one counts,
    which is why only the words after a pivot may be the pivot again. Fragments of two words are left out.
    """
    words_ = Words.of(lang, texts, known)
    codes, number = words_.codes, words_.number
    rank = words_.rank[codes]
    linked = np.zeros(len(codes), bool)
    both = np.flatnonzero((rank[:-1] > _GAP) & (rank[1:] > _GAP))
    linked[both] = has_bit(bits, number[codes[both]], number[codes[both + 1]])
    reach = longest - 1
    before, after = _windows(rank, linked, reach)
    at = np.flatnonzero((rank > _GAP) & (before + after > 1))
    before, after = before[at], after[at]
    columns, mixed = [], []
    for k in range(-reach, reach + 1):
        outside = (k < -before) | (k > after)
        where = codes[np.clip(at + k, 0, len(codes) - 1)]
        columns.append(words_.tokens.take(pa.array(where, mask=outside)))
        mixed.append(np.where(outside, 0, number[where] + 1))
    owner, split = _owners(number[codes[at]], _mixed(*mixed), known)
    table = pa.table({"owner": owner, "split": split, "before": before.astype(np.int8), "fragment": pc.binary_join_element_wise(*columns, " ", null_handling="skip")})
    counted = table.group_by(["owner", "split", "before", "fragment"]).aggregate([([], "count_all")])
    return counted.rename_columns({"count_all": "times"}).append_column("lang", pa.array([lang] * len(counted), pa.string()))


def _slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (_mixed(first, second) >> np.uint64(24)) % np.uint64(PAIR_BITS)


def has_bit(bits: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether the pairs of two words' numbers have their bit set."""
    slots = _slots(first, second)
    return (bits[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def pair_bits(pairs: DataFrame, known: Lexicon) -> np.ndarray:
    """The table of bits of (lang, phrase), pairs of tokens; at most PAIR_BITS / 64 rows come to the driver."""
    sent = pairs.sparkSession.sparkContext.broadcast({code_text(i): i for i in range(len(known.words))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for batch in batches:
            tokens = [t for p in batch.column("phrase").to_pylist() for t in p.split(" ")]
            numbers = np.array([number[t] if t[0] != _SPELLED else len(number) + zlib.crc32(t[1:].encode()) for t in tokens], np.int64)
            slots = _slots(numbers[::2], numbers[1::2])
            bit = np.left_shift(np.uint64(1), slots & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(6)).astype(np.int32)), pa.array(bit)], names=["place", "bits"])

    rows = pairs.select("phrase").mapInArrow(run, "place int, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(PAIR_BITS // 64, np.uint64)
    bits[rows.column("place").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return bits


_FRAGMENT = "owner long, split boolean, lang string, before byte, fragment string, times long"


_PAIR = "owner long, split boolean, lang string, phrase string, times long"


def _mined(docs: DataFrame, schema: str, together: int, find: Callable[[str, list[bytes]], pa.Table]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in schema.split(", ")]
        for batch in runs(batches, together):
            for lang, texts in _by_lang(batch):
                yield from find(lang, texts).select(names).to_batches()

    return docs.mapInArrow(run, schema)


def owned(shortest: int, longest: int) -> Column:
    """The phrases of `parts` that hold their pivot, from `shortest` words to `longest`."""
    parts, before = F.col("parts"), F.col("before")
    after = F.size(parts) - before - 1
    spans = [(a, b) for a in range(longest) for b in range(longest - a) if a + b + 1 >= shortest]
    return F.array(*[F.when((before >= a) & (after >= b), F.array_join(F.slice(parts, before - a + 1, F.lit(a + b + 1)), " ")) for a, b in spans])


def _counted(mined: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of what occurs `least` times; only the counts of divided pivots meet again."""
    local = mined.groupBy("owner", "split", "lang", "phrase").agg(F.sum("times").alias("n")).where(F.col("split") | (F.col("n") >= least))
    return local.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def frequent_phrases(docs: DataFrame, known: Lexicon, total: int, longest: int, least: int) -> DataFrame:
    """(lang, phrase, n) of the phrases of two words and more that occur `least` times."""
    context = docs.sparkSession.sparkContext
    partitions = max(1, min(MOST_PARTITIONS, total // PARTITION_WORDS))
    sent = context.broadcast(known)
    pairs = _mined(docs, _PAIR, WORDS_TOGETHER, lambda lang, texts: pairs_of(lang, texts, sent.value)).repartition(partitions, "owner")
    found = _counted(pairs, least)
    if longest > 2:
        found = written(found)
        bits = context.broadcast(pair_bits(found, known))
        dealt = _mined(docs, _FRAGMENT, FRAGMENTS_TOGETHER, lambda lang, texts: fragments_of(lang, texts, sent.value, longest, bits.value)).repartition(partitions, "owner")
        same = dealt.groupBy("owner", "split", "lang", "before", "fragment").agg(F.sum("times").alias("times"))
        cut = same.withColumn("parts", F.split("fragment", " "))
        found = found.unionByName(_counted(cut.select("owner", "split", "lang", "times", F.explode(owned(3, longest)).alias("phrase")).where(F.col("phrase").isNotNull()), least))
    words_ = context.broadcast({code_text(i): w for i, w in enumerate(known.words)})

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = words_.value
        for batch in batches:
            texts = [" ".join(t[1:] if t.startswith(_SPELLED) else word[t] for t in p.split(" ")) for p in batch.column("phrase").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(texts, pa.string()), batch.column("n")], names=["lang", "phrase", "n"])

    return found.mapInArrow(spelled, "lang string, phrase string, n long")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more in (lang, phrase, n), at their lowest cut.

    `totals` has (lang, n), the words of each language. Products have up to 38 digits.
    """
    size = F.size("parts")
    join = lambda first, length: F.array_join(F.slice("parts", first, length), " ")
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(k.alias("k"), join(F.lit(1), k).alias("first"), join(k + 1, size - k).alias("rest")))
    candidates = phrases.where(F.col("phrase").contains(" ")).select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("parts"))
    parted = candidates.select("lang", "phrase", "a", F.inline(cuts))
    whole = lambda part, n: phrases.select("lang", F.col("phrase").alias(part), F.col("n").alias(n))
    joined = parted.join(whole("first", "l"), ["lang", "first"]).join(whole("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    joined = joined.withColumn("above", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).withColumn("below", wide("l") * wide("r"))
    lowest = joined.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("at"))
    return lowest.select("lang", "phrase", "a", "at.l", "at.r", "n", "at.score")


def not_absorbed(candidates: DataFrame, percent: int) -> DataFrame:
    """Phrases without a longer one around them that has `percent` of their occurrences.

    A phrase occurs at least as often as a longer one around it, so that it is enough to look at those
    with one word more.
    """
    parts = F.split("phrase", " ")
    shorter = F.array(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), " "), F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 1), " "))
    longer = candidates.select("lang", F.explode(shorter).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    joined = candidates.join(longer, ["lang", "phrase"], "left")
    return joined.where(100 * F.coalesce("around", F.lit(0)) < percent * F.col("a")).drop("around")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, absorbed: int = ABSORBED, size: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), the first `top` phrases of each language.

    Null texts count as empty, null languages as "und"; repeated rows count as often as they stand.
    Texts of any length are read whole, and no phrase crosses the end of a piece or text. Columns other
    than text and lang are not read. A language without a phrase that occurs `least` times, and an empty
    table, give no rows. A phrase of several words equals another if the words do; ties of a score are
    broken by occurrences, then by the bytes of the phrase.
    """
    docs = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    counts = written(word_counts(docs))
    totals = written(counts.groupBy("lang").agg(F.sum("n").alias("n")))
    total = totals.agg(F.sum("n")).first()[0] or 0
    frequent = counts.where(F.col("n") >= least)
    known = lexicon(frequent, total, size)
    several = frequent_phrases(docs, known, total, longest, least)
    phrases = written(frequent.select("lang", F.col("word").alias("phrase"), "n").unionByName(several))
    kept = not_absorbed(scored(phrases, totals), absorbed)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the first ones of each salt hold the first ones of the whole
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


QUERIES = {"op13_collocations": op13_collocations}
ORACLES = {
    "op13_collocations": rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase FROM pieces, range(1, {LONGEST + 1}) AS g(m)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS w FROM f, range(1, {LONGEST}) AS g(k) WHERE k < m),
scores AS (
  SELECT c.lang, c.phrase, c.a, min({{'score': CAST(1000 * CAST(c.a AS HUGEINT) * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT), 'k': k, 'l': x.a, 'r': y.a}}) AS best, n
  FROM cuts AS c JOIN total USING (lang) JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ') JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  GROUP BY c.lang, c.phrase, c.a, n),
inner_parts AS (
  SELECT f.lang, f.a, array_to_string(string_split(f.phrase, ' ')[i:i + j - 1], ' ') AS phrase FROM f, range(1, {LONGEST}) AS g(i), range(2, {LONGEST}) AS h(j) WHERE j < m AND i + j - 1 <= m),
around AS (SELECT lang, phrase, max(a) AS a FROM inner_parts GROUP BY ALL),
ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY best.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, best.l AS l, best.r AS r, n, best.score AS score
  FROM scores AS s LEFT JOIN around AS o ON o.lang = s.lang AND o.phrase = s.phrase WHERE 100 * coalesce(o.a, 0) < {ABSORBED} * s.a)
SELECT * FROM ranked WHERE rank <= {TOP}"""
}
