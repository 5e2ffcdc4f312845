"""Substring dedup: bytes of long strings that stand anywhere else in the corpus, by prefix-free parsing.

A rolling hash over short grams triggers the parse: a position p belongs to the least gram of the first
SPAN grams of its string (the 400 bytes that start at p). The run of positions with one trigger is a
phrase; with the bytes that their strings cover it is an entry of the dictionary. Where a phrase
starts and ends, and which trigger it has, follows from the strings' own bytes, so that equal strings
meet under equal triggers wherever they stand. Every such string holds the bytes from its trigger to
FOLLOW bytes after it, hence phrases whose trigger is followed by bytes that no other trigger has are
unique, and are dropped first.

The rest makes a dictionary of distinct phrases with their number of occurrences. In highly repetitive
text it is small: a phrase that occurs twice or more is wholly repeated, whatever the corpus holds of
it, and only one occurrence of each distinct phrase is looked at again. The entries under one trigger
are put into suffix order twice, by their bytes from the trigger on and by those before it read
backwards, with the longest common prefixes of neighbours. A string is d bytes before its trigger and
WIDTH - d from there on, so two entries share it if they lie in one run of each order with common
prefixes of at least these lengths. Bytes are compared, not hashes. The parse carries what is found
back to the corpus.

A trigger with over CROWD entries is not sorted in one task: the strings of its entries are grouped by
128-bit hashes instead, which deals them over tasks and gives the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.common import documents, runs, text_bytes, text_hash
from loamwork.runtime import written

WIDTH = 400
GRAM = 16
SPAN = 256
FOLLOW = WIDTH - (SPAN - 1)

#: Bits of the filter that keeps texts without a repeat out of shuffles; a 64th of them are rows that are broadcast.
SLOTS = 1 << 22
#: Entries of one trigger that a task sorts at most.
CROWD = 8192
#: Bytes of text, and of entries, that a task looks at together.
BATCH = 1 << 19
ENTRIES = 1 << 20

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BASE = int(_rng.integers(1 << 61, 1 << 63)) | 1
_TABLE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PHRASE = "key long, entry long, doc_id long, tid long, lo int, before short, more short, times int"
_WANTED = "key long, single boolean, crowded boolean, lo int, before short, more short"


class Rolling:
    """Hashes of the grams of a buffer from running sums of weighted bytes, modulo 2^64.

    They only choose triggers: grams that share a hash make longer or shorter phrases, no other result.
    """

    _powers: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def _table(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls._powers is None or len(cls._powers[0]) < n:
            size = max(n, 1 << 16)
            cls._powers = tuple(np.cumprod(np.r_[_U(1), np.full(size - 1, _U(b), np.uint64)]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return cls._powers

    @classmethod
    def grams(cls, data: np.ndarray, width: int) -> np.ndarray:
        n = len(data)
        powers, inverse = cls._table(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * powers[:n], out=sums[1:])
        h = (sums[width:] - sums[:-width]) * inverse[: n + 1 - width]
        h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
        return h ^ (h >> _U(29))


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` successive values, by minima from both ends of blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1 : width - 1 + n])


def phrases(texts: list[bytes], gram: int = GRAM, span: int = SPAN, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(key, entry, text number, first position, positions before the trigger, positions after the first, times) of each phrase.

    key is the hash of what follows the trigger in all its strings, entry that of the phrase with all
    bytes that its strings cover. A phrase that follows itself, as in periodic text, comes once with
    the number of times.
    """
    follow = width - (span - 1)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    count = np.maximum(ends - starts - width + 1, 0)
    if not count.sum():
        return (np.zeros(0, np.int64),) * 7
    whole = b"".join(texts)
    data = np.frombuffer(whole, np.uint8)
    at = np.arange(len(data) - gram + 1, dtype=np.uint64)
    # the last of equal grams wins, which two equal strings agree on
    ranked = Rolling.grams(data, gram) & _U(0xFFFFFFFF00000000) | (_U(0xFFFFFFFF) - at)
    trigger = (_U(0xFFFFFFFF) - (least_in_windows(ranked, span) & _U(0xFFFFFFFF))).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + starts[owner]
    own = trigger[place]
    first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[first[1:], len(own)] - 1
    lo, hi, a, doc = place[first], place[last], own[first], owner[first]
    key = [xxhash.xxh3_64_intdigest(whole[x : x + follow]) for x in a.tolist()]
    shape = ((a - lo) << 16 | (hi - lo)).tolist()
    entry = [xxhash.xxh3_64_intdigest(whole[x : y + width], s) for x, y, s in zip(lo.tolist(), hi.tolist(), shape, strict=True)]
    columns = np.array(key, np.uint64).view(np.int64), np.array(entry, np.uint64).view(np.int64), doc, lo - starts[doc], a - lo, hi - lo
    fresh = np.flatnonzero(np.r_[True, (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]) | (doc[1:] != doc[:-1])])
    return *(c[fresh] for c in columns), np.diff(np.r_[fresh, len(doc)])


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, tid, text): a row is known by its id and its text's hash, so that texts that share an id stay apart."""
    return docs.select("doc_id", text_hash().alias("tid"), "text")


def parse(docs: DataFrame) -> DataFrame:
    """(key, entry, doc_id, tid, lo, before, more, times) of all phrases of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, BATCH):
            key, entry, doc, lo, before, more, times = phrases(text_bytes(batch))
            ids, tids = (batch.column(c).take(pa.array(doc)) for c in ("doc_id", "tid"))
            columns = [pa.array(key), pa.array(entry), ids, tids, *(pa.array(c.astype(t)) for c, t in ((lo, np.int32), (before, np.int16), (more, np.int16), (times, np.int32)))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "entry", "doc_id", "tid", "lo", "before", "more", "times"])

    return _texts(docs).mapInArrow(run, _PHRASE)


def _marked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """`texts` with `seen`: false only if no row of `wanted` has the row's id and text. A filter of fixed size tells."""
    slot = F.pmod(F.xxhash64("doc_id", "tid"), F.lit(SLOTS))
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(F.lit(63).cast("long")).cast("int")
    words = wanted.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    held = texts.join(F.broadcast(words), word == F.col("_word"), "left")
    return held.withColumn("seen", F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False))).drop("_word", "_bits")


def _with(texts: DataFrame, by_row: DataFrame, column: str, how: str) -> DataFrame:
    on = texts["doc_id"].eqNullSafe(by_row["doc_id"]) & (texts["tid"] == by_row["tid"])
    return texts.join(by_row, on, how).select(texts["doc_id"], texts["tid"], "text", column)


def _covers(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` with the bytes that the strings of each phrase cover."""
    by_row = wanted.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("key", "single", "crowded", "lo", "before", "more")).alias("phrases"))
    texts = _marked(_texts(docs), wanted).where("seen").drop("seen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, BATCH):
            found = batch.column("phrases")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            flat = found.flatten()
            texts = text_bytes(batch)
            cover = [texts[i][lo : lo + more + WIDTH] for i, lo, more in zip(owner.tolist(), flat.field("lo").to_pylist(), flat.field("more").to_pylist(), strict=True)]
            ids, tids = (batch.column(c).take(pa.array(owner)) for c in ("doc_id", "tid"))
            names = ["key", "single", "crowded", "lo", "before", "more"]
            yield pa.RecordBatch.from_arrays([*[flat.field(c) for c in names], ids, tids, pa.array(cover, pa.binary())], names=[*names, "doc_id", "tid", "cover"])

    return _with(texts, by_row, "phrases", "inner").mapInArrow(run, f"{_WANTED}, doc_id long, tid long, cover binary")


def _classes(keys: list[int], parts: list[bytes], depths: np.ndarray) -> np.ndarray:
    """For each part and depth the number of its class: those under one key that agree in so many first bytes.

    Parts are put into suffix order under their key; a class is a run whose neighbours' common prefixes reach the depth.
    """
    order = sorted(range(len(parts)), key=lambda i: (keys[i], parts[i]))
    size = max(1, max(map(len, parts)))
    rows = np.frombuffer(b"".join(parts[i].ljust(size, b"\0") for i in order), np.uint8).reshape(-1, size)
    lengths = np.array([len(parts[i]) for i in order])
    differs = rows[1:] != rows[:-1]
    common = np.minimum(np.where(differs.any(1), differs.argmax(1), size), np.minimum(lengths[1:], lengths[:-1]))
    held = np.array([keys[i] for i in order])
    common[held[1:] != held[:-1]] = -1
    found = np.zeros((len(parts), len(depths)), np.int32)
    np.cumsum(common[:, None] < depths[None, :], axis=0, dtype=np.int32, out=found[1:])
    ordered = np.empty_like(found)
    ordered[order] = found
    return ordered


def shared_strings(keys: list[int], covers: list[bytes], before: np.ndarray, more: np.ndarray, single: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the entry, first, last) of each run of strings of single entries that another string equals.

    first and last count positions from the start of the entry.
    """
    depths = np.arange(int((before - more).min()), int(before.max()) + 1)
    left = _classes(keys, [c[:b][::-1] for c, b in zip(covers, before.tolist(), strict=True)], depths)
    right = _classes(keys, [c[b:] for c, b in zip(covers, before.tolist(), strict=True)], width - depths)
    inside = (depths <= before[:, None]) & (depths >= (before - more)[:, None])
    codes = (left[inside].astype(np.int64) << 36) | (right[inside].astype(np.int64) << 12) | np.broadcast_to(np.arange(len(depths)), inside.shape)[inside]
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    twice = np.zeros(len(codes), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    hit = np.zeros((len(covers), len(depths) + 2), bool)
    hit[:, 1:-1][inside] = twice
    hit[~single] = False
    # depths fall as positions rise
    edge = np.diff(hit.astype(np.int8), axis=1)
    entry, high = np.nonzero(edge == -1)
    _, low = np.nonzero(edge == 1)
    return entry, before[entry] - depths[high - 1], before[entry] - depths[low]


def _sorted_spans(covers: DataFrame) -> DataFrame:
    """(doc_id, tid, start, stop) from the entries of triggers that are not crowded, in suffix order."""
    names = ["key", "single", "lo", "before", "more", "doc_id", "tid", "cover"]

    def spans(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        before, more, single, lo = (table.column(c).to_numpy() for c in ("before", "more", "single", "lo"))
        entry, first, last = shared_strings(table.column("key").to_pylist(), table.column("cover").to_pylist(), before.astype(np.int64), more.astype(np.int64), single)
        ids, tids = (table.column(c).combine_chunks().take(pa.array(entry)) for c in ("doc_id", "tid"))
        start = lo[entry].astype(np.int64)
        return pa.RecordBatch.from_arrays([ids, tids, pa.array(start + first), pa.array(start + last + WIDTH)], names=["doc_id", "tid", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in runs(batches, ENTRIES, "cover"):
            key = batch.column("key").to_numpy()
            if size >= ENTRIES:
                # all whose key cannot come again; a key has at most CROWD entries
                fresh = np.flatnonzero(key != held[-1].column("key")[-1].as_py())
                if len(fresh):
                    yield spans([*held, batch.slice(0, int(fresh[0]))])
                    held, size, batch = [], 0, batch.slice(int(fresh[0]))
            held.append(batch)
            size += batch.column("cover").nbytes
        if held:
            yield spans(held)

    usual = covers.where("not crowded").select(*names)
    return usual.repartition("key").sortWithinPartitions("key").mapInArrow(run, "doc_id long, tid long, start long, stop long")


def _hashed_spans(covers: DataFrame) -> DataFrame:
    """The same from the entries of crowded triggers, by hashes of their strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, BATCH >> 3, "cover"):
            more = batch.column("more").to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), more + 1)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(more + 1) - (more + 1), more + 1)
            digests = b"".join(xxhash.xxh3_128_digest(c[k : k + WIDTH]) for c, m in zip(batch.column("cover").to_pylist(), more.tolist(), strict=True) for k in range(m + 1))
            halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
            single, ids, tids = (batch.column(c).take(pa.array(owner)) for c in ("single", "doc_id", "tid"))
            start = batch.column("lo").to_numpy().astype(np.int64)[owner] + offset
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), single, ids, tids, pa.array(start)], names=["h1", "h2", "single", "doc_id", "tid", "start"])

    each = covers.where("crowded").select("single", "lo", "more", "doc_id", "tid", "cover").mapInArrow(run, "h1 long, h2 long, single boolean, doc_id long, tid long, start long")
    twice = each.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    return each.where("single").join(twice, ["h1", "h2"], "left_semi").select("doc_id", "tid", "start", (F.col("start") + WIDTH).alias("stop"))


def repeated_spans(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, tid, start, stop), which may overlap: every byte that goes lies in one, and no other byte does."""
    parsed = written(parse(docs))
    # written first, so that the join below has nothing but joins above its exchanges and may be split at a hot key
    shared = written(parsed.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key"))
    rows = written(parsed.join(shared, "key", "left_semi"))
    # any one occurrence will do, as entries that have several are settled
    one = [F.first(c).alias(c) for c in ("doc_id", "tid", "lo", "before", "more")]
    entries = written(rows.groupBy("key", "entry").agg(F.sum("times").alias("n"), *one))
    whole = rows.join(entries.where("n > 1").select("key", "entry"), ["key", "entry"], "left_semi")
    first = F.col("lo").cast("long")
    whole = whole.select("doc_id", "tid", first.alias("start"), (first + F.col("times") * (F.col("more") + 1) - 1 + WIDTH).alias("stop"))
    # keys with one entry are settled; the others' entries are compared
    open_keys = entries.groupBy("key").agg(F.count("*").alias("entries"), F.min("n").alias("least")).where("entries > 1 AND least = 1").select("key", (F.col("entries") > crowd).alias("crowded"))
    wanted = written(entries.join(open_keys, "key").select("key", (F.col("n") == 1).alias("single"), "crowded", "doc_id", "tid", "lo", "before", "more"))
    covers = written(_covers(docs, wanted))
    return whole.unionByName(_sorted_spans(covers)).unionByName(_hashed_spans(covers))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans; touching ones are one."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _merged_by_row(spans: DataFrame) -> DataFrame:
    """(doc_id, tid, spans): each row's spans as maximal runs; a row has fewer than it has bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            runs_of = [[{"start": a, "stop": b} for a, b in merged([(s["start"], s["stop"]) for s in found])] for found in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tid"), pa.array(runs_of, kind)], names=["doc_id", "tid", "spans"])

    # a set, so that rows that stand many times over bring their spans once a task
    by_row = spans.groupBy("doc_id", "tid").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return by_row.mapInArrow(run, "doc_id long, tid long, spans array<struct<start:bigint,stop:bigint>>")


def remove_repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each document's bytes without those of repeated strings.

    Null texts count as empty. What is left may not be valid UTF-8. Every row is a document of its own,
    whatever its doc_id: rows that repeat one, or have none, lose what their own text shares with any
    other row, so that equal rows lose all strings. Strings never cross documents, texts of any length
    are parsed whole, and an empty table gives an empty result. Only doc_id and text are read.
    """
    by_row = written(_merged_by_row(repeated_spans(docs, crowd)))
    texts = _marked(_texts(docs), by_row)
    # only rows that may have a span are brought together with theirs
    clean = texts.where("not seen").drop("seen").withColumn("spans", F.lit(None).cast("array<struct<start:bigint,stop:bigint>>"))
    joined = _with(texts.where("seen").drop("seen"), by_row, "spans", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            rows: list[tuple] = []
            for doc_id, text, found in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), batch.column("spans").to_pylist(), strict=True):
                edges = [0, *(x for s in found or () for x in (s["start"], s["stop"])), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((doc_id, len(text), len(text) - len(kept), len(found or ()), kept))
            kinds = [*[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return clean.unionByName(joined).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op5_substring_dedup": op5_substring_dedup}
ORACLES: dict[str, str] = {}
