"""Signatures of texts of different lengths, and of texts without blanks, can be compared."""

import collections
import hashlib
import random
import statistics
import struct

import pytest
import regex
import xxhash

from loamwork.llm import order_minhash


@pytest.fixture(scope="module")
def likeness(spark):
    def run(pairs):
        df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
        df = order_minhash.with_signature(order_minhash.with_signature(df, "a", "sa"), "b", "sb")
        return [r["x"] for r in df.select("i", order_minhash.likeness("sa", "sb").alias("x")).orderBy("i").collect()]

    return run


def prose(rng, n):
    text = ""
    while len(text) < n:
        text += "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) + " "
    return text[:n]


def test_edits_and_copies_of_any_length(spark, likeness):
    rng = random.Random(2)
    long, bare, wide = prose(rng, 300), "".join(rng.choice("0123456789abcdef") for _ in range(400)), "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(400))
    pairs = [(long, long[:225]), (long[:250], long[:260]), (long[:60], long[:50]), (bare, bare[:300] + bare[50:150]), (bare, "7" + bare), (wide, "\u4e00" + wide[:300]), ("y" * 300, "y" * 225 + "w" * 75)]
    assert all(x > 0.4 for x in likeness(pairs))
    assert all(x < 0.1 for x in likeness([(long, prose(rng, 240)), (bare, bare[::-1]), ("", long)]))
    docs = spark.createDataFrame([(0, long), (1, ""), (2, bare), (3, None)], "doc_id long, text string")
    near = {r["doc_id"]: r["near_edited"] for r in order_minhash.fingerprint_edits(docs).collect()}
    assert near[0] > 0.4 and near[2] > 0.4 and near[1] == near[3] == 1.0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h64(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed)
    return seed


def plain_signature(text):
    """Order MinHash word by word: {bucket: hash of its two least elements in text order}."""
    pattern = order_minhash._PIECES.replace("\\\\", "\\")
    pattern = regex.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), pattern)
    pieces = [m.group(0).encode() for m in regex.finditer(pattern, text)]
    seen, buckets = collections.Counter(), collections.defaultdict(list)
    for i in range(max(len(pieces) - 1, min(1, len(pieces)))):
        element = signed(h64(*pieces[i : i + 2])) >> 24
        h = h64(struct.pack("<q", element), struct.pack("<i", seen[element]))
        seen[element] += 1
        buckets[signed(h) >> 58].append((signed(h) >> 24, i))
    out = {}
    for bucket, found in buckets.items():
        ordered = sorted(sorted(found)[:2], key=lambda x: x[1])
        out[bucket % 64] = h64(*(struct.pack("<q", h) for h, _ in ordered)) & 0xFFFFFFFF
    return out


def plain_likeness(a, b):
    used = a.keys() | b.keys()
    return sum(a.get(k) == b.get(k) for k in used) / len(used) if used else 1.0


def test_query_equals_a_plain_version(spark, odd):
    texts = [(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()] + [(40, "日本語のテキスト" * 9), (41, "Quiz Zebra x5 " * 7), (42, "\U00020000\U0001f600 ab")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    known = sorted((d, t) for d, t in texts if d is not None)
    after = [(*known[i], known[(i + 1) % len(known)][1]) for i in range(len(known))] + [(d, t, "") for d, t in texts if d is None]
    expected = collections.Counter()
    for doc_id, text, following in after:
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = map(plain_signature, (text, edited, following))
        written = lambda x: "".join(f"{k:02x}{x[k]:08x}" for k in sorted(x, key=lambda k: k if k < 32 else k - 64))
        expected[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)] += 1
    found = order_minhash.fingerprint_edits(df).collect()
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found) == expected


def test_likeness_falls_with_edit_distance(spark, likeness):
    rng = random.Random(8)
    shares, pairs = [0, 0.005, 0.02, 0.05, 0.1, 0.3], []
    for share in shares:
        for _ in range(12):
            text = prose(rng, 4000).split()
            edited = [w if rng.random() >= share else "".join(rng.choice("abcdefghij") for _ in range(5)) for w in text]
            pairs.append((" ".join(text), " ".join(edited)))
    found = likeness(pairs)
    means = [statistics.mean(found[12 * k : 12 * k + 12]) for k in range(len(shares))]
    print("likeness by share of words replaced", dict(zip(shares, [round(m, 3) for m in means], strict=True)))
    assert means[0] == 1.0 and all(a > b for a, b in zip(means, means[1:])) and means[2] > 0.8 and means[4] < 0.75
