import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from loamwork.llm import bpe, packing

ALPHABET = " \t\n\r\x0b\x1c\x85\xa0 　" "aaabbeEthingTHEéñ0129²½一二日本🙂'’.,!?<|>endoftext\x00"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def samples():
    rng = random.Random(6)
    found = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(4000)]
    return [*found, "", "<|endoftext|>" * 2 + " x", "don't we'll I'VE 's", "a" * 3000, " " * 5000 + "b", "xq" * 900]


def test_ids_equal_the_librarys(library):
    texts = samples()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    own = bpe.Bpe(bpe.default_vocabulary())
    assert list(own.encode(texts)) == expected
    assert list(bpe.compiled(bpe.default_vocabulary()).encode(texts)) == expected
    assert [own.decode(i) for i in expected] == [library.decode(i, skip_special_tokens=False) for i in expected]


def test_all_ways_to_merge_agree(monkeypatch):
    own = bpe.load(bpe.default_vocabulary())
    words = [w for t in samples()[:300] for w in own._words(t)]
    slow = [own._merged(w.encode()) for w in words]
    monkeypatch.setattr(bpe, "LONG_WORD", 1)
    assert [own._merged(w.encode()) for w in words] == slow
    own.learn(words)
    assert [own._known[w] for w in words] == slow


def test_round_trip_of_odd_texts(odd, library):
    found = bpe.round_trip(odd).collect()
    rows = odd.select("doc_id", "text").collect()
    expected = collections.Counter((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in rows)
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in found) == expected
    ids = bpe.encode_documents(odd)
    assert "slot" in ids.columns and all(bpe.load(bpe.default_vocabulary()).decode(r["ids"]) == (r["text"] or "") for r in ids.collect())


def checked_plan(counts, capacity):
    segments, n = packing.plan(dict(counts), capacity)
    sequences, ranks = collections.defaultdict(list), collections.defaultdict(list)
    for size, rank, times, first, offset in segments:
        for i in range(times):
            sequences[first + i].append((offset, size))
            ranks[size].append(rank + i)
    assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(c)) for s, c in counts.items() if c}
    assert sorted(sequences) == list(range(n))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= capacity
    return n


def optimum(items, capacity):
    best = [len(items)]

    def go(rest, bins):
        if len(bins) >= best[0]:
            return
        if not rest:
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + rest[0] <= capacity}.values():
            go(rest[1:], [*bins[:k], bins[k] + rest[0], *bins[k + 1 :]])
        go(rest[1:], [*bins, rest[0]])

    go(sorted(items, reverse=True), [])
    return best[0]


def test_plans_are_sound_and_reduction_keeps_the_optimum():
    rng = random.Random(8)
    for _ in range(400):
        capacity = rng.choice([7, 10, 20, 31])
        items = [rng.randint(1, capacity) for _ in range(rng.randrange(10))]
        counts, best = collections.Counter(items), optimum(items, capacity)
        assert best <= checked_plan(counts, capacity) <= best + 1
        left = dict(counts)
        fixed = packing.reduce_dominated(left, capacity)
        assert sum(t for _, t in fixed) + optimum([s for s, c in left.items() for _ in range(c)], capacity) == best
    many = collections.Counter(min(1024, max(1, int(rng.lognormvariate(6.3, 0.9)))) for _ in range(20000))
    assert checked_plan(many, 1024) <= 1.01 * sum(s * c for s, c in many.items()) / 1024


def test_packing_of_odd_texts(odd, empty, library):
    rows = odd.select("doc_id", "text").collect()
    found = packing.pack(odd).collect()
    whole = collections.Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids + [2])) for r in rows)
    expected = collections.Counter()
    for (doc_id, ids), times in whole.items():
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += times
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(r["length"] for r in found) // 1024) + 1
    assert packing.pack(empty).count() == 0
