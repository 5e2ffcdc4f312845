import collections
import hashlib
import os
import random
import sys

import numpy as np
import pytest

from loamwork.llm import line_dedup, simhash_dedup, substring_dedup

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_lines(odd):
    expected = collections.Counter(brute.lines(texts(odd)))
    found = line_dedup.dedup_lines(odd)
    assert {"slot", "block"} < set(found.columns)
    assert collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found.collect()) == expected
    assert sum(k[2] for k in expected) > 5


def test_lines_of_texts_that_share_an_id(spark):
    shared, other = "x" * 50, "y" * 50
    rows = [(i, shared) for i in range(6)] + [(2, f"{other}\n{shared}\nend"), (2, f"only here {other}\nsecond"), (9, f"{other}\n{shared}")]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found) == collections.Counter(brute.lines(rows))
    assert (2, f"only here {other}\nsecond") in {(r["doc_id"], r["kept_text"]) for r in found}


def test_line_groups_across_partitions_and_batches():
    rng = random.Random(3)
    rows = sorted({(rng.randrange(9), 0, -rng.randrange(12), rng.randrange(3)) for _ in range(400)})
    docs = collections.defaultdict(set)
    for a, _, d, _ in rows:
        docs[a].add(-d)
    expected = sorted((-d, p) for a, _, d, p in rows if len(docs[a]) >= 5 and -d != max(docs[a]))
    for cuts in ([], [100], [3, 4, 9, 250, 251], list(range(7, 400, 7))):
        whole = [i for i in cuts if i >= len(rows) or rows[i - 1][:3] != rows[i][:3]]
        parts = [rows[a:b] for a, b in zip([0, *whole], [*whole, len(rows)], strict=True) if rows[a:b]]
        found = []
        for n, part in enumerate(parts):
            groups = line_dedup._Groups(1 << 62)
            list(groups.feed(*(np.array(c) * (1, 1, -1, 1)[k] for k, c in enumerate(zip(*part, strict=True)))))
            groups.close()
            found.append((n, *groups.first, *groups.key, groups.n))
        known = line_dedup._neighbours(found)
        got = []
        for n, part in enumerate(parts):
            groups = line_dedup._Groups(5, *known[n])
            for at in range(0, len(part), 11):
                columns = [np.array(c) * (1, 1, -1, 1)[k] for k, c in enumerate(zip(*part[at : at + 11], strict=True))]
                for d, p in groups.feed(*columns):
                    got += zip(d.tolist(), p.tolist(), strict=True)
        assert sorted(got) == expected


def test_bitmaps_are_compressed_and_partial(odd):
    maps = line_dedup.keep_bitmaps(odd).collect()
    assert maps and all(r["n_dropped"] > 0 and isinstance(r["keep"], (bytes, bytearray)) for r in maps)
    assert line_dedup.kept_text(b"a\nb\nc", None) == (b"a\nb\nc", 0)


def test_simhash_components(odd):
    found = simhash_dedup.near_duplicates(odd).collect()
    assert collections.Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in found) == collections.Counter(brute.components(texts(odd)))


@pytest.mark.parametrize("bucket", [256, 2])
def test_links_equal_all_pairs(spark, bucket):
    rng = random.Random(9)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            x = base
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x - (1 << 64) if x >> 63 else x)
    fps = sorted(fps)
    expected = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    found = [tuple(r) for r in simhash_dedup.linked_pairs(spark.createDataFrame([(f,) for f in fps], "fp long"), bucket=bucket).collect()]
    assert len(found) == len(expected) and set(found) == expected


def brute_removed(rows, width=400):
    counts = collections.Counter(t[p : p + width] for _, t in rows for p in range(len(t) - width + 1))
    out = collections.Counter()
    for doc_id, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - width + 1):
            if counts[t[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def found_removed(df, **how):
    return collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in substring_dedup.remove_repeats(df, **how).collect())


def test_substrings_of_odd_texts(odd):
    assert found_removed(odd) == brute_removed([(d, (t or "").encode()) for d, t in texts(odd)])


@pytest.mark.parametrize("crowd", [substring_dedup.CROWD, 2])
def test_substrings_of_shared_passages(spark, crowd):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    passages = [word(rng.randrange(380, 1200)) for _ in range(6)]
    rows = [(i, word(rng.randrange(0, 900)) + rng.choice(passages)[rng.randrange(0, 30) :] + word(rng.randrange(0, 300)) + rng.choice([*passages, ""]) + rng.choice(["", "ab" * 500])) for i in range(40)]
    # texts of their own under one id and under none
    rows += [(3, word(700)), (3, passages[0] + word(50)), (None, word(900)), (None, word(20) + passages[1]), (None, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found_removed(df, crowd=crowd) == brute_removed([(d, t.encode()) for d, t in rows])


def test_shared_strings_of_one_batch():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(14, 40))) for _ in range(60)] + [b"ab" * 20]
    key, entry, doc, lo, before, more, times = substring_dedup.phrases(texts, gram=2, span=5, width=10)
    assert (times * (more + 1)).sum() == sum(max(0, len(t) - 9) for t in texts) and times.max() > 1
    covers = [texts[d][p : p + m + 10] for d, p, m in zip(doc.tolist(), lo.tolist(), more.tolist())]
    single = np.array([rng.random() < 0.8 for _ in covers])
    found = {(i, p) for i, a, b in zip(*substring_dedup.shared_strings(key.tolist(), covers, before, more, single, 10)) for p in range(a, b + 1)}
    count = collections.Counter((key[i], c[p : p + 10]) for i, c in enumerate(covers) for p in range(more[i] + 1))
    assert found == {(i, p) for i, c in enumerate(covers) for p in range(more[i] + 1) if single[i] and count[key[i], c[p : p + 10]] > 1}
    assert 0 < len(found) < sum(more + 1)


def test_empty_tables(empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    assert simhash_dedup.near_duplicates(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
