import collections
import random
import re
import string

import pytest

from loamwork.llm import phrases

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain(rows, longest, least, top, absorbed=100):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                counts[lang or "und"].update(words[i : i + m] for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= absorbed * a and inside(p, q) for q, b in candidates.items()):
                continue
            score, _, l, r = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(13)
    vocabulary = ["the", "OF", "a", "Haus", "ä", "日本", "new", "york", "\x01x", "z\x1cq", "|", "it's", *[f"w{i}" for i in range(30)]]
    weights = [40, 30, 20, *[8] * 9, *[2] * 30]
    rows = []
    for i in range(160):
        text = "".join(rng.choices(vocabulary, weights)[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(rng.randrange(60)))
        rows.append((text + " new york city hall" * (i % 3), ["en", "de", None][i % 3]))
    return [*rows, (None, "en"), ("", "fr"), (" ,.\n", "fr"), ("the of the of the of " * 200, "en"), *[("same text here again", "es")] * 5, ("alone", "it")]


@pytest.mark.parametrize("longest,least,top,size", [(5, 4, 2000, None), (5, 4, 7, 3), (3, 2, 2000, 0), (4, 3, 50, 12)])
def test_equals_counting_all_phrases(spark, monkeypatch, longest, least, top, size):
    monkeypatch.setattr(phrases, "PARTS", 40)
    monkeypatch.setattr(phrases, "PARTITION_WORDS", 500)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "text string, lang string, n int, word string").repartition(3)
    found = phrases.collocations(df, longest, least, top, size=size)
    assert sorted(map(tuple, found.collect())) == plain(rows, longest, least, top)
    assert phrases.collocations(df.limit(0), longest, least, top).count() == 0


def test_a_share_of_occurrences_absorbs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, phrases.collocations(df, 5, 4, 2000, absorbed=60).collect())) == plain(rows, 5, 4, 2000, 60)


def test_fragments_hold_their_pivot_and_more_frequent_words():
    texts = [t.encode() for t, lang in corpus() if t and lang == "en"]
    counted = collections.Counter(w for w in phrases.words(texts) if w != b"\xff")
    order = [w for w, _ in sorted(counted.items(), key=lambda x: (-x[1], x[0]))]
    import numpy as np

    known = phrases.Lexicon({"en": {w: i for i, w in enumerate(order[:20])}}, [w.decode() for w in order[:20]], np.ones(20, np.int64), True)
    number = {phrases.code_text(i): i for i in range(20)}
    every = np.full(phrases.PAIR_BITS // 64, np.uint64(0xFFFFFFFFFFFFFFFF))
    found = phrases.fragments_of("en", texts, known, 5, every).to_pylist()
    assert found
    for row in found:
        codes = [number[t] for t in row["fragment"].split(" ")]
        pivot = codes[row["before"]]
        assert all(c < pivot for c in codes[: row["before"]]) and max(codes) == pivot and row["owner"] // (phrases.PARTS + 1) == pivot


def test_products_beyond_64_bits(spark):
    n = 9 * 10**13
    counted = spark.createDataFrame([("en", "a b", 10**12 + 7), ("en", "a", 3 * 10**12 + 1), ("en", "b", 2 * 10**12 + 3)], "lang string, phrase string, n long")
    found = phrases.scored(counted, spark.createDataFrame([("en", n)], "lang string, n long")).collect()
    assert [r["score"] for r in found] == [1000 * (10**12 + 7) * n // ((3 * 10**12 + 1) * (2 * 10**12 + 3))]
