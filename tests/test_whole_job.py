"""Queries answer for all of their input, long texts and near copies included."""

import collections
import difflib
import random
import re

import pytest

from loamwork import constants as C
from loamwork.functions import arrow
from loamwork.plans import registry

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def written(spark, folder, texts):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_rouge_of_long_texts(spark, tmp_path):
    texts = ["a title here\n" + "word " * n for n in (10, 497, 498, 5000)] + ["one line " * 3000, "", None]
    found = {r["record_id"]: r["rouge_l"] for r in registry.queries()["q_rouge_l"](spark, written(spark, tmp_path, texts)).collect()}
    expected = {str(i): round(2 * 3 / (6 + n), 6) for i, n in enumerate((10, 497, 498, 5000))} | {"4": 1.0, "5": 0.0, "6": 0.0}
    assert found == pytest.approx(expected)


def test_longest_common_equals_the_whole_table():
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert arrow.longest_common(a, b) == table[-1][-1]


def brute_groups(texts):
    """The least index that each text is linked to, by equal texts and by near titles of a block."""
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def title(t):
        plain = re.sub(C.TITLE_NOISE, " ", re.sub("[^a-z0-9 ]+", " ", t.split("\n")[0].lower()))
        return re.sub(" +", " ", plain).strip()

    titles = [title(t) for t in texts]
    for j, b in enumerate(titles):
        for i, a in enumerate(titles[:j]):
            same = " ".join(texts[i].lower().split()) == " ".join(texts[j].lower().split())
            block = a and b and a.split()[0][:12] == b.split()[0][:12] and len(a) // 10 == len(b) // 10
            if same or (block and difflib.SequenceMatcher(None, a, b).ratio() >= C.TITLE_THRESHOLD):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(texts))]


def test_full_queries_link_near_titles(spark, tmp_path):
    rng = random.Random(6)
    names = ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(12)]
    titles = [f"{n} grant for the study of rivers and lakes {k}" for n in names for k in ("in europe", "in Europe!", "in europa", "of the far north")]
    texts = [f"{t}\n" + "body " * rng.randrange(3, 9) + str(rng.randrange(2)) for t in titles] + [f"{titles[0]}\nx"] * 3 + ["", ""]
    rng.shuffle(texts)
    where, groups = written(spark, tmp_path, texts), brute_groups(texts)
    members = collections.defaultdict(list)
    for i, g in enumerate(groups):
        members[g].append(i)
    best = {g: min(m, key=lambda i: (-len(texts[i].split()), i % 28, i)) for g, m in members.items()}
    run = lambda name: [tuple(r) for r in registry.queries()[name](spark, where).collect()]
    sizes = [len(m) for m in members.values()]
    assert len(members) < len(set(texts)) and set(run("q_dup_histogram_full")) == set(collections.Counter(sizes).items())
    assert run("q_dedupe_summary_full") == [(len(texts), len(members), len(texts) - len(members), sum(len({i % 3 for i in m}) > 1 for m in members.values()))]
    assert set(run("q_canonical_record_full")) == {(str(best[g]), len(m)) for g, m in members.items()}
    assert set(run("q_group_evidence_full")) == {(str(best[g]), len(m), ",".join(map(str, m))) for g, m in members.items()}
    merged = [n for n in sizes if n > 1]
    assert run("q_freeze_manifest_full") == [(len(members), len({i % 3 for i in best.values()}), len(merged), sum(merged))]
    split = dict(run("q_group_split_full"))
    assert len(split) == len(texts) and all(len({split[str(i)] for i in m}) == 1 for m in members.values())
    assert set(run("q_split_counts_full")) == set(collections.Counter(split.values()).items())


def test_token_stats_of_three_variants(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = [f"title {i}\n" + " ".join(f"w{k}" for k in range(n)) for i, n in enumerate((5, 150, 250, 500, 598, 599, 3000))] + ["", None]
    found = {r["variant"]: r.asDict() for r in registry.queries()["q_token_stats"](spark, written(spark, tmp_path, texts)).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = [((t or "").split("\n")[0], t or "") for t in texts]
    cut = [f"TITLE: {a}\n\nOPPORTUNITY TEXT:\n{' '.join(b.split()[:600])}" for a, b in parts]
    variants = {"input_truncated": cut, "input_plus_target": [f"{x}\n\n{C.PROXY_TARGET}" for x in cut], "full_text": [f"TITLE: {a}\n\n{b}" for a, b in parts]}
    assert set(found) == set(variants)
    for name, shown in variants.items():
        counts = sorted(len(tokenizer.encode(x, add_special_tokens=False).ids) for x in shown)
        assert found[name]["max"] == counts[-1] and found[name]["p50"] == counts[len(counts) // 2]
        assert all(found[name][f"fit_{c}"] == pytest.approx(sum(n <= c for n in counts) / len(counts)) for c in (512, 768, 1024, 1536, 2048))


def test_cache_lookup_of_urls_with_several_responses(spark, tmp_path):
    # pages of one URL come in either order, with and without an error; some have none
    rows = [(i, f"http://a.org/{i * 7 % 150}" if i % 10 else None, f"<p>{i}</p>") for i in range(400)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7).write.parquet(f"{tmp_path}/pages.parquet")
    best = collections.defaultdict(int)
    for i, url, _ in rows:
        best[url] = max(best[url], (404 if i % 4 == 0 else 200) if i % 3 else 0)
    expected = collections.Counter({0: "not cached", 200: "-", 404: "status 404"}[s] for s in best.values())
    assert len(expected) > 1
    assert {r["error"]: r["n"] for r in registry.queries()["q_cache_lookup"](spark, str(tmp_path)).collect()} == dict(expected)


def test_token_counts_of_odd_texts_in_bounded_slices(monkeypatch):
    import pandas as pd
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(9)
    marks = ["<|endoftext|>", "  ", "\n", "\n\n", " \n ", "\t", "\x1c", "\x85", "\u3000", "'s", "''re", "é", "語", "١٢", "\U0001f600", "a" * 300, "don't", "!?", "word", "x1"]
    texts = ["".join(rng.choice(marks) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(300)] + [None, "", "w " * 200_000, "é" * 5000]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    held = []

    class Watched:
        from_file = staticmethod(lambda path: Watched())
        no_truncation = no_padding = lambda self: None

        def encode_batch_fast(self, some, **more):
            held.append((sum(map(len, some)), len(some)))
            return tokenizer.encode_batch_fast(some, **more)

    monkeypatch.setattr("tokenizers.Tokenizer", Watched)
    count = arrow.token_counter(public_tokenizers.path("byte_bpe_50k.json")).func
    assert next(count(iter([pd.Series(texts)]))).tolist() == expected
    monkeypatch.setattr(arrow, "CACHE_WORDS", 8)
    assert next(count(iter([pd.Series([*texts, *texts])]))).tolist() == expected * 2
    # many texts of a batch are never encoded together beyond a slice
    assert next(count(iter([pd.Series([f"{i} {'wq' * 5000}" for i in range(200)])]))).sum() > 0
    assert all(size <= arrow.SLICE or n == 1 for size, n in held)
