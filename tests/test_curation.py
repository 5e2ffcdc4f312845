import difflib
import itertools
import random

from pyspark.sql import functions as F

from loamwork.functions import arrow
from loamwork.operators import curation, inventory, labels, pick
from loamwork.operators.components import connected_components

SCHEMA = "seq long, record_id string, source_id string, title string, clean_text string, content_hash string, canonical_url string, published_at string"


def record(i, source="a", title=None, words=5, digest=None, published="2026-01-01"):
    return (i, f"r{i}", source, title or f"title number {i} of its own {i * 7919}", "w " * words, digest or f"h{i}", f"u{i}", published)


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(50)] + [(1, 1)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    assert found == {n: find(n) for n in list(parent)}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_by_hash_and_title(spark):
    rows = [record(0, digest="x"), record(1, "b", digest="x"), record(2, title="Erasmus master grants 20"), record(3, title="Erasmus master grants 20!"), record(4, title="Erasmus master grant 21")]
    grouped = curation.duplicate_groups(spark.createDataFrame(rows, SCHEMA))
    found = {r["seq"]: (r["group_id"], r["group_size"]) for r in grouped.collect()}
    assert found[0] == (0, 2) and found[1] == (0, 2) and found[2] == found[3] and found[2][0] == 2 and found[4][1] == 3


def test_canonical_is_longest_then_earliest_then_first(spark):
    rows = [record(0, words=50, digest="x"), record(1, words=120, digest="x"), record(2, words=120, digest="x", published="2025-01-01"), record(3, words=120, digest="x", published=""), record(4, words=120, digest="x", published="2025-01-01")]
    grouped = curation.duplicate_groups(spark.createDataFrame(rows, SCHEMA), titles=False)
    assert [r["seq"] for r in grouped.where("is_canonical").collect()] == [2]
    assert curation.dedupe_summary(grouped).first().asDict() == {"records": 5, "groups": 1, "removed": 4, "cross_source": 0}


def test_normalize_outcomes(spark):
    english = "the students of this programme will apply for a deadline " * 6
    rows = [record(0)[:4] + (english,) + record(0)[5:], record(1)[:4] + ("too short " * 5,) + record(1)[5:], record(2)[:4] + ("wort " * 60,) + record(2)[5:], record(3)[:4] + (None,) + record(3)[5:]]
    found = {r["seq"]: r["outcome"] for r in curation.classify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {0: "kept", 1: "short", 2: "other_language", 3: "short"}


def test_splits_keep_groups_together(spark):
    rows = [(f"r{i}", f"src_{i % 3}", i if i != 99 else 0) for i in range(100)]
    split = labels.assign_splits(spark.createDataFrame(rows, "record_id string, source_id string, group_id long"), "classify")
    found = {r["record_id"]: r["split"] for r in split.collect()}
    assert len(found) == 100 and found["r0"] == found["r99"]
    held = [r["source_id"] for r in labels.held_out_sources(split, "classify").where("held_out").collect()]
    assert all((found[f"r{i}"] == "unseen_sources_test") == (f"src_{i % 3}" in held) for i in range(1, 99))


def test_held_out_sources_have_their_published_ranks(spark):
    known = spark.createDataFrame([("opportunity_desk",), ("paset_rsif",), ("scholars4dev",), ("euraxess",)], "source_id string")
    for task, expected in (("classify", {"paset_rsif", "scholars4dev"}), ("summarize", {"opportunity_desk"})):
        assert {r["source_id"] for r in labels.held_out_sources(known, task).where("held_out").collect()} == expected


def test_stratified_round_robin(spark):
    rows = [(i, f"r{i}", "Scholarship" if i < 10 else "Other") for i in range(30)]
    picked = curation.stratified(spark.createDataFrame(rows, "seq long, record_id string, title string"), 12).collect()
    assert sum(r["title"] == "Scholarship" for r in picked) == 6 and len(picked) == 12


def test_percentiles_by_nearest_rank(spark):
    found = curation.length_summary(spark.range(10).withColumnRenamed("id", "v"), "v", [4]).first()
    assert (found["p50"], found["p90"], found["max"], found["fit_4"]) == (5, 9, 9, 0.5)


def test_pickers_break_ties_by_sequence(spark):
    log = spark.createDataFrame([(0, "a", "x", ""), (1, "a", "x", ""), (2, "a", None, "y"), (3, "b", "", "z")], "seq long, k string, s1 string, s2 string")
    assert {r["k"]: r["seq"] for r in pick.latest(log, "k", ["s1", "s2"]).collect()} == {"a": 2, "b": 3}
    assert {r["k"]: r["seq"] for r in pick.first(log, "k").collect()} == {"a": 0, "b": 3}
    assert {(r["k"], r["seq"], r["position"]) for r in pick.last_in_first_order(log, "k").collect()} == {("a", 2, 0), ("b", 3, 3)}


def test_registry_ids_are_distinct(spark):
    names = spark.createDataFrame([(0, "Ä b"), (1, "a B"), (2, "a_b_2"), (3, "a b")], "pos long, name string")
    ids = [r["source_id"] for r in inventory.registry(names).orderBy("pos").collect()]
    assert ids[0] == "a_b" and len(set(ids)) == 4
    assert inventory.drift(names, names).count() == 0


def block_of_titles(n):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    titles = ["grantee " + " ".join(rng.choice(vocabulary) for _ in range(8)) for _ in range(n * 9 // 10)]
    return titles + [t[:20] + rng.choice("abc") + t[21:] for t in titles[: n // 10]]


def test_near_titles_equal_brute_force(spark):
    titles = [*block_of_titles(250), "a" * 24 + " bbbbb", "a" * 25 + " bbbbb", "e" * 40 + " x" * 20, "e" * 42 + " x" * 19, "1234567 8888888", "1234567 8888889", "", None, "Ab ab", "ab ab"]
    df = spark.createDataFrame(list(enumerate(titles)), "seq long, title string")
    plain = {r["seq"]: r["t"] for r in curation.title_blocks(df).collect()}
    first, expected = {}, set()
    for i in sorted(plain):
        if plain[i] in first:
            expected.add((first[plain[i]], i))
        first.setdefault(plain[i], i)
    for i, j in itertools.combinations(sorted(first.values()), 2):
        a, b = plain[i], plain[j]
        if a.split()[0][:12] == b.split()[0][:12] and len(a) // 10 == len(b) // 10 and difflib.SequenceMatcher(None, a, b).ratio() >= 0.9:
            expected.add((i, j))
    assert {tuple(r) for r in curation.title_edges(df).collect()} == expected and len(expected) > 20


def test_pairs_of_a_frequent_word_follow_the_similar_titles(spark):
    """Ten times the titles of one block make about ten times the rows, not a hundred times."""
    passed = [curation.title_pairs(spark.createDataFrame(list(enumerate(block_of_titles(n))), "seq long, title string"), letters=True).count() for n in (500, 5000)]
    assert 0 < passed[0] <= 100 and passed[1] <= 12 * passed[0]
    every = curation.title_pairs(spark.createDataFrame(list(enumerate(block_of_titles(500))), "seq long, title string")).count()
    assert every > 100 * passed[0]


def test_members_of_a_group_are_rows(spark):
    rows = [(i, f"r{i}", "s", "t", "u", i % 4, i < 4) for i in range(10)]
    grouped = spark.createDataFrame(rows, "seq long, record_id string, source_id string, title string, canonical_url string, group_id long, is_canonical boolean")
    found = {tuple(r)[:3] for r in curation.group_members(grouped).collect()}
    assert found == {(f"r{i % 4}", 3 if i % 4 < 2 else 2, i) for i in range(10)}


def text_pairs(n):
    """Texts of up to 500 characters, with few and many characters changed, moved and repeated."""
    rng = random.Random(12)
    for _ in range(n):
        a = " ".join(rng.choice(["the", "of", "ing", "tion", "wh", "xq", "7", "rivers"]) for _ in range(rng.randrange(1, 90)))
        b = list(a)
        for _ in range(rng.randrange(0, max(2, len(a) // 6))):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(["", "x", "the ", "q"])
        yield a, "".join(b) if rng.random() < 0.8 else " ".join(reversed(a.split()))


def test_similarity_to_a_threshold_equals_the_ratio():
    seen = set()
    for a, b in [*text_pairs(600), ("", ""), ("", "a"), ("a", "a"), ("ab" * 300, "ba" * 300), ("abcdefghi", "abcdefghij")]:
        for t in (0.0, 0.6, 0.9, 18 / 19, 1.0):
            ratio = difflib.SequenceMatcher(None, a, b).ratio()
            assert arrow.similar(difflib.SequenceMatcher(None, "", b), a, t) == (ratio >= t)
            seen.add((t, ratio >= t, len(b) >= 200))
    assert {(0.9, x, y) for x in (True, False) for y in (True, False)} <= seen


def test_runs_of_letters_lose_no_similar_pair():
    near = 0
    for a, b in text_pairs(600):
        apart = sum(int(x).bit_count() for x in (arrow.gram_bits(a) ^ arrow.gram_bits(b)).view("uint64"))
        # the count of characters that only one has, by difflib without and with its rule for frequent ones
        for auto in (False, True):
            alone = len(a) + len(b) - 2 * sum(m.size for m in difflib.SequenceMatcher(None, a, b, auto).get_matching_blocks())
            assert apart <= 5 * alone
            near += apart > 0 and alone <= 0.1 * (len(a) + len(b))
    assert near > 100


def test_long_titles_of_one_block_make_few_pairs(spark):
    """Long titles agree in their letters; their runs of letters tell them apart."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    titles = ["grantee " + " ".join(rng.choice(vocabulary) for _ in range(60))[:325] for _ in range(300)]
    titles += [t[:150] + "zz" + t[152:] for t in titles[:20]]
    df = spark.createDataFrame(list(enumerate(titles)), "seq long, title string")
    assert 20 <= curation.title_pairs(df, letters=True).count() < 200


def test_groups_read_texts_twice(spark, tmp_path):
    """Once for what decides about groups and once to return the records, whatever the number of rounds."""
    rows = [(i, f"r{i}", "s", f"title number {i % 9} of the rivers", f"body {i % 40}", f"h{i % 40}", "", "2026") for i in range(200)]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(x):
        seen.add(1)
        return x

    records = spark.createDataFrame(rows, "seq long, record_id string, source_id string, title string, clean_text string, content_hash string, canonical_url string, published_at string")
    records = records.withColumn("content_hash", read(F.concat("content_hash", F.lit(""))))
    assert curation.duplicate_groups(records).select("record_id", "group_id").count() == 200
    curation.duplicate_groups(records).select("record_id", "group_id").write.format("noop").mode("overwrite").save()
    # two queries; the join's test for nulls counts once more
    assert seen.value <= 2 * 3 * len(rows)


def test_gaps_between_matching_blocks_are_as_few_as_anchors():
    """Runs of letters of two texts differ by what is alone and by gaps, which a long second text has few of; no similar pair is lost."""
    rng = random.Random(21)
    copies = [(t, "".join(rng.choice("etaoinsz") if rng.random() < 0.02 else c for c in t)) for t in block_of_titles(40) for t in [" ".join([t] * 6)]]
    near = fewer = 0
    for a, b in [*text_pairs(600), *copies]:
        apart = sum(int(x).bit_count() for x in (arrow.gram_bits(a) ^ arrow.gram_bits(b)).view("uint64"))
        letters = sum(int(x).bit_count() for x in (arrow.letter_bits(a) ^ arrow.letter_bits(b)).view("uint64"))
        alone = len(a) + len(b) - 2 * sum(m.size for m in difflib.SequenceMatcher(None, a, b).get_matching_blocks())
        assert letters <= alone and apart <= alone + 4 * min(alone, arrow.anchors(b))
        near += apart > 0 and alone <= 0.1 * (len(a) + len(b))
        fewer += arrow.anchors(b) < alone
    assert near > 100 and fewer > 40


def test_longest_match_equals_difflib():
    rng = random.Random(22)
    seen = set()
    for a, b in text_pairs(300):
        matcher = difflib.SequenceMatcher(None, a, b)
        at = [i for i, c in enumerate(a) if c in matcher.b2j]
        for _ in range(4):
            (alo, ahi), (blo, bhi) = (sorted(rng.choices(range(len(x) + 1), k=2)) for x in (a, b))
            found = matcher.find_longest_match(alo, ahi, blo, bhi)
            assert arrow.longest_match(matcher, at, alo, ahi, blo, bhi) == tuple(found)
            seen.add((found.size > 0, len(b) >= 200))
    assert len(seen) == 4


def test_long_titles_of_common_words_make_few_pairs(spark):
    """Long titles of the same frequent words share their letters and most runs of letters; their matching blocks are few."""
    rng = random.Random(23)
    words = ["the", "of", "and", "in", "to", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "this", "are", "from", "at", "his", "which", "or", "have", "an", "they", "one", "were"]
    titles = [("the " + " ".join(rng.choice(words) for _ in range(120)))[:345] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(titles)), "seq long, title string")
    assert curation.title_pairs(df, letters=True).count() < 200


def components(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_links_have_the_components_of_edges(spark):
    rng = random.Random(24)
    titles = block_of_titles(150)
    titles += [t[:k] + rng.choice("xyz ") + t[k + 1 :] for t in titles[:6] for k in rng.sample(range(8, 30), 15)]
    titles += [" ".join([t] * 5)[:k] + "q" + " ".join([t] * 5)[k:] for t in titles[6:9] for k in range(10, 200, 12)] + titles[:5]
    rng.shuffle(titles)
    df = spark.createDataFrame(list(enumerate(titles)), "seq long, title string")
    edges, links = ([tuple(r) for r in f(df).collect()] for f in (curation.title_edges, curation.title_links))
    assert set(links) < set(edges) and components(links) == components(edges)


def test_a_group_of_near_copies_is_not_compared_pair_by_pair(monkeypatch):
    import pandas as pd

    base = "the rivers and lakes of the northern countries and their keepers"
    titles = [base[:i] + c + base[i + 1 :] for i in range(10, 60) for c in "xyz7"]
    asked = []
    plain = arrow.similar
    monkeypatch.setattr(arrow, "similar", lambda *a: asked.append(1) or plain(*a))
    pairs = list(itertools.combinations(range(len(titles)), 2))
    batches = [pairs[i : i + 1000] for i in range(0, len(pairs), 1000)]
    series = ([pd.Series([titles[p[0]] for p in x]), pd.Series([titles[p[1]] for p in x]), pd.Series([p[0] for p in x]), pd.Series([p[1] for p in x])] for x in batches)
    found = pd.concat(list(arrow.linking_at(0.9).func(tuple(x) for x in series)))
    assert found.sum() == len(asked) == len(titles) - 1 and len(found) == len(pairs)


def test_forgotten_links_are_found_again(monkeypatch):
    monkeypatch.setattr(arrow, "LINKED", 3)
    links = arrow.Links()
    for i in range(9):
        links.add(*sorted((links.root(i), links.root(i + 1))))
    assert links.root(9) == links.root(8) < 8 and links.root(0) == 0


def test_groups_without_texts_read_them_once(spark):
    rows = [(i, f"r{i}", "s", f"title number {i % 9} of the rivers", f"body {i % 40}", f"h{i % 40}", "", "2026") for i in range(200)]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(x):
        seen.add(1)
        return x

    plain = spark.createDataFrame(rows, SCHEMA)
    expected = curation.duplicate_groups(plain).drop("clean_text")
    found = curation.duplicate_groups(plain.withColumn("clean_text", read("clean_text")), texts=False)
    assert sorted(found.columns) == sorted(expected.columns)
    assert sorted(map(tuple, found.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert seen.value == len(rows)
