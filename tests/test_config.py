import pytest
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import text
from loamwork.operators import inventory, labels, metrics
from loamwork.sources import config, connectors, files, providers


def test_source_list_becomes_a_registry(spark, tmp_path):
    path = tmp_path / "sources.yaml"
    path.write_text('[{"name": "Türkiye Scholarships", "scope": ["masters"], "postings_page": "https://www.a.org/x "}, {"name": "türkiye scholarships", "postings_page": "https://b.org"}]', encoding="utf-8")
    built = inventory.registry(config.read_sources(spark, str(path))).orderBy("pos")
    assert [r["source_id"] for r in built.collect()] == ["turkiye_scholarships", "turkiye_scholarships_2"]
    assert [r["d"] for r in built.select(text.domain_of(F.col("postings_page")).alias("d")).collect()] == ["a.org", "b.org"]
    assert config.taxonomy(spark).count() == len(C.CATEGORIES)


def test_versions_logs_and_environment(spark, tmp_path):
    assert config.versions(spark, str(tmp_path / "none")) == []
    files.write_frozen(spark.range(2), str(tmp_path / "m" / "v1"), {})
    assert config.versions(spark, str(tmp_path / "m")) == ["v1"]
    for n in range(2):
        config.log_run(spark, str(tmp_path / "log"), config.run_manifest(n=n))
    assert spark.read.text(str(tmp_path / "log")).count() == 2
    target = {"A": "1"}
    config.set_environment("A=2\n# c=d\nB = 'x'\n\nnonsense", target)
    assert target == {"A": "1", "B": "x"}


def test_pool_rotates_waits_and_gives_up():
    now, sent = [0.0], []

    def send(slot, request):
        sent.append(slot.name)
        if slot.name == "limited":
            raise providers.RateLimited("later")
        if slot.name == "broke":
            raise providers.ProviderError("Insufficient balance")
        return "ok"

    slots = [providers.Slot("limited"), providers.Slot("broke"), providers.Slot("good", rpm=2, rpd=4, margin=1.0), providers.Slot("other", role="verifier")]
    pool = providers.Pool(slots, send, clock=lambda: now[0], wait=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(4):
        assert pool.call("x")[0].name == "good"
    assert slots[1].disabled and now[0] >= 60 and "other" not in sent
    with pytest.raises(providers.QuotaExhausted):
        pool.call("x")
    now[0] += providers.DAY + 1
    assert pool.call("x")[0].name == "good" and pool.call("x", ("verifier",))[0].name == "other"
    specs = [{"api_key_env": "K", "kind": "gemini", "model": "m"}, {"api_key_env": "K", "kind": "o", "model": "m"}, {"api_key_env": "N", "kind": "gemini", "model": "m"}]
    assert len(providers.configured(specs, {"K": "k"})) == 1


def test_waiting_times_of_a_slot():
    slot = providers.Slot("s", rpd=100, rpm=10)
    slot.answered = [1000.0 * k for k in range(84)]
    now = 84_500.0
    assert slot.ready_at(now) == now
    slot.note(now, True)
    assert slot.ready_at(now) == 0 + providers.DAY + providers.TICK and slot.ready_at(providers.DAY + 1) == providers.DAY + 1
    slot = providers.Slot("s", rpm=2, margin=1.0)
    slot.note(59.0, True)
    slot.note(59.5, True)
    assert slot.ready_at(59.9) == 60.0 and slot.ready_at(60.1) == 60.1
    slot.note(61.0, False, providers.seconds_of("30", 61.0))
    assert slot.available_after == 91.0 and slot.ready_at(70.0) == 91.0
    slot.note(100.0, False)
    slot.note(100.0, False)
    assert slot.available_after == 100.0 + providers.BACKOFF * 4
    assert providers.seconds_of("Thu, 01 Jan 1970 00:02:00 GMT", 60.0) == 60.0 and providers.seconds_of("soon", 0.0) is None
    other = providers.Slot("t")
    assert providers.choose([slot, other], ("primary",), 101.0) == (101.0, other) and providers.choose([slot], ("judge",), 0.0) == (providers.inf, None)


def test_snapshots_and_registries(spark, tmp_path):
    path = str(tmp_path / "state")
    for n in (1, 2):
        config.save_snapshot(spark.createDataFrame([(n, "x")], "b long, a string"), path)
        assert [tuple(r) for r in config.load_snapshot(spark, path, "a string, b long").collect()] == [("x", n)]
    (tmp_path / "state").rename(tmp_path / "state.old")
    assert config.load_snapshot(spark, path, "a string, b long").count() == 1
    config.write_registry(spark, str(tmp_path / "r.yaml"), [{"name": "É", "postings_page": "https://a.org"}])
    assert (tmp_path / "r.yaml").read_text(encoding="utf-8").startswith("# ") and config.read_sources(spark, str(tmp_path / "r.yaml")).first()["name"] == "É"
    names = ["a", "a", "a 2", "a 2", "b", "a", "a 2 2", "B!"]
    built = inventory.registry(spark.createDataFrame(list(enumerate(names)), "pos long, name string")).orderBy("pos").collect()
    expected, used = [], set()
    for name in names:
        slug = name.lower().strip("!").replace(" ", "_")
        found = next(x for n in range(1, 99) if (x := slug if n == 1 else f"{slug}_{n}") not in used)
        used.add(found)
        expected.append(found)
    assert [r["source_id"] for r in built] == expected and len(used) == len(names)


def test_remaining_projections(spark):
    df = spark.createDataFrame([("phd", {"b": 0.7, "a": 0.3}), ("none", {"a": 1.0})], "c string, p map<string,double>")
    found = df.select(text.category_index(F.col("c")).alias("i"), metrics.in_order(F.col("p"), ["a", "b"]).alias("p"), text.example_prompt("I", "E", "S", F.col("c")).alias("raw")).collect()
    assert [(r["i"], r["p"]) for r in found] == [(2, [0.3, 0.7]), (None, [1.0, 0.0])]
    assert found[0]["raw"].endswith("OPPORTUNITY:\nphd\n\nTARGET OUTPUT:\n")
    verdicts = spark.createDataFrame([(0, "r", False), (1, "r", None), (2, "s", True)], "seq long, record_id string, agreement boolean")
    assert [(r["record_id"], r["seq"]) for r in labels.disputed(verdicts).collect()] == [("r", 0)]
    rows = spark.createDataFrame([("r", "text", "phd")], "record_id string, input string, target string")
    assert tuple(labels.training_rows(rows, "classify", 1).first()) == ("text", 2)


def test_feed_probe(spark):
    from loamwork import schemas

    rows = [("k", "s", "https://a/feed", 1, 200, "", 0, "<html>"), ("k", "s", "https://a/rss", 2, 200, "", 0, "<rss><channel><item><title>t</title><link>l</link></item></channel></rss>")]
    assert tuple(connectors.feed_probe(spark.createDataFrame(rows, schemas.RESPONSE)).first()) == ("s", "https://a/rss", "rss", 1)
