import json
import os
import time

from loamwork.sources import fetch_job, fetching


def means_for(log, answers):
    """Means whose clock jumps ahead when it is waited for, and whose sender writes down what it sends and when."""

    def make():
        skipped = [0.0]
        clock = lambda: time.time() + skipped[0]
        tries = {}

        def send(url):
            with open(os.path.join(log, f"{os.getpid()}.jsonl"), "a", encoding="utf-8") as f:
                f.write(json.dumps([clock(), url]) + "\n")
            tries[url] = tries.get(url, -1) + 1
            return fetching.Response(*answers(url, tries[url]))

        return fetch_job.Means(send, clock, lambda s: skipped.__setitem__(0, skipped[0] + s), lambda url: "private" not in url)

    return make


def sent(log):
    return sorted(json.loads(line) for name in os.listdir(log) for line in open(os.path.join(log, name), encoding="utf-8"))


def test_hosts_keep_their_delays_and_a_second_run_sends_nothing(spark, tmp_path):
    log, cache = str(tmp_path / "log"), str(tmp_path / "cache")
    os.mkdir(log)
    rows = [("s", f"https://{host}.org/{i}", i) for host in ("a", "b", "c") for i in range(4)] + [("s", "https://a.org/1", 9), ("s", "https://b.org/private", 5), ("s", None, 1), ("s", "https://d.org/x", 1), ("s", "https://d.org/y", 2), ("s", "https://a.org/gone", 7), ("s", "https://c.org/busy", 8)]
    requests = spark.createDataFrame(rows, "source_id string, url string, page int").repartition(5)

    def answers(url, tried):
        if "d.org" in url:
            return (403,)
        if "gone" in url:
            return (404, "none")
        return (503,) if "busy" in url and tried < 9 else (200, f"body of {url}")

    counts = {r["outcome"]: r["n"] for r in fetch_job.fetch_into(requests, cache, "1", means_for(log, answers), 2).collect()}
    assert counts == {"done": 12, "refused": 2, "failed": 2, "disallowed": 1}
    first = sent(log)
    for host in "abc":
        times = [t for t, url in first if f"{host}.org" in url]
        assert len(times) >= 4 and all(b - a >= fetching.DELAY - 0.01 for a, b in zip(times, times[1:], strict=False))
    assert len([u for _, u in first if "d.org" in u]) == 1 and len([u for _, u in first if u == "https://a.org/1"]) == 1
    found = fetch_job.responses_for(requests.where("url IS NOT NULL"), cache)
    assert {r["url"]: r["text"] for r in found.where("status = 200").collect()} == {u: f"body of {u}" for _, u, _ in rows if u and u.split("/")[-1].isdigit()}
    again = {r["outcome"]: r["n"] for r in fetch_job.fetch_into(requests.where("source_id = 's' AND NOT url LIKE '%d.org%' AND NOT url LIKE '%busy%' AND NOT url LIKE '%private%'"), cache, "2", means_for(log, answers), 2).collect()}
    assert again == {} and sent(log) == first
    retried = {r["outcome"]: r["n"] for r in fetch_job.fetch_into(requests, cache, "3", means_for(log, lambda url, tried: (200, "now")), 2).collect()}
    assert retried == {"done": 3, "disallowed": 1} and fetch_job.read_cache(spark, cache).count() == 16
