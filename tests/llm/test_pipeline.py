import collections
import os
import random
import re
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from loamwork.llm import bpe, quality_classifier
from loamwork.llm.textstats import features

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, slot string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    shared = ["This line of more than forty characters stands in many documents.", "And so does this other line, which is about as long as that one."]
    rows, labels = [], []
    for i in range(160):
        body = [rng.choice(words) for _ in range(rng.randrange(60, 180))]
        if i % 5 == 0:
            body = [w + "###" for w in body]
        text = "\n".join([" ".join(body), *[x for x in shared if rng.random() < 0.4]])
        rows.append((i, text + (f"\nask k{i}.{i}@mail{i % 3}.example.com" if i % 7 == 1 else "")))
        labels.append((i, int(i % 5 > 0), 0))
    rows += [(400, " ".join(rng.choice(words) for _ in range(20000))), (13, "Another text under an id that is there already. " + " ".join(words[:150])), (13, rows[11][1].replace("a", "a", 1))]
    rows += [(200 + i, rows[11 + i][1].replace("a", "a", 1)) for i in range(6)] + [(300, None), (301, ""), (302, rows[12][1]), (302, rows[12][1])]
    where = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(d, t, "en", "s", len(t or ""), "x", "y") for d, t in rows], SCHEMA).repartition(3).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_each_stage_equals_its_plain_version(spark, tables, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "personal_data", "packing"]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    before, after = [docs], []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before[-1], tables).write.parquet(str(tmp_path / name))
        before.append(spark.read.parquet(str(tmp_path / name)))
    after = [texts(d) for d in before[1:-1]]
    for d, rows in zip(before[1:-1], after, strict=True):
        assert d.columns == corpus_pipeline.COLUMNS
        assert all(r["n_chars"] == len(r["text"] or "") for r in d.collect()) or d is before[1]
    model = quality_classifier.train(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    good = [(d, t) for d, t in texts(docs) if model.score(np.array([features((t or "").encode())]))[0] >= quality_classifier.CUT]
    assert collections.Counter(after[0]) == collections.Counter(good) and 100 < len(good) < len(texts(docs))
    assert collections.Counter(after[1]) == collections.Counter((d, t) for d, _, _, t in brute.lines(after[0]))
    group = brute.components(after[1])
    assert collections.Counter(after[2]) == collections.Counter(r for r, (d, _, c) in zip(after[1], group, strict=True) if d == c) and len(after[2]) < len(after[1])
    mail = re.compile(r"\S+@\S+")
    without, mails = ([f(t) for _, t in rows] for rows, f in ((after[3], lambda t: mail.sub("", t)), (after[3], mail.findall)))
    assert collections.Counter(zip((d for d, _ in after[3]), without, strict=True)) == collections.Counter((d, mail.sub("", t)) for d, t in after[2])
    assert not {m for x in mails for m in x} & {m for _, t in after[2] for m in mail.findall(t)} and any(mails)
    library = Tokenizer.from_file(bpe.default_vocabulary())
    lengths = collections.Counter()
    for d, t in after[3]:
        lengths[d] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    packed = before[-1].collect()
    assert collections.Counter({d: sum(r["length"] for r in packed if r["doc_id"] == d) for d in lengths}) == lengths
    assert len({r["sequence_id"] for r in packed}) <= 1.05 * sum(lengths.values()) / 1024 + 1
    run = corpus_pipeline.run(spark, tables).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in run) == collections.Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_empty_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.count() == 0
