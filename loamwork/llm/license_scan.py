"""License scans: a trained paragraph classifier whose families a template comparison confirms.

A paragraph is a run of lines between lines without a letter or digit; lines of one paragraph are
joined, so statements may be wrapped at any width. It is looked at sentence by sentence, as it may name
several licences, and sentences of over WINDOW words in windows that overlap by half. A multinomial
logistic regression over the word n-grams of such a unit (one to three words) names a licence family
or "unknown". A unit counts if "unknown" is the less likely half, and then for its likeliest family,
provided that the unit holds most word pairs of one of the family's templates, and for other families
that beat "unknown" and of which it holds a whole template.

The model is trained on the driver from statements generated below, in the same way for every corpus:
verbs, names and contexts that are put together at random, licences that are none of the families,
names without their version, and sentences that only sound like licences. Its temperature is fitted on
statements with names and phrases that the scoring model has not seen (a fold each), so that the
probability of "unknown" means something for licences that are new to it.

Texts are scored by SQL functions only, without a join or a shuffle: the weights are folded into the
plan as constants of a fixed size. Units without a cue are not scored: every template has one (see the
tests), and what has none could not be confirmed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.common import documents, text_or_empty

UNKNOWN = "unknown"
#: A template is confirmed by this share of its pairs of words; a unit counts up to this probability of "unknown".
SHARE = 0.8
UNLIKELY = 0.5
BUCKETS = 1 << 13
#: Words of a unit at most; templates have no more than half of it.
WINDOW = 64
FOLDS = 3

# Names of each family as statements have them, in lower case and without punctuation.
NAMES = {
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0", "apache software license 2 0"],
    "MIT": ["mit license", "expat license"],
    "BSD-2-Clause": ["bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd license"],
    "BSD-3-Clause": ["bsd 3 clause", "3 clause bsd", "new bsd license", "modified bsd license"],
    "GPL-2.0": ["gnu general public license version 2", "gpl version 2", "gpl 2 0", "gpl v2", "gplv2 license", "gnu gplv2"],
    "GPL-3.0": ["gnu general public license version 3", "gpl version 3", "gpl 3 0", "gpl v3", "gplv3 license", "gnu gplv3"],
    "LGPL": ["gnu lesser general public license", "gnu library general public license", "lgpl 2 1", "lgpl 3 0", "lgpl v2 1", "lgpl v3", "lgplv3 license"],
    "AGPL-3.0": ["gnu affero general public license version 3", "agpl 3 0", "agpl v3", "agplv3 license"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"],
    "CC0-1.0": ["cc0 1 0", "cc0 license", "creative commons zero"],
    "ISC": ["isc license"],
}
#: Names of one word, which count only with a word of these before them.
BARE = {"MIT": ["mit"], "ISC": ["isc"], "GPL-2.0": ["gplv2"], "GPL-3.0": ["gplv3"], "LGPL": ["lgplv3"], "AGPL-3.0": ["agplv3"], "CC0-1.0": ["cc0"]}
POINTERS = ["under", "license", "identifier"]
#: Creative Commons licences by their conditions and versions.
CONDITIONS = {"": "attribution", "SA": "attribution sharealike", "NC": "attribution noncommercial", "NC-SA": "attribution noncommercial sharealike", "ND": "attribution noderivatives", "NC-ND": "attribution noncommercial noderivatives"}
VERSIONS = ["4.0", "3.0", "2.5", "2.0"]
_GNU = "under the terms of the gnu {} public license as published by the free software foundation either version {} of the license"
STATEMENTS = {
    "MIT": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "GPL-2.0": [_GNU.format("general", "2")],
    "GPL-3.0": [_GNU.format("general", "3")],
    "LGPL": [_GNU.format("lesser general", "2 1"), _GNU.format("lesser general", "3")],
    "AGPL-3.0": [_GNU.format("affero general", "3")],
    "BSD-3-Clause": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "redistribution and use in source and binary forms with or without modification are permitted provided that neither the name of the copyright holder nor the names of its contributors"],
    "BSD-2-Clause": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "ISC": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "CC0-1.0": ["dedicated to the public domain", "released into the public domain"],
    "Proprietary": ["all rights reserved", "no part of this publication may be reproduced without the prior written permission of the copyright owner", "unauthorized copying of this file is strictly prohibited confidential and proprietary"],
}
#: What makes a unit worth a score; a regular expression.
CUES = r"licen[cs]|copyright|rights|spdx|(?:identifier|under) (?:mit|isc)|gnu|[al]?gpl|bsd|apache|mozilla|mpl|cc0|cc (?:by|attribution)|by (?:nc|sa|nd)|commons|attribution|noncommercial|sharealike|noderivatives|public domain|permission|permitted|hereby|software|documentation|modification|redistribution|contributors|publication|copying|proprietary"

# What training statements are made of.
VERBS = ["licensed under", "released under", "distributed under", "available under", "published under", "provided under", "covered by", "made available under", "subject to", "offered under"]
FRAMES = ["{v} the {n}", "{v} {n}", "{n}", "license {n}", "spdx license identifier {n}", "this {t} is {v} the {n}", "{t} {v} the terms of the {n}", "uses the {n}", "see the {n} for details", "dual {v} {n}", "the {t} comes with the {n}", "its {t} is {n}"]
THINGS = ["software", "code", "work", "file", "package", "library", "dataset", "text", "project", "site"]
OTHERS = ["eclipse public license 2 0", "artistic license 2 0", "boost software license 1 0", "zlib license", "unlicense", "european union public license 1 2", "microsoft public license", "open software license 3 0", "sil open font license 1 1", "open database license", "python software foundation license", "bsl 1 1", "elastic license 2 0", "apache license", "apache license 1 1", "gnu general public license", "gpl", "bsd", "creative commons", "cc by", "mozilla public license 1 1", "community license agreement", "end user license agreement", "commercial license"]
NEGATIVES = [
    "the driver lost his license after the accident", "a fishing license costs ten dollars", "civil rights and human rights", "the rights of way across the field", "copyright law is taught in the second year",
    "ask for permission before you enter", "parking is permitted on sundays", "the public library opens at nine", "the state owns the public domain lands", "a license plate with three digits", "released under pressure from the crowd",
    "distributed under the table", "available under the counter", "the license agreement was signed", "the new rights issue was reserved for members", "general public admission", "an apache helicopter landed", "students of mit",
    "public transport version 2 0", "no license was given to students of mit", "the gnu is an antelope", "all seats reserved", "copyright disputes went to court", "license fees rose by 2 0 percent", "version 3 of the report",
]
FILLERS = ["the", "of", "and", "a", "report", "by", "see", "our", "page", "data", "it", "author", "2019", "2021", "from", "with", "more", "about", "on", "terms", "copyright", "version", "for", "under", "license", "details"]


@lru_cache(maxsize=1)
def names() -> dict[str, list[str]]:
    """All names of all families, those of Creative Commons made from their conditions."""
    found = {family: list(x) for family, x in NAMES.items()}
    for version in VERSIONS:
        for code, long in CONDITIONS.items():
            digits = version.replace(".", " ")
            family = f"CC-BY-{code}-{version}".replace("--", "-")
            found[family] = [family.lower().replace("-", " ").replace(".", " "), f"creative commons {long} {digits}", f"cc {long} {digits}"]
    return found


@lru_cache(maxsize=1)
def templates() -> dict[str, list[str]]:
    found = {family: list(x) for family, x in names().items()}
    for family, bare in BARE.items():
        found[family] += [f"{p} {x}" for x in bare for p in POINTERS]
    for family, statements in STATEMENTS.items():
        found.setdefault(family, []).extend(statements)
    return found


def pairs(words: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


@dataclass(frozen=True)
class Classifier:
    """weights: by n-gram of the vocabulary and family; figures: what it is worth on unseen statements."""

    families: tuple[str, ...]
    vocabulary: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    figures: dict[str, float]

    def scores(self, words: list[str]) -> np.ndarray:
        """The scores that scan() computes in SQL, of which the softmax is the probability of each family."""
        place = {g: i for i, g in enumerate(self.vocabulary)}
        weights, bias = self.rounded()
        return bias + sum((weights[place[g]] for g in grams(words) if g in place), np.zeros(len(self.families)))

    def rounded(self) -> tuple[np.ndarray, np.ndarray]:
        return np.round(self.weights.astype(float) / self.temperature, 5), np.round(self.bias.astype(float) / self.temperature, 5)


def _examples(rng: np.random.Generator) -> list[tuple[int, str, str]]:
    """(fold, statement, family): a name is in one fold only, as are phrases around it as far as they are listed."""
    found = []

    def between(text: str) -> str:
        before, after = (list(rng.choice(FILLERS, rng.integers(0, 7))) for _ in range(2))
        return " ".join([*before, text, *after])

    def stated(name: str, fold: int) -> str:
        frame, verb = (str(rng.choice(x[fold::FOLDS])) for x in (FRAMES, VERBS))
        return between(frame.format(n=name, v=verb, t=rng.choice(THINGS)))

    for family, every in names().items():
        for k, name in enumerate([*every, *BARE.get(family, ())]):
            fold = k % FOLDS
            for _ in range(16 if " " in name else 32):
                pointed = name if " " in name else f"{rng.choice(POINTERS)} {name}"
                found.append((fold, stated(pointed, fold), family))
    for family, every in STATEMENTS.items():
        for k, text in enumerate(every):
            for _ in range(20):
                words = text.split()
                lost = int(rng.integers(0, len(words)))
                found.append((k % FOLDS, between(" ".join(w for i, w in enumerate(words) if i != lost or len(words) < 8)), family))
    for k, name in enumerate(OTHERS):
        found += [(k % FOLDS, stated(name, k % FOLDS), UNKNOWN) for _ in range(24)]
    for k, text in enumerate(NEGATIVES):
        found += [(k % FOLDS, between(text), UNKNOWN) for _ in range(12)]
    for k in range(150):
        found.append((k % FOLDS, " ".join(rng.choice([*FILLERS, *THINGS], rng.integers(1, 30))), UNKNOWN))
    return found


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _fitted(x: np.ndarray, y: np.ndarray, n: int, rounds: int = 80) -> tuple[np.ndarray, np.ndarray]:
    target = np.eye(n, dtype=np.float32)[y]
    w, b = np.zeros((x.shape[1], n), np.float32), np.zeros(n, np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        error = (target - _softmax(x @ w + b)) / len(x)
        vw, vb = 0.9 * vw + x.T @ error - 1e-5 * w, 0.9 * vb + error.sum(0)
        w, b = w + 0.5 * vw, b + 0.5 * vb
    return w, b


def calibration_error(p: np.ndarray, right: np.ndarray, bins: int = 10) -> float:
    """Expected calibration error of probabilities `p` of answers of which `right` are right."""
    where = np.minimum((p * bins).astype(int), bins - 1)
    return float(sum(abs(p[where == k].mean() - right[where == k].mean()) * (where == k).mean() for k in range(bins) if (where == k).any()))


@lru_cache(maxsize=1)
def train() -> Classifier:
    rng = np.random.default_rng(7)
    examples = _examples(rng)
    families = (UNKNOWN, *templates())
    fold = np.array([f for f, _, _ in examples])
    y = np.array([families.index(family) for _, _, family in examples])
    seen: dict[str, int] = {}
    for _, text, _ in examples:
        for g in grams(text.split()):
            seen[g] = seen.get(g, 0) + 1
    vocabulary = tuple(sorted(g for g, n in seen.items() if n >= 10))
    place = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(examples), len(vocabulary)), np.float32)
    for row, (_, text, _) in enumerate(examples):
        x[row, [place[g] for g in grams(text.split()) if g in place]] = 1
    # every statement is scored by a model that knows neither its name nor its phrases
    raw = np.zeros((len(examples), len(families)), np.float32)
    for k in range(FOLDS):
        w, b = _fitted(x[fold != k], y[fold != k], len(families))
        raw[fold == k] = x[fold == k] @ w + b
    at = np.arange(len(y))
    half = at % 2 == 0
    own = np.eye(len(families), dtype=np.float32)[0]
    tried = [(float(t), float(u)) for t in np.geomspace(0.2, 5, 40) for u in np.linspace(-3, 3, 31)]
    loss = [-np.log(_softmax(raw[half] / t + u * own)[np.arange(half.sum()), y[half]] + 1e-12).mean() for t, u in tried]
    temperature, shift = tried[int(np.argmin(loss))]
    p = _softmax(raw[~half] / temperature + shift * own)
    best = p.argmax(1)
    truth = y[~half]
    figures = {
        "statements": len(y), "vocabulary": len(vocabulary), "temperature": temperature, "shift": shift, "accuracy": float((best == truth).mean()), "ece": calibration_error(p.max(1), best == truth),
        "unknown_ece": calibration_error(p[:, 0], truth == 0), "unknown_taken_for_a_licence": float((p[truth == 0, 0] <= UNLIKELY).mean()), "licences_taken_for_unknown": float((p[truth > 0, 0] > UNLIKELY).mean()),
    }
    w, b = _fitted(x, y, len(families))
    return Classifier(families, vocabulary, w, b + temperature * shift * own, temperature, figures)


def _constant(value: list, kind: str) -> Column:
    """A list as one literal, which the optimizer parses once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _pairs_of(w: Column) -> Column:
    return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1)))


def _triples_of(w: Column) -> Column:
    return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))


def units_of(paragraph: Column) -> Column:
    """The word lists of a paragraph's sentences that have a cue, long ones as windows that overlap by half."""
    # a stop before a blank ends a sentence, unless a single letter or digit stands before it
    sentences = F.filter(F.split(paragraph, r"(?<=[^\s.!?;]{2}[.!?;])\s+"), lambda s: s.rlike(cue_pattern()))
    plain = lambda s: F.regexp_replace(F.regexp_replace(F.lower(s), "licence", "license"), "[^a-z0-9]+", " ")
    words = F.transform(sentences, lambda s: F.regexp_extract_all(plain(s), F.lit("[a-z0-9]+"), F.lit(0)))
    half = WINDOW // 2
    cut = lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(w) - 1) / half).cast("int") - 1)), lambda k: F.slice(w, k * half + 1, WINDOW))
    return F.filter(F.flatten(F.transform(words, cut)), lambda w: F.concat_ws(" ", w).rlike(cue_pattern()))


def cue_pattern() -> str:
    return rf"(?i)(?<![A-Za-z0-9])(?:{CUES.replace(' ', '[^A-Za-z0-9]+')})"


def with_scores(df: DataFrame, units: str = "_units") -> DataFrame:
    """`df` with _pairs, the distinct word pairs of each unit, and _z, its score for each family."""
    model = train()
    n = len(model.families)
    weights, bias = model.rounded()
    # n-grams by bucket; all of a bucket are compared with the text's, so that none overwrites or stands for another
    table: list[list[int]] = [[] for _ in range(BUCKETS)]
    for i, g in enumerate(model.vocabulary):
        table[xxhash.xxh64_intdigest(g.encode(), 42) % BUCKETS].append(i)
    buckets, vocabulary = _constant(table, "array<array<int>>"), _constant(list(model.vocabulary), "array<string>")
    flat, biases = _constant(weights.ravel().tolist(), "array<double>"), _constant(bias.tolist(), "array<double>")
    classes = F.sequence(F.lit(0), F.lit(n - 1))
    found = lambda g: F.filter(F.get(buckets, F.xxhash64(g).bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")), lambda i: F.get(vocabulary, i) == g)
    rows = F.transform(units, lambda w: F.flatten(F.transform(F.array_distinct(F.concat(w, _pairs_of(w), _triples_of(w))), found)))
    return (
        df.withColumn("_pairs", F.transform(units, lambda w: F.array_distinct(_pairs_of(w))))
        .withColumn("_rows", rows)
        .withColumn("_z", F.transform("_rows", lambda rs: F.transform(classes, lambda c: F.get(biases, c) + F.aggregate(rs, F.lit(0.0), lambda a, r: a + F.get(flat, r * n + c)))))
        .drop("_rows")
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_paragraphs, n_candidates, n_licensed, families, top_family, top_probability.

    n_paragraphs counts paragraphs with a letter or digit, n_candidates those with a cue, n_licensed those
    with a confirmed family. families lists the confirmed ones, sorted and distinct, joined by commas.
    top_family is the likeliest confirmed family (of equals the first by name), "unknown" without one,
    with probability 0. Null and empty texts have no paragraphs. Texts and paragraphs of any length are
    read whole; repeated rows give equal rows; only doc_id and text are read.
    """
    families = list(train().families)
    text = text_or_empty()
    paragraphs = F.filter(F.split(text, "\n(?:[^A-Za-z0-9\\x80-\\x{10FFFF}\n]*+\n)++"), lambda x: x.rlike("[A-Za-z0-9]|[^\\x00-\\x7F]"))
    base = docs.select("doc_id", F.size(paragraphs).cast("long").alias("n_paragraphs"), F.filter(paragraphs, lambda x: x.rlike(cue_pattern())).alias("_paragraphs"))
    each = F.flatten(F.transform("_paragraphs", lambda p, k: F.transform(units_of(p), lambda w: F.struct(k.alias("k"), w.alias("w")))))
    base = base.withColumn("_each", F.when(F.size("_paragraphs") > 0, each).otherwise(F.array().cast("array<struct<k:int,w:array<string>>>"))).withColumn("_units", F.transform("_each", lambda x: x["w"]))
    scored = with_scores(base)
    known = _constant([{"f": families.index(f), "g": sorted(pairs(t.split()))} for f, ts in templates().items() for t in ts], "array<struct<f:int,g:array<string>>>")
    named = _constant(families, "array<string>")

    def verdicts(z: Column, i: Column) -> Column:
        """(p, f, ok, k) of each family that one unit may be of."""
        e = F.transform(z, lambda x: F.exp(x - F.array_max(z)))
        total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
        licences = F.slice(z, 2, len(families))
        best = F.array_position(licences, F.array_max(licences))
        held = F.get(F.col("_pairs"), i)
        # the best family, or any that is likelier than none
        own = F.filter(known, lambda t: (t["f"] == best) | (F.get(z, t["f"]) > F.get(z, F.lit(0))))
        met = F.filter(own, lambda t: F.size(F.array_intersect(t["g"], held)) >= F.when(t["f"] == best, F.lit(SHARE)).otherwise(F.lit(1.0)) * F.size(t["g"]))
        listed = F.array_distinct(F.transform(met, lambda t: t["f"]))
        made = F.transform(listed, lambda f: F.struct((-F.round(F.get(e, f) / total, 6)).alias("p"), F.get(named, f).alias("f"), F.get(F.col("_each"), i)["k"].alias("k")))
        return F.when(F.get(e, F.lit(0)) / total <= UNLIKELY, made).otherwise(F.slice(made, 1, 0))

    found = scored.withColumn("_found", F.flatten(F.transform("_z", verdicts)))
    top = F.array_min("_found")
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("_paragraphs").cast("long").alias("n_candidates"),
        F.size(F.array_distinct(F.transform("_found", lambda v: v["k"]))).cast("long").alias("n_licensed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_found", lambda v: v["f"]))), ",").alias("families"),
        F.coalesce(top["f"], F.lit(UNKNOWN)).alias("top_family"),
        F.coalesce(-top["p"], F.lit(0.0)).alias("top_probability"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLES: dict[str, str] = {}
