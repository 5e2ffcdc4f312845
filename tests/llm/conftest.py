import pytest

PROSE = [
    "The quick brown fox jumps over the lazy dog while the band plays on and on until morning.",
    "A second sentence of some length follows here so that a shared line has forty characters.",
    "Ein dritter Satz mit Umlauten wie ä, ö und ü steht hier, damit auch andere Bytes vorkommen.",
]
CLASHES = ["n_lines", "n_dropped", "kept_text", "keep", "ids", "score", "fp", "part", "slot", "spans", "block", "extra", "signature", "entity", "n_entities", "features", "label", "key", "lo", "nonce", "target", "length", "start", "rank", "_keep", "_tid", "tid", "row", "id", "targets", "_targets", "mentions", "_mentions", "between", "words", "found", "more", "cluster", "phrase", "n"]


def odd_rows():
    """Nulls, empty and blank texts, copies, repeated rows, a long text, shared lines."""
    rows = [(i, "\n".join(PROSE[k % 3] + (f" {i}" if k == i % 3 else "") for k in range(3)) if i % 4 else PROSE[i % 3]) for i in range(14)]
    rows += [(20, None), (21, ""), (22, " \n\t\n"), (23, "word"), (24, "x" * 3000 + " \n" + "ab " * 2000), (25, rows[1][1]), (25, rows[1][1]), (None, rows[1][1]), (None, None), (30, " ".join(str(i) for i in range(3000)))]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    names = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASHES)) for r in odd_rows()], f"doc_id long, text string, {names}").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
