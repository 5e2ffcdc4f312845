"""BPE encoding and decoding: speculate with greedy longest matches, verify, merge only where that fails.

Pre-tokenization cuts a text into words. For words that a worker has not met, a greedy longest match
proposes tokens. A proposal is what merging would give exactly if no merge ever crosses the border
between two adjacent tokens, and that depends on the two tokens alone; one vectorised check decides
it for all new adjacent pairs at once. Words with a pair that fails are merged exactly, by rank.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from loamwork.llm.common import documents, runs

#: Pieces, words and pairs that a worker remembers; beyond that it forgets all and goes on.
CACHE_PIECES = 600_000
CACHE_PAIRS = 1_000_000
#: Bytes beyond which a word is merged with a queue.
LONG_WORD = 256
#: White space beyond this length overflows the stack of the compiled encoder's pattern.
LONG_BLANK = 2000
_NEVER = np.int64(1 << 40)
_LAST = 1 << 40

# The white space of the Unicode standard, and the byte-level pre-tokenizer's pattern.
_SPACE = r"\t-\r \x85\xa0  -     　"
#: A text with one of these has words that no split at single spaces and line ends finds.
_IRREGULAR = ["  ", " \n", "\n ", "\n\n", "\0", "\t", "\v", "\f", "\r", *map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])]
_BLANKS = (" ", "\n")
_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, by letter."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Bpe:
    """A byte-level BPE model read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        self._special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._byte_id = [0] * 256
        for token, i in vocab.items():
            if len(token) == 1:
                self._byte_id[letters[token]] = i
        self._words = regex.compile(_PATTERN).findall
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._rank = np.full(size, -1, np.int64)
        self._rank[made] = np.arange(len(made))
        self._left, self._right = np.arange(size), np.arange(size)
        self._left[made], self._right[made] = left, right
        codes = left << 32 | right
        order = np.argsort(codes)
        self._codes, self._code_rank = codes[order], order
        self._merge = {p: r for r, p in enumerate(zip(left.tolist(), right.tolist(), strict=True))}
        self._made = [vocab[a + b] for a, b in pairs]
        # tokens that merging their own bytes would not give are never proposed
        sound = np.ones(size, bool)
        crossing = self._compatible(left, right, np.arange(len(made)))
        for c, a, b, ok in zip(made.tolist(), left.tolist(), right.tolist(), crossing.tolist(), strict=True):
            sound[c] = ok and sound[a] and sound[b]
        self._match = {self.bytes[i]: i for i in vocab.values() if sound[i]}
        self._longest = max(map(len, self._match))
        self._known: dict[str, tuple[int, ...]] = {}
        self._pieces: dict[str, tuple[int, ...]] = {s: (i,) for s, i in self.special.items()}
        self._pairs: dict[int, bool] = {}

    def _compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether merging the bytes of a and b, one after the other, leaves the border between them.

        Goes back in time: undoes the later of the two merges that made the tokens beside the
        border, and asks each time whether a merge across it would have come first. Of two merges
        of one rank the left one comes first.
        """
        ok = np.ones(len(a), bool)
        at, x, y = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), _NEVER) if limit is None else limit.astype(np.int64)
        while len(at):
            code = x << 32 | y
            place = np.minimum(np.searchsorted(self._codes, code), len(self._codes) - 1)
            crossing = np.where(self._codes[place] == code, self._code_rank[place], _NEVER)
            ok[at[crossing < limit]] = False
            rx, ry = self._rank[x], self._rank[y]
            go = (crossing >= limit) & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry = at[go], x[go], y[go], rx[go], ry[go]
            later_left = rx > ry
            limit = np.where(later_left, rx, ry + 1)
            x, y = np.where(later_left, self._right[x], x), np.where(later_left, y, self._left[y])
        return ok

    def _propose(self, word: bytes) -> list[int]:
        match, found, at, n = self._match, [], 0, len(word)
        while at < n:
            end = min(n, at + self._longest)
            while (i := match.get(word[at:end])) is None:
                end -= 1
            found.append(i)
            at = end
        return found

    def _merged(self, word: bytes) -> tuple[int, ...]:
        """Merging by rank, the leftmost of equals first."""
        parts = [self._byte_id[b] for b in word]
        get = self._merge.get
        if len(parts) > LONG_WORD:
            return self._merged_by_heap(parts)
        ranks = [get(p, _LAST) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) != _LAST:
            at = ranks.index(best)
            parts[at : at + 2] = [self._made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((parts[at - 1], parts[at]), _LAST)
            if at < len(ranks):
                ranks[at] = get((parts[at], parts[at + 1]), _LAST)
        return tuple(parts)

    def _merged_by_heap(self, parts: list[int]) -> tuple[int, ...]:
        """The same for words so long that a search of all pairs for each merge would take too long."""
        n, get = len(parts), self._merge.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := get(p)) is not None]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            j = after[i]
            if parts[i] < 0 or j >= n or get((parts[i], parts[j])) != rank:
                continue  # one of the two has been merged since
            parts[i], parts[j], after[i] = self._made[rank], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := get((parts[a], parts[b]))) is not None:
                    heappush(queue, (r, a))
        return tuple(p for p in parts if p >= 0)

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that are not known yet."""
        words = list(words)
        if not words:
            return
        raw = [w.encode() for w in words]
        proposed = [self._propose(w) for w in raw]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inside = owner[1:] == owner[:-1]
        codes = (flat[:-1] << 32 | flat[1:])[inside]
        distinct, where = np.unique(codes, return_inverse=True)
        new = [c for c in distinct.tolist() if c not in self._pairs]
        if new:
            if len(self._pairs) > CACHE_PAIRS:
                self._pairs.clear()
                new = distinct.tolist()
            fresh = np.array(new, np.int64)
            self._pairs.update(zip(new, self._compatible(fresh >> 32, fresh & 0xFFFFFFFF).tolist(), strict=True))
        good = np.fromiter((self._pairs[c] for c in distinct.tolist()), bool, len(distinct))
        failed = set(owner[1:][inside][~good[where]].tolist())
        for i, word in enumerate(words):
            self._known[word] = self._merged(raw[i]) if i in failed else tuple(proposed[i])

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text; strings of special tokens become these tokens."""
        split = [self._split(t) for t in texts]
        cache = self._pieces
        missing = set(chain.from_iterable(split)).difference(cache)
        if len(cache) + len(missing) > CACHE_PIECES:
            cache.clear()
            cache.update(((s, (i,)) for s, i in self.special.items()))
            missing = set(chain.from_iterable(split)).difference(cache)
        words = [self._words(p) for p in missing]
        self._learn_missing(set(chain.from_iterable(words)))
        known = self._known
        for piece, own in zip(missing, words, strict=True):
            cache[piece] = known[own[0]] if len(own) == 1 else tuple(chain.from_iterable(map(known.__getitem__, own)))
        for pieces in split:
            yield list(chain.from_iterable(map(cache.__getitem__, pieces)))

    def _split(self, text: str) -> list[str]:
        """Pieces that no word crosses: single words where white space is regular, else the whole."""
        if self._special_split is not None and any(s in text for s in self.special):
            return list(chain.from_iterable([p] if p in self.special else self._split(p) for p in self._special_split.split(text)))
        if any(s in text for s in _IRREGULAR) or text[:1] in _BLANKS or text[-1:] in _BLANKS:
            return self._words(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _learn_missing(self, words: set[str]) -> None:
        missing = words.difference(self._known)
        if len(self._known) + len(missing) > CACHE_PIECES:
            self._known.clear()
            missing = words
        self.learn(missing)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


class Compiled:
    """The tiktoken library over the same vocabulary, for operators that need ids and not the method above."""

    def __init__(self, path: str):
        import tiktoken

        self._own = load(path)
        ranks = {b: i for i, b in enumerate(self._own.bytes) if i not in self._own.special.values()}
        self._encode = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._blank = regex.compile(rf"[{_SPACE}]{{{LONG_BLANK}}}")

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        special = self._own.special
        for text in texts:
            if any(s in text for s in special) or (len(text) > LONG_BLANK and self._blank.search(text)):
                yield from self._own.encode([text])
            else:
                yield self._encode(text)


@lru_cache(maxsize=2)
def compiled(path: str) -> Compiled:
    return Compiled(path)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [x or "" for x in batch.column(name).to_pylist()]


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """`docs` with ids array<int>; null texts count as empty, which has no ids."""
    path = vocabulary or default_vocabulary()
    kept = [f for f in docs.schema.fields if f.name != "ids"]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in runs(batches):
            ids = pa.array(list(bpe.encode(texts(batch))), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], ids], names=[*[f.name for f in kept], "ids"])

    return docs.mapInArrow(run, ddl)


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document.

    Null texts count as empty: no tokens, and the hashes of empty strings. Texts of any length are
    encoded whole; repeated rows give repeated rows; other columns are not read.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        names = [str(i) for i in range(len(bpe.bytes))]
        for batch in runs(batches):
            counts, coded, decoded = [], [], []
            for ids in bpe.encode(texts(batch)):
                counts.append(len(ids))
                coded.append(sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded.append(sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


QUERIES = {"op6_bpe_round_trip": op6_bpe_round_trip}
ORACLES: dict[str, str] = {}
