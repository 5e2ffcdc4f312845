"""Functions that Spark lacks, over Arrow batches."""

from __future__ import annotations

import bisect
import difflib
import heapq
import html
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType

from loamwork import constants as C

# Tags that stand on lines of their own, and those whose content is not text.
_BLOCKS = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "blockquote", "section", "article"}
_HIDDEN = {"script", "style", "noscript", "template"}

#: Characters of texts that a worker's matchers hold.
MATCHED = 4 << 20
#: Texts whose links a worker remembers.
LINKED = 1 << 20
#: 64-bit words of a text's runs of characters, and of its letters.
GRAM_WORDS, LETTER_WORDS = 32, 8


class _Text(HTMLParser):
    """Collects the text of a page; a block's end and a line break become a line end."""

    def __init__(self, without: tuple[str, ...] = ()) -> None:
        super().__init__(convert_charrefs=True)
        self._without = _HIDDEN | set(without)
        self.parts: list[str] = []
        self._hidden = 0
        self._open: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self._without:
            self._hidden += 1
        elif tag == "br":
            self.parts.append("\n")
        elif tag in ("p", "li", "tr") and tag in self._open[-1:]:
            self.handle_endtag(tag)  # these close themselves when the next one opens
        if tag in _BLOCKS:
            self._open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self._without:
            self._hidden = max(0, self._hidden - 1)
        elif tag in _BLOCKS and tag in self._open:
            while self._open:
                self.parts.append("\n")
                if self._open.pop() == tag:
                    break

    def handle_data(self, data: str) -> None:
        if not self._hidden:
            self.parts.append(data)


def html_text(page: str | None, without: tuple[str, ...] = ()) -> str:
    """Readable text of a page: blocks on lines of their own, blanks collapsed, one empty line at most; tags in `without` are left out."""
    if not page or "<" not in page:
        return html.unescape(page or "").strip()
    parser = _Text(without)
    parser.feed(page)
    parser.close()
    out: list[str] = []
    for line in "".join(parser.parts).splitlines():
        line = re.sub("[ \t ]+", " ", line).strip()
        if line or (out and out[-1]) or not out:
            out.append(line)
    return "\n".join(out).strip()[: C.RAW_TEXT_LIMIT]


@pandas_udf(StringType())
def html_to_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(html_text)


def ratio(a: str, b: str) -> float:
    """Ratcliff and Obershelp's similarity; the order of its arguments matters."""
    return difflib.SequenceMatcher(None, a, b).ratio()


@pandas_udf(DoubleType())
def similarity(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def _same(a: str, i: int, b: str, j: int, most: int) -> int:
    """How many characters of `a` from i on, `most` at most, are those of `b` from j on."""
    if a[i : i + most] == b[j : j + most]:
        return most
    low, high = 0, most
    while high - low > 1:
        mid = (low + high) // 2
        if a[i + low : i + mid] == b[j + low : j + mid]:
            low = mid
        else:
            high = mid
    return low


def longest_match(matcher: difflib.SequenceMatcher, at: list[int], alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
    """What matcher.find_longest_match() returns, if `at` are the places in the first text of characters that the matcher looks up.

    In a long second text the frequent ones are not looked up; only the few places of the others are visited.
    """
    a, b, b2j = matcher.a, matcher.b, matcher.b2j
    besti, bestj, size = alo, blo, 0
    run, last = {}, -2
    for i in at[bisect.bisect_left(at, alo) : bisect.bisect_left(at, ahi)]:
        before, run = run if i == last + 1 else {}, {}
        last = i
        for j in b2j[a[i]]:
            if j < blo:
                continue
            if j >= bhi:
                break
            k = run[j] = before.get(j - 1, 0) + 1
            if k > size:
                besti, bestj, size = i - k + 1, j - k + 1, k
    while besti > alo and bestj > blo and a[besti - 1] == b[bestj - 1]:
        besti, bestj, size = besti - 1, bestj - 1, size + 1
    size += _same(a, besti + size, b, bestj + size, min(ahi - besti, bhi - bestj) - size)
    return besti, bestj, size


def similar(matcher: difflib.SequenceMatcher, a: str, threshold: float) -> bool:
    """Whether `a` and the matcher's second text have a ratio of `threshold` or more.

    Matching blocks are found as ratio() finds them, widest open range first, until the count of matching
    characters is enough or what the open ranges can add at most is not.
    """
    both = len(a) + len(matcher.b)
    if not both:
        return threshold <= 1
    need = max(0, int(threshold * both / 2) - 1)
    while 2.0 * need / both < threshold:
        need += 1
    matcher.set_seq1(a)
    found, left = 0, min(len(a), len(matcher.b))
    ranges = [(-left, 0, len(a), 0, len(matcher.b))]
    at = [i for i, c in enumerate(a) if c in matcher.b2j] if found < need <= left else []
    while ranges and found < need <= found + left:
        width, alo, ahi, blo, bhi = heapq.heappop(ranges)
        left += width
        i, j, k = longest_match(matcher, at, alo, ahi, blo, bhi)
        if k:
            found += k
            for part in ((alo, i, blo, j), (i + k, ahi, j + k, bhi)):
                most = min(part[1] - part[0], part[3] - part[2])
                if most:
                    left += most
                    heapq.heappush(ranges, (-most, *part))
    return found >= need


def _near(threshold: float) -> Callable[[str, str], bool]:
    # what a matcher knows of its second text serves all pairs that have it
    matchers: dict[str, difflib.SequenceMatcher] = {}
    held = 0

    def near(x: str, y: str) -> bool:
        nonlocal held
        if y not in matchers:
            held += len(y)
            if held > MATCHED:
                matchers.clear()
                held = len(y)
            matchers[y] = difflib.SequenceMatcher(None, "", y)
        return similar(matchers[y], x, threshold)

    return near


def similar_at(threshold: float) -> Callable:
    """An Arrow function of two texts: whether their similarity() is `threshold` or more."""

    @pandas_udf(BooleanType())
    def similar_texts(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        near = _near(threshold)
        for a, b in pairs:
            yield pd.Series([near(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    return similar_texts


class Links:
    """Which numbers are linked so far, by chains of links too; it forgets all when it knows LINKED numbers."""

    def __init__(self) -> None:
        self._up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self._up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def add(self, x: int, y: int) -> None:
        if len(self._up) >= LINKED:
            self._up.clear()
        self._up[max(x, y)] = min(x, y)


def linking_at(threshold: float) -> Callable:
    """An Arrow function of two texts and their numbers: whether their similarity() is `threshold` or more, but
    false without a comparison where a task's other pairs link the two numbers already.

    What it finds true has the connected components of all similar pairs. Of a group of near copies, which may
    all be similar to each other, it compares about as many pairs as there are texts, not their square.
    """

    @pandas_udf(BooleanType())
    def linking(pairs: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        near, links = _near(threshold), Links()
        for a, b, ia, ib in pairs:
            out = []
            for x, y, i, j in zip(a, b, ia.tolist(), ib.tolist(), strict=True):
                i, j = links.root(i), links.root(j)
                new = i != j and near(x, y)
                if new:
                    links.add(i, j)
                out.append(new)
            yield pd.Series(out, dtype=bool)

    return linking


def gram_bits(text: str) -> np.ndarray:
    """A text's runs of three characters, the i-th occurrence of one apart from the others, each by hash one of 64 * GRAM_WORDS bits."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    grams = np.sort((codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:])
    first = np.r_[True, grams[1:] != grams[:-1]] if len(grams) else np.zeros(0, bool)
    at = np.arange(len(grams))
    times = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    mixed = (grams ^ (times * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    flags = np.zeros(64 * GRAM_WORDS, np.uint8)
    flags[(mixed >> np.uint64(40)) % np.uint64(len(flags))] = 1
    return np.packbits(flags).view(np.int64)


def letter_bits(text: str) -> np.ndarray:
    """A text's letters as bits: the i-th bit of a letter is set if the text has it i times or more.

    Letters and the space have 16 bits, digits four; what is beyond that is not compared. Two texts
    differ in at most as many bits as they have characters that the other one lacks.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(codes[codes < 128], minlength=128)
    many = np.arange(16) < counts[[32, *range(97, 123)]][:, None]
    few = np.arange(4) < counts[48:58][:, None]
    flags = np.zeros(64 * LETTER_WORDS, bool)
    flags[: many.size + few.size] = np.concatenate([many.ravel(), few.ravel()])
    return np.packbits(flags).view(np.int64)


def anchors(text: str) -> int:
    """The most matching blocks, but for one, that ratio() can find in `text` as its second argument.

    Where that has 200 characters or more, blocks are looked for at characters that are not frequent in it (a
    hundredth of all and one more); so each block holds one of these, but for what both texts begin with.
    """
    n = len(text)
    if n < 200:
        return n
    _, counts = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
    return int(counts[counts <= n // 100 + 1].sum())


@pandas_udf(ArrayType(LongType()))
def marks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """A text's anchors(), then its letter_bits(), then its gram_bits()."""
    for batch in texts:
        yield batch.map(lambda t: np.concatenate([[anchors(t)], letter_bits(t), gram_bits(t)]))


def longest_common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a row of the table at a time.

    What both begin with is counted first: some longest one always holds it whole.
    """
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[same:], b[same:]
    number = {w: i for i, w in enumerate(dict.fromkeys(b))}
    other = np.array([number[w] for w in b])
    row = np.zeros(len(b) + 1, np.int32)
    for w in a:
        if w in number:
            step = np.maximum(row[1:], row[:-1] + (other == number[w]))
            row[1:] = np.maximum.accumulate(step)
    return same + int(row[-1])


def rouge_f1(text: str | None, reference: str | None) -> float:
    a, b = (text or "").split(), (reference or "").split()
    return 2 * longest_common(a, b) / (len(a) + len(b)) if a and b else 0.0


@pandas_udf(DoubleType())
def rouge_l(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([rouge_f1(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def braces(raw: str | None) -> str | None:
    """What stands between the first and the last brace, if it is one JSON object; as canonical JSON."""
    found = re.search(r"\{.*\}", raw or "", re.DOTALL)
    try:
        return json.dumps(json.loads(found.group(0)), ensure_ascii=False) if found else None
    except ValueError:
        return None


@pandas_udf(StringType())
def strict_json(raw: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in raw:
        yield batch.map(braces)


#: Characters of a slice whose encodings are held at once.
SLICE = 1 << 18
#: Words whose numbers of tokens a worker remembers (beyond that it forgets all), and the longest of them.
CACHE_WORDS, LONG_WORD = 1 << 18, 64
# Fixed value: how the byte-level pre-tokenizer cuts a text into words, with the white space of the Unicode standard.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def slices(texts: Iterable[str | None], limit: int = SLICE) -> Iterator[list[str]]:
    """The texts, null as empty, in lists of about `limit` characters, or one text that is longer."""
    held, size = [], 0
    for t in texts:
        t = t or ""
        if held and size + len(t) > limit:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def token_counter(path: str) -> Callable:
    """An Arrow function that counts a text's tokens by the tokenizer file at `path`; null counts as empty.

    An encoding takes some forty bytes for each character of its text, so that only a slice of a batch is
    encoded at once. Where the file cuts texts into byte-level words, which are encoded each by itself, a
    word is encoded once and then remembered.
    """

    @pandas_udf(LongType())
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # a task has one core; threads of the library would each keep memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        cut = kind.get("pre_tokenizer") or {}
        by_word = kind.get("normalizer") is None and (cut.get("type"), cut.get("use_regex", True), cut.get("add_prefix_space")) == ("ByteLevel", True, False)
        special = [t["content"] for t in kind.get("added_tokens", ())]
        split, known = regex.compile(_WORD).findall, {}

        def encoded(parts: list[str]) -> Iterator[int]:
            for some in slices(parts):
                yield from [len(e.ids) for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]

        def of_words(text: str) -> int:
            words = split(text)
            new = {w for w in words if w not in known}
            if new:
                if len(known) + len(new) > CACHE_WORDS:
                    known.clear()
                    new = set(words)
                ordered = list(new)
                once = dict(zip(ordered, encoded(ordered), strict=True))
                total = sum(once[w] if w in once else known[w] for w in words)
                known.update((w, n) for w, n in once.items() if len(w) <= LONG_WORD)
                return total
            return sum(map(known.__getitem__, words))

        for batch in texts:
            if by_word:
                yield pd.Series([next(encoded([t])) if any(s in t for s in special) else of_words(t) for t in (x or "" for x in batch)], dtype="int64")
            else:
                yield pd.Series(list(encoded(batch)), dtype="int64")

    return count
