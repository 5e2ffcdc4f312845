"""Statistics of one text, from its UTF-8 bytes."""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
_BLANK = b" \t\n\x0b\x0c\r"
_TAILS = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = b"0123456789"
_MARKS = b"!?"
_STOPS = b".,;:"


def without(text: bytes, unwanted: bytes) -> int:
    """Bytes of the text that are none of `unwanted`."""
    return len(text.translate(None, unwanted))


def word_numbers(words: list[bytes]) -> tuple[np.ndarray, int]:
    """A number for each word, equal for equal words, and how many there are."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words)), len(number)


def repeated_windows(numbers: np.ndarray, distinct: int, width: int = 3) -> int:
    """Words that lie in a window of `width` words which the text has twice or more."""
    n = len(numbers) - width + 1
    if n < 2:
        return 0
    codes, size = numbers[:n], distinct
    for k in range(1, width):
        if size * distinct >= 1 << 62:
            seen, codes = np.unique(codes, return_inverse=True)
            size = len(seen)
        codes = codes * distinct + numbers[k : n + k]
        size *= distinct
    order = np.sort(codes)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, where, times = np.unique(codes, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[where] > 1)
    inside = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + width, -1)
    return int((np.cumsum(inside) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines))


def base_counts(text: bytes, words: list[bytes]) -> dict[str, int]:
    numbers, distinct = word_numbers(words)
    return {
        "n_words": len(words),
        "word_chars": without(text, _TAILS + _BLANK),
        "n_symbols": len(text) - without(text, SYMBOLS),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_windows(numbers, distinct) if distinct < len(words) else 0,
    }


def features(text: bytes) -> list[float]:
    """Shares and sizes that say something about a text's quality, whatever its language."""
    words = text.split()
    numbers, distinct = word_numbers(words)
    n, chars = len(words), max(1, without(text, _TAILS))
    lines = text.count(b"\n") + 1
    per_word = max(1, n)
    shares = [
        (len(text) - without(text, SYMBOLS)) / per_word,
        (len(text) - without(text, _MARKS)) / per_word,
        (len(text) - without(text, _UPPER)) / chars,
        (len(text) - without(text, _DIGITS)) / chars,
        (len(text) - without(text, _STOPS)) / per_word,
        duplicate_lines(text) / lines,
        repeated_windows(numbers, distinct) / per_word,
        float((numbers[1:] == numbers[:-1]).mean()) if n > 1 else 0.0,
        distinct / per_word,
    ]
    length = np.log1p(n)
    word = without(text, _TAILS + _BLANK) / per_word
    return [*shares, *[s**0.5 for s in shares], *[min(1.0, 20 * s) for s in shares], length, length * length / 10, min(1.0, n / 50), word, abs(word - 5.0), float(n == 0)]


N_FEATURES = len(features(b""))
