"""Plain versions of operators, over lists of (doc_id, text)."""

import collections
import string

import xxhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
BLANK = " \t\n\x0b\x0c\r"


def line_key(line):
    return line.translate(LOWER).strip(BLANK)


def lines(rows):
    """(doc_id, lines before, lines that went, kept text) of each row."""
    holders = collections.defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(line_key(line)) >= 40:
                holders[line_key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if doc_id is None or not (len(h := holders.get(line_key(x), set())) >= 5 and max(h) != doc_id)]
        out.append((doc_id, len(every), len(every) - len(kept), "\n".join(kept)))
    return out


def simhash(text):
    words = (text or "").translate(LOWER).translate({ord(c): " " for c in BLANK}).split(" ")
    words = [w for w in words if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """(doc_id, fingerprint, smallest doc_id reachable) of each row."""
    fps = {t: simhash(t) for _, t in rows}
    out = []
    for doc_id, text in rows:
        seen, todo = {fps[text]}, [fps[text]]
        while todo:
            x = todo.pop()
            for y in set(fps.values()) - seen:
                if (x ^ y).bit_count() <= 2:
                    seen.add(y)
                    todo.append(y)
        out.append((doc_id, fps[text], min(d for d, t in rows if d is not None and fps[t] in seen)))
    return out
