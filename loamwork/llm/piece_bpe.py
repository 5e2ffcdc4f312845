"""SentencePiece encoding and decoding: exact merging by backtracking over longest matches.

A text is cut where no piece of the vocabulary holds both neighbours, since no merge crosses such a
border. What lies between (mostly words) is encoded once and remembered: an Aho-Corasick automaton
finds all pieces in it; from left to right the longest piece is taken that is compatible with the one
before. Two adjacent pieces are compatible if merging their joint characters again gives these two.
Where no piece fits, the position is marked in a bitfield as failed and the piece before it is taken
back for a shorter one. The sequence whose neighbours are all compatible is the one that merging gives:
the first merge to cross one of its borders would also cross it when the two pieces are merged alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loamwork.llm.bpe import texts
from loamwork.llm.common import documents, runs

#: Units and pairs of pieces that a worker remembers; beyond that it forgets all and goes on.
CACHE_UNITS = 1_000_000
CACHE_PAIRS = 1_000_000
#: Units beyond this length are encoded, but not remembered.
LONG_UNIT = 64
#: Characters beyond which merging uses a queue.
LONG_MERGE = 64

# The space of pieces, what an unknown piece decodes to, and the mark of a wrong byte.
SPACE = "▁"
_UNKNOWN = " ⁇ "
_WRONG = "�"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _follow(lead: int, second: int) -> bool:
    """Whether `second` may follow the leading byte `lead` in UTF-8."""
    low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
    high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
    return low <= second <= high


def _by_bytes(raw: bytes) -> str:
    """UTF-8 in which each byte that belongs to no character becomes a mark of its own."""
    out, at = [], 0
    while at < len(raw):
        lead = raw[at]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        part = raw[at : at + size]
        if size and len(part) == size and (size == 1 or (_follow(lead, part[1]) and all(0x80 <= b < 0xC0 for b in part[2:]))):
            out.append(part.decode())
            at += size
        else:
            out.append(_WRONG)
            at += 1
    return "".join(out)


class PieceBpe:
    """A SentencePiece model of the merge type: pieces and their scores, read by the library of that name.

    Held to models that leave a text as it is but for spaces, put a space before it, and spell unknown
    characters by bytes; another model is refused.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in every]
        self._byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(model.is_byte, self._byte_ids)) or any(map(model.is_unused, every)):
            raise ValueError("needs a model with byte pieces and without unused ones")
        if model.normalize("ﬁ  ä ") != f"{SPACE}ﬁ{SPACE}{SPACE}ä{SPACE}":
            raise ValueError("needs a model that changes nothing but spaces")
        byte_of = {i: b for b, i in enumerate(self._byte_ids)}
        self._control = frozenset(i for i in every if model.is_control(i))
        self._raw = [b"" if i in self._control else _UNKNOWN.encode() if model.is_unknown(i) else bytes([byte_of[i]]) if i in byte_of else pieces[i].replace(SPACE, " ").encode() for i in every]
        self._is_byte = [i in byte_of for i in every]
        self._id = {pieces[i]: i for i in every if i not in byte_of and i not in self._control and not model.is_unknown(i)}
        self._spaced = frozenset(i for p, i in self._id.items() if p.startswith(SPACE))
        # the higher the score, the earlier a merge
        self._order = {p: -model.get_score(i) for p, i in self._id.items()}
        self._borders(self._id)
        self._automaton = ahocorasick.Automaton()
        # pieces that merging their own characters would not give are never taken
        for piece in self._id:
            if len(piece) > 1 and self.merge(piece) == [piece]:
                self._automaton.add_word(piece, piece)
        self._automaton.make_automaton()
        self._units: dict[str, tuple[int, ...]] = {}
        self._pairs: dict[tuple[str, str], bool] = {}

    def _borders(self, pieces: Iterable[str]) -> None:
        """Tables of the neighbours that some piece holds: one of ASCII and the space, one of codes for the rest."""
        pairs = sorted({ord(a) << 32 | ord(b) for p in pieces for a, b in zip(p, p[1:], strict=False)})
        self._held = np.array(pairs, np.int64)
        self._small = np.zeros((129, 129), bool)
        for p in pairs:
            a, b = (128 if c == ord(SPACE) else c for c in (p >> 32, p & 0xFFFFFFFF))
            if a < 129 and b < 129:
                self._small[a, b] = True

    def cut(self, text: str) -> list[str]:
        """`text` in units that no merge crosses."""
        if len(text) < 2:
            return [text] if text else []
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        small = np.where(code == ord(SPACE), 128, np.where(code < 128, code, 129)).astype(np.uint8)
        a, b = small[:-1], small[1:]
        held = self._small[np.minimum(a, 128), np.minimum(b, 128)]
        if len(other := np.flatnonzero((a == 129) | (b == 129))):
            pair = code[:-1][other].astype(np.int64) << 32 | code[1:][other]
            place = np.minimum(np.searchsorted(self._held, pair), len(self._held) - 1)
            held[other] = self._held[place] == pair
        cuts = [0, *(np.flatnonzero(~held) + 1).tolist(), len(text)]
        return [text[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]

    def merge(self, text: str) -> list[str]:
        """Merging the characters of `text`: the highest score first, the leftmost of equals."""
        parts, get = list(text), self._order.get
        if len(parts) > LONG_MERGE:
            return self._merge_by_heap(parts)
        never = float("inf")
        orders = [get(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while orders and (best := min(orders)) != never:
            at = orders.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del orders[at]
            if at:
                orders[at - 1] = get(parts[at - 1] + parts[at], never)
            if at < len(orders):
                orders[at] = get(parts[at] + parts[at + 1], never)
        return parts

    def _merge_by_heap(self, parts: list[str]) -> list[str]:
        n, get = len(parts), self._order.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(o, i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (o := get(a + b)) is not None]
        heapify(queue)
        while queue:
            _, i, made = heappop(queue)
            j = after[i]
            if j >= n or not parts[i] or parts[i] + parts[j] != made:
                continue  # one of the two has been merged since
            parts[i], parts[j], after[i] = made, "", after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (o := get(parts[a] + parts[b])) is not None:
                    heappush(queue, (o, a, parts[a] + parts[b]))
        return [p for p in parts if p]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the characters of a and b gives these two pieces again."""
        known = self._pairs.get((a, b))
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[a, b] = a + b not in self._order and self.merge(a + b) == [a, b]
        return known

    def backtrack(self, unit: str) -> list[str]:
        """The pieces of `unit`; characters that are no piece stand alone."""
        matches: list[list[str]] = [[c] for c in unit]
        for end, piece in self._automaton.iter(unit):
            matches[end + 1 - len(piece)].append(piece)  # shorter ones of a start come first
        taken: list[str] = []
        failed = bytearray(len(unit) // 8 + 1)
        at, choice = 0, len(matches[0]) - 1
        while at < len(unit):
            options = matches[at]
            last = taken[-1] if taken else None
            while choice >= 0:
                piece = options[choice]
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (last is None or self.compatible(last, piece)):
                    break
                choice -= 1
            if choice >= 0:
                taken.append(piece)
                at = end
                choice = len(matches[at]) - 1 if at < len(unit) else 0
            else:
                # what precedes is the only way to get here, so that none leads on from here
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= len(piece)
                choice = matches[at].index(piece) - 1
        return taken

    def _ids(self, unit: str) -> tuple[int, ...]:
        found: list[int] = []
        for piece in self.backtrack(unit):
            i = self._id.get(piece)
            if i is None:
                found.extend(map(self._byte_ids.__getitem__, piece.encode()))
            else:
                found.append(i)
        return tuple(found)

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text, without begin and end."""
        known = self._units
        for text in texts:
            if not text:
                yield []
                continue
            units = self.cut(SPACE + text.replace(" ", SPACE))
            new = set(units).difference(known)
            if len(known) + len(new) > CACHE_UNITS:
                known.clear()
                new = set(units)
            known.update((u, self._ids(u)) for u in new)
            yield list(chain.from_iterable(map(known.__getitem__, units)))
            for u in new:
                if len(u) > LONG_UNIT:
                    del known[u]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of `ids`: the space before it goes, bytes in a row are read as UTF-8, begin and end give nothing."""
        ids = list(ids)
        # the first piece that is not begin or end loses one space; bytes and an unknown piece lose none
        start = 1 if next((i for i in ids if i not in self._control), None) in self._spaced else 0
        if self._control.isdisjoint(ids):
            try:
                return b"".join(map(self._raw.__getitem__, ids))[start:].decode()
            except UnicodeDecodeError:
                pass
        return self._decode_slowly(ids)[start:]

    def _decode_slowly(self, ids: list[int]) -> str:
        """The same where begin and end part rows of bytes, or bytes are no UTF-8."""
        out: list[str] = []
        row = bytearray()
        for i in ids:
            if self._is_byte[i]:
                row += self._raw[i]
                continue
            out.append(_by_bytes(bytes(row)))
            row.clear()
            out.append(self._raw[i].decode())
        out.append(_by_bytes(bytes(row)))
        return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> PieceBpe:
    return PieceBpe(path)


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """`docs` with ids array<int>; null texts count as empty, which has no ids. A column named ids is replaced."""
    path = model or default_model()
    kept = [f for f in docs.schema.fields if f.name != "ids"]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in runs(batches):
            ids = pa.array(list(bpe.encode(texts(batch))), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], ids], names=[*[f.name for f in kept], "ids"])

    return docs.mapInArrow(run, ddl)


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document.

    Null texts count as empty: no tokens, and the hashes of empty strings. Texts of any length are
    encoded whole, and also runs of any length without a border; repeated rows give repeated rows;
    other columns are not read. A space mark in a text counts, and comes back, as a space. An empty
    table gives an empty result.
    """
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        names = [str(i) for i in range(len(bpe._raw))]
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


def op11_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


QUERIES = {"op11_piece_round_trip": op11_piece_round_trip}
ORACLES: dict[str, str] = {}
