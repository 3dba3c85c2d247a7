"""Packing documents into training sequences by non-negative least squares.

Documents are tokenised and packed in blocks of bounded size where they are read, so no token
is shuffled. A document's full windows become sequences of their own; what is left of each
document is one piece shorter than a window. A block's pieces are counted by length class,
combinations of one to three classes that fill a window are listed, and non-negative repeat
counts are solved for so that the combinations use up the histogram. The counts are rounded down
and the combinations filled with real pieces. The residual pieces are packed greedily, longest first,
each into the fullest sequence that takes it; the holes that remain are filled by cutting the shortest pieces.
The one sequence that is still not full is cut at the powers of two that make up its length, so nothing is padded.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import map_batches, pieces

WINDOW = 2048
END = 1
CLASSES = 32
BLOCK_TOKENS = 4 << 20
TOKENIZER = "word_bpe_49k.json"
# Words, and parts of words, that a task remembers the ids of at most, and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 250_000, 64


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Kept(dict):
    """What ``make`` says of words, remembered of a bounded number of words of bounded length.

    Nothing here refers back to itself, so all of it goes with the encoder that a task drops at its end.
    """

    __slots__ = ("make",)

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make

    def __missing__(self, word: str) -> bytes:
        value = self.make(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = value
        return value


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers.

    The tokenizer never joins text across blanks or line ends, so a text's ids are those of its
    words one after the other, and words are remembered. Plain words are lower-cased and split
    here and only their parts go to the model; all others go to the tokenizer as they are.
    """

    # The tokenizer's own split into parts, and the letters that lower-casing treats one by one.
    _split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
    _plain = regex.compile(r"[!-;=-~¡-įı-ɏ]*").fullmatch

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        model = whole.model
        split, plain = self._split, self._plain
        shown = _shown_bytes()

        def part_ids(part: str) -> bytes:
            text = part if part.isascii() else part.encode().decode("latin-1").translate(shown)
            return array("I", [t.id for t in model.tokenize(text)]).tobytes()

        parts = Kept(part_ids)

        def word_ids(word: str) -> bytes:
            if word.isalpha() and word.isascii():
                return parts[word.lower()]
            if plain(word):
                own = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
                return parts[own[:-1]] + parts[own[-1]] if own[-1:] in (",", ".") and own[:-1].isalpha() else b"".join([parts[p] for p in split(own)])
            ids = whole.encode(word, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)

        self.words = Kept(word_ids)

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def _shown_bytes() -> dict[int, str]:
    """How a byte-level tokenizer writes bytes: visible ones as they are, others from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def combinations(classes: int = CLASSES) -> np.ndarray:
    """Every sum of one to three class lengths that makes up a window, as use counts by class."""
    found = []
    for a in range(1, classes + 1):
        for b in range(0, a + 1):
            c = classes - a - b
            if 0 <= c <= b:
                use = np.zeros(classes)
                for x in (a, b, c):
                    if x:
                        use[x - 1] += 1
                found.append(use)
    return np.array(found)


def solve(use: np.ndarray, target: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative x that brings ``x @ use`` near ``target``, by coordinate descent."""
    gram, wanted = use @ use.T, use @ target
    x = np.zeros(len(use))
    slope = -wanted.astype(float)
    diagonal = np.diag(gram)
    for _ in range(rounds):
        moved = 0.0
        for i in range(len(x)):
            new = max(0.0, x[i] - slope[i] / diagonal[i])
            if new != x[i]:
                slope += (new - x[i]) * gram[i]
                moved = max(moved, abs(new - x[i]))
                x[i] = new
        if moved < 0.25:
            break
    return x


def plan(lengths: list[int], window: int = WINDOW, classes: int = CLASSES) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(piece, start, length)`` that hold pieces shorter than a window.

    All sequences are full but the last ones, whose lengths are powers of two.
    """
    size = window // classes
    own = [-(-n // size) for n in lengths]  # rounded up: a combination never overflows
    waiting: list[list[int]] = [[] for _ in range(classes + 1)]
    for i in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        if lengths[i]:
            waiting[own[i]].append(i)
    use = combinations(classes)
    x = np.floor(solve(use, np.array([len(w) for w in waiting[1:]], float)) + 1e-6).astype(int)
    filled: list[list[tuple[int, int, int]]] = []
    for row, times in zip(use, x.tolist()):
        need = [(c + 1, int(k)) for c, k in enumerate(row.tolist()) if k]
        for _ in range(min([times, *[len(waiting[c]) // k for c, k in need]])):
            filled.append([(i, 0, lengths[i]) for c, k in need for i in [waiting[c].pop() for _ in range(k)]])
    # The residual, longest first, each into the fullest sequence that takes it.
    rest = sorted((i for w in waiting for i in w), key=lambda i: (-lengths[i], i))
    room = [window - sum(n for _, _, n in s) for s in filled]
    spaces = sorted((r, k) for k, r in enumerate(room) if r)
    for i in rest:
        at = bisect_left(spaces, (lengths[i], -1))
        if at < len(spaces):
            r, k = spaces.pop(at)
        else:
            r, k = window, len(filled)
            filled.append([])
        filled[k].append((i, 0, lengths[i]))
        if r > lengths[i]:
            insort(spaces, (r - lengths[i], k))
    return _closed(filled, window)


def _closed(filled: list[list[tuple[int, int, int]]], window: int) -> list[list[tuple[int, int, int]]]:
    """Fill the holes by taking the emptiest sequences apart, cutting where a hole ends."""
    room = [window - sum(n for _, _, n in s) for s in filled]
    order = sorted(range(len(filled)), key=lambda k: (room[k], k))
    low, high = 0, len(order) - 1
    while low < high:
        k, giver = order[low], order[high]
        if not room[k]:
            low += 1
        elif not filled[giver]:
            high -= 1
        else:
            i, start, n = filled[giver].pop()
            taken = min(n, room[k])
            filled[k].append((i, start, taken))
            room[k] -= taken
            if taken < n:
                filled[giver].append((i, start + taken, n - taken))
    out = [filled[k] for k in order[: high + 1] if filled[k]]
    if out:
        out[-1:] = _powers(out[-1])
    return out


def _powers(items: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    left, out = sum(n for _, _, n in items), []
    items = items[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        out.append([])
        while size:
            i, start, n = items.pop()
            taken = min(n, size)
            out[-1].append((i, start, taken))
            size -= taken
            if taken < n:
                items.append((i, start + taken, n - taken))
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` tokens.

    Columns: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A document
    is its ids and the end id; a null or empty text is the end id alone. Each row is a document, also
    where rows repeat. ``sequence_id`` is made of the partition and a number within it.
    """
    path = tokenizer or tokenizer_path()
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

    def block(ids: list, data: list[bytes], first: int) -> tuple[dict, int]:
        out: dict[str, list] = {c: [] for c in columns}

        def add(i: int, start: int, n: int, sequence: int, offset: int) -> None:
            crc = zlib.crc32(memoryview(data[i])[4 * start : 4 * (start + n)])
            for c, v in zip(columns, (ids[i], start, n, crc, len(data[i]) // 4, sequence, offset)):
                out[c].append(v)

        number, left = first, []
        for i, d in enumerate(data):
            full = len(d) // 4 // window
            for k in range(full):
                add(i, k * window, window, number, 0)
                number += 1
            left.append(len(d) // 4 - full * window)
        for sequence in plan(left, window):
            offset = 0
            for i, start, n in sequence:
                add(i, len(data[i]) // 4 - left[i] + start, n, number, offset)
                offset += n
            number += 1
        return out, number

    def run(batches) -> Iterator[dict]:
        from pyspark import TaskContext

        encode = Encoder(path)
        end = struct.pack("<I", END)
        number = TaskContext.get().partitionId() << 40
        ids: list = []
        data: list[bytes] = []
        size = 0
        for batch in pieces(batches):
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids.append(doc_id)
                data.append(encode(text or "") + end)
                size += len(data[-1]) // 4
                if size >= block_tokens:
                    out, number = block(ids, data, number)
                    yield out
                    ids, data, size = [], [], 0
        if ids:
            yield block(ids, data, number)[0]

    return map_batches(docs.select("doc_id", "text"), run, ", ".join(f"{c} long" for c in columns))
