"""Byte-level BPE ids of whole slices of text: every distinct piece of a slice is encoded once."""

from __future__ import annotations

import base64
import unicodedata
from functools import cache, cached_property
from itertools import chain

import numpy as np

from tagloom.llm import textcols as T

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Where letters, marks and spaces are the same in every edition of Unicode: fixed ranges, both ends included.
SETTLED = (
    (0x0000, 0x024F), (0x0391, 0x03A1), (0x03A3, 0x03C9), (0x0400, 0x045F), (0x2010, 0x2027), (0x20AC, 0x20AC),
    (0x3041, 0x3094), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
)
#: What the ids of special tokens begin with in a text.
SPECIAL = b"<|"
#: Pieces whose ids a task remembers, and ids of all of them; only speed and memory depend on it.
REMEMBERED, REMEMBERED_IDS = 1_000_000, 1 << 24


@cache
def _classes() -> np.ndarray:
    """The class of every code point, as the vocabulary's pattern has it."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    for c in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        table[c] = SPACE  # Unicode's White_Space, fixed values
    return table


@cache
def _settled() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    for first, last in SETTLED:
        table[first : last + 1] = True
    return table


def _piece_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First code points of the pieces of rows without an apostrophe.

    Runs of one class are pieces; a single space before a run belongs to it; the last of
    several white-space characters before a run stands alone or, if a space, belongs to the run.
    """
    kind = _classes()[points]
    n = len(points)
    begins = np.zeros(n + 1, dtype=bool)
    begins[offsets] = True
    start = begins[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    joined = ~begins[1:-1] & (kind[:-1] == SPACE) & (kind[1:] != SPACE)  # position i + 1 follows white space
    start[:-1] |= joined
    start[1:] &= ~(joined & (points[:-1] == 0x20))
    return np.flatnonzero(start)


class Encoder:
    """Ids of a byte-level BPE vocabulary for slices of text.

    `path` is its file of ranks; the tokenizer's own file lies beside it, as .json. Rows that may hold a special token, or
    characters whose class depends on the edition of Unicode, are encoded by that tokenizer as they are.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.file = path.removesuffix(".tiktoken") + ".json"
        self._forget()

    @cached_property
    def tokenizer(self):
        """Read where a row asks for it: it takes more memory than the ranks."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    def _forget(self) -> None:
        """Nothing is remembered: `table` holds hashes of pieces (0: free place), `at` and `sizes` where the ids of each lie in `ids`."""
        self.known, self.used, self.ids = 0, 0, np.zeros(1 << 16, dtype=np.uint16)
        self._empty(1 << 16)

    def _empty(self, places: int) -> None:
        self.table = np.zeros(places, dtype=np.uint64)
        self.at, self.sizes = np.zeros(places, dtype=np.uint32), np.zeros(places, dtype=np.uint32)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash in the table, or the free one where it would go."""
        last = len(self.table) - 1
        place = (hashes >> np.uint64(65 - len(self.table).bit_length())).astype(np.int64)
        here = self.table[place]
        left = np.flatnonzero((here != hashes) & (here != 0))
        while len(left):
            place[left] = (place[left] + 1) & last
            here = self.table[place[left]]
            left = left[(here != hashes[left]) & (here != 0)]
        return place

    def _put(self, hashes: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> None:
        """Enters distinct hashes that the table does not hold; of several that want one place the last gets it first."""
        while len(hashes):
            place = self._places(hashes)
            self.table[place] = hashes
            own = self.table[place] == hashes
            self.at[place[own]], self.sizes[place[own]] = at[own], sizes[own]
            hashes, at, sizes = hashes[~own], at[~own], sizes[~own]

    def _remember(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Encodes the pieces, whose hashes are distinct and new, and keeps their ids."""
        # They are pieces of the pattern already: none is split again.
        encode = self.encoding._core_bpe.encode_single_piece
        found = [encode(piece.encode()) for piece in pieces]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(chain.from_iterable(found), dtype=np.uint16, count=int(sizes.sum()))
        if 2 * (self.known + len(hashes)) > len(self.table):
            held = np.flatnonzero(self.table)
            old = self.table[held], self.at[held], self.sizes[held]
            self._empty(1 << (2 * (self.known + len(hashes)) - 1).bit_length())
            self._put(*old)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + len(ids), dtype=np.uint16)])
        self._put(hashes, self.used + np.cumsum(sizes) - sizes, sizes)
        self.ids[self.used : self.used + len(ids)] = ids
        self.known, self.used = self.known + len(hashes), self.used + len(ids)

    def _plain(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_ordinary(text), dtype=np.uint16)

    def rows(self, part: T.Slice) -> list[np.ndarray]:
        """The ids of each row."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.uint16)] * len(part)
        quoted = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(part.data == 0x27)])[part.offsets]) > 0)
        for r in quoted:  # contractions have rules of their own
            out[r] = self._plain(part.text(r))
        marks = np.flatnonzero((part.data[:-1] == SPECIAL[0]) & (part.data[1:] == SPECIAL[1]))
        special = np.searchsorted(part.offsets, marks, side="right") - 1
        text = part.data.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        if not len(points):
            return out
        chars = np.concatenate([[0], np.cumsum(T.code_point_starts(part.data))])
        offsets = chars[part.offsets]
        unsettled = np.searchsorted(offsets, np.flatnonzero(~_settled()[points]), side="right") - 1
        exact = np.union1d(special, unsettled)
        for r in exact.tolist():
            out[r] = np.asarray(self.tokenizer.encode(part.text(r), add_special_tokens=False).ids, dtype=np.uint16)
        quoted = np.union1d(quoted, exact)
        starts = _piece_starts(points, offsets)
        ends = np.append(starts[1:], len(points))
        values = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        hashes = T.span_hashes(values ^ (values >> np.uint64(29)), starts, ends)
        hashes |= np.uint64(1)  # none is 0
        if self.known > REMEMBERED or self.used > REMEMBERED_IDS:
            self._forget()
        place = self._places(hashes)
        new = np.flatnonzero(self.table[place] == 0)
        if len(new):
            distinct, first = np.unique(hashes[new], return_index=True)
            spans = zip(starts[new[first]].tolist(), ends[new[first]].tolist())
            self._remember(distinct, [text[i:j] for i, j in spans])
            place = self._places(hashes)
        at, size = self.at[place].astype(np.int64), self.sizes[place].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(size)])
        every = self.ids[np.repeat(at - before[:-1], size) + np.arange(before[-1])]
        bounds = before[np.searchsorted(starts, offsets)]
        for r in np.setdiff1d(np.arange(len(part)), quoted):
            out[r] = every[bounds[r] : bounds[r + 1]]
        return out


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)
