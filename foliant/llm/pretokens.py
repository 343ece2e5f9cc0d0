"""Pre-tokens of whole slices of text at once, and a bounded memory of what a tokenizer gives for each."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

import numpy as np

from foliant.llm.common import kept
from foliant.llm.textcodes import code_points, hash_spans

#: Classes of code points; letters of contractions have their own, as they can follow an apostrophe.
END, SPACE, OTHER, NUMBER, LETTER, QUOTE = range(6)
BLANK = 6  # U+0020
SINGLE = 7  # s t m d
FIRST_R, FIRST_V, FIRST_L, SECOND_E = 8, 9, 10, 11
_TABLE: list[np.ndarray] = []


#: Planes beyond this one have no characters of their own yet, but for marks.
_PLANES = 0x40000


def unassigned() -> str:
    """The code points that Python's Unicode version has no character for; the library's may be newer."""
    return "".join(c for c in map(chr, range(_PLANES)) if unicodedata.category(c) == "Cn")


def classes(codes: np.ndarray) -> np.ndarray:
    if not _TABLE:
        from tokenizers import Regex, pre_tokenizers

        table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
        for c in range(sys.maxunicode + 1):
            kind = unicodedata.category(chr(c))[0]
            if kind in "LN":
                table[c] = LETTER if kind == "L" else NUMBER
        # What Python does not know, the library tells.
        rest = unassigned()
        points = np.array([ord(c) for c in rest])
        for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
            own = np.ones(len(points), bool)
            for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(rest):
                own[a:b] = False
            table[points[own]] = kind
        table[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
        table[32] = BLANK
        table[39] = QUOTE
        table[[ord(c) for c in "stmd"]] = SINGLE
        table[[ord(c) for c in "rvle"]] = FIRST_R, FIRST_V, FIRST_L, SECOND_E
        _TABLE.append(table)
    return _TABLE[0][codes]


def byte_level_starts(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of the byte-level pattern: contractions, then runs of letters, numbers or other
    signs with the blank before them, then white space without the blank that goes to what follows."""
    c = classes(codes)
    c[ends] = END
    kind = np.array([END, SPACE, OTHER, NUMBER, LETTER, OTHER, SPACE, *[LETTER] * 5], np.uint8)[c]
    before = np.empty_like(kind)
    before[0], before[1:] = END, kind[:-1]
    blank_before = np.zeros(len(c), bool)
    blank_before[1:] = c[:-1] == BLANK
    run = kind != before
    start = run & ~(blank_before & (kind != SPACE) & (kind != END))
    # The last white space before something else starts a pre-token: with what follows if it is a blank, else alone.
    last = np.zeros(len(c), bool)
    last[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END)
    start |= last
    # Contractions start at a quote that starts a run after no blank.
    quote = np.flatnonzero((c == QUOTE) & run & ~blank_before)
    quote = quote[quote + 2 < len(c)]
    if len(quote):
        one, two = c[quote + 1], c[quote + 2]
        short = one == SINGLE
        long = ((one == FIRST_R) | (one == FIRST_V)) & (two == SECOND_E) | (one == FIRST_L) & (two == FIRST_L)
        start[quote[short | long] + 1] = False
        after = np.concatenate([quote[short] + 2, quote[long & ~short] + 3])
        after = after[after < len(c)]
        start[after[kind[after] == LETTER]] = True
    start[ends] = True
    at = np.flatnonzero(start)
    stop = np.append(at[1:], len(c))
    keep = kind[at] != END
    return at[keep], stop[keep]


class Memory:
    """What a function of a string gives (a list of ints), kept by the string's hash; emptied when it holds too much."""

    def __init__(self, make: Callable[[list[str]], list[list[int]]], most: int = 1_500_000) -> None:
        self.make, self.most = make, most
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.place = np.empty(0, np.int64)
        self.offset = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.int32)

    def look_up(self, text: Callable[[int, int], str], codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The entries' numbers for the spans [starts, ends) of codes; text gives a span's string."""
        hashes, where, inverse = np.unique(hash_spans(codes, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > self.most:
            self._clear()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        entry = np.empty(len(hashes), np.int64)
        entry[known] = self.place[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            made = self.make([text(a, b) for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            entry[new] = len(self.offset) - 1 + np.arange(len(new))
            self.offset = np.concatenate([self.offset, self.offset[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, np.fromiter((x for ids in made for x in ids), np.int32, int(sizes.sum()))])
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.place = np.insert(self.place, at[new], entry[new])
        return entry[inverse]

    def counts(self, entries: np.ndarray) -> np.ndarray:
        return self.offset[entries + 1] - self.offset[entries]

    def ids(self, entries: np.ndarray) -> np.ndarray:
        """All entries' ids, one after another."""
        n = self.counts(entries)
        total = np.cumsum(n)
        shift = np.repeat(self.offset[entries] - (total - n), n)
        return self.flat[shift + np.arange(len(shift))]


class ByteLevelEncoder:
    """Ids of whole texts under a byte-level BPE file, as the tokenizers library gives them.

    A pre-token alone has the same ids as within its text, so each different one is encoded once by the library. Texts
    that hold an added token's string go through the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory(self._make)

    def _make(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for x in range(0, len(texts), 4096) for e in self.tokenizer.encode_batch_fast(texts[x : x + 4096], add_special_tokens=False)]

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        odd = {i: self.tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if t and any(a in t for a in self.added)}
        plain = ["" if i in odd else t for i, t in enumerate(texts)]
        codes, ends = code_points(plain)
        joined = "\0".join(t or "" for t in plain)
        starts, stops = byte_level_starts(codes, ends)
        entries = self.memory.look_up(lambda a, b: joined[a:b], codes, starts, stops)
        ids, n = self.memory.ids(entries), self.memory.counts(entries)
        before = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.searchsorted(starts, ends)])]
        if odd:
            pieces = [np.array(odd[i], np.int32) if i in odd else ids[before[i] : before[i + 1]] for i in range(len(texts))]
            return np.concatenate(pieces), np.array([len(p) for p in pieces])
        return ids, np.diff(before)


def byte_level_encoder(path: str) -> ByteLevelEncoder:
    """One for each file and worker process, as its memory pays off over tasks."""
    return kept("byte_level", path, lambda: ByteLevelEncoder(path))
