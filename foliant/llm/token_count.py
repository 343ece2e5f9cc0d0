"""Token counts by compiled finite-state transducers.

Two deterministic machines count what a BPE tokenizer with word ends would emit, without building the tokens:

* the splitter reads classes of code points and marks where pre-tokens start. Texts are cut into chunks; each chunk's map
  from every entry state to its exit state is computed for all chunks at once, the maps are composed by a parallel prefix
  scan, and a second sweep from the now known entry states writes the marks;
* the word machine reads a pre-token's symbols. A state is what the future can depend on: the longest suffix that begins a
  vocabulary entry, and for each of its positions the last token of the tokenisation that ends there and its count
  relative to the newest. Each transition carries the number of tokens that it adds, so a word's count is the sum over its
  path. Transitions are compiled when first taken and shared by all words of a worker.

Why last tokens are enough: with ordered merges, tokens t1 .. tn are the tokenisation of their text exactly if each two
neighbours are the tokenisation of theirs; so the last token of a prefix is the one token that fits what stands before it.

Defined results: a null or empty text has no tokens and no bytes; rows are counted one by one, whatever their id; an empty
table gives an empty result; very long texts are a slice of their own, and a long word is one path through the machine.
Other columns are not read.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import id_text, slices
from foliant.llm.pretokens import BLANK, END, FIRST_L, FIRST_R, FIRST_V, LETTER, NUMBER, OTHER, QUOTE, SECOND_E, SINGLE, SPACE, Memory, classes, unassigned
from foliant.llm.textcodes import code_points

#: Code points of a chunk of the splitter.
CHUNK = 256

# --- the splitter -----------------------------------------------------------------------------------------------------

#: Its states: between pre-tokens; in letters; after a number; in other signs; after a quote that could start a
#: contraction; after such a quote and r or v, and l; after a contraction.
GAP, IN_LETTERS, AFTER_NUMBER, IN_OTHER, AT_QUOTE, AT_RV, AT_L, CONTRACTED = range(8)
#: What a transition marks: a start at this code point, at the one before it, an end of all (white space).
HERE, ONE_BACK, OUTSIDE = 1, 2, 4


def _compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by state and class for  's|'t|'re|'ve|'m|'ll|'d|letters+|number|others+."""
    letters = {LETTER, SINGLE, FIRST_R, FIRST_V, FIRST_L, SECOND_E}
    step, marks = np.zeros((8, 12), np.uint8), np.zeros((8, 12), np.uint8)
    for state in range(8):
        for c in range(12):
            if c in (END, SPACE, BLANK):
                to, mark = GAP, OUTSIDE
            elif c == NUMBER:
                to, mark = AFTER_NUMBER, HERE
            elif c == QUOTE:
                to, mark = (IN_OTHER, 0) if state in (IN_OTHER, AT_QUOTE) else (AT_QUOTE, HERE)
            elif c == OTHER:
                to, mark = (IN_OTHER, 0) if state in (IN_OTHER, AT_QUOTE) else (IN_OTHER, HERE)
            elif state == AT_QUOTE and c == SINGLE:
                to, mark = CONTRACTED, 0
            elif state == AT_QUOTE and c in (FIRST_R, FIRST_V):
                to, mark = AT_RV, 0
            elif state == AT_QUOTE and c == FIRST_L:
                to, mark = AT_L, 0
            elif state == AT_RV and c == SECOND_E or state == AT_L and c == FIRST_L:
                to, mark = CONTRACTED, 0
            else:
                to, mark = IN_LETTERS, 0 if state in (IN_LETTERS, AT_RV, AT_L) else HERE
            assert c not in letters or to in (IN_LETTERS, AT_RV, AT_L, CONTRACTED)
            # A contraction that does not come about: the letter after the quote starts a pre-token of its own.
            if state in (AT_RV, AT_L) and to != CONTRACTED:
                mark |= ONE_BACK
            step[state, c], marks[state, c] = to, mark
    return step, marks


_STEP, _MARKS = _compile_splitter()


def _scan(maps: np.ndarray) -> np.ndarray:
    """Composition of all maps before each chunk, from state GAP: inclusive prefix scan by doubling, then one shift."""
    n, whole, width = len(maps), maps.copy(), 1
    while width < n:
        later = whole[width:].copy()
        whole[width:] = np.take_along_axis(later, whole[:-width].astype(np.int64), axis=1)
        width *= 2
    entry = np.zeros(n, np.uint8)
    entry[1:] = whole[:-1, GAP]
    return entry


def split(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of joined texts; ends are the places of the texts' separators."""
    c = classes(codes)
    c[ends] = END
    n = -(-len(c) // CHUNK)
    grid = np.full((CHUNK, n), END, np.uint8)
    padded = np.full(n * CHUNK, END, np.uint8)
    padded[: len(c)] = c
    grid[:] = padded.reshape(n, CHUNK).T
    step, marks = _STEP.ravel(), _MARKS.ravel()
    states = np.repeat(np.arange(8, dtype=np.uint8)[:, None], n, axis=1)
    for j in range(CHUNK):
        states = step[states * np.uint8(12) + grid[j]]
    state = _scan(np.ascontiguousarray(states.T))
    out = np.empty((CHUNK, n), np.uint8)
    for j in range(CHUNK):
        at = state * np.uint8(12) + grid[j]
        out[j] = marks[at]
        state = step[at]
    flags = out.T.reshape(-1)[: len(c)]
    start = (flags & HERE) > 0
    start[:-1] |= (flags[1:] & ONE_BACK) > 0
    edge = start | ((flags & OUTSIDE) > 0)
    at = np.flatnonzero(edge)
    stop = np.append(at[1:], len(c))
    keep = start[at]
    return at[keep], stop[keep]


# --- the word machine -------------------------------------------------------------------------------------------------


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordMachine:
    """Lazily compiled transducer of an ordered-merge BPE over symbols, the last of a word with the end mark."""

    def __init__(self, merges: list[tuple[str, str]], end: str, most_states: int = 200_000) -> None:
        self.end, self.most = end, most_states
        self.rank = {pair: i for i, pair in reversed(list(enumerate(map(tuple, merges))))}
        self.symbol = byte_symbols()
        # Tokens as tuples of symbols; the end mark belongs to its symbol.
        self.tokens: dict[tuple[str, ...], str] = {}
        for pair in self.rank:
            for t in (*pair, "".join(pair)):
                self.tokens[self._parts(t)] = t
        self.starts = {p[:i] for p in self.tokens for i in range(1, len(p) + 1)}
        self.edges: dict[str, tuple | None] = {}
        # Every piece of a merge is made by an earlier one: then merges along a text's way go by rank.
        made: dict[str, int] = {}
        for pair, i in self.rank.items():
            made["".join(pair)] = min(i, made.get("".join(pair), i))
        self.ordered = all(made.get(x, -1) < i for pair, i in self.rank.items() for x in pair)
        self._reset()

    def _reset(self) -> None:
        # A state: (longest suffix that begins a token, last token and relative count at each of its positions).
        self.states: list[tuple] = [((), ((None, 0),))]
        self.number = {self.states[0]: 0}
        self.trans: list[dict[str, tuple[int, int]]] = [{}]

    def _parts(self, token: str) -> tuple[str, ...]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return (*body[:-1], body[-1] + self.end)
        return tuple(token)

    def tokenise(self, symbols: tuple[str, ...]) -> list[str]:
        """Merges by rank, leftmost first: what the transducer's compilation rests on."""
        parts = list(symbols)
        while len(parts) > 1:
            low = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if low[0] == len(self.rank):
                break
            i = low[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _own(self, token: str) -> bool:
        """Whether merging a token's symbols gives the token; keeps the pieces along its two edges.

        An edge is a list of (piece, rank of the merge that ends it), from the single symbol to the token itself.
        """
        if token not in self.edges:
            parts, rank, left, right = list(self._parts(token)), self.rank, [], []
            while len(parts) > 1:
                low, i = min((rank.get(p, len(rank)), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
                if low == len(rank):
                    break
                if i == 0:
                    left.append((parts[0], low))
                if i == len(parts) - 2:
                    right.append((parts[-1], low))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            never = len(rank)
            self.edges[token] = ([*left, (token, never)], [*right, (token, never)]) if parts == [token] else None
        return self.edges[token] is not None

    def _fit(self, left: str, right: str) -> bool:
        """Whether two tokens are the tokenisation of their joined text: no merge across the border comes before the
        merges that end its two pieces (at equal rank the leftmost merge comes first)."""
        if not self.ordered:
            return self.tokenise(self._parts(left) + self._parts(right)) == [left, right]
        rank, never = self.rank, len(self.rank)
        self._own(left)
        self._own(right)
        for x, x_ends in self.edges[left][1]:
            for y, y_ends in self.edges[right][0]:
                r = rank.get((x, y), never)
                if r < never and r < x_ends and r <= y_ends:
                    return False
        return True

    def _compile(self, number: int, symbol: str) -> tuple[int, int]:
        suffix, window = self.states[number]
        text = (*suffix, symbol)
        # window[i]: last token and count (relative to the newest) after the first i symbols of suffix.
        found = None
        for i in range(len(text)):
            part = text[i:]
            token = self.tokens.get(part) if len(part) > 1 else symbol
            if token is None or not self._own(token):
                continue
            left = window[i][0]
            if left is None or self._fit(left, token):
                found = (token, window[i][1] + 1)
                break
        assert found, "some single symbol always fits"
        added = found[1]
        keep = 0
        while keep < len(text) and text[keep:] not in self.starts:
            keep += 1
        full = (*window, found)
        to = (text[keep:], tuple((t, n - added) for t, n in full[keep:]))
        if to not in self.number:
            self.number[to] = len(self.states)
            self.states.append(to)
            self.trans.append({})
        self.trans[number][symbol] = done = (self.number[to], added)
        return done

    def count(self, word: str) -> int:
        symbols = [self.symbol[b] for b in word.encode()]
        symbols[-1] += self.end
        if len(self.states) > self.most:
            self._reset()
        at, total, trans = 0, 0, self.trans
        for s in symbols:
            go = trans[at].get(s)
            at, added = go if go else self._compile(at, s)
            total += added
        return total


class TokenCounter:
    """Counts for a tokenizers file of the kind: NFC, white space to blanks, lower case; the splitter's pattern; word BPE."""

    def __init__(self, path: str) -> None:
        from tokenizers import normalizers

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        kinds = [n["type"] for n in file["normalizer"]["normalizers"]]
        pattern = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if kinds != ["NFC", "Replace", "Lowercase"] or pattern != r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" or model["type"] != "BPE":
            raise ValueError("no transducer is known for this kind of tokenizer")
        self.machine = WordMachine(model["merges"], model["end_of_word_suffix"] or "")
        self.memory = Memory(lambda words: [[self.machine.count(w)] for w in words])
        added = [t["content"] for t in file["added_tokens"]]
        self.added = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        # Characters newer than Python's Unicode version are the library's to compose and lower.
        newer = unassigned()
        self.beyond = re.compile(f"[^\0-{chr(ord(newer[0]) - 1)}]")
        self.newer = np.zeros(sys.maxunicode + 1, bool)
        self.newer[[ord(c) for c in newer]] = True
        self.nfc, self.lower = normalizers.NFC().normalize_str, normalizers.Lowercase().normalize_str

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        extra = np.zeros(len(texts), np.int64)
        plain = []
        for i, t in enumerate(texts):
            t = t or ""
            if self.added and "<" in t and (n := len(self.added.findall(t))):
                # An added token counts one and parts what stands around it.
                extra[i], t = n, self.added.sub("\n", t)
            if t.isascii():
                plain.append(t.lower())
            elif self.beyond.search(t) and self.newer[code_points([t])[0]].any():
                plain.append(self.lower(self.nfc(t)))
            else:
                plain.append(unicodedata.normalize("NFC", t).replace("Σ", "σ").lower())  # sigma without regard to its place
        codes, ends = code_points(plain)
        joined = "\0".join(plain)
        starts, stops = split(codes, ends)
        entries = self.memory.look_up(lambda a, b: joined[a:b], codes, starts, stops)
        counts = self.memory.flat[self.memory.offset[entries]].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.searchsorted(starts, ends)])]
        return np.diff(total) + extra


_COUNTERS: dict[str, TokenCounter] = {}


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = TokenCounter(path)
        for batch in batches:
            for part, texts in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(_COUNTERS[path](texts))], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every document."""
    texts = id_text(docs, id_col, text_col).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return texts.mapInArrow(_counts(tokenizer), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
