"""Personal data in texts: plain identifiers, and disguised ones found through offset-preserving normalisation.

A transducer rewrites a text and keeps, for every character it writes, the source span it stands for. Its rules, in order:

* characters that Unicode calls compatible with ASCII ones (mathematical letters, full-width signs, circled and raised
  digits), decimal digits of all scripts, small capitals and letters in circles and squares, and look-alike letters of
  other scripts become ASCII, and characters without width vanish: one table, made from Unicode's properties and names and
  a list of look-alikes;
* character references and percent codes of @ and . become signs;
* letters that look like digits become digits within numbers that are digits for two thirds at least;
* runs of digits spelled in English, German, French or Spanish become digits, "double" and "triple" ones as often: with
  three dots or more in between an address, else seven digits or more, with a plus or half of them spelled;
* bracketed words for @ and . become signs (up to three blanks around each), and words framed by one sign on both sides,
  as in name*at*host*dot*tld;
* bare words, "name at host dot tld" and "name at host.tld", where host and tld look like labels and not like words of a
  sentence; the words of other languages for @ take theirs for the dot.

The plain detectors then read the rewritten text; what they find where something was rewritten is mapped back to source
characters and added, unless it overlaps a plain span of its kind. 10 to 15 rewritten digits count as a phone without a
plus if they were spelled and no other span has them. Letters set apart by blanks ("j o h n @ ...") are not put together.

Defined results: a null or empty text has no spans; every row is scanned by itself, whatever its id; texts are scanned
whole and in linear time; an empty table gives an empty result. Other columns are not read. Spans are code points, end exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from foliant.llm.common import id_text, sha256_hex, slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# --- plain detectors --------------------------------------------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _LOCAL.match(text[begin - 1]):
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((begin, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)  # nothing before this sign can belong to a later match
        at = text.find("@", max(done, at + 1))
    return out


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m[0].split("."))]


def luhn(digits: str) -> bool:
    odd = [int(d) for d in digits[::-1]]
    return (sum(odd[::2]) + sum(d * 2 - 9 * (d > 4) for d in odd[1::2])) % 10 == 0


def cards(text: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(text) if 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]


def plain(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the plain detectors, in order."""
    out = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(a, b, 1) for a, b in ips(text)]
        out += [(a, b, 2) for a, b in cards(text)]
        if "+" in text:
            out += [(a, b, 3) for a, b in phones(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


# --- the normalising transducer ---------------------------------------------------------------------------------------

# Letters of other scripts that look like ASCII ones, by their Unicode code charts: Cyrillic and Greek, Armenian,
# Cherokee, and Latin ones that no property ties to ASCII.
LOOK_ALIKES = str.maketrans(
    "АВЕКМНОРСТУХІЈЅасеорухіјѕһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαοινκρυχ" + "ՕօՍսոհցզաԼ" + "ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏚᏙᏞᏟᏢᏴᏦᎩᏔᏒ" + "ıɑɡȷ" + "。｡",
    "ABEKMHOPCTYXIJSaceopyxijshdqwABEZHIKMNOPTYXaoivkpux" + "OoUunhgqwL" + "DRTAJEWMHGZSVLCPBKyWR" + "iagj" + "..",
)
# Characters without width.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Digits spelled in English, German, French and Spanish.
DIGIT_WORDS = {
    w: str(d)
    for d, words in enumerate(
        [
            "zero oh null zéro cero",
            "one eins un une uno",
            "two zwei zwo deux dos",
            "three drei trois tres",
            "four vier quatre cuatro",
            "five fünf fuenf cinq cinco",
            "six sechs seis",
            "seven sieben sept siete",
            "eight acht huit ocho",
            "nine neun neuf nueve",
        ]
    )
    for w in words.split()
}
# Words before a digit that stands several times, words for a dot, and for a plus.
TIMES = {"double": 2, "doppel": 2, "doble": 2, "triple": 3}
DOTS, PLUS = ("dot", "point", "punkt", "punto"), ("plus", "más")

# ASCII letters that look like digits.
DIGIT_LIKE = str.maketrans("OoIlSBZ", "0011582")
# Character references and percent codes.
REFERENCES = {"&#64;": "@", "&#x40;": "@", "&commat;": "@", "%40": "@", "&#46;": ".", "&#x2e;": ".", "&period;": "."}

_REFERENCE = re.compile(r"(?i)\s{0,3}(?:" + "|".join(REFERENCES) + r")\s{0,3}")
_LIKE = "".join(map(chr, DIGIT_LIKE))
_NUMBER_LIKE = re.compile(rf"(?<![A-Za-z0-9])[0-9{_LIKE}](?:[ .-]?[0-9{_LIKE}])++(?![A-Za-z0-9])")
_LETTER_IN_NUMBER = re.compile(rf"[0-9][ .-]?[{_LIKE}]|[{_LIKE}][ .-]?[0-9]")
_NAMED = re.compile(r"(?:LATIN LETTER SMALL CAPITAL|MODIFIER LETTER (?:SMALL |CAPITAL )?|(?:NEGATIVE )?(?:CIRCLED|SQUARED|PARENTHESIZED) LATIN (?:CAPITAL|SMALL) LETTER|REGIONAL INDICATOR SYMBOL LETTER) ?([A-Z])")


def _folded(c: str) -> str | None:
    """What a character beyond ASCII stands for, None where it stands for itself."""
    if c in INVISIBLE:
        return ""
    if ord(c) in LOOK_ALIKES:
        return c.translate(LOOK_ALIKES)
    if c.isdigit():
        return str(unicodedata.digit(c))
    plain_form = unicodedata.normalize("NFKC", c)
    if plain_form.isascii():
        return plain_form if plain_form.strip() == plain_form and "..." not in plain_form else None
    named = _NAMED.fullmatch(unicodedata.name(c, ""))
    return named[1].lower() if named else None


@lru_cache
def _folds() -> dict[str, str]:
    """The characters beyond ASCII that stand for others: about two thousand, made once a worker."""
    found = ((chr(c), _folded(chr(c))) for c in (*range(0x80, 0xD800), *range(0xE000, 0x20000)))
    return {c: f for c, f in found if f is not None}


def _foreign(text: str) -> re.Pattern | None:
    """A pattern of the characters of a text that stand for others."""
    if text.isascii() or _folds().keys().isdisjoint(own := set(text)):
        return None
    return re.compile("[" + "".join(map(re.escape, sorted(own & _folds().keys()))) + "]")


_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_TIMES, _DOT, _PLUS = "|".join(TIMES), "|".join(DOTS), "|".join(PLUS)
#: Words without which nothing is spelled.
_SPELLING = frozenset(DIGIT_WORDS) | frozenset(DOTS)
#: Spelled digits and figures in a row, with "plus" and dots among them; _spelled_edits tells which runs count.
_FIGURE = r"[0-9]++(?:\.[0-9]++)*+"
_ONE = rf"(?:(?:{_TIMES})[\s,-]+)?(?:{_WORD})|{_FIGURE}"
_SPELLED = re.compile(rf"(?i)(?<![\w.])(?:(?:{_PLUS})[\s,-]+)?(?:{_ONE})(?:(?:[\s,-]+(?:{_DOT})[\s,-]+|[\s,-]+)(?:{_ONE}))+(?!\w)")
_SPELLED_PART = re.compile(rf"(?i)(?:{_PLUS})\b|(?:{_DOT})\b|(?:(?:{_TIMES})[\s,-]+)?(?:{_WORD})\b|{_FIGURE}")
_SIGN = r"[\[({{<]\s{{0,3}}(?:{0})\s{{0,3}}[\])}}>]"
_BRACKETED = re.compile(r"(?i)\s{0,3}(?:" + _SIGN.format("[aä]t|@|arroba|arobase") + "|" + _SIGN.format(r"d[o0]t|\.|punto|punkt|point") + r")\s{0,3}")
_FRAMED = re.compile(r"(?i)(?<![A-Za-z0-9])[A-Za-z0-9.+]{1,64}([*/|_~-])(at)\1[A-Za-z0-9]{1,63}(?:\1dot\1[A-Za-z0-9]{1,63})+(?![A-Za-z0-9])")
_IS_AT = re.compile(r"(?i)[aä]t|@|arroba|arobase")
_LABEL = r"[A-Za-z0-9-]{1,63}"
#: Bare words: "name at host dot tld", "name at host.tld".
_BARE = re.compile(rf"(?i)(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{{1,64}})(\s{{1,3}}at\s{{1,3}}|\s{{0,3}}@\s{{0,3}})({_LABEL}(?:(?:\s{{1,3}}dot\s{{1,3}}|\.){_LABEL})+)(?![A-Za-z0-9])")
#: The same with the words of other languages, which no sentence holds by chance.
_BARE_OTHER = re.compile(rf"(?i)(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{{1,64}})(\s{{1,3}}(?:arroba|arobase)\s{{1,3}})({_LABEL}(?:(?:\s{{1,3}}(?:{_DOT})\s{{1,3}}|\.){_LABEL})+)(?![A-Za-z0-9])")
_BARE_DOT = re.compile(rf"(?i)\s{{1,3}}(?:{_DOT})\s{{1,3}}|\.")
_TOP = re.compile(r"(?i)[a-z]{2,24}|xn--[a-z0-9-]{1,59}")
# Words of a sentence that are no first label after a bare "at", no last label after a bare "dot", and no name
# before an "at" that a host with written dots follows.
_NOT_FIRST = frozenset("the a an this that these those my your his her its our their each every some any no which what".split())
_NOT_LAST = frozenset("the an this that these those your his her its our their on and or of for with from was are were but if then than".split())
_NOT_NAME = frozenset("us me him her them it you is are was were be been look looking looked visit available found online hosted see here there page pages site website read more out up and or the live located posted published back today now work works working find sold only directly".split())


class Rewritten:
    """A text and, for each of its characters, the source span that it stands for."""

    def __init__(self, text: str) -> None:
        self.text, self.begin, self.end, self.changed = text, list(range(len(text))), list(range(1, len(text) + 1)), [False] * len(text)

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Edits (start, end, new) of the present text, in order and apart."""
        if not edits:
            return
        pieces, begin, end, changed, done = [], [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            pieces += [self.text[done:a], new]
            begin += self.begin[done:a] + [self.begin[a]] * len(new) if new else self.begin[done:a]
            end += self.end[done:a] + [self.end[b - 1]] * len(new) if new else self.end[done:a]
            changed += self.changed[done:a] + [True] * len(new)
            done = b
        self.text, self.begin, self.end, self.changed = "".join(pieces), begin, end, changed

    def source(self, a: int, b: int) -> Span:
        return self.begin[a], self.end[b - 1]

    def touched(self, a: int, b: int) -> bool:
        """Whether anything within was rewritten, or left out."""
        return any(self.changed[a:b]) or self.end[b - 1] - self.begin[a] != b - a


def _foreign_edits(text: str) -> list[tuple[int, int, str]]:
    foreign, folds = _foreign(text), _folds()
    return [(m.start(), m.end(), folds[m[0]]) for m in foreign.finditer(text)] if foreign else []


def _reference_edits(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), REFERENCES[m[0].strip().lower()]) for m in _REFERENCE.finditer(text)]


def _number_like_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _NUMBER_LIKE.finditer(text):
        letters = sum(map(str.isalpha, m[0]))
        if letters and sum(map(str.isdigit, m[0])) >= 2 * letters:
            out += [(i, i + 1, c.translate(DIGIT_LIKE)) for i, c in enumerate(m[0], m.start()) if c.isalpha()]
    return out


def _framed_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _FRAMED.finditer(text):
        out.append((m.start(2) - 1, m.end(2) + 1, "@"))
        dot = re.compile(f"(?i){re.escape(m[1])}dot{re.escape(m[1])}")
        out += [(*d.span(), ".") for d in dot.finditer(text, m.end(2) + 1, m.end())]
    return out


def _digits(word: str) -> str:
    """The digits that a part of a spelled run stands for: a figure's own, those of a word, twice or more of a doubled one."""
    if word in DIGIT_WORDS:
        return DIGIT_WORDS[word]
    first, _, last = word.replace(",", " ").replace("-", " ").partition(" ")
    return DIGIT_WORDS[last.strip()] * TIMES[first] if first in TIMES else word


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _SPELLED.finditer(text):
        words = [(p.start() + m.start(), p.end() + m.start(), p[0].lower()) for p in _SPELLED_PART.finditer(m[0])]
        spelled = sum(len(_digits(w)) for *_, w in words if w[0].isalpha() and w not in DOTS and w not in PLUS)
        dots = sum(w in DOTS for *_, w in words)
        figures = sum(len(w.replace(".", "")) for *_, w in words if w[0].isdigit())
        address = dots > 0 and dots + sum(w.count(".") for *_, w in words) >= 3
        # Seven digits or more with a plus, or mostly spelled ones; other figures beside a number word are left alone.
        number = spelled > 0 and spelled + figures >= 7 and (spelled >= 7 or words[0][2] in PLUS or 2 * spelled >= spelled + figures)
        if not address and not number:
            continue
        for i, (a, b, w) in enumerate(words):
            end = words[i + 1][0] if i + 1 < len(words) else m.end()
            # In an address only spelled digits join; a figure is a number of its own.
            if address and i + 1 < len(words) and (w[0].isdigit() or words[i + 1][2][0].isdigit()) and not {w, words[i + 1][2]} & {*DOTS, *PLUS}:
                end = b
            out.append((a, end, "+" if w in PLUS else "." if w in DOTS else _digits(w)))
    return out


def _bracket_edits(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "@" if _IS_AT.search(m[0]) else ".") for m in _BRACKETED.finditer(text)]


_OTHER_AT = re.compile("(?i)arroba|arobase")


def _bare_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in sorted([*_BARE.finditer(text), *(_BARE_OTHER.finditer(text) if _OTHER_AT.search(text) else ())], key=lambda m: m.start()):
        dots = [d.span() for d in _BARE_DOT.finditer(text, m.start(3), m.end(3))]
        ends = [a for a, _ in dots[1:]] + [m.end(3)]
        while dots and not (_TOP.fullmatch(last := text[dots[-1][1] : ends[-1]]) and (dots[-1][1] - dots[-1][0] == 1 or last.lower() not in _NOT_LAST)):
            dots.pop()
            ends.pop()
        if not dots:
            continue
        if "@" not in m[2] and (text[m.start(3) : dots[0][0]].lower() in _NOT_FIRST or (all(b - a == 1 for a, b in dots) and m[1].lower() in _NOT_NAME)):
            continue
        signs = [(*m.span(2), "@"), *((a, b, ".") for a, b in dots)]
        out += [(a, b, new) for a, b, new in signs if text[a:b] != new]
    return out


def _apart(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for e in sorted(edits):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


def _rules(text: str) -> list[Callable[[str], list]]:
    """The rewriting rules that can apply, by cheap signs."""
    out: list[Callable[[str], list]] = []
    if foreign := _foreign(text):
        out.append(_foreign_edits)
        text = foreign.sub(lambda m: _folds()[m[0]], text)
    low = text.lower()
    if ("&" in text or "%40" in text) and _REFERENCE.search(text):
        out.append(_reference_edits)
        low = _REFERENCE.sub(lambda m: REFERENCES[m[0].strip().lower()], low)
    if _DIGIT.search(text) and _LETTER_IN_NUMBER.search(text):
        out.append(_number_like_edits)
    if not _SPELLING.isdisjoint(low.replace(",", " ").replace("-", " ").split()) and _SPELLED.search(low):
        out.append(_spelled_edits)
    if any(x in low for x in "[({<") and _BRACKETED.search(low):
        out.append(_bracket_edits)
    if "at" in low and "dot" in low:
        out.append(_framed_edits)
    if "at" in low or "@" in low or _OTHER_AT.search(low):
        out.append(_bare_edits)
    return out


class _Taken:
    """Spans by kind, those of one kind in order; plain ones and others."""

    def __init__(self, plain_spans: list[tuple[int, int, int]]) -> None:
        self.plain = set(plain_spans)
        self.spans = [sorted((b, a) for a, b, k in plain_spans if k == kind) for kind in range(len(KINDS))]

    def free(self, x: int, y: int, kinds: Sequence[int]) -> bool:
        """Whether a span of the last of kinds meets nothing of them but plain spans of its own kind that it contains."""
        for k in kinds:
            own = self.spans[k]
            for i in range(bisect_left(own, (x + 1, -1)), len(own)):
                q, p = own[i]
                if p >= y:
                    break
                if not (k == kinds[-1] and (p, q, k) in self.plain and x <= p and q <= y):
                    return False
        return True

    def add(self, x: int, y: int, kind: int) -> None:
        insort(self.spans[kind], (y, x))


def disguised(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of identifiers that only the rewritten text shows."""
    rules, new = _rules(text), None
    for rule in rules:
        if edits := _apart(rule(new.text if new else text)):
            new = new or Rewritten(text)
            new.apply(edits)
    if new is None:
        return []
    taken, out = _Taken(found), []
    spans = [(*s, True) for s in plain(new.text)]
    if _spelled_edits in rules:
        # A run of spelled digits of a phone's length counts without a plus.
        spans += [(*m.span(), 3, False) for m in re.finditer(r"(?<![0-9+])[0-9]{10,15}(?![0-9])", new.text) if all(new.changed[m.start() : m.end()])]
    for a, b, kind, sure in sorted(spans, key=lambda s: (s[2], not s[3], s[0])):
        if new.touched(a, b):
            x, y = new.source(a, b)
            if taken.free(x, y, (kind,) if sure else range(len(KINDS))):
                out.append((x, y, kind))
                taken.add(x, y, kind)
    return out


def joined(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Plain spans, and added ones."""
    if not text:
        return [], []
    base = plain(text)
    return base, disguised(text, base)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"]
    for batch in batches:
        for part, texts in slices(batch):
            found = [scan(t) for t in texts]
            counts = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *counts, pa.array([len(more) for _, more in found], pa.int64()), pa.array([sha256_hex(joined(base, KINDS)) for base, _ in found], pa.string()), pa.array([joined(base + more, KINDS) for base, more in found], pa.string())],
                names=names,
            )


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of plain spans by kind, n_added, the digest of the plain spans, and all spans as kind:start:end."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return id_text(docs, id_col, text_col).mapInArrow(_scan, f"doc_id long, {counts}, n_added long, base_sha256 string, spans string")


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets."""
    if text is None:
        return None
    base, more = scan(text)
    out, done = [], 0
    for a, b, k in sorted(base + more):
        if b > done:
            out += [text[done : max(a, done)], f"[{KINDS[k]}]"]
            done = b
    return "".join(out) + text[done:]
