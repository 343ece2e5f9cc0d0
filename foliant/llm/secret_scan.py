"""Secrets in texts: plain patterns, and random strings told from ordinary identifiers by two Markov models.

Both models count pairs of characters in labelled samples: the values that the plain patterns find in labelled documents,
and generated random strings, on one side; all other runs of these documents, and identifiers in the usual spellings, on
the other. A candidate (a run of 16 or more letters, digits and + / _ = - with a letter, that no plain span touches) is a
secret if its log-likelihood ratio for each character reaches the limit of its class: letters of one case, which may be a
word of any language, or all others. The limits are chosen on documents that were not trained on, and with models that have
not seen their languages either: the least ones at which no more than FALSE_RATE of the strings that these documents' words
make, joined in the usual spellings, pass for secrets.

Sequences of neighbouring characters, strings of few different ones, and codes of short parts are no candidates.

Defined results: a null or empty text has no spans; every row is scanned by itself; texts are scanned whole; an empty table
gives an empty result. Without labels the models know generated strings alone, and the limits are the fixed ones. Other
columns are not read. Spans are code points, end exclusive.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import id_text, removed, sha256_hex, slices, written
from foliant.llm.personal_data import joined

KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Limits (letters of one case, others) where fewer than ENOUGH ordinary strings are there to choose them on, and the part
#: of these that may pass.
LIMITS, ENOUGH, FALSE_RATE = (2.0, 1.25), 500, 1e-3
#: Parts that the labelled documents' languages are dealt to.
FOLDS = 4
#: Hashes of labelled ids that are told apart before texts are moved: a bitmap of 1 MB, however many labels there are.
SLOTS = 1 << 23

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_HINTS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
#: Identifiers that name things and open nothing.
_UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
# Ordinary identifiers, so that the model knows joined and underscored words without any sample.
ORDINARY = """getElementById setAttribute addEventListener application/json content-type max_value_length user_name
database_connection_string configuration_manager is_enabled http_response_status document_identifier toString
LoadBalancerConfiguration requestTimeoutSeconds number_of_partitions shuffle_read_bytes internationalization
default_character_encoding background-color text-decoration windowInnerHeight createTemporaryDirectory
SparkListenerEvent last_modified_date primary_key_constraint README CHANGELOG LICENSE MAX_RETRY_COUNT
ENVIRONMENT_VARIABLE_NAME self_attention_layer learning_rate_schedule gradient_accumulation_steps
x86_64-pc-windows-msvc aarch64-apple-darwin /usr/local/share/doc /etc/systemd/system /home/user/projects/src/main
/var/lib/docker/overlay2 python3-dev lib/python3/site-packages utf8_general_ci sha256sum base64_decode
i18n/locale/en_US 2024-01-15T10-30-00 release-v2.10.3 node_modules/webpack/lib ubuntu-22-04-lts
H2O_MODEL_V3 int64_t uint8_array md5_hash_of_file gpt2_tokenizer_config mp3_to_wav Level2Category3
https//www/index/page2 wp-content/uploads/2019/03/image-150x150 com/example/project/v1beta1/resources""".split()


# Words that identifiers are made of.
WORDS = """get set is has add remove update create delete find load save read write open close init start stop run parse build
make user name id key value list map item index count size file path data type node text string number date time page
request response error message event handler service client server config option setting manager factory builder model
view controller test util helper abstract base default custom local remote public private internal global cache buffer
stream batch queue thread lock process task job account address order product customer image video audio color width
height length min max sum total first last next previous parent child root left right top bottom source target input
output result status state code version format encoding language country region project module package class method
function variable parameter argument field column table row database schema query filter sort group join""".split()


def ordinary_strings(n: int, seed: int = 5) -> list[str]:
    """Identifiers and paths of two to five words in the usual spellings, the labelled samples of the other model."""
    own = random.Random(seed)
    out = []
    for i in range(n):
        w = [own.choice(WORDS) for _ in range(own.randint(2, 5))]
        if own.random() < 0.3:
            w[own.randrange(len(w))] += str(own.choice((1, 2, 3, 8, 10, 16, 32, 64, 100, 256, 2019, 2024)))
        kinds = (w[0] + "".join(x.capitalize() for x in w[1:]), "".join(x.capitalize() for x in w), "_".join(w), "-".join(w), "_".join(w).upper(), "/" + "/".join(w), "/".join(w), "=".join(w[:2]))
        out.append(kinds[i % len(kinds)])
    return out


def plain(text: str) -> list[tuple[int, int, int]]:
    low = text.lower()
    out = [(*m.span(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6] if any(h in low for h in _HINTS) else []
    if "AKIA" in text:
        out += [(*m.span(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return sorted(out + [(*m.span(), 2) for m in _HEX.finditer(text)], key=lambda s: (s[0], s[2]))


_INDEX = np.full(128, -1, np.int64)
_INDEX[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def pair_counts(strings: Iterable[str]) -> np.ndarray:
    """Counts of neighbouring characters; row len(ALPHABET) is a string's start."""
    n = len(ALPHABET)
    at = _INDEX[np.frombuffer("".join(f"\n{s}" for s in strings).encode(), np.uint8)]
    at[at < 0] = n
    first, second = at[:-1], at[1:]
    inside = second < n
    return np.bincount(first[inside] * n + second[inside], minlength=(n + 1) * n).reshape(n + 1, n)


def random_strings(n: int, seed: int = 7) -> list[str]:
    """Random strings over the alphabets that secrets use, the labelled samples of their model."""
    own = random.Random(seed)
    alphabets = ["0123456789abcdef", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", ALPHABET[:62], ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "_-"]
    return ["".join(own.choice(alphabets[i % len(alphabets)]) for _ in range(own.randint(16, 48))) for i in range(n)]


def ratio(random_counts: np.ndarray, ordinary_counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each pair, both models smoothed by one half."""

    def model(c: np.ndarray) -> np.ndarray:
        return np.log((c + 0.5) / (c + 0.5).sum(axis=1, keepdims=True))

    return model(random_counts) - model(ordinary_counts)


def score(text: str, ratios: np.ndarray) -> float:
    """Mean log-likelihood ratio of a string's characters."""
    at = _INDEX[np.frombuffer(text.encode(), np.uint8)]
    return float((ratios[len(ALPHABET), at[0]] + ratios[at[:-1], at[1:]].sum()) / len(at))


def _apart(base: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of spans."""
    starts, ends = [], []
    for p, q, _ in sorted(base):
        if ends and p <= ends[-1]:
            ends[-1] = max(ends[-1], q)
        else:
            starts.append(p)
            ends.append(q)
    return starts, ends


def one_case(s: str) -> bool:
    """Whether a string may be a word: letters of one case, the first one a capital or not."""
    return s.isalpha() and (s[1:].islower() or s.isupper())


_PART = re.compile(r"[_=/+-]+")


def candidate(s: str) -> bool:
    """Rulers, numbers and UUIDs are no secrets, nor are sequences, repeated characters and codes of short parts; what else
    has a letter is for the models to tell."""
    if not any(c.isalpha() for c in s) or _UUID.fullmatch(s) or len(set(s.lower())) < 6:
        return False
    if max(map(len, _PART.split(s))) < 8:
        return False
    steps = sum(abs(ord(x) - ord(y)) <= 1 for x, y in zip(s, s[1:], strict=False))
    return 2 * steps < len(s)


def added(text: str, base: list[tuple[int, int, int]], model: tuple[np.ndarray, tuple[float, float]]) -> list[tuple[int, int, int]]:
    ratios, limits = model
    out = []
    starts, ends = _apart(base)
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        s = m[0]
        k = bisect_right(ends, a)
        if k < len(starts) and starts[k] < b:
            continue
        if candidate(s) and score(s, ratios) >= limits[not one_case(s)]:
            out.append((a, b, 3))
    return out


# --- training ---------------------------------------------------------------------------------------------------------


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str | None) -> DataFrame:
    """text, fold (by language) and held of all labelled documents. A bitmap of the labels' hashes keeps nearly all other
    texts from the exact join."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    words = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("__bits"))
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.pmod(F.xxhash64(lang), F.lit(FOLDS)).cast("int").alias("fold"))
    near = texts.where("text is not null").withColumn("__slot", slot).join(F.broadcast(words), F.shiftright("__slot", 6) == F.col("__word"))
    near = near.where("shiftright(__bits, cast(__slot % 64 as int)) & 1 = 1").select("doc_id", "text", "fold")
    held = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    return near.hint("merge").join(ids.distinct(), "doc_id").select("text", "fold", held.alias("held"))


def values_and_rest(text: str) -> tuple[list[str], list[str]]:
    """The values of a text's plain secrets, and its runs of four or more characters elsewhere."""
    values, rest, done = [], [], 0
    for a, b, kind in plain(text):
        values.append(_ASSIGN.match(text, a)[2] if kind == 0 else text[a:b])
        if a > done:
            rest.append(text[done:a])
        done = max(done, b)
    runs = [w for p in [*rest, text[done:]] for w in _RUN.findall(p) if not w.isdigit()]
    return [v for v in map(_kept, values) if v], runs


def _kept(value: str) -> str:
    return "".join(c for c in value if c in ALPHABET)


def joined_words(words: list[str]) -> list[str]:
    """Strings of 16 characters or more that neighbouring words make in the usual spellings."""
    out, at = [], 0
    while at < len(words):
        own, size = [], 0
        while at < len(words) and size < 16:
            own.append(words[at])
            size += len(words[at])
            at += 1
        if size < 16:
            break
        w = [x.lower() for x in own]
        spelled = ("".join(w), w[0] + "".join(x.capitalize() for x in w[1:]), "_".join(w), "".join(w).capitalize(), "-".join(w), "/".join(w), "_".join(w).upper(), "".join(w).upper())
        out.append(spelled[len(out) % len(spelled)])
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of characters (fold, secret, a, b, n) of the documents that are not held out."""
    n = len(ALPHABET)
    total = np.zeros((FOLDS, 2, n + 1, n), np.int64)
    for batch in batches:
        for text, fold, held in zip(*(batch.column(c).to_pylist() for c in ("text", "fold", "held")), strict=True):
            if not held:
                values, runs = values_and_rest(text)
                total[fold, 1] += pair_counts(values)
                total[fold, 0] += pair_counts(runs)
    at = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int32()) for x in at), pa.array(total[at])], names=["fold", "secret", "a", "b", "n"])


def _judge(shared):
    """Scores (letters, secret, score in hundredths, n) of the held-out documents' strings, each by the model of other
    languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text, fold, held in zip(*(batch.column(c).to_pylist() for c in ("text", "fold", "held")), strict=True):
                if held:
                    values, runs = values_and_rest(text)
                    ordinary = joined_words([w for r in runs for w in re.findall("[A-Za-z]{2,}", r)])
                    for secret, strings in ((1, [v for v in values if len(v) >= 16]), (0, ordinary)):
                        for x in filter(candidate, strings):
                            found[one_case(x), secret, int(np.floor(score(x, shared.value[fold]) * 100))] += 1
        rows = [(*k, n) for k, n in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.bool_(), pa.int32(), pa.int32(), pa.int64()))], names=["letters", "secret", "score", "n"])

    return run


def train(docs: DataFrame, labels: DataFrame | None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> tuple[np.ndarray, tuple[float, float]]:
    """The pairs' log-likelihood ratios, and the limits for letters of one case and for others.

    All labelled documents count; a third of them, by a hash of the id, is held out for the limits.
    """
    n = len(ALPHABET)
    counts = np.zeros((FOLDS, 2, n + 1, n), np.int64)
    ordinary, drawn = pair_counts(list(ORDINARY) * 5 + ordinary_strings(6000)), pair_counts(random_strings(6000))
    if labels is None:
        return ratio(drawn, ordinary), LIMITS
    known = written(_labelled(docs, labels, id_col, text_col, lang_col), "labelled")
    for r in known.mapInArrow(_count, "fold int, secret int, a int, b int, n long").groupBy("fold", "secret", "a", "b").agg(F.sum("n").alias("n")).collect():
        counts[r.fold, r.secret, r.a, r.b] = r.n
    model = lambda c: ratio(drawn + c[1], ordinary + c[0])
    whole = counts.sum(axis=0)
    apart = known.sparkSession.sparkContext.broadcast([model(whole - counts[f]) for f in range(FOLDS)])
    judged = known.mapInArrow(_judge(apart), "letters boolean, secret int, score int, n long").where("secret = 0").groupBy("letters", "score").agg(F.sum("n").alias("n")).collect()
    removed(known)
    return model(whole), tuple(_limit([(r.score, r.n) for r in judged if r.letters == letters], default) for letters, default in zip((True, False), LIMITS, strict=True))


def _limit(scores: list[tuple[int, int]], default: float) -> float:
    """The least limit that no more than FALSE_RATE of so many scores (in hundredths, rounded down) reach."""
    total = sum(n for _, n in scores)
    if total < ENOUGH:
        return default
    above, limit = 0, 0.0
    for s, n in sorted(scores, reverse=True):
        above += n
        if above > FALSE_RATE * total:
            limit = (s + 1) / 100
            break
    return limit


_RUN = re.compile(r"[A-Za-z0-9+/_=-]{4,}")


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        for batch in batches:
            for part, texts in slices(batch):
                base = [plain(t) if t else [] for t in texts]
                more = [added(t, b, shared.value) if t else [] for t, b in zip(texts, base, strict=True)]
                counts = [pa.array([sum(s[2] == k for s in x) for x in (more if k == 3 else base)], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, pa.array([sha256_hex(joined(b, KINDS)) for b in base], pa.string()), pa.array([joined(b + m, KINDS) for b, m in zip(base, more, strict=True)], pa.string())], names=names)

    return run


def find_secrets(docs: DataFrame, model: tuple[np.ndarray, tuple[float, float]], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of plain spans by kind and of random strings, the digest of the plain spans, and all spans. model: as
    train() gives it."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return id_text(docs, id_col, text_col).mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(model)), f"doc_id long, {counts}, base_sha256 string, spans string")
