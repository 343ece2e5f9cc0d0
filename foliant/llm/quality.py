"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame and SQL functions only.

Words and word pairs are hashed to BUCKETS. One multinomial over buckets is estimated from all documents (raw), one from
trusted documents (target), each smoothed by one; a bucket's weight is the log of their ratio in thousandths, rounded. A
document's score is the sum of its n-grams' weights over their number; documents that pass the base rules are kept if it
reaches the threshold. Weights and sums are whole numbers, so the verdict never depends on the order of additions.

Defined results: a null or empty text has no words and fails the base rules; rows are judged one by one, whatever their
id; without trusted documents all weights are equal and the score decides nothing; an empty table gives an empty result.
Texts are taken whole: the words of one text are one array, so a text has to fit a task, as any Spark string does.
Three-word windows, words and lines are compared by 64-bit hashes or as strings. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import id_text

BUCKETS = 1 << 14
#: Trusted documents that the target is estimated from at most: those whose ids have the least hashes.
TRUSTED_DOCUMENTS = 20_000
#: Mean weight, in nats, under which a document goes.
THRESHOLD = -0.1

_SPACE = r"[\\x20\\x09-\\x0D]"
_TRIM = r"' \t\n\u000B\u000C\r'"
#: The words of text; an array that is evaluated once, as w, by _let.
_WORDS = rf"if(btrim(text, {_TRIM}) = '' or text is null, cast(array() as array<string>), split(btrim(text, {_TRIM}), '{_SPACE}+'))"
_NONE = "cast(array() as array<bigint>)"
_WINDOWS = f"if(size(h) >= 3, transform(sequence(0, size(h) - 3), i -> xxhash64(h[i], h[i + 1], h[i + 2])), {_NONE})"
_LINES = rf"filter(split(coalesce(text, ''), '\n'), x -> btrim(x, {_TRIM}) != '')"


def _let(value: str, name: str, body: str) -> str:
    """body with name bound to value, so that an expensive value is computed once a row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


#: Words in windows that occur twice: hashes sorted with their places, equal neighbours, then the union of their spans.
_REPEATED = _let(
    _WINDOWS,
    "v",
    "if(size(array_distinct(v)) = size(v), 0, "
    + _let(
        "sort_array(transform(v, (x, i) -> struct(x as x, i as i)))",
        "s",
        "aggregate(sort_array(filter(transform(s, (e, j) -> if((j > 0 and s[greatest(j - 1, 0)].x = e.x) or (j < size(s) - 1 and s[least(j + 1, size(s) - 1)].x = e.x), e.i, cast(null as int))), p -> p is not null)), "
        "named_struct('c', 0, 'e', 0), (a, p) -> named_struct('c', a.c + p + 3 - greatest(p, a.e), 'e', p + 3), a -> a.c)",
    )
    + ")",
)


def _grams(buckets: int) -> str:
    return f"concat(transform(h, x -> cast(pmod(x, {buckets}) as int)), if(size(h) >= 2, transform(sequence(0, size(h) - 2), i -> cast(pmod(xxhash64(h[i], h[i + 1]), {buckets}) as int)), cast(array() as array<int>)))"


def _hashes(body: str) -> str:
    return _let(_WORDS, "w", _let("transform(w, x -> xxhash64(x))", "h", body))


def weights(docs: DataFrame, trusted: DataFrame | None, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, trusted_documents: int = TRUSTED_DOCUMENTS) -> str:
    """The buckets' weights in order, comma-joined: one short number a bucket reaches the driver.

    trusted: a table whose doc_id column names the trusted documents.
    """
    texts = id_text(docs, id_col, text_col)
    if trusted is None:
        texts = texts.withColumn("good", F.lit(0))
    else:
        ids = trusted.select(F.col("doc_id").cast("long").alias("__id")).where("__id is not null").distinct().orderBy(F.xxhash64("__id"), "__id").limit(trusted_documents)
        texts = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("__id"), "left").withColumn("good", F.col("__id").isNotNull().cast("int"))
    counts = texts.select("good", F.explode(F.expr(_hashes(_grams(buckets)))).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0, ["raw", "good"])
    total = every.agg(F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))
    ratio = F.log((F.col("good") + 1) / (F.col("all_good") + buckets)) - F.log((F.col("raw") + 1) / (F.col("all_raw") + buckets))
    weighed = every.join(F.broadcast(total)).select("bucket", F.round(ratio * 1000).cast("int").alias("weight"))
    return weighed.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "weight"))), lambda x: x["weight"].cast("string")), ",")).first()[0]


def judge(docs: DataFrame, weight_list: str, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """The base figures, base_failed, score (in nats for each n-gram) and kept of every document."""
    table = f"cast(split('{weight_list}', ',') as array<int>)"
    pairs = f"if(size(h) >= 2, aggregate(sequence(0, size(h) - 2), 0L, (a, i) -> a + {table}[cast(pmod(xxhash64(h[i], h[i + 1]), {buckets}) as int)]), 0L)"
    figures = _hashes(f"named_struct('n_words', cast(size(w) as bigint), 'word_chars', cast(char_length(array_join(w, '')) as bigint), 'n_repeat_words', cast({_REPEATED} as bigint), 'total', aggregate(h, 0L, (a, x) -> a + {table}[cast(pmod(x, {buckets}) as int)]) + {pairs})")
    lines = _let(_LINES, "l", "cast(size(l) - size(array_distinct(l)) as bigint)")
    symbols = r"cast(coalesce(char_length(text) - char_length(regexp_replace(text, '[#*$%&|<>]', '')), 0) as bigint)"
    out = id_text(docs, id_col, text_col).select("doc_id", F.expr(f"{lines} as n_dup_lines"), F.expr(f"{symbols} as n_symbols"), F.expr(f"inline(array({figures}))"))
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    out = out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    limit = round(threshold * 1000)
    out = out.withColumns({"score": F.col("total") / (grams * 1000.0), "kept": ~F.col("base_failed") & (F.col("total") >= grams * F.lit(limit))})
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
