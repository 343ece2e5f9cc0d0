"""The registered query of each operator, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import clustering, decontaminate, jaccard_join, language_id, lexical_search, mixture, personal_data, quality, secret_scan, sharding, token_count, token_store, warc

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, coverage=(1, 20)))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"), k=3, threshold=(90, 100))


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 6))


def mixture_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target of each value, and whether the shares of the expected sample meet it."""
    rows = mixture.annotated(table(spark, sf_dir, "documents"))
    return mixture.shares(mixture.rates(rows)).select("dimension", "value", F.round("target", 9).alias("target"), "reached")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, shards = token_store.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=2)
    return token_store.read_digests(spark, root, shards)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.weights(docs, table(spark, sf_dir, "labels").where("quality = 1")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), limit=2048)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.find_secrets(docs, secret_scan.train(docs, table(spark, sf_dir, "labels")))


def op9_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, root, archives)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.prototypes(docs))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(table(spark, sf_dir, "embeddings"), dims=64, scale=64, k=16, rounds=3, seed="1")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.assign(table(spark, sf_dir, "documents"), shards=40, overhead=16))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, segments = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(root, segments, table(spark, sf_dir, "benchmark"), k=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_decontamination, op2_jaccard_join, op3_mixture, op4_token_store, op5_quality_rules, op6_token_counts, op7_personal_data, op8_secret_scan, op9_warc_bundles, op10_language_id)
    own += (op11_centroid_clustering, op12_sharding, op13_lexical_search)
    return {f.__name__: f for f in (*own, mixture_shares)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH item AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
win AS (SELECT item, k, list_aggregate(words[i:i + k - 1], 'string_agg', ' ') AS win
        FROM (SELECT item, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM (SELECT *, least(len(words), 13) AS k FROM item WHERE len(words) > 0))),
doc AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
place AS (SELECT rid, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win)),
hit AS (SELECT p.rid, p.i, p.k, w.item FROM (SELECT rid, i, k, list_aggregate(words[i:i + k - 1], 'string_agg', ' ') AS win FROM place) p JOIN win w USING (k, win)),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

_OP2 = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, list_aggregate(words[i:i + 2], 'string_agg', ' ') AS sh
       FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM doc WHERE len(words) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM inter JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y WHERE 100 * c >= 90 * (s.n + t.n - c)),
pair AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM size UNION SELECT reach.x, pair.y FROM reach JOIN pair ON reach.y = pair.x),
comp AS (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x)
SELECT doc.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, doc.doc_id)::BIGINT AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN comp USING (doc_id)
"""


def _mixture_sql() -> str:
    """The fit unrolled: one step for each round and dimension."""
    trim = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    length = "length(coalesce(text, ''))"

    def without(pattern: str) -> str:
        return f"{length} - length(regexp_replace(coalesce(text, ''), '{pattern}', '', 'g'))"

    steps = [
        f"""doc AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  CASE WHEN 20 * ({without("[0-9]")}) > {length} THEN 'numbers' WHEN 50 * ({without("[#*$%&|<>{}]")}) > {length} THEN 'markup'
       WHEN 40 * ({without(chr(92) + "n")} + 1) > {length} THEN 'lists' WHEN {length} > 4000 THEN 'long prose' ELSE 'prose' END AS topic,
  CASE WHEN text IS NULL OR {trim} = '' THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS tokens FROM documents)""",
        "cell AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM doc GROUP BY ALL)",
        "total AS (SELECT sum(tokens)::DOUBLE AS t FROM cell)",
    ]
    for d in mixture.DIMENSIONS:
        steps += [
            f"sum_{d} AS (SELECT {d}, sum(tokens)::DOUBLE / (SELECT t FROM total) AS nat, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens)::DOUBLE, {mixture.TEMPER[d]}) ELSE 0 END AS raw FROM cell GROUP BY {d})",
            f"share_{d} AS MATERIALIZED (SELECT {d}, nat, raw / sum(raw) OVER () AS share FROM sum_{d})",
            # The scarcest values, and what they leave to the others.
            f"scarce_{d} AS MATERIALIZED (SELECT *, row_number() OVER w AS place, sum(nat) OVER w AS have, sum(share) OVER w AS want FROM share_{d} WHERE share > 0 WINDOW w AS (ORDER BY nat / share, {d} ROWS UNBOUNDED PRECEDING))",
        ]
    steps.append(f"budget AS MATERIALIZED (SELECT least({mixture.BUDGET}::DOUBLE, " + ", ".join(f"(SELECT coalesce(min(have / (want - {mixture.SHORT}::DOUBLE)) FILTER (want > {mixture.SHORT}::DOUBLE), 1) FROM scarce_{d})" for d in mixture.DIMENSIONS) + ", 1) AS b)")
    for d in mixture.DIMENSIONS:
        steps += [
            f"spread_{d} AS MATERIALIZED (SELECT arg_min(m, place) AS m FROM (SELECT (b - (have - nat)) / (b * (1 - (want - share))) AS m, place, nat, share, b FROM scarce_{d}, budget) WHERE m * share * b <= nat * (1 + 1e-12))",
            f"goal_{d} AS MATERIALIZED (SELECT {d}, CASE WHEN share > 0 THEN least(nat, m * share * b) ELSE 0 END * t AS goal_{d} FROM share_{d}, budget, spread_{d}, total)",
        ]
    steps.append("fit0 AS MATERIALIZED (SELECT cell.*, 1.0::DOUBLE AS f_source, 1.0::DOUBLE AS f_lang, 1.0::DOUBLE AS f_topic, goal_source, goal_lang, goal_topic FROM cell JOIN goal_source USING (source) JOIN goal_lang USING (lang) JOIN goal_topic USING (topic))")
    n = 0
    for _ in range(mixture.ROUNDS):
        for d in mixture.DIMENSIONS:
            n += 1
            rest = " * ".join(f"f_{e}" for e in mixture.DIMENSIONS if e != d)
            steps += [
                f"""try{n} AS MATERIALIZED (SELECT *, row_number() OVER w AS place, CASE WHEN sum(tokens * r) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > 0
  THEN (goal_{d} - coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(tokens * r) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) ELSE {mixture.WHOLE}::DOUBLE END AS f
  FROM (SELECT *, {rest} AS r FROM fit{n - 1}) WINDOW w AS (PARTITION BY {d} ORDER BY r DESC, source, lang, topic))""",
                f"""new{n} AS MATERIALIZED (SELECT {d}, CASE WHEN any_value(goal_{d}) >= sum(tokens) * (1 - 1e-12) THEN {mixture.WHOLE}::DOUBLE ELSE least(coalesce(arg_min(f, place) FILTER (f * r <= 1), {mixture.WHOLE}::DOUBLE), {mixture.WHOLE}::DOUBLE) END AS f_{d} FROM try{n} GROUP BY {d})""",
                f"fit{n} AS MATERIALIZED (SELECT source, lang, topic, tokens, goal_source, goal_lang, goal_topic, {', '.join(f'old.f_{e}' if e != d else f'new{n}.f_{e}' for e in mixture.DIMENSIONS)} FROM fit{n - 1} old JOIN new{n} USING ({d}))",
            ]
    final = f"""SELECT doc_id, source, lang, topic, doc.tokens, round(rate, 6) AS rate,
  ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate AS sampled
FROM doc JOIN (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(1.0::DOUBLE, f_source * f_lang * f_topic) ELSE 0 END AS rate FROM fit{n}) USING (source, lang, topic)"""
    return "WITH " + ",\n".join(steps) + "\n" + final


def _shares_sql() -> str:
    """Targets from the tokens alone; that the sample's expectation meets them is what is asked."""
    full = _mixture_sql()
    doc = full[: full.index("budget AS MATERIALIZED")].rstrip().rstrip(",")
    return doc + "\n" + " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS value, round(share, 9) AS target, TRUE AS reached FROM share_{d}" for d in mixture.DIMENSIONS)


_OP9 = """
WITH page AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
digest AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS hex FROM page),
first AS (SELECT hex, min(page_id) AS first FROM digest GROUP BY hex),
coded AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(hex, 5 * i + 1, 5))::BIGINT) AS v FROM digest JOIN first USING (hex))
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v[1 + j // 4] >> (15 - 5 * (j % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM coded
"""


def _clustering_sql(rounds: int = 3) -> str:
    """The rounds unrolled, each with the distances of all vectors to all centroids."""
    steps = [
        "kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "part AS MATERIALIZED (SELECT rid, unnest(v) AS x, unnest(range(64)) AS i FROM kept)",
        "centre0 AS MATERIALIZED (SELECT c, unnest(v) AS y, unnest(range(64)) AS i FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM kept QUALIFY c < 16))",
    ]
    for n in range(rounds + 1):
        steps.append(f"near{n} AS MATERIALIZED (SELECT rid, c, d FROM (SELECT rid, c, sum((x - y) * (x - y))::BIGINT AS d FROM part JOIN centre{n} USING (i) GROUP BY rid, c) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)")
        if n < rounds:
            mean = "(s - ((s % m) + m) % m) // m"
            steps.append(f"centre{n + 1} AS MATERIALIZED (SELECT c, i, coalesce({mean}, y) AS y FROM centre{n} LEFT JOIN (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS m FROM near{n} JOIN part USING (rid) GROUP BY c, i) USING (c, i))")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM near{rounds} JOIN kept USING (rid) JOIN (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM centre{rounds} GROUP BY c) USING (c)"""


_OP12 = """
WITH RECURSIVE bits(i, v, k) AS (SELECT i, i, 0 FROM (SELECT unnest(range(256))::BIGINT AS i) UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
doc AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS body, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null id')), 1, 16))::UBIGINT::UHUGEINT AS key FROM documents),
walk(rid, key, here, ahead) AS (SELECT rid, key, -1::BIGINT, 0::BIGINT FROM doc
  UNION ALL SELECT rid, next, ahead, floor((ahead + 1) * (2147483648.0::DOUBLE / ((next >> 33)::BIGINT + 1)::DOUBLE))::BIGINT FROM (SELECT rid, ahead, (key * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM walk WHERE ahead < 41)),
jump AS (SELECT rid, max(ahead) FILTER (ahead < 40)::INTEGER AS shard, max(ahead) FILTER (ahead < 41)::INTEGER AS grown_shard FROM walk GROUP BY rid),
sized AS (SELECT rid, doc_id, octet_length(body) + 16 AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(body), '..'), lambda x: ('0x' || x)::BIGINT)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM doc, crc)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard FROM sized JOIN jump USING (rid)
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP13 = f"""
WITH doc AS MATERIALIZED (SELECT * FROM (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS words FROM documents) WHERE len(words) > 0),
item AS MATERIALIZED (SELECT iid, item_id, unnest(list_distinct(words)) AS term FROM (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS words FROM benchmark)),
whole AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM doc),
tf AS MATERIALIZED (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(words) AS term FROM doc) WHERE term IN (SELECT term FROM item) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
m AS (SELECT rid, doc_id, 100 - 90 + (90 * len(words) * n_docs) // n_terms AS m FROM doc, whole),
score AS (SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM item JOIN w USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0) WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": _OP1, "op2_jaccard_join": _OP2, "op3_mixture": _mixture_sql(), "mixture_shares": _shares_sql(), "op9_warc_bundles": _OP9, "op11_centroid_clustering": _clustering_sql(), "op12_sharding": _OP12, "op13_lexical_search": _OP13}
