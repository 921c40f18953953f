"""The registered queries of this subpackage, each over its whole table, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import collocations, decontaminate, iblt, langid, lm, packing, preference, quality, simhash, spelling, topk, toxicity, warc
from meterline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def toxicity_categories() -> dict:
    """The labels table has two marks: junk is what has no quality, and informs the model of toxic texts."""
    return {"junk": F.lit(1) - F.col("quality"), "toxic": F.col("toxic")}


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sited = docs.withColumns({"host": F.col("source"), "path": F.col("lang")})
    return quality.posteriors(sited, table(spark, folder, "labels"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    chain = toxicity.fit(docs, table(spark, folder, "labels"), toxicity_categories())
    return toxicity.score(docs, chain)


def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return preference.rendered_pairs(table(spark, folder, "conversations"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated_regions(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.identify(docs, langid.learn(langid.training_rows(docs)))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


def op10_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return iblt.edited_fingerprints(table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_warc,
        op3_simhash,
        op4_toxicity,
        op5_chat_formatting,
        op6_decontamination,
        op7_language_id,
        op8_lm_scoring,
        op9_packing,
        op10_document_fingerprints,
        op11_spelling_variants,
        op12_exact_topk,
        op13_collocations,
    )
}

_WARC_SQL = """
WITH bodies AS (
  SELECT page_id, url, coalesce(html, '') AS body FROM pages
), keyed AS (
  SELECT page_id, url, strlen(body) AS payload_bytes, sha1(body) AS hex,
         min(page_id) OVER (PARTITION BY sha1(body)) AS response_id
  FROM bodies
), bits AS (
  SELECT *, list_aggregate(list_transform(string_split(hex, ''), lambda c : CASE c
    WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011'
    WHEN '4' THEN '0100' WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111'
    WHEN '8' THEN '1000' WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011'
    WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110' ELSE '1111' END), 'string_agg', '') AS bit
  FROM keyed
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i : substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * CAST(substr(bit, CAST(5 * i + 1 AS BIGINT), 1) AS INT) + 8 * CAST(substr(bit, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
           + 4 * CAST(substr(bit, CAST(5 * i + 3 AS BIGINT), 1) AS INT) + 2 * CAST(substr(bit, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
           + CAST(substr(bit, CAST(5 * i + 5 AS BIGINT), 1) AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response_id THEN NULL ELSE response_id END AS refers_to,
       url
FROM bits
"""

_PREFERENCE_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY coalesce(role, ''), coalesce(text, '')) AS copy
  FROM conversations
), o AS (
  SELECT conv_id, role, text FROM t
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy) = 1
), n AS (
  SELECT conv_id, row_number() OVER w AS rn, lead(conv_id) OVER w AS after, lag(conv_id) OVER w AS before
  FROM o WHERE conv_id IS NOT NULL WINDOW w AS (PARTITION BY role, text ORDER BY conv_id)
), p AS (
  SELECT conv_id, (rn - 1) % 2 AS side, CASE WHEN (rn - 1) % 2 = 0 THEN after ELSE before END AS other FROM n
  UNION ALL
  SELECT conv_id, 0, NULL FROM o WHERE conv_id IS NULL
), d AS (
  SELECT t.*, p.side, CASE WHEN p.side = 0 THEN t.conv_id ELSE p.other END AS pair_id,
         CASE WHEN p.side = 0 THEN p.other ELSE t.conv_id END AS rejected_id
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), cut AS (
  SELECT pair_id, min(struct_pack(turn := turn, copy := copy)) AS cut
  FROM (SELECT pair_id, turn, copy FROM d GROUP BY ALL
        HAVING count(*) < 2 OR min(role) <> max(role) OR min(text) <> max(text))
  GROUP BY pair_id
), parts AS (
  SELECT d.*, CASE WHEN cut.cut IS NULL OR struct_pack(turn := d.turn, copy := d.copy) < cut.cut THEN 'prompt'
                   WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part
  FROM d LEFT JOIN cut ON d.pair_id IS NOT DISTINCT FROM cut.pair_id
)
SELECT pair_id, pair_id AS chosen_id, rejected_id, part, turn, CAST(copy AS INT) AS copy, role,
       '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN CAST(length(role) + 5 AS BIGINT) END AS loss_from,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN CAST(length(role) + 5 + length(text) + 8 AS BIGINT) END AS loss_to
FROM parts WHERE part <> 'prompt' OR side = 0
"""

_SPELLING_SQL = """
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda i : list_reduce(list_prepend(i, range(8)),
    lambda c, k : CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS step
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
), low AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM runs GROUP BY ALL
), bytes AS (
  SELECT run, times, hex(concat(doc_id, ':', run)) AS hex FROM low
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(hex) // 2), lambda i : CAST('0x' || substr(hex, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b : xor(c >> 8, step[xor(c & 255, b) + 1]))) AS h
  FROM bytes, steps
), cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
  FROM hashed
), words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM cut GROUP BY word HAVING length(word) >= 5 AND sum(times) >= 3
), without AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, x.word FROM without w JOIN words x ON w.rest = x.word
  UNION SELECT x.word, w.word FROM without w JOIN words x ON w.rest = x.word
), best AS (
  SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near FROM pairs p JOIN words w ON w.word = p.near
  QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near COLLATE "binary") = 1
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), paths AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT p.word, f.form FROM paths p JOIN formed f ON f.word = p.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, p.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN paths p ON p.word = f.word JOIN formed e ON e.word = p.at AND e.form IS NULL
"""

_TOPK_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x : floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_COLLOCATIONS_SQL = """
WITH low AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM low
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), grams AS (
  SELECT lang, 1 AS size, unnest(words) AS phrase FROM worded
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(words)), lambda i : words[i] || ' ' || words[i + 1])) FROM worded
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(words) - 1), lambda i : words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
  FROM worded
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), found AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE size > 1 AND f >= 10
), longer AS (
  SELECT lang, phrase, max(a) AS around FROM (
    SELECT lang, a, unnest([words[1] || ' ' || words[2], words[2] || ' ' || words[3]]) AS phrase FROM found WHERE size = 3
  ) GROUP BY ALL
), kept AS (
  SELECT found.* FROM found LEFT JOIN longer USING (lang, phrase) WHERE around IS NULL OR 100 * around < 50 * a
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head AND x.size = c.k
  JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest AND y.size = len(string_split(c.phrase, ' ')) - c.k
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op2_warc": _WARC_SQL,
    "op5_chat_formatting": _PREFERENCE_SQL,
    "op11_spelling_variants": _SPELLING_SQL,
    "op12_exact_topk": _TOPK_SQL,
    "op13_collocations": _COLLOCATIONS_SQL,
}
