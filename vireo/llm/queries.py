"""One query per operator, over its whole tables, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm import bit_sliced, byte_bpe, collocations, crf_quality, decontaminate, language_id, line_dedup, ngram_join, preference, suffix_dedup, turn_repair, url_filter, warc
from vireo.llm.common import Scratch, read

RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
         url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_windows(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[CAST(s AS BIGINT):CAST(s + least(len(w), 10) - 1 AS BIGINT)], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT r, k, s, array_to_string(w[CAST(s AS BIGINT):CAST(s + k - 1 AS BIGINT)], ' ') AS g
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
hit AS (SELECT r, s, dw.k, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


#: Rank file and pattern of the byte-level vocabulary.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def token_digests(docs: DataFrame) -> DataFrame:
    encoded = byte_bpe.encode(docs, RANKS, PATTERN)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read(spark, sf_dir, "documents"))


def op5_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return bit_sliced.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


OP5_SQL = """
WITH v AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path("archives")
    warc.write_warc(read(spark, sf_dir, "pages"), path)
    records = warc.read_warc(spark, path, payloads=False)
    return records.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast("long").alias("refers_to"))


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT *, array_to_string(list_transform(string_split(hex, ''),
           lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', c) - 3, 4)), '') AS b FROM p),
d AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(16 * CAST(substr(b, CAST(5 * i + 1 AS BIGINT), 1) AS INT) + 8 * CAST(substr(b, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
             + 4 * CAST(substr(b, CAST(5 * i + 3 AS BIGINT), 1) AS INT) + 2 * CAST(substr(b, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
             + CAST(substr(b, CAST(5 * i + 5 AS BIGINT), 1) AS INT) AS BIGINT), 1)), '') AS payload_digest FROM bits),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM m
"""


def _preference(sides: DataFrame) -> DataFrame:
    pairs = preference.format_pairs(sides)
    text = lambda c: F.array_join(F.transform(F.col(c), lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return pairs.select("conv_id", F.col("prompt_turns").cast("long").alias("prompt_turns"), "prompt", "chosen_text", text("chosen_spans").alias("chosen_spans"),
                        "rejected_text", text("rejected_spans").alias("rejected_spans"))


def op7_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preference(preference.swapped_replies(read(spark, sf_dir, "conversations")))


def preference_spliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 on sides that part at any turn and go on for several."""
    return _preference(preference.spliced_tails(read(spark, sf_dir, "conversations")))


OP7_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
             count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT conv_id, role, text, i, n FROM t WHERE i < n
      UNION ALL SELECT a.conv_id, b.role, b.text, a.n, a.n FROM t a JOIN t b ON b.conv_id = xor(a.conv_id, 1) AND b.i = b.n WHERE a.i = a.n),
x AS (SELECT t.conv_id, min(t.i) FILTER (WHERE r.role IS DISTINCT FROM t.role OR r.text IS DISTINCT FROM t.text) AS d, max(t.n) AS n
      FROM t LEFT JOIN r ON r.conv_id = t.conv_id AND r.i = t.i GROUP BY t.conv_id),
p AS (SELECT conv_id, coalesce(d - 1, n) AS prompt_turns FROM x),
sides AS (SELECT 'c' AS side, conv_id, i, role, text FROM t UNION ALL SELECT 'r', conv_id, i, role, text FROM r),
seg AS (SELECT side, s.conv_id, i, role, i <= prompt_turns AS shared, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece,
          length(role) + 5 AS head FROM sides s JOIN p USING (conv_id)),
pos AS (SELECT *, sum(length(piece)) OVER (PARTITION BY side, conv_id, shared ORDER BY i) AS until FROM seg),
f AS (SELECT conv_id,
        coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE shared AND side = 'c'), '') AS prompt,
        coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE NOT shared AND side = 'c'), '') AS chosen_text,
        coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE NOT shared AND side = 'r'), '') AS rejected_text,
        coalesce(string_agg(CAST(CAST(until - length(piece) + head AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(until AS BIGINT) AS VARCHAR), ',' ORDER BY i) FILTER (WHERE NOT shared AND side = 'c' AND role = 'assistant'), '') AS chosen_spans,
        coalesce(string_agg(CAST(CAST(until - length(piece) + head AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(until AS BIGINT) AS VARCHAR), ',' ORDER BY i) FILTER (WHERE NOT shared AND side = 'r' AND role = 'assistant'), '') AS rejected_spans
      FROM pos GROUP BY conv_id)
SELECT f.conv_id, CAST(prompt_turns AS BIGINT) AS prompt_turns, prompt, chosen_text, chosen_spans, rejected_text, rejected_spans FROM f JOIN p USING (conv_id)
"""


#: As OP7_SQL, with the rejected side (r) of ``preference.spliced_tails``.
SPLICED_SQL = OP7_SQL[:OP7_SQL.index("r AS (")] + r"""
cut AS (SELECT conv_id, length(text) % (n + 1) AS kept FROM t WHERE i = 1),
r AS (SELECT t.conv_id, role, text, i FROM t JOIN cut USING (conv_id) WHERE i <= kept
      UNION ALL SELECT cut.conv_id, b.role, b.text, b.i FROM cut JOIN t b ON b.conv_id = xor(cut.conv_id, 1) AND b.i > kept),
""" + OP7_SQL[OP7_SQL.index("x AS ("):]


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), RULES)


OP9_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
hit AS (SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS said
        FROM s LEFT JOIN rules ON ('.' || host) LIKE ('%.' || rhost) AND starts_with(path, rpath) GROUP BY ALL),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^((www|m|amp)\.)+', ''), '\.?(:(80|443))?$', '') || regexp_replace(path, '/+$', '') END AS canonical FROM hit)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN canonical IN (SELECT canonical FROM c WHERE said = 'block' AND canonical IS NOT NULL) THEN 'block' END, 'allow') AS verdict, canonical FROM c
"""


def fold(ident: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % parts


#: Score from which a document counts as good.
GOOD = 0.3


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> crf_quality.Model:
    """Learned from the labelled rows outside fold 0 of 5."""
    return crf_quality.fit(docs, read(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))


def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = crf_quality.score(docs, quality_model(docs, spark, sf_dir))
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter((fold("doc_id", 3) != 1) & F.col("lang").isNotNull()).select("text", "lang"))
    return language_id.predict(docs, model).select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents").select("text", "lang"))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[CAST(i AS BIGINT):CAST(i + k - 1 AS BIGINT)], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS s(k))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
cut AS (SELECT lang, phrase, a, i, array_to_string(w[1:CAST(i AS BIGINT)], ' ') AS x, array_to_string(w[CAST(i + 1 AS BIGINT):k], ' ') AS y
        FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
s AS (SELECT cut.lang, cut.phrase, a, i, u.f AS l, v.f AS r, CAST(1000000 AS HUGEINT) * a * a // (CAST(u.f AS HUGEINT) * v.f) AS score
      FROM cut JOIN f u ON u.lang = cut.lang AND u.phrase = cut.x JOIN f v ON v.lang = cut.lang AND v.phrase = cut.y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
longer AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN longer o USING (lang, phrase) WHERE o.a IS NULL OR 100 * o.a < 50 * b.a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang) WHERE rank <= 2000
"""


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    edits, totals = turn_repair.repair(turn_repair.damage(conversations), Scratch(spark))
    turn = F.when(F.col("edit") != "D", F.concat_ws(":", "role", "text"))
    told = edits.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "edit", turn.alias("turn")))).alias("e"))
    told = told.select("conv", F.array_join("e.edit", "").alias("audit"), F.array_join("e.turn", "\n").alias("repaired"))
    ids = conversations.select("conv_id").distinct()
    out = ids.join(totals, ids["conv_id"].eqNullSafe(totals["conv"]), "left").join(told, ids["conv_id"].eqNullSafe(told["conv"]), "left")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"))


OP12_SQL = r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(CAST(3988292384 AS BIGINT), c // 2) ELSE c // 2 END)) AS t),
k AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(CAST(4294967295 AS BIGINT), list_reduce(list_transform(range(0, CAST(length(key) + 1 AS BIGINT)), lambda i: CASE WHEN i = 0 THEN CAST(4294967295 AS BIGINT) ELSE CAST(ascii(substr(key, i, 1)) AS BIGINT) END),
          lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % 20 AS kind FROM k, tab),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM h, (VALUES (1), (2)) AS v(copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed, substr(role, 1, 1) AS y FROM d),
f AS (SELECT conv_id, turn, role, text, i, n, y,
        CASE WHEN trimmed = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'ok' END AS fault,
        i > 1 AND coalesce(lag(y) OVER (PARTITION BY conv_id ORDER BY i), '') || y NOT IN ('su', 'ua', 'au') AS illegal FROM n),
s AS (SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS t, fault NOT IN ('blank', 'duplicate') AS may FROM f),
r AS (SELECT conv_id, max(n) + 1 AS i, {'c': 0, 's': ''} AS v0, {'c': 10, 's': 'II'} AS vs, {'c': 5, 's': 'I'} AS vu, {'c': 0, 's': ''} AS va FROM s GROUP BY conv_id
      UNION ALL
      SELECT conv_id, i, list_min([b0, {'c': 5 + u.c, 's': 'I' || u.s}]), list_min([bs, {'c': 5 + u.c, 's': 'I' || u.s}]), u, a
      FROM (SELECT conv_id, i, b0, bs, list_min([bu, {'c': 5 + ba.c, 's': 'I' || ba.s}]) AS u, list_min([ba, {'c': 5 + bu.c, 's': 'I' || bu.s}]) AS a
        FROM (SELECT r.conv_id, s.i,
            list_min([{'c': 2 + v0.c, 's': 'D' || v0.s}, {'c': CASE WHEN may THEN 1 + t + vu.c ELSE 1000000000 END, 's': 'R' || vu.s},
                      {'c': CASE WHEN may AND y = 's' THEN t + vs.c WHEN may AND y = 'u' THEN t + vu.c ELSE 1000000000 END, 's': 'K' || CASE WHEN y = 's' THEN vs.s ELSE vu.s END}]) AS b0,
            list_min([{'c': 2 + vs.c, 's': 'D' || vs.s}, {'c': CASE WHEN may THEN 1 + t + vu.c ELSE 1000000000 END, 's': 'R' || vu.s}, {'c': CASE WHEN may AND y = 'u' THEN t + vu.c ELSE 1000000000 END, 's': 'K' || vu.s}]) AS bs,
            list_min([{'c': 2 + vu.c, 's': 'D' || vu.s}, {'c': CASE WHEN may THEN 1 + t + va.c ELSE 1000000000 END, 's': 'R' || va.s}, {'c': CASE WHEN may AND y = 'a' THEN t + va.c ELSE 1000000000 END, 's': 'K' || va.s}]) AS bu,
            list_min([{'c': 2 + va.c, 's': 'D' || va.s}, {'c': CASE WHEN may THEN 1 + t + vu.c ELSE 1000000000 END, 's': 'R' || vu.s}, {'c': CASE WHEN may AND y = 'u' THEN t + vu.c ELSE 1000000000 END, 's': 'K' || vu.s}]) AS ba
          FROM r JOIN s ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.i = r.i - 1))),
best AS (SELECT conv_id, v0.c AS cost, v0.s AS audit FROM r WHERE i = 1),
e AS (SELECT conv_id, j, substr(audit, j, 1) AS e, length(replace(substr(audit, 1, j), 'I', '')) AS i, length(replace(substr(audit, 1, j), 'D', '')) AS o
      FROM (SELECT *, unnest(range(1, CAST(length(audit) + 1 AS BIGINT))) AS j FROM best)),
m AS (SELECT e.*, s.role, s.text, s.y FROM e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id AND s.i = e.i AND e.e <> 'I' WHERE e.e <> 'D'),
z AS (SELECT *, max(CASE WHEN o = 1 AND e = 'K' AND y = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM m),
told AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS repaired FROM z GROUP BY conv_id),
tot AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
          count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM s GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN tot ON tot.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                      F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
s AS (SELECT r, doc_id, i, b[i:i + 49] AS s FROM (SELECT r, doc_id, b, CAST(unnest(range(1, octet_length(b) - 48)) AS BIGINT) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM s GROUP BY s),
hit AS (SELECT r, i FROM s JOIN f USING (s) WHERE first < doc_id),
mark AS (SELECT r, i, CASE WHEN i > 50 + coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -100) THEN 1 ELSE 0 END AS new FROM hit),
run AS (SELECT r, min(i) AS a, max(i) + 50 AS z FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM mark) GROUP BY r, g),
edge AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS since FROM run),
kept AS (SELECT r, a AS o, hex(b[since:a - 1]) AS h, z - a AS n, 1 AS k FROM edge JOIN d USING (r)
         UNION ALL SELECT r, 1 + octet_length(b), hex(b[coalesce(z, 1):octet_length(b)]), 0, 0 FROM d LEFT JOIN (SELECT r, max(z) AS z FROM run GROUP BY r) USING (r)),
whole AS (SELECT r, sum(n) AS n_removed, sum(k) AS n_spans, string_agg(h, '' ORDER BY o, k DESC) AS h FROM kept GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM d JOIN whole USING (r)
"""


QUERIES = {"op1_crf_quality": op1_crf_quality, "op2_decontaminate": op2_decontaminate, "op3_ngram_join": op3_ngram_join, "op4_byte_bpe": op4_byte_bpe, "op5_bit_sliced": op5_bit_sliced, "op6_warc": op6_warc, "op7_preference": op7_preference, "op8_line_dedup": op8_line_dedup, "op9_url_filter": op9_url_filter, "op10_language_id": op10_language_id, "op11_collocations": op11_collocations, "op12_turn_repair": op12_turn_repair, "op13_suffix_dedup": op13_suffix_dedup, "preference_spliced": preference_spliced}
ORACLE_SQL = {"op2_decontaminate": OP2_SQL, "op5_bit_sliced": OP5_SQL, "op6_warc": OP6_SQL, "op7_preference": OP7_SQL, "op9_url_filter": OP9_SQL, "op11_collocations": OP11_SQL, "op12_turn_repair": OP12_SQL, "op13_suffix_dedup": OP13_SQL, "preference_spliced": SPLICED_SQL}
