"""Registered queries of the corpus operators and their DuckDB twins.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds the
twin of every query that SQL can express.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ridewise.llm import (decontaminate, exact_dedup, hard_negatives, lexical_search, line_dedup, link_graph, near_dedup, packing, quality_classifier,
                          substring_dedup, token_counts, token_records, tool_calls)
from ridewise.llm.common import NULL_ID, prepare, read_table, scratch_path

#: vocabulary and end id of the token queries; the file is never copied
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return deco


def _id(col: str = "__id"):
    return F.when(F.col(col) != F.lit(NULL_ID), F.col(col))


@query("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""")
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


@query("op7_line_dedup", r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last_doc AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""")
def op7_line_dedup(spark, sf_dir):
    return line_dedup.line_digests(read_table(spark, sf_dir, "documents"))


@query("op10_substring_dedup", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                      lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 49], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
first AS (SELECT s, min(doc_id) AS first_doc FROM win GROUP BY s HAVING min(doc_id) <> max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM win JOIN first USING (s) WHERE first_doc < doc_id),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS t FROM word ANTI JOIN gone USING (doc_id, q)
         GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def op10_substring_dedup(spark, sf_dir):
    out = substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))
    return out.select(_id().alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_decontaminate")
def op2_decontaminate(spark, sf_dir):
    out = decontaminate.flag_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(_id().alias("doc_id"), "contaminated", "items", "coverage")


QUALITY_THRESHOLD = 0.3


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, read_table(spark, sf_dir, "labels"))
    keep = {"doc_id": F.col("doc_id").cast("long"), "held_out": F.coalesce(quality_classifier.fold("doc_id") == 0, F.lit(False))}
    return (quality_classifier.score(docs, model, keep=keep)
            .select("doc_id", "held_out", "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
                    "difference", "n_bytes"))


#: The tool protocol read into ``conversations``: a user's turn calls ``reply``,
#: the assistant's next turn is its result.
REPLY_SCHEMA = {"reply": {"text": {"type": "string", "required": True, "minLength": 1, "maxLength": 2000},
                          "turn": {"type": "integer", "required": True, "minimum": 0}}}


def conversation_messages(conv):
    mid = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit(":"), t.cast("string"))
    kind = F.when(F.col("role") == "user", "call").when(F.col("role") == "assistant", "result").otherwise("note")
    args = F.to_json(F.struct(F.col("turn"), F.col("text")))
    return conv.select(F.col("conv_id").alias("thread"), F.col("turn").alias("seq"), kind.alias("kind"),
                       mid(F.col("turn")).alias("id"), mid(F.col("turn") - 1).alias("parent_id"),
                       F.when(F.col("role") == "assistant", mid(F.col("turn") - 1)).alias("call_id"),
                       F.when(F.col("role") == "user", "reply").alias("name"),
                       F.when(F.col("role") == "user", args).otherwise(F.col("text")).alias("payload"))


@query("op4_tool_calls", r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, text FROM conversations),
lv AS (SELECT conv_id, turn, 0::BIGINT AS level FROM m a
       WHERE NOT EXISTS (SELECT 1 FROM m b WHERE b.conv_id = a.conv_id AND b.turn = a.turn - 1)
       UNION ALL SELECT m.conv_id, m.turn, lv.level + 1 FROM lv JOIN m ON m.conv_id = lv.conv_id AND m.turn = lv.turn + 1),
u AS (SELECT * FROM m WHERE role = 'user'), a AS (SELECT * FROM m WHERE role = 'assistant'),
c AS (SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer, a.turn AS result_seq,
             CASE WHEN a.conv_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status
      FROM u LEFT JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1),
j AS (SELECT conv_id, turn, status,
             list_filter([CASE WHEN length(question) > 2000 THEN 'large text' END, CASE WHEN question IS NULL THEN 'missing text' END,
                          CASE WHEN question = '' THEN 'small text' END], lambda x: x IS NOT NULL) AS errors,
             '{"arguments":{' || CASE WHEN question IS NULL THEN '' ELSE '"text":' || to_json(question)::VARCHAR || ',' END
             || '"turn":' || turn || '}' || CASE WHEN answer IS NULL THEN '' ELSE ',"content":' || to_json(answer)::VARCHAR END
             || ',"id":"' || conv_id || ':' || turn || '","name":"reply"'
             || CASE WHEN result_seq IS NULL THEN '' ELSE ',"result_seq":' || result_seq END
             || ',"seq":' || turn || ',"status":"' || status || '"}' AS record FROM c
      UNION ALL
      SELECT conv_id, turn, 'orphan', NULL,
             '{' || CASE WHEN text IS NULL THEN '' ELSE '"content":' || to_json(text)::VARCHAR || ',' END
             || '"id":"' || conv_id || ':' || turn || '","result_seq":' || turn || ',"seq":' || turn || ',"status":"orphan"}'
      FROM a WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.conv_id = a.conv_id AND u.turn = a.turn - 1))
SELECT j.conv_id, j.turn, status, level, len(errors) = 0 AS valid, errors, record
FROM j JOIN lv ON lv.conv_id = j.conv_id AND lv.turn = j.turn""")
def op4_tool_calls(spark, sf_dir):
    out = tool_calls.link_tool_calls(conversation_messages(read_table(spark, sf_dir, "conversations")), REPLY_SCHEMA)
    return out.select(F.col("thread").alias("conv_id"), F.col("seq").alias("turn"), "status", "level", "valid", "errors", "record")


@query("op5_near_dedup")
def op5_near_dedup(spark, sf_dir):
    out = near_dedup.near_classes(read_table(spark, sf_dir, "documents"))
    return out.select(_id().alias("doc_id"), _id("class_id").alias("class_id"), "class_size", "kept")


@query("op6_token_records")
def op6_token_records(spark, sf_dir):
    path = scratch_path(spark, "token-records")
    token_records.write_records(read_table(spark, sf_dir, "documents"), path, TOKENIZER, END_ID)
    back = token_records.read_records(spark, path)
    return back.select(_id().alias("doc_id"), F.col("start").cast("long").alias("start"), "n_tokens", F.crc32("ids").alias("ids_crc32"))


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]
DAMPING, ROUNDS = 0.85, 20


@query("op8_link_graph", r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, coalesce(html, '') AS html FROM pages),
rules AS (SELECT * FROM (VALUES """ + ", ".join(f"('{r}', '{v}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in URL_RULES)
       + r""") t(rule, v, rule_host, rule_path)),
judged AS (SELECT page_id, host, path,
    (SELECT max_by(rule, length(rule)) FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
       AND starts_with(path, rule_path)) AS rule FROM p),
seeds AS (SELECT host, count(*) FILTER (v = 'allow') AS good, count(*) FILTER (v = 'block') AS bad
          FROM judged LEFT JOIN rules USING (rule) WHERE host <> '' GROUP BY host),
links AS (SELECT src, dst, count(*)::DOUBLE AS weight FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, '""" + link_graph.LINK.replace("'", "''") + r"""', 1)),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM p WHERE host <> '')
    WHERE src <> dst GROUP BY ALL),
parts AS (SELECT DISTINCT string_split(host, '.') AS l FROM (SELECT host FROM p WHERE host <> '' UNION SELECT dst FROM links)),
chain AS (SELECT DISTINCT array_to_string(l[i:], '.') AS src FROM (SELECT l, unnest(range(1, len(l) + 1)) AS i FROM parts)),
up AS (SELECT src, regexp_extract(src, '(?s)^[^.]*\.(.*)$', 1) AS dst FROM chain WHERE regexp_extract(src, '(?s)^[^.]*\.(.*)$', 1) <> ''),
edges AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT * FROM links UNION ALL SELECT src, dst, 1.0 FROM up
          UNION ALL SELECT dst, src, 1.0 FROM up) GROUP BY ALL),
ways AS (SELECT 't' AS kind, src, dst, weight FROM edges UNION ALL SELECT 'd', dst, src, weight FROM edges),
flow AS (SELECT kind, src, dst, weight / sum(weight) OVER (PARTITION BY kind, src) AS p FROM ways),
seed AS (SELECT 't' AS kind, host, good::DOUBLE AS w FROM seeds WHERE good > 0 UNION ALL SELECT 'd', host, bad::DOUBLE FROM seeds WHERE bad > 0),
start AS (SELECT kind, host, w / sum(w) OVER (PARTITION BY kind) AS s FROM seed),
""" + link_graph.propagation_sql(ROUNDS, DAMPING) + r""",
hosts AS (SELECT host, round(coalesce(sum(x) FILTER (kind = 't'), 0), 12) AS trust,
                 round(coalesce(sum(x) FILTER (kind = 'd'), 0), 12) AS distrust FROM score GROUP BY host)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
       round(coalesce(trust, 0), 9) AS trust, round(coalesce(distrust, 0), 9) AS distrust
FROM judged LEFT JOIN rules USING (rule) LEFT JOIN hosts USING (host)""")
def op8_link_graph(spark, sf_dir):
    out = link_graph.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES, damping=DAMPING, rounds=ROUNDS)
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))


SEQUENCE = 4096


@query("op9_packing")
def op9_packing(spark, sf_dir):
    out = packing.pack_documents(read_table(spark, sf_dir, "documents"), TOKENIZER, END_ID, SEQUENCE)
    return out.withColumn("doc_id", _id()).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


#: vocabulary of the counting query and the number of tokens beyond which a document is over the limit
COUNT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 1024


@query("op11_token_counts")
def op11_token_counts(spark, sf_dir):
    out = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), COUNT_TOKENIZER)
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op12_lexical_search", r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
c AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM d),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, nd),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // l))))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (doc_id), c GROUP BY ALL),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""")
def op12_lexical_search(spark, sf_dir):
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), 10)


@query("op13_hard_negatives", r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY rank <= 3""")
def op13_hard_negatives(spark, sf_dir):
    """Every seventh label is moved on by one, so that labels and neighbours disagree."""
    moved = F.when(F.pmod(F.col("vec_id"), F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", moved))
