"""Registered queries of the operators, on whole tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zilverspoor.llm.common import table
from zilverspoor.session import run_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
pos AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM d),
tri AS (
  SELECT doc_id, i, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c FROM pos
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
dup AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri WHERE c IS NOT NULL)
  WHERE n > 1),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov USING (doc_id)),
f AS (
  SELECT *, CAST(
      CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failures
  FROM m)
SELECT *, (failures & 3) <> 0 AS base_failed, (failures & 55) = 0 AS kept FROM f
"""


@query("op8_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import quality_rules as q

    book = q.ledger(table(spark, folder, "documents"))
    return book.withColumns({"base_failed": ~q.verdict("base"), "kept": q.verdict("standard")})


@query("op10_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from zilverspoor.llm import byte_bpe as b

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = b.encode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    return b.decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op9_token_records")
def token_records(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from zilverspoor.llm import token_records as t

    docs = table(spark, folder, "documents")
    out = run_dir(spark, "token-records")
    t.write(docs, out, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return t.read(spark, out).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


DECONTAMINATE_SQL = r"""
WITH lower_ascii AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
win AS (
  SELECT DISTINCT id AS item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w FROM (
    SELECT id, ws, least(13, len(ws)) AS n, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS i
    FROM lower_ascii WHERE kind = 'b' AND len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
spots AS (
  SELECT id AS doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM (
    SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
    FROM lower_ascii, sizes WHERE kind = 'd' AND len(ws) >= n)),
occ AS (SELECT doc_id, s.n, i, item_id FROM spots s JOIN win ON win.n = s.n AND win.w = s.w),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM lower_ascii d LEFT JOIN hit ON hit.doc_id = d.id LEFT JOIN items ON items.doc_id = d.id
WHERE kind = 'd'
"""


@query("op7_decontaminate", DECONTAMINATE_SQL)
def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import decontaminate as d

    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = d.hits(docs, table(spark, folder, "benchmark"))
    listed = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "row.doc_id", "n_words", d.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
    ).withColumn("contaminated", d.contaminated(F.col("n_hit"), F.col("n_words")))


@query("op2_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import toxicity as t

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    apart = t.held_out(F.col("doc_id"), 4, 2)
    model = t.fit(docs, labels.filter(~apart))
    return t.score(docs, model).select(
        "doc_id", apart.alias("held_out"), "score",
        (F.col("score") >= t.THRESHOLD).cast("int").alias("predicted"), "weight",
    )


@query("op3_ngram_trie")
def ngram_trie(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import ngram_trie as n
    from zilverspoor.llm.toxicity import held_out

    docs = table(spark, folder, "documents").select("doc_id", "text")
    apart = held_out(F.col("doc_id"), 7, 2)
    levels = n.train(docs.filter(~apart))
    return n.score(docs, levels).select("*", apart.alias("held_out"))


@query("op4_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import secret_scan as s

    docs = table(spark, folder, "documents")
    return s.scan(docs, s.fit(s.labelled_findings(spark)))


@query("op1_minhash_dedup")
def minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import minhash_dedup as m

    found = m.classes(table(spark, folder, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.col("class").alias("class_id"))


@query("op6_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import suffix_dedup as s

    found = s.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUOTE_SQL = r"""
WITH RECURSIVE ln AS (
  SELECT *, CAST(length(regexp_replace(regexp_extract(line, '^[ \t]*(>[ \t]?)+'), '[^>]', '', 'g'))
                 AS INTEGER) AS level,
         regexp_replace(line, '^[ \t]*(>[ \t]?)+', '') AS content
  FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM conversations WHERE text IS NOT NULL)),
quoting AS (SELECT DISTINCT conv_id, turn FROM ln WHERE level > 0),
runs AS (
  SELECT *, i - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY i) AS run FROM ln),
tail AS (
  SELECT conv_id, turn, level, run, max(i) AS run_end,
         max(CASE WHEN trim(line, ' ' || chr(9) || chr(13)) <> '' THEN i END) AS last_line
  FROM runs GROUP BY ALL),
own AS (
  SELECT r.conv_id, r.turn, r.i, r.line FROM runs r JOIN tail t USING (conv_id, turn, level, run)
  WHERE level = 0 AND NOT (
    r.i >= t.last_line
    AND EXISTS (SELECT 1 FROM ln n WHERE n.conv_id = r.conv_id AND n.turn = r.turn AND n.i = t.run_end + 1)
    AND EXISTS (SELECT 1 FROM ln n WHERE n.conv_id = r.conv_id AND n.turn = r.turn AND n.i = t.last_line
      AND regexp_matches(n.line, '(?i)^.{0,200}\b(wrote|schrieb|a écrit|escribió)\b.{0,80}:\s*$')))),
body AS (
  SELECT conv_id, turn, trim(string_agg(line, chr(10) ORDER BY i), chr(10)) AS text
  FROM own GROUP BY conv_id, turn),
units AS (
  SELECT conv_id, turn, line AS u FROM own
  UNION SELECT conv_id, turn, text FROM body
  UNION SELECT conv_id, turn, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) FROM body),
written AS (
  SELECT DISTINCT conv_id, turn, lower(trim(regexp_replace(u, '\s+', ' ', 'g'))) AS u FROM units),
qline AS (
  SELECT conv_id, turn, level, run, i, lower(trim(regexp_replace(content, '\s+', ' ', 'g'))) AS u
  FROM runs WHERE level > 0),
quotes AS (
  SELECT conv_id, turn, level, u FROM qline WHERE u <> ''
  UNION SELECT conv_id, turn, level, string_agg(u, ' ' ORDER BY i) FROM qline WHERE u <> ''
        GROUP BY conv_id, turn, level, run),
origin AS (SELECT conv_id, u, min(turn) AS origin FROM written WHERE u <> '' GROUP BY ALL),
link AS (
  SELECT q.conv_id, q.turn, origin, CAST(sum(length(q.u)) AS BIGINT) AS matched
  FROM quotes q JOIN origin o ON o.conv_id = q.conv_id AND o.u = q.u AND origin < q.turn
  WHERE level = 1 GROUP BY ALL),
best AS (
  SELECT * FROM link
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY matched DESC, origin DESC) = 1),
place AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
answer AS (
  SELECT p.conv_id, p.turn, coalesce(b.origin, v.turn) AS reply_to, coalesce(b.matched, 0) AS matched
  FROM place p LEFT JOIN best b USING (conv_id, turn)
  LEFT JOIN place v ON v.conv_id = p.conv_id AND v.turn = p.turn - 1),
walk AS (
  SELECT conv_id, turn, turn AS thread, CAST(0 AS BIGINT) AS depth FROM answer WHERE reply_to IS NULL
  UNION ALL
  SELECT a.conv_id, a.turn, w.thread, w.depth + 1
  FROM answer a JOIN walk w ON w.conv_id = a.conv_id AND w.turn = a.reply_to)
SELECT c.conv_id, w.thread, w.depth, c.turn, c.role, a.reply_to,
       CAST(coalesce(a.matched, 0) AS BIGINT) AS matched,
       CASE WHEN c.text IS NULL THEN NULL WHEN q.turn IS NULL THEN c.text ELSE coalesce(b.text, '') END AS text
FROM conversations c
LEFT JOIN answer a ON a.conv_id = c.conv_id AND a.turn = c.turn
LEFT JOIN walk w ON w.conv_id = c.conv_id AND w.turn = c.turn
LEFT JOIN quoting q ON q.conv_id = c.conv_id AND q.turn = c.turn
LEFT JOIN body b ON b.conv_id = c.conv_id AND b.turn = c.turn
"""


@query("op5_quote_linking", QUOTE_SQL)
def quote_linking(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import quote_linking as q

    return q.conversations(table(spark, folder, "conversations"))


AUDIT_SQL = r"""
WITH lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
      || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
      || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d),
h AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN lab USING (doc_id) GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT o, CAST(s AS INTEGER) AS step, substr(o, s, 1) AS name, substr(o, 1, s - 1) AS before
  FROM o, (SELECT unnest(range(1, 6)) AS s)),
r AS (
  SELECT part, o, step, name,
         sum(CASE WHEN translate(before || name, fails, '') = before || name THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN here AND clean THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN here AND NOT clean THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = name THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN here AND clean THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN here AND clean THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT *, contains(fails, name) AS here, translate(before, fails, '') = before AS clean FROM s, h)
  GROUP BY part, o, step, name)
SELECT part, o AS filter_order, step, name AS "filter", CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, name) AS BIGINT) AS shapley
FROM r
"""


@query("op11_filter_audit", AUDIT_SQL)
def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import filter_audit as a

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return a.interactions(docs, labels, {"good": "quality = 1", "toxic": "toxic = 1"})


SEARCH_SQL = r"""
WITH asked AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM benchmark),
times AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(ws) AS t FROM asked) GROUP BY ALL),
d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
held AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n, ws FROM d WHERE len(ws) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM held),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(ws) AS t FROM held) GROUP BY ALL),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT)
           AS score
  FROM times JOIN tf USING (t) JOIN weights USING (t), total GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER w <= 20
"""


@query("op12_lexical_search", SEARCH_SQL)
def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import lexical_search as s

    found = s.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)
    return found.select(
        F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score"
    )


VECTOR_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CASE WHEN len(q.c) = len(v.c) THEN CAST(list_dot_product(q.c, v.c) AS BIGINT) END AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scores WHERE score IS NOT NULL
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""


@query("op13_vector_search", VECTOR_SQL)
def vector_search(spark: SparkSession, folder: str) -> DataFrame:
    from zilverspoor.llm import vector_search as v

    at = v.points(table(spark, folder, "embeddings"), "vec_id", "embedding")
    found = v.search(at.filter(F.col("key") % 100 == 0), v.build(at), k=10)
    return found.select(
        F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score"
    )


#: Messages that quote, made of the given ones: the message before, also announced, on two levels or
#: edited, or a conversation's first message. A third of all is one conversation.
QUOTING_SQL = r"""made AS (
  SELECT CASE WHEN m.conv_id % 3 = 0 THEN -1 ELSE m.conv_id END AS conv_id,
         CASE WHEN m.conv_id % 3 = 0 THEN m.conv_id * 16 + m.turn ELSE m.turn END AS turn, m.role,
         CASE WHEN p.text IS NULL THEN m.text
              WHEN (m.conv_id * 5 + m.turn) % 6 = 1 THEN '> ' || replace(p.text, chr(10), chr(10) || '> ') || chr(10) || chr(10) || m.text
              WHEN (m.conv_id * 5 + m.turn) % 6 = 2 THEN 'On Monday Ada wrote:' || chr(10) || '> ' || replace(p.text, chr(10), chr(10) || '> ') || chr(10) || m.text
              WHEN (m.conv_id * 5 + m.turn) % 6 = 3 THEN '>> ' || replace(coalesce(q.text, p.text), chr(10), chr(10) || '> > ') || chr(10)
                || '> ' || replace(p.text, chr(10), chr(10) || '> ') || chr(10) || m.text
              WHEN (m.conv_id * 5 + m.turn) % 6 = 4 THEN '> ' || replace(p.text, chr(10), chr(10) || '> ') || ' indeed' || chr(10) || m.text
              WHEN (m.conv_id * 5 + m.turn) % 6 = 5 THEN m.text || chr(10) || '>' || replace(f.text, chr(10), chr(10) || '>')
              ELSE m.text END AS text
  FROM conversations m
  LEFT JOIN conversations p ON p.conv_id = m.conv_id AND p.turn = m.turn - 1
  LEFT JOIN conversations q ON q.conv_id = m.conv_id AND q.turn = m.turn - 2
  LEFT JOIN conversations f ON f.conv_id = m.conv_id AND f.turn = 0)"""


@query(
    "quoting_conversations",
    QUOTE_SQL.replace("WITH RECURSIVE ln", f"WITH RECURSIVE {QUOTING_SQL},\nln").replace(
        "conversations WHERE", "made WHERE"
    ).replace("FROM conversations c", "FROM made c"),
)
def quoting_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Quote linking on messages that do quote: what was given quotes nothing."""
    from zilverspoor.llm import quote_linking as q

    given = table(spark, folder, "conversations")
    other = lambda name, back: given.select(
        "conv_id", (F.col("turn") + back).alias("turn"), F.col("text").alias(name)
    )
    first = given.where("turn = 0").select("conv_id", F.col("text").alias("f"))
    rows = given.join(other("p", 1), ["conv_id", "turn"], "left")
    rows = rows.join(other("q", 2), ["conv_id", "turn"], "left").join(first, "conv_id", "left")
    lines = lambda text, marks: F.replace(text, F.lit("\n"), F.lit(f"\n{marks}"))
    quoted = F.concat(F.lit("> "), lines(F.col("p"), "> "))
    deeper = F.concat(F.lit(">> "), lines(F.coalesce("q", "p"), "> > "))
    cases = {
        1: F.concat(quoted, F.lit("\n\n"), "text"),
        2: F.concat(F.lit("On Monday Ada wrote:\n"), quoted, F.lit("\n"), "text"),
        3: F.concat(deeper, F.lit("\n"), quoted, F.lit("\n"), "text"),
        4: F.concat(quoted, F.lit(" indeed\n"), "text"),
        5: F.concat("text", F.lit("\n>"), lines(F.col("f"), ">")),
    }
    kind = (F.col("conv_id") * 5 + F.col("turn")) % 6
    text = F.when(F.col("p").isNull(), F.col("text"))
    for number, made in cases.items():
        text = text.when(kind == number, made)
    hot = F.col("conv_id") % 3 == 0
    messages = rows.select(
        F.when(hot, -1).otherwise(F.col("conv_id")).alias("conv_id"),
        F.when(hot, F.col("conv_id") * 16 + F.col("turn")).otherwise(F.col("turn")).alias("turn"),
        "role", text.otherwise(F.col("text")).alias("text"),
    )
    return q.conversations(messages)
