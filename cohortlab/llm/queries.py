"""Registered queries over whole tables, one per operator, and their SQL.

Each derives the columns it returns from what its operator puts out.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm import (ann, chat_format, decontaminate, exact_dedup, fill_middle, html_blocks, line_dedup, pii, piece_bpe, prefix_trie, quality,
                           simhash, toxicity)
from cohortlab.llm.common import labelled, remainder, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


WHITE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, {WHITE_SQL}), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM lines),
hot AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
flagged AS (SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AS gone FROM keyed k LEFT JOIN hot h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id"""


@register("op4_line_dedup", LINES_SQL)
def op4(spark: SparkSession, d: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
parts AS (
  SELECT *, lag(role) OVER w AS before,
    length(regexp_replace(text, '([<\[]\\*)(\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>|/?INST\])', '\1\\\2', 'g')) AS shown
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(shown + CASE WHEN before IS DISTINCT FROM role THEN 12 + length(role) + 1 + 11 ELSE 10 END) AS BIGINT) AS formatted_chars
FROM parts GROUP BY conv_id"""


@register("op6_chat_format", CHAT_SQL)
def op6(spark: SparkSession, d: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    out = chat_format.format_chats(turns)
    out = out.select("conv_id", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
                     chat_format.loss_text(F.col("segments")).alias("loss"))
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(said_all.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def encoded(docs: DataFrame) -> DataFrame:
    """Token counts and digests of ids and decoded text, per document."""
    out = piece_bpe.encode(docs.select("doc_id", "text"), model_path())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op8_piece_encode")
def op8(spark: SparkSession, d: str) -> DataFrame:
    return encoded(table(spark, d, "documents"))


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Quality of every row of ``docs``, named by ``key``; the labels of documents with remainder 1 are held out."""
    train = labelled(labels, "quality").where(remainder(F.col("doc_id"), 3) != 1)
    return quality.classify(docs, train, key=key)


@register("op3_quality_classifier")
def op3(spark: SparkSession, d: str) -> DataFrame:
    out = quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@register("op9_simhash_near_dedup")
def op9(spark: SparkSession, d: str) -> DataFrame:
    out = simhash.near_dedup(table(spark, d, "documents").select("doc_id", "text"), shingle=4, radius=4)
    return out.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@register("op10_benchmark_decontamination")
def op10(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"))


# The key of a deployment comes from its secret store; this one makes the query repeatable.
PII_KEY = b"cohortlab example key"


@register("op1_pii_pseudonyms")
def op1(spark: SparkSession, d: str) -> DataFrame:
    out = pii.pseudonymise(table(spark, d, "documents").select("doc_id", "text"), PII_KEY)
    return out.select("doc_id", "text", F.size("spans").cast("long").alias("n_replaced"), "spans")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every document; the labels of those with remainder 0 are held out."""
    train = labelled(labels, "toxic").where(remainder(F.col("doc_id"), 5) != 0)
    return toxicity.classify(docs.select("doc_id", "text"), train)


@register("op2_toxicity")
def op2(spark: SparkSession, d: str) -> DataFrame:
    out = toxicity_scores(table(spark, d, "documents"), table(spark, d, "labels"))
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@register("op5_html_main_text")
def op5(spark: SparkSession, d: str) -> DataFrame:
    out = html_blocks.extract(table(spark, d, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@register("op7_learned_partitions")
def op7(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
-- crc32 of the decimal id, eight bits a digit
codes AS (
  SELECT conv_id, conv_id - conv_id % 20 AS head, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
rebuilt AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d FROM (
    SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM codes c JOIN t ON t.conv_id = c.head AND t.pos <= c.h
    UNION ALL SELECT t.conv_id, 1, t.pos, t.role, t.text FROM t JOIN codes c ON t.conv_id = c.conv_id WHERE t.pos > c.h)),
steps AS (
  SELECT conv_id, d, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY d)) AS key,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM codes),
nodes AS (
  SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = n) AS ends
  FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS n FROM steps) GROUP BY d, key),
links AS (SELECT DISTINCT a.d, a.key, b.key AS up FROM steps a JOIN steps b ON a.conv_id = b.conv_id AND b.d = a.d - 1),
children AS (SELECT d - 1 AS d, up AS key, count(*) AS n_children FROM links GROUP BY 1, 2),
below AS (
  SELECT p.d, p.key, sum((y.n_convs - 1) * y.words) AS saved, count(*) FILTER (WHERE c.key IS NULL) AS n_leaves
  FROM nodes y JOIN steps p ON p.conv_id = y.conv_id AND p.d <= y.d LEFT JOIN children c ON c.d = y.d AND c.key = y.key GROUP BY 1, 2)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves,
  b.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.key = n.key LEFT JOIN children c ON c.d = n.d AND c.key = n.key
LEFT JOIN links l ON l.d = n.d AND l.key = n.key LEFT JOIN nodes u ON u.d = n.d - 1 AND u.key = l.up"""


@register("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.trie_of(*prefix_trie.with_shared_heads(prefix_trie.numbered(table(spark, d, "conversations"))))


MIDDLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS toks,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
drawn AS (
  SELECT *, len(toks) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3,
    ('0x' || d[25:32])::BIGINT AS h4 FROM cut),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(toks[1:a], '') AS prefix, array_to_string(toks[a + 1:b], '') AS middle, array_to_string(toks[b + 1:], '') AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""


@register("op12_fill_in_middle", MIDDLE_SQL)
def op12(spark: SparkSession, d: str) -> DataFrame:
    out = fill_middle.fill_in_middle(table(spark, d, "documents").select("doc_id", "text"), seed=1, rate=90, spm=20)
    back = fill_middle.restore(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


COPIES_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@register("op13_exact_dedup", COPIES_SQL)
def op13(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, d, "documents"))
