"""The registered queries of the text operators and the SQL that some of them are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklog.llm import (
    decontamination,
    edit_fingerprints,
    fill_in_middle,
    html_text,
    language_id,
    language_model,
    line_dedup,
    ngram_join,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    url_filter,
)
from blocklog.llm.text import remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify_languages(docs, language_id.fit_languages(docs))
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its lines, those that went, the documents that keep them, and what is left."""
    docs = _table(spark, sf_dir, "documents")
    left = line_dedup.dedup_lines(docs.select("doc_id", "text", F.size(F.split("text", "\n", -1)).alias("n_lines")), most=None, least=1)
    return left.select("doc_id", "n_lines", F.size("removed_lines").alias("n_removed"), "removed_lines", "first_docs", "text")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), [url_filter.parse_rule(*r) for r in URL_RULES])


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_rules.fit_rules(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, model)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.fit_quality(docs, _table(spark, sf_dir, "labels"))
    scored = quality_classifier.score_quality(docs, model)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(_table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"), keep_output=False).drop("output")


def op12_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_decontamination": op4_decontamination,
    "op5_url_filter": op5_url_filter,
    "op6_ngram_join": op6_ngram_join,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_language_model": op9_language_model,
    "op10_html_text": op10_html_text,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_edit_fingerprints": op12_edit_fingerprints,
    "op13_prefix_trie": op13_prefix_trie,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op4_decontamination": f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS MATERIALIZED (
  SELECT DISTINCT item_id, len(win) AS m, array_to_string(win, ' ') AS win FROM (
    SELECT item_id, w[s : s + 9] AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT m FROM iw),
starts AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, sizes WHERE len(w) >= m),
occ AS MATERIALIZED (
  SELECT DISTINCT doc_id, s, p.m, item_id
  FROM (SELECT doc_id, m, s, array_to_string(w[s : s + m - 1], ' ') AS win FROM starts) p
  JOIN iw ON iw.m = p.m AND iw.win = p.win),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS pos FROM occ) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op6_ngram_join": f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT b, root FROM reach JOIN link ON reach.doc_id = a WHERE root < b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(root) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY ALL""",
    "op11_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
h AS (
  SELECT doc_id, text, length(text) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
    CAST('0x' || hex[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || hex[25:32] AS BIGINT) % 100 AS h4
  FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
      WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form
    WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || substring(text, 1, low) || '<S>' || substring(text, high + 1, n - high) || '<M>' || substring(text, low + 1, high - low)
    ELSE '<S>' || substring(text, high + 1, n - high) || '<P>' || substring(text, 1, low) || '<M>' || substring(text, low + 1, high - low) END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM f""",
    "op13_prefix_trie": """
WITH crc AS (
  SELECT list(v ORDER BY k) AS t FROM (
    SELECT k, list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
    FROM (SELECT CAST(range AS BIGINT) AS k FROM range(256)))),
t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns, CAST(conv_id AS VARCHAR) AS name FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, xor(list_reduce(
    list_concat([4294967295], list_transform(range(1, length(name) + 1), lambda p: CAST(ascii(name[p]) AS BIGINT))),
    lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) % 9 AS h
  FROM own, crc),
built AS MATERIALIZED (
  SELECT h.conv_id, list_concat(coalesce(base.turns[1 : h.h], []), h.turns[h.h + 1 :]) AS turns
  FROM h LEFT JOIN own base ON base.conv_id = h.conv_id - h.conv_id % 5),
members AS (SELECT conv_id, d, turns[1 : d] AS pre, d = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)),
nodes AS MATERIALIZED (
  SELECT pre, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    (count(*) - 1) * coalesce(strlen(pre[d].text), 0) AS saved
  FROM members GROUP BY pre, d),
kids AS MATERIALIZED (SELECT pre[1 : d - 1] AS pre, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
sums AS (
  SELECT pre[1 : e] AS pre, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT nodes.pre, saved, n_children, unnest(range(0, d + 1)) AS e FROM nodes LEFT JOIN kids ON kids.pre = nodes.pre) GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums ON sums.pre = n.pre LEFT JOIN kids ON kids.pre = n.pre LEFT JOIN nodes p ON n.d > 0 AND p.pre = n.pre[1 : n.d - 1]""",
}
