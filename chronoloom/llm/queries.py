"""The registered queries of the operators in this package, with SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm import (
    byte_bpe,
    conversation_repair,
    debruijn,
    decontaminate,
    jaccard_join,
    language,
    licenses,
    pieces,
    preferences,
    quality,
    suffix_dedup,
    token_align,
    toxicity,
)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn=None, *, sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add(fn) if fn else add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"'[^\x20\x09-\x0D]+'"
_ITEM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE_SQL = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, len(g) AS k, array_to_string(g, ' ') AS g FROM (
    SELECT item_id, w[s : s + least(len(w), 13) - 1] AS g FROM (
      SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM b WHERE len(w) > 0))),
dw AS (
  SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS g FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
    FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hit AS (SELECT doc_id, s, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
n AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS i FROM hit) GROUP BY doc_id),
i AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)"""


@query(sql=DECONTAMINATE_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.scan(docs, items))


def _quality_sql() -> str:
    def q(pattern: str) -> str:
        return "'" + pattern + "'"

    ws = r"'[\x20\x09-\x0D]+'"
    rest = lambda c, p: f"length(regexp_replace({c}, {q(p)}, '', 'g'))"
    symbols, separators = rest("line", quality.NO_SYMBOL), rest("line", quality.NO_SEPARATOR)
    shouts = f"len(regexp_extract_all(line, {q(quality.SHOUT)}))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
l AS (
  SELECT doc_id, line, len(regexp_extract_all(line, {WORDS})) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
f AS (
  SELECT doc_id, line, n, n > 0 AND (
    ({symbols} >= 3 AND 5 * {symbols} >= n) OR ({shouts} >= 2 AND 3 * {shouts} >= n)
    OR (n >= 5 AND 2 * {rest("line", quality.NO_UPPER)} > {rest("line", quality.NO_LETTER)})
    OR ({separators} >= 2 AND 6 * {separators} >= n) OR regexp_matches(line, {q(quality.MENU)})
    OR (n <= {quality.BOILERPLATE_WORDS} AND regexp_matches(line, {q(quality.BOILERPLATE)}))) AS bad
  FROM l),
lines AS (
  SELECT doc_id, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup,
    count(*) FILTER (bad) AS n_bad, coalesce(sum(n) FILTER (NOT bad), 0) AS n_left
  FROM f GROUP BY doc_id),
g AS (
  SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, array_to_string(w[s : s + 4], ' ')) AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM d WHERE len(w) >= 5)),
r AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(s, s + 5)) AS i FROM g WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, {ws}, '', 'g')) AS BIGINT) AS word_chars,
    CAST({rest("text", quality.NO_SYMBOL)} AS BIGINT) AS n_symbols, CAST(n_dup AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines,
    CAST(n_bad AS BIGINT) AS n_bad_lines, CAST(n_left AS BIGINT) AS n_left_words,
    len(w) < 10 OR 100 * coalesce(r.n, 0) > 20 * len(w) AS base_failed
  FROM d JOIN lines USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT *, NOT base_failed AND 100 * n_left_words >= 50 * n_words AS kept FROM m"""


@query(sql=_quality_sql())
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of every document."""
    return quality.digest(quality.measure(table(spark, sf_dir, "documents")))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that occur elsewhere too."""
    return suffix_dedup.digest(suffix_dedup.dedup_suffixes(table(spark, sf_dir, "documents")))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


@query
def op5_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout and decoded again."""
    return pieces.round_trip(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


PASSAGES_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
g AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(w[s : s + 19], ' ') ORDER BY doc_id, s) AS nr
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
x AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM g WHERE nr > 1),
k AS (
  SELECT doc_id, string_agg(v, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN x USING (doc_id, i)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""


@query(sql=PASSAGES_SQL)
def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 20-word passages that start earlier in the corpus."""
    return debruijn.digest(debruijn.dedup_passages(table(spark, sf_dir, "documents")))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


PREFERENCES_SQL = """
WITH l AS (
  SELECT conv_id, max(turn) AS last, arg_max(text, turn) AS answer FROM conversations
  WHERE role = 'assistant' AND conv_id IS NOT NULL GROUP BY conv_id),
p AS (
  SELECT conv_id, last, CASE WHEN lead(conv_id) OVER w IS NULL THEN first_value(answer) OVER w ELSE lead(answer) OVER w END AS other
  FROM l WHERE (SELECT count(*) FROM l) > 1 WINDOW w AS (ORDER BY conv_id)),
t AS (
  SELECT conv_id AS pair_id, turn, role, text AS a,
    CASE WHEN turn = last AND role = 'assistant' THEN other ELSE text END AS b
  FROM conversations JOIN p USING (conv_id)),
f AS (SELECT pair_id, min(turn) FILTER (a IS DISTINCT FROM b) AS first FROM t GROUP BY pair_id),
r AS (
  SELECT pair_id, turn, role, CASE WHEN first IS NULL OR turn < first THEN 'prompt' ELSE 'chosen' END AS part, a AS text
  FROM t JOIN f USING (pair_id)
  UNION ALL
  SELECT pair_id, turn, role, 'rejected', b FROM t JOIN f USING (pair_id) WHERE turn >= first)
SELECT pair_id, part, turn, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
  part <> 'prompt' AND role = 'assistant' AS trained
FROM r"""


@query(sql=PREFERENCES_SQL)
def op9_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and completions of every conversation that has an answer, against the next one's last answer."""
    turns = table(spark, sf_dir, "conversations")
    return preferences.format_pairs(*preferences.neighbour_pairs(turns))


@query
def op9_neighbour_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and completions of every conversation that has an answer, whatever the gaps in the ids."""
    turns = table(spark, sf_dir, "conversations")
    return preferences.format_pairs(*preferences.neighbour_pairs(turns))


JACCARD_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, {WORDS}) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.root = e.a)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(root) AS component_id
FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id"""


@query(sql=JACCARD_SQL)
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of linked documents that every document belongs to."""
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


@query
def op10_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of documents that every document links with directly."""
    return jaccard_join.link_counts(table(spark, sf_dir, "documents"))


@query
def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    return token_align.digest(table(spark, sf_dir, "documents"))


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by byte-level BPE and decoded again."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
