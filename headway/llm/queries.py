"""Registered queries of the text operators: each applies one to its whole table and derives digest columns from its output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    bytebpe,
    chatgrammar,
    collocations,
    crossparse,
    decontaminate,
    guesscost,
    lexsearch,
    perplexity,
    piecetable,
    simhash,
    toxiccrf,
    urltrees,
    viterbi,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query()
def op1_quality_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    """Word statistics, rules and perplexity bands of every document."""
    return perplexity.score(table(spark, folder, "documents"))


@query(
    r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
item_windows AS (
  SELECT item, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM item_windows),
doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
doc_windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc_words, sizes WHERE len(w) >= k)),
met AS (
  SELECT d.doc_id, d.i, d.k, t.item FROM doc_windows d JOIN (SELECT DISTINCT item, win, k FROM item_windows) t
  ON d.win = t.win AND d.k = t.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM met) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items m ON d.doc_id = m.doc_id
"""
)
def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and which items these are."""
    marked = decontaminate.mark(table(spark, folder, "documents"), table(spark, folder, "benchmark"), into="hits")
    hits = F.col("hits")
    return marked.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        decontaminate.items_digest(hits["items"]).alias("items_sha256"),
        (hits["n_hit"] > 0).alias("contaminated"),
    )


@query()
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from rows that are not held out."""
    docs = table(spark, folder, "documents")
    found = crossparse.identify(docs.select("doc_id", "text"), crossparse.learned_from(docs))
    return found.select("doc_id", crossparse.held_out(F.col("doc_id")).alias("held_out"), "language.*")


@query()
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document: counts and digest of the fixed patterns, and all spans."""
    s = F.col("secrets")
    return guesscost.scan(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id",
        *(s[n].alias(n) for n in ("n_assign", "n_access", "n_hex")),
        F.sha2(s["base"], 256).alias("base_sha256"),
        s["spans"].alias("spans"),
        s["n_guess"].alias("n_guess"),
        s["most_guesses"].alias("most_guesses"),
    )


PIECES = "piece_bpe_32k.model"


@query()
def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and their decoded text, as digests."""
    model = piecetable.read_model(public_tokenizers.path(PIECES))
    return piecetable.encode(table(spark, folder, "documents"), model, with_ids=False)


@query()
def op10_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and group of near duplicates of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@query()
def op3_unigram_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Number of unigram pieces of every document."""
    model = piecetable.read_model(public_tokenizers.path(PIECES))
    return viterbi.token_counts(table(spark, folder, "documents"), model)


URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query()
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return urltrees.judge(table(spark, folder, "pages"), URL_RULES)


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learned from labels that are not held out."""
    docs = table(spark, folder, "documents")
    model = toxiccrf.learned_from(docs, table(spark, folder, "labels"))
    found = toxiccrf.score(docs.select("doc_id", "text"), model)
    score = F.col("toxicity")["score"]
    return found.select(
        "doc_id",
        toxiccrf.held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        F.when(score >= 0.3, 1).otherwise(0).alias("predicted"),
        F.col("toxicity")["n_toxic"].alias("n_toxic"),
    )


@query(
    r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
      ELSE 20 + length(to_base64(encode(role))) END + length(text)
    + CASE WHEN regexp_matches(text, '\[/?INST\]|</?s>|<</?SYS>>|<<ROLE:[A-Za-z0-9+/=]*>>|<</ROLE>>')
        OR regexp_matches(text, '[\[<]<?\\+/?(?:s>|INST\]|SYS>>|ROLE)')
      THEN len(regexp_extract_all(text, '[\[<]<?\\*/?(?:s>|INST\]|SYS>>|ROLE)')) ELSE 0 END AS n
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
)
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted and read back, as digests; with one whose texts hold marks."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.sql(
        "SELECT -1L AS conv_id, n AS turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(n, role)"
    )
    made = chatgrammar.format_conversations(rows.unionByName(hard))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = chatgrammar.loss_text(F.col("formatted"), F.col("loss_spans"))
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


RANKS = "byte_bpe_multi_50k.tiktoken"


@query()
def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes they decode to, as digests."""
    lines = bytebpe.read_ranks(public_tokenizers.path(RANKS))
    return bytebpe.encode(table(spark, folder, "documents"), lines, public_tokenizers.PATTERN, with_ids=False)


@query(
    r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
ws AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ws, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM counts WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT lang, phrase, k, f AS a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS tail
  FROM c, (SELECT unnest([1, 2, 3]) AS j) WHERE j < k),
s AS (
  SELECT cuts.*, h.f AS l, t.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (h.f + t.f) AS BIGINT) AS score
  FROM cuts JOIN counts h ON cuts.lang = h.lang AND cuts.head = h.phrase JOIN counts t ON cuts.lang = t.lang AND cuts.tail = t.phrase),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
dropped AS (
  SELECT DISTINCT low.lang, low.phrase FROM low JOIN c ON low.lang = c.lang AND c.k > low.k
    AND contains(' ' || c.phrase || ' ', ' ' || low.phrase || ' ') AND 100 * c.f >= 80 * low.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM low ANTI JOIN dropped USING (lang, phrase))
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON ranked.lang = totals.lang WHERE rank <= 2000
"""
)
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 phrases of every language whose words stand together most."""
    return collocations.mine(table(spark, folder, "documents"))


@query(
    r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
size AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS wt
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size),
sizes AS (SELECT doc_id, 100 - 90 + (90 * len(w) * docs) // words AS m FROM d, size WHERE len(w) > 0),
scores AS (
  SELECT item_id, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
)
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexsearch.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
