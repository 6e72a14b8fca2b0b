"""The registered queries of this package, and SQL for those it can express.

Each applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    chat_format,
    collocations,
    decontaminate,
    html_extract,
    license_scan,
    phrase_fingerprints,
    quality_model,
    repeated_spans,
    secret_scan,
    sentence_pieces,
    shingle_join,
    suffix_spans,
    token_alignment,
)
from starmart.llm.common import read_table

PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"
BYTE_TOKENS = "byte_bpe_50k.json"
#: Word n-grams and similarity of the join, the repeat and benchmark windows.
JOIN_WORDS, JOIN_SHARE = 4, (85, 100)
REPEAT_WORDS = 50
REPEAT_BYTES = 50
BENCHMARK_WORDS = 10


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    text = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_format.conversation_digests(rows, tokenizer_path(RANKS), public_tokenizers.PATTERN).drop("n_tokens", "loss_tokens")


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shingle_join.similar_components(read_table(spark, sf_dir, "documents"), JOIN_WORDS, *JOIN_SHARE)
    return rows.select("doc_id", "n_shingles", "component_id")


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.remove_repeats(read_table(spark, sf_dir, "documents"), REPEAT_WORDS).drop("kept")


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.token_digests(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), BENCHMARK_WORDS)
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_digests(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENS), tokenizer_path(PIECES))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_spans.remove_repeated_bytes(read_table(spark, sf_dir, "documents"), REPEAT_BYTES, kept=False)


def queries() -> dict:
    return {
        "op1_chat_format": chat,
        "op2_license_scan": licenses,
        "op3_html_extract": pages,
        "op4_secret_scan": secrets,
        "op5_ngram_jaccard_join": jaccard,
        "op6_document_fingerprints": fingerprints,
        "op7_substring_dedup": repeats,
        "op8_sentencepiece": pieces,
        "op9_quality_classifier": quality,
        "op10_decontamination": benchmark,
        "op11_token_alignment": alignment,
        "op12_collocations": phrases,
        "op13_suffix_dedup": byte_repeats,
    }


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), sized AS (
  SELECT *, length(role) + length(text) + 13
    + len(regexp_extract_all(role || chr(10) || text, '<\\*s>|\[\\*INST\]|<\\*/s>|\[\\*/INST\]|<\\*pad>')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, w[i:i + 3] AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * same >= 85 * (x.n + y.n - same)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) USING (doc_id)
"""

REPEATS_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
), first AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN first USING (h) WHERE doc_id > d
), kept AS (
  SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words) x
  ANTI JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

BENCHMARK_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))
), found AS (SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN windows USING (n, s)
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1
), of AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM found) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN of USING (doc_id)
"""


COLLOCATIONS_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM docs
), freq AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k AS words, count(*)::HUGEINT AS a
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) v(k)) GROUP BY ALL
), sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM freq WHERE words = 1 GROUP BY lang
), cand AS (SELECT *, string_split(phrase, ' ') AS p FROM freq WHERE words > 1 AND a >= 10
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(p[1:k], ' ') AS lp, array_to_string(p[k + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand)
), scored AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, (1000000 * c.a * c.a) // (l.a * r.a) AS score
  FROM cuts c JOIN freq l ON l.lang = c.lang AND l.phrase = c.lp JOIN freq r ON r.lang = c.lang AND r.phrase = c.rp
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(p[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest([1, 2]) AS i FROM cand WHERE words = 3) GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON s.lang = i.lang AND s.phrase = i.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


SUFFIX_SQL = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM docs)
), first AS (SELECT s, min(doc_id) AS d FROM windows GROUP BY s
), hit AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM windows JOIN first USING (s) WHERE doc_id > d
), numbered AS (
  SELECT doc_id, i, count(*) FILTER (p IS NULL OR i > p + 50) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM hit
), spans AS (SELECT doc_id, min(i) AS b, max(i) + 50 AS e FROM numbered GROUP BY doc_id, g
), gaps AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS k FROM spans
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * k + 1, 2 * (b - k)), '' ORDER BY b) || substr(any_value(h), 2 * max(e) + 1) AS t,
    sum(e - b) AS n, count(*) AS c
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(c, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(t, h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": CHAT_SQL,
        "op5_ngram_jaccard_join": JACCARD_SQL,
        "op7_substring_dedup": REPEATS_SQL,
        "op10_decontamination": BENCHMARK_SQL,
        "op12_collocations": COLLOCATIONS_SQL,
        "op13_suffix_dedup": SUFFIX_SQL,
    }
