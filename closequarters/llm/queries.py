"""One registered query per operator, each over its whole table, and the SQL
twins of those that SQL can express."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat_prefix import control_conversation, conversation_digests, format_turns
from .collision_join import near_vectors
from .common import read_table
from .exact_split import exact_dedup
from .heap_bpe import bpe_round_trip
from .hyperminhash import near_duplicates
from .kneser_ney import toxicity_scores
from .line_spread import MIN_SITES, line_report
from .ngram_lm import language_model_scores
from .nnls_pack import pack_documents
from .pairwise_quality import quality_scores
from .periodic_runs import periodic_runs, planted_repeats, run_report
from .phrase_stripes import MAX_WORDS, MIN_COUNT, NO_LANG, TOP, collocations
from .template_join import NAMING, license_scan


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _op1(spark, d):
    return near_vectors(read_table(spark, d, "embeddings"))


def _op2(spark, d):
    conv = read_table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_turns(conv.unionByName(control_conversation(spark))))


def _op3(spark, d):
    return line_report(read_table(spark, d, "documents"))


def _op4(spark, d):
    return exact_dedup(read_table(spark, d, "documents"))


def _op5(spark, d):
    return toxicity_scores(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def _op6(spark, d):
    return quality_scores(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def _op7(spark, d):
    return license_scan(read_table(spark, d, "documents"), naming=NAMING)


def _op8(spark, d):
    return near_duplicates(read_table(spark, d, "documents"), shingle=4, percent=80)


def _op9(spark, d):
    return pack_documents(read_table(spark, d, "documents"), tokenizer_file("word_bpe_49k.json"))


def _op10(spark, d):
    return bpe_round_trip(read_table(spark, d, "documents"), tokenizer_file("byte_bpe_50k.json"))


def _op11(spark, d):
    return run_report(periodic_runs(planted_repeats(read_table(spark, d, "documents"))))


def _op12(spark, d):
    return language_model_scores(read_table(spark, d, "documents"))


def _op13(spark, d):
    return collocations(read_table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_collision_join": _op1,
    "op2_chat_prefix": _op2,
    "op3_line_spread": _op3,
    "op4_exact_split": _op4,
    "op5_kneser_ney": _op5,
    "op6_pairwise_quality": _op6,
    "op7_template_join": _op7,
    "op8_hyperminhash": _op8,
    "op9_nnls_pack": _op9,
    "op10_heap_bpe": _op10,
    "op11_factor_runs": _op11,
    "op12_mapped_lm": _op12,
    "op13_phrase_stripes": _op13,
}

ESCAPE_SQL = r"regexp_replace({}, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')"

ORACLES: dict[str, str] = {
    "op2_chat_prefix": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, length({ESCAPE_SQL.format('role')}) + length({ESCAPE_SQL.format('text')}) + 1
             + length(role) - length(replace(replace(role, chr(92), ''), chr(10), ''))
             + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END AS chars FROM turns),
g AS (SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(chars)::BIGINT AS formatted_chars
      FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM g""",
    "op3_line_spread": f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
wide AS (SELECT line FROM lines WHERE trim(line, ' ') <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (SELECT l.*, w.line IS NOT NULL AND row_number() OVER (PARTITION BY l.line ORDER BY doc_id, pos) > 1 AS gone
           FROM lines l LEFT JOIN wide w ON l.line = w.line),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
                coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
         FROM marked GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, length(text)::BIGINT AS n_chars, sha256(text) AS text_sha256 FROM kept""",
    "op4_exact_split": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op13_phrase_stripes": f"""
WITH texts AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
said AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
f AS (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
    FROM said, range(1, {MAX_WORDS + 1}) r(m) WHERE len(w) >= m) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
often AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f FROM f WHERE m > 1 AND f >= {MIN_COUNT}),
inside AS (
  SELECT DISTINCT lang, part, f FROM (
    SELECT lang, f, unnest(list_transform(range(1, m - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS part
    FROM often, range(2, {MAX_WORDS}) r(k) WHERE k < m)),
kept AS (SELECT * FROM often o WHERE NOT EXISTS (
  SELECT 1 FROM inside i WHERE i.lang = o.lang AND i.part = o.phrase AND 100 * i.f >= 100 * o.f)),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, l.f AS l, r.f AS r, n.n,
         ((1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:m], ' ') AS rest
        FROM kept, range(1, {MAX_WORDS}) r(k) WHERE k < m) c
  JOIN f l ON l.lang = c.lang AND l.phrase = c.first JOIN f r ON r.lang = c.lang AND r.phrase = c.rest
  JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= {TOP}""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
