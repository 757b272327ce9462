"""The operators as queries over whole tables, and their SQL where SQL can express them."""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import (
    chat_format, collocations, decontaminate, exact_dedup, hard_negatives, line_dedup, mixing, quality_rules, secret_scan, simhash, suffix_dedup, token_records, toxicity,
)

END_ID = 2
#: target weights of the sources: four steps, five sources each; all others share one weight
WEIGHTS = {f"src{n}": 4 - n // 5 for n in range(20)}
TRICKY = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is in the layout of turn rows; the conversation with control strings comes as a record."""
    messages = [{"role": role, "content": TRICKY} for role in ("user", "assistant")]
    record = spark.range(1).select(F.lit(json.dumps({"conv_id": -7, "messages": messages})).alias("record"))
    more = chat_format.turns_of_json(record, "record").select("conv_id", "turn", "role", "text")
    turns = chat_format.turns_of_table(table(spark, sf_dir, "conversations"))
    return chat_format.report(turns.unionByName(more))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"), WEIGHTS)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.encode_to_files(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.report(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows carry a wrong label, and every hundredth id is an anchor."""
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, noisy)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.judged(table(spark, sf_dir, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}


#: for the queries that SQL can express and DuckDB answers in reasonable time
SQL: dict[str, str] = {}

# Words, spans and turns are the operators' own results, each computed here from its definition.
SQL["op5_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    -- marks are 16 characters a turn; each of the three replaced characters takes one more
    sum(
        16 + 2 * (length(role) + length(text))
        - length(regexp_replace(role || text, '[\\<>]', '', 'g'))
    )::BIGINT AS formatted_chars
FROM turns
GROUP BY conv_id
"""

SQL["op6_decontaminate"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'
    ) AS words
    FROM documents
),
items AS (
    SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'
    ) AS words
    FROM benchmark
),
item_starts AS (
    SELECT item, words, least(len(words), 10) AS size, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i
    FROM items WHERE len(words) > 0
),
patterns AS (SELECT DISTINCT item, size, array_to_string(words[i : i + size - 1], ' ') AS run FROM item_starts),
sizes AS (SELECT d, words, unnest((SELECT list(DISTINCT size) FROM patterns)) AS size FROM texts),
starts AS (SELECT d, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM sizes),
windows AS (SELECT d, size, i, array_to_string(words[i : i + size - 1], ' ') AS run FROM starts),
found AS (SELECT d, i, size, item FROM windows JOIN patterns USING (size, run)),
covered AS (SELECT DISTINCT d, unnest(range(i, i + size)) AS word FROM found),
hits AS (SELECT d, count(*) AS n_hit FROM covered GROUP BY d),
owners AS (SELECT d, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT d, item FROM found) GROUP BY d)
SELECT
    doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (d) LEFT JOIN owners USING (d)
"""

SQL["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
    )) AS piece
    FROM documents
),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM lists GROUP BY lang),
sizes AS (SELECT lang, words, unnest(range(1, 6)) AS size FROM lists),
starts AS (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM sizes),
counts AS (
    SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS f
    FROM starts GROUP BY ALL HAVING count(*) >= 100
),
cuts AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k
    FROM counts WHERE size > 1
),
scores AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
        ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1 : c.k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.k + 1 :], ' ')
    JOIN totals t ON t.lang = c.lang
),
weakest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
kept AS (
    SELECT * FROM weakest w WHERE NOT EXISTS (
        SELECT 1 FROM counts o
        WHERE o.lang = w.lang AND o.size > w.size AND o.f >= w.a
            AND contains(' ' || o.phrase || ' ', ' ' || w.phrase || ' ')
    )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""

SQL["op12_hard_negatives"] = r"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS alike,
        list_inner_product(a.v, b.v)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p
JOIN scores s ON s.anchor_id = p.anchor_id AND NOT alike
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

SQL["op13_exact_dedup"] = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
    FROM documents
)
SELECT
    doc_id,
    first_value(doc_id) OVER (same ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER same AS group_size,
    row_number() OVER (same ORDER BY chars DESC, doc_id) = 1 AS kept,
    sha256(plain) AS text_sha256
FROM plain
WINDOW same AS (PARTITION BY plain)
"""


def statements() -> dict[str, str]:
    return dict(SQL)
