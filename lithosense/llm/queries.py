"""The dealt operators as queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lithosense.llm import ann, bpe, chat, decontaminate, hmm, line_dedup, manifest, near_dedup, quality, repair, rules, secrets, sharding
from lithosense.llm.common import table

# CRC-32 of an ASCII string {s} in SQL; ``crc`` holds its table, built by its rule.
_CRC_TABLE = """
    crc AS (
      SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
    )"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = [f"shard-{i:04d}" for i in range(1000)]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("op2_sharding")
def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document placed on one of 1,000 shards."""
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


@query("op5_bpe")
def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, into=None, digests=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


_PROBE = "</s>[INST] ok [/INST]"


@query(
    "op7_chat",
    """
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), sized AS (
      SELECT *, length(role) + length(text) + length(role || text) - length(replace(role || text, '␛', ''))
        + len(regexp_extract_all(text, '<[|](im_start|im_sep|im_end|endoftext)[|]>|</?s>|\\[/?INST\\]|<</?SYS>>'))
        + len(regexp_extract_all(role, '<[|](im_start|im_sep|im_end|endoftext)[|]>|</?s>|\\[/?INST\\]|<</?SYS>>'))
        + length('<|im_start|>') + length('<|im_sep|>') + length('<|im_end|>') + 1 AS chars
      FROM rows
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(chars)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """,
)
def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted and read back."""
    probe = spark.range(2).selectExpr("-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{_PROBE}' AS text")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.format_conversations(conversations))


@query("op10_secrets")
def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document; formats are learnt from the same table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digests(secrets.scan(docs, secrets.fit(docs)))


@query("op8_near_dedup")
def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles are similar."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query("op1_line_dedup")
def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that an earlier line repeats, equal or one edit away."""
    cleaned = line_dedup.remove_duplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


@query("op3_decontaminate")
def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it holds."""
    return decontaminate.by_document(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op9_quality")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's perplexity under the model of trusted text, and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query("op6_hmm")
def hmm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under the hidden Markov model and under word frequencies."""
    return hmm.score(table(spark, sf_dir, "documents"))


@query("op4_ann")
def ann_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@query(
    "op11_quality_rules",
    f"""
    WITH {_CRC_TABLE}, texts AS (
      SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents
    ), words AS (
      SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS i
      FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts)
    ), spans AS (
      SELECT rid, i, word, lead(word) OVER w AS next,
        word || ' ' || lead(word) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w || ' ' || lead(word, 4) OVER w AS five
      FROM words WINDOW w AS (PARTITION BY rid ORDER BY i)
    ), repeats AS (
      SELECT rid, count(DISTINCT i + k) AS n_repeat_words
      FROM (SELECT rid, i FROM spans WHERE five IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, five) > 1), range(5) r(k)
      GROUP BY rid
    ), lines AS (
      SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
    ), counted AS (
      SELECT rid, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM words GROUP BY rid
    ), measured AS (
      SELECT t.rid, doc_id, lang, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM texts t LEFT JOIN counted USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN repeats USING (rid)
    ), trusted AS (
      SELECT doc_id, md5(doc_id::VARCHAR) AS k FROM labels WHERE doc_id IS NOT NULL
      GROUP BY doc_id HAVING min(coalesce(quality, 0)) = 1 AND max(coalesce(toxic, 0)) = 0
    ), chosen AS (
      SELECT doc_id FROM trusted WHERE k < '8' ORDER BY k, doc_id LIMIT 20000
    ), grams AS (
      SELECT rid, word AS gram FROM spans UNION ALL SELECT rid, word || ' ' || next FROM spans WHERE next IS NOT NULL
    ), spelt AS (
      SELECT gram, hex(gram) AS x FROM (SELECT DISTINCT gram FROM grams)
    ), hashed AS (
      SELECT gram, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) & 65535 AS bucket FROM spelt, crc
    ), placed AS (
      SELECT rid, bucket FROM grams JOIN hashed USING (gram)
    ), buckets AS (
      SELECT bucket, count(*) AS r, count(c.doc_id) AS t
      FROM placed JOIN texts USING (rid) LEFT JOIN chosen c ON c.doc_id = texts.doc_id GROUP BY bucket
    ), ratios AS (
      SELECT bucket, round((ln((t + 1) / (sum(t) OVER () + 65536)) - ln((r + 1) / (sum(r) OVER () + 65536))) * 1048576)::BIGINT AS ratio FROM buckets
    ), scores AS (
      SELECT rid, floor(sum(ratio)::BIGINT * 10000.0::DOUBLE / (count(*) * 1048576.0::DOUBLE))::BIGINT AS score FROM placed JOIN ratios USING (bucket) GROUP BY rid
    ), held AS (
      SELECT lang, score FROM scores JOIN measured m USING (rid) WHERE m.doc_id IN (SELECT doc_id FROM trusted WHERE k >= '8')
    ), ranked AS (
      SELECT lang, score, row_number() OVER (PARTITION BY lang ORDER BY score) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM held
    ), ranked_all AS (
      SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM held
    ), own AS (
      SELECT lang, min(score) FILTER (i = floor((n - 1) * 0.5)) AS mid, min(score) FILTER (i = floor((n - 1) * 0.01)) AS low FROM ranked WHERE n >= 20 GROUP BY lang
    ), overall AS (
      SELECT min(score) FILTER (i = floor((n - 1) * 0.5)) AS mid, min(score) FILTER (i = floor((n - 1) * 0.01)) AS low FROM ranked_all
    ), judged AS (
      SELECT m.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, score,
        coalesce(o.mid - 2 * (o.mid - o.low), a.mid - 2 * (a.mid - a.low)) AS lim
      FROM measured m LEFT JOIN scores USING (rid) LEFT JOIN own o ON o.lang IS NOT DISTINCT FROM m.lang, overall a
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score / 10000.0::DOUBLE AS score,
      NOT base_failed AND coalesce(score >= lim, true) AS kept
    FROM judged
    """,
)
def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures, and whether it reads enough like trusted text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return rules.classify(docs, table(spark, sf_dir, "labels")).drop("limit")


@query(
    "op12_conversation_repair",
    f"""
    WITH RECURSIVE {_CRC_TABLE}, keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
    ), kinds AS (
      SELECT conv_id, turn, role, text, {_CRC.format(s="k")} % 20 AS kind FROM keyed, crc
    ), damaged AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM kinds, range(2) r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
    ), numbered AS (
      SELECT *, row_number() OVER w AS n, lag(left(role, 1)) OVER w AS before FROM damaged
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    ), faults AS (
      SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
        WHEN n > min(n) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault
      FROM numbered
    ), inserts(a, m, cost, letters, lines) AS (
      VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
        (0, 2, 3, 'I', 'user:' || chr(10)), (1, 2, 3, 'I', 'user:' || chr(10)), (2, 3, 3, 'I', 'assistant:' || chr(10)), (3, 2, 3, 'I', 'user:' || chr(10)),
        (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))
    ), made(m, b, name) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
    kept(m, initial, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    edges AS (
      SELECT conv_id, n, m, m AS b, 4 AS cost, 'D' AS letter, '' AS line FROM faults, (VALUES (0), (1), (2), (3)) s(m)
      UNION ALL SELECT conv_id, n, m, b, 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'R', name || ':' || text || chr(10)
        FROM faults, made WHERE fault IN ('', 'truncated')
      UNION ALL SELECT conv_id, n, m, b, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', role || ':' || text || chr(10)
        FROM faults JOIN kept ON left(role, 1) = initial WHERE fault IN ('', 'truncated')
    ), steps AS (
      SELECT conv_id, n, a, b, i.cost + e.cost AS cost, letters || letter AS letters, lines || line AS lines FROM edges e JOIN inserts i ON i.m = e.m
    ), paths AS (
      SELECT conv_id, 0::BIGINT AS n, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM (SELECT DISTINCT conv_id FROM conversations)
      UNION ALL
      SELECT p.conv_id, s.n, s.b, p.cost + s.cost, p.audit || s.letters, p.lines || s.lines
      FROM paths p JOIN steps s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.n = p.n + 1 AND s.a = p.state
      QUALIFY row_number() OVER (PARTITION BY p.conv_id, s.b ORDER BY p.cost + s.cost, p.audit || s.letters) = 1
    ), lengths AS (
      SELECT conv_id, max(n) AS n FROM paths GROUP BY conv_id
    ), ended AS (
      SELECT p.conv_id, p.cost + CASE state WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END AS cost,
        audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
        lines || CASE state WHEN 1 THEN 'user:' || chr(10) || 'assistant:' || chr(10) WHEN 2 THEN 'assistant:' || chr(10) ELSE '' END AS lines
      FROM paths p JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.n = p.n
    ), cheapest AS (
      SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
    ), counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
      FROM faults GROUP BY conv_id
    )
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, cost, audit, sha256(left(lines, greatest(length(lines) - 1, 0))) AS repaired_sha256
    FROM cheapest e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
)
def repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, with its faults and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digests(repair.damage(rows), rows.select("conv_id").distinct())


def _packed(*fields: str) -> str:
    return " || ".join(f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in fields)


@query(
    "op13_merkle_manifest",
    f"""
    WITH RECURSIVE {_CRC_TABLE}, hashed AS (
      SELECT row_number() OVER () AS rid, doc_id, source, sha256({_packed("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
        CASE WHEN {_CRC.format(s="doc_id::VARCHAR")} % 5 = 0
          THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown, lang, n_chars
      FROM documents, crc
    ), leaves AS (
      SELECT rid, doc_id, source, leaf, sha256({_packed("doc_id", "source", "lang", "n_chars", "shown")}) AS claimed,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s
      FROM hashed
    ), nodes AS (
      SELECT s, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY s) AS width FROM leaves
      UNION ALL
      SELECT s, level, pos, h, count(*) OVER (PARTITION BY s) FROM (
        SELECT s, level + 1 AS level, pos // 16 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM nodes WHERE width > 1 GROUP BY s, level, pos // 16
      )
    ), subroots AS (
      SELECT s, level AS depth, h FROM nodes WHERE width = 1
    ), tops AS (
      SELECT 0 AS level, s AS pos, h, count(*) OVER () AS width FROM subroots
      UNION ALL
      SELECT level, pos, h, count(*) OVER () FROM (
        SELECT level + 1 AS level, pos // 16 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM tops WHERE width > 1 GROUP BY level, pos // 16
      )
    ), paths AS (
      SELECT rid, n.level AS k, n.pos, n.h, n.pos = l.pos // (16 ** n.level)::BIGINT AS own
      FROM leaves l JOIN nodes n ON n.s = l.s AND n.width > 1 AND n.pos // 16 = l.pos // (16 ** (n.level + 1))::BIGINT
      UNION ALL
      SELECT rid, depth + t.level, t.pos, t.h, t.pos = l.s // (16 ** t.level)::BIGINT
      FROM leaves l JOIN subroots r ON r.s = l.s JOIN tops t ON t.width > 1 AND t.pos // 16 = l.s // (16 ** (t.level + 1))::BIGINT
    ), folds AS (
      SELECT rid, 0 AS k, claimed AS h FROM leaves
      UNION ALL
      SELECT f.rid, f.k + 1, sha256(string_agg(CASE WHEN own THEN f.h ELSE p.h END, '' ORDER BY p.pos)) FROM folds f JOIN paths p ON p.rid = f.rid AND p.k = f.k GROUP BY f.rid, f.k
    ), folded AS (
      SELECT rid, arg_max(h, k) AS h FROM folds GROUP BY rid
    ), proofs AS (
      SELECT rid, string_agg(h, '' ORDER BY k, pos) AS siblings FROM paths WHERE NOT own GROUP BY rid
    )
    SELECT doc_id, leaf, r.h AS subroot, t.h AS root, sha256(coalesce(siblings, '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
    FROM leaves l JOIN subroots r USING (s) JOIN folded f USING (rid) LEFT JOIN proofs USING (rid), (SELECT h FROM tops WHERE width = 1) t
    """,
)
def manifest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and roots, and whether a tampered copy is found out."""
    docs = table(spark, sf_dir, "documents")
    shown = {"text": manifest.tampered(F.col("text"), F.col("doc_id"))}
    return manifest.manifest(manifest.leaves(docs, presented=shown))
