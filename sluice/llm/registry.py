"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import (decontaminate, filter_audit, imatch, language_id, line_dedup, lm_score,
                        minhash, quality)
from sluice.llm.chat_format import check_chats
from sluice.llm.common import table
from sluice.llm.mixing import mix
from sluice.llm.token_alignment import alignment
from sluice.llm.token_counts import token_counts
from sluice.llm.warc import archive


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dups(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.evaluate(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.evaluate(table(spark, sf_dir, "documents"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), vocabulary(),
                     vocabulary("piece_bpe_32k.model"))


# A conversation of texts that hold control strings, escaped ones included.
PLANTED = [(-7, i, role, "\\### Assistant: </turn> ok") for i, role in
           enumerate(("user", "assistant"))]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return check_chats(chats.unionByName(spark.createDataFrame(PLANTED, chats.schema)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dups": op1_near_dups,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_decontaminate": op4_decontaminate,
    "op5_mixing": op5_mixing,
    "op6_line_dedup": op6_line_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_imatch": op8_imatch,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_alignment": op12_token_alignment,
    "op13_chat_format": op13_chat_format,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


# Line classes, the classes with an earlier near line (a third of the shorter line must occur
# unchanged in the other), and the dropped lines. A place is id * 10^6 + line number.
LINES = """
    split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
    every AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS pos
              FROM split),
    line AS (SELECT doc_id, pos, doc_id * 1000000 + pos AS place,
                    trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM every),
    long AS (SELECT * FROM line WHERE length(line) >= 32),
    class AS (SELECT line, min(place) AS first, length(line) AS n FROM long GROUP BY line),
    side AS (SELECT *, unnest([-2, -1, 0, 1, 2]) AS d FROM class),
    near AS (SELECT DISTINCT greatest(a.first, b.first) AS first
             FROM side a JOIN class b ON a.n + a.d = b.n AND a.first <> b.first
             WHERE (contains(b.line, a.line[1:a.n // 3])
                    OR contains(b.line, a.line[a.n // 3 + 1:2 * (a.n // 3)])
                    OR contains(b.line, a.line[2 * (a.n // 3) + 1:]))
               AND levenshtein(a.line, b.line) <= 2),
    gone AS (SELECT long.doc_id, long.pos FROM long JOIN class USING (line)
             WHERE long.place <> class.first OR class.first IN (SELECT first FROM near))"""

SQL: dict[str, str] = {
    "op1_near_dups": """
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (SELECT doc_id, list_sort(CASE WHEN len(ws) = 0 THEN []
                  WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                  ELSE list_distinct(list_transform(range(1, len(ws) - 3),
                      lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS sh FROM w),
        c AS (SELECT sh, min(doc_id) AS rep FROM s WHERE len(sh) > 0 GROUP BY sh),
        x AS (SELECT rep, len(sh) AS n, unnest(sh) AS g FROM c),
        p AS (SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS same
              FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep GROUP BY ALL),
        e AS (SELECT a, b FROM p WHERE 100 * same >= 75 * (na + nb - same)),
        ends AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r AS (SELECT rep AS node, rep AS root FROM c
              UNION SELECT ends.b, r.root FROM r JOIN ends ON ends.a = r.node),
        m AS (SELECT node, min(root) AS root FROM r GROUP BY node)
        SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(m.root, s.doc_id) AS component_id,
               coalesce(m.root, s.doc_id) = s.doc_id AS kept
        FROM s LEFT JOIN c ON c.sh = s.sh LEFT JOIN m ON m.node = c.rep""",
    "op6_line_dedup": f"""
        WITH {LINES}
        SELECT split.doc_id, coalesce(len(any_value(parts)), 0) AS n_lines,
               coalesce(len(any_value(parts)), 0) - count(gone.pos) AS n_kept,
               coalesce(string_agg(gone.pos, ',' ORDER BY gone.pos), '') AS dropped_lines
        FROM split LEFT JOIN gone USING (doc_id) GROUP BY split.doc_id""",
    "op10_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha256(coalesce(html, '')) AS payload_digest FROM pages),
             f AS (SELECT payload_digest, min(page_id) AS first FROM p
                   WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, CASE WHEN first IS NULL OR page_id = first THEN 'response'
                             ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to,
               CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op11_filter_audit": """
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text
                   FROM documents),
        w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'),
                                    lambda x: x <> '') AS ws FROM d),
        first AS (SELECT text, min(doc_id) AS low FROM d GROUP BY text),
        lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
                FROM labels GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
                     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
                     regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > low, false) AS e
              FROM w JOIN first USING (text) LEFT JOIN lab USING (doc_id)),
        m AS (SELECT part, CASE WHEN a THEN 1 ELSE 0 END + CASE WHEN b THEN 2 ELSE 0 END
                         + CASE WHEN c THEN 4 ELSE 0 END + CASE WHEN d THEN 8 ELSE 0 END
                         + CASE WHEN e THEN 16 ELSE 0 END AS failed, good, toxic FROM f),
        n AS (SELECT part, failed, count(*) AS docs, count(*) FILTER (good) AS good,
                     count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, failed),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
        o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
              FROM l p, l q, l r, l s, l t
              WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
                AND len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
        steps AS (SELECT filter_order, step, l.x, l.bit,
                         list_sum([0] || list_transform(range(1, step), lambda k:
                             1 << (ascii(filter_order[k]) - 65)))::INTEGER AS before
                  FROM o, range(1, 6) AS g(step) JOIN l ON l.x = filter_order[step]),
        r AS (SELECT part, filter_order, step, x,
                     sum(CASE WHEN failed & (before | bit) = 0 THEN docs ELSE 0 END) AS kept,
                     sum(CASE WHEN failed & before = 0 AND failed & bit <> 0
                              THEN docs ELSE 0 END) AS removed,
                     sum(CASE WHEN failed & before <> 0 AND failed & bit <> 0
                              THEN docs ELSE 0 END) AS redundant,
                     sum(CASE WHEN failed = bit THEN docs ELSE 0 END) AS unique_fails,
                     sum(CASE WHEN failed & before = 0 AND failed & bit <> 0
                              THEN good ELSE 0 END) AS good_lost,
                     sum(CASE WHEN failed & before = 0 AND failed & bit <> 0
                              THEN toxic ELSE 0 END) AS toxic_lost
              FROM n, steps GROUP BY part, filter_order, step, x)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r""",
    "op13_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                   FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
                   UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                                           text) AS pos,
                     len(regexp_extract_all(text,
                         '### (?:System|User|Assistant|Role=[\w.~%-]*):|</turn>')) AS escapes,
                     CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
                          ELSE 5 + length(url_encode(role)) END AS label
              FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos))
                   AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
                   AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                                 ORDER BY pos)) AS loss_sha256,
               CAST(sum(4 + label + 2 + length(text) + escapes + 9) AS BIGINT)
                   AS formatted_chars
        FROM n GROUP BY conv_id""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
