"""Registered queries of the training-data operators: (spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import ann, bpe, conversations, htmltext, langid, lm, manifest, mixing, parity_join, suffix_rules, templates, units, warc
from ledgerlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@registered
def op1_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@registered
def op2_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parity_join.component_ids(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


@registered
def op3_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_rules.quality(table(spark, sf_dir, "documents"), ["doc_id"])


@registered
def op4_elias_fano_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.fit_and_score(table(spark, sf_dir, "documents"))


@registered
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), BPE_RANKS)


@registered
def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = templates.drop_lines(table(spark, sf_dir, "documents"), ["doc_id"])
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@registered
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = mixing.mix_report(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "size", "source_size", "target", "taken", "n_slots", "first_shard", "last_shard")


@registered
def op8_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


@registered
def op9_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.fit_and_predict(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "held_out", "lang_pred", "score")


@registered
def op10_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = units.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start", "end", "n_words", "first_doc_id")


@registered
def op11_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@registered
def op12_bitmap_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audited(table(spark, sf_dir, "documents"))


@registered
def op13_block_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


# CRC-32 of ASCII text {0} as list arithmetic; the table ``crc_table`` holds its 256 words as the list t.
CRC_TABLE = """crc_table AS (
            SELECT list(v ORDER BY i) AS t FROM (
                SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) AS r(i)
            )
        )"""
CRC = """xor(list_reduce([4294967295] || list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _coded(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_coded, ["doc_id", "source", "lang", n_chars, "text"])) + ")"


ORACLE_SQL: dict[str, str] = {
    # v0 .. v3: least cost of the turns from pos on, in the states nothing yet, after system, user, assistant.
    "op13_block_tables": f"""
        WITH RECURSIVE {CRC_TABLE},
        keyed AS (
            SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
            FROM conversations
        ),
        kinds AS (SELECT c, turn, role, text, {CRC.format("name")} % 20 AS kind FROM keyed, crc_table),
        turns AS (
            SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM kinds
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
                   rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
            FROM turns
        ),
        faults AS (
            SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY pos) AS earlier,
                   CASE WHEN trimmed = '' THEN 'b' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 THEN 'd'
                        WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
            FROM placed
        ),
        counts AS (
            SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                   count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY c
        ),
        backward AS (
            SELECT c, n + 1 AS pos, 0 AS v0, 4 AS v1, 2 AS v2, 0 AS v3 FROM counts
            UNION ALL
            SELECT c, pos, least(b0, 2 + least(b2, 2 + b3)), least(b1, 2 + least(b2, 2 + b3)), least(b2, 2 + b3), least(b3, 2 + b2)
            FROM (
                SELECT b.c, f.pos,
                       least(3 + v0, m + 2 + v2, CASE WHEN initial = 's' THEN m + v1 WHEN initial = 'u' THEN m + v2 ELSE 1000000 END) AS b0,
                       least(3 + v1, m + 2 + v2, CASE WHEN initial = 'u' THEN m + v2 ELSE 1000000 END) AS b1,
                       least(3 + v2, m + 2 + v3, CASE WHEN initial = 'a' THEN m + v3 ELSE 1000000 END) AS b2,
                       least(3 + v3, m + 2 + v2, CASE WHEN initial = 'u' THEN m + v2 ELSE 1000000 END) AS b3
                FROM backward b JOIN (SELECT *, CASE fault WHEN '' THEN 0 WHEN 't' THEN 1 ELSE 1000000 END AS m FROM faults) f
                  ON b.c = f.c AND f.pos = b.pos - 1
            )
        ),
        costs AS (SELECT c, pos, [v0, v1, v2, v3] AS v FROM backward),
        forward AS (
            SELECT c, CAST(1 AS BIGINT) AS pos, 0 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM counts
            UNION ALL
            SELECT c, CASE WHEN letter = 'I' THEN pos ELSE pos + 1 END,
                   CASE WHEN letter = 'D' THEN q WHEN letter = 'K' AND initial = 's' THEN 1 WHEN q = 2 THEN 3 ELSE 2 END, audit || letter,
                   CASE letter WHEN 'D' THEN lines WHEN 'K' THEN lines || [role || ':' || text]
                        ELSE lines || [CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || CASE letter WHEN 'R' THEN text ELSE '' END] END
            FROM (
                SELECT f.c, f.pos, f.q, f.audit, f.lines, r.initial, r.role, r.text,
                       CASE WHEN r.pos IS NOT NULL AND here.v[q + 1] = 3 + later.v[q + 1] THEN 'D'
                            WHEN here.v[q + 1] = 2 + here.v[CASE WHEN q = 2 THEN 4 ELSE 3 END] THEN 'I'
                            WHEN initial = 's' AND q = 0 AND here.v[1] = m + later.v[2] THEN 'K'
                            WHEN initial = 'u' AND q <> 2 AND here.v[q + 1] = m + later.v[3] THEN 'K'
                            WHEN initial = 'a' AND q = 2 AND here.v[3] = m + later.v[4] THEN 'K'
                            ELSE 'R' END AS letter
                FROM forward f JOIN costs here ON f.c = here.c AND f.pos = here.pos
                LEFT JOIN costs later ON f.c = later.c AND later.pos = f.pos + 1
                LEFT JOIN (SELECT *, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS m FROM faults) r ON f.c = r.c AND f.pos = r.pos
                WHERE r.pos IS NOT NULL OR f.q IN (1, 2)
            )
        ),
        ended AS (SELECT f.c, f.audit, sha256(array_to_string(lines, chr(10))) AS digest FROM forward f JOIN counts n ON f.c = n.c AND f.pos = n.n + 1 WHERE q IN (0, 3))
        SELECT i.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
               coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, CAST(coalesce(v.v[1], 0) AS BIGINT) AS cost,
               coalesce(e.audit, '') AS audit, coalesce(e.digest, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS c FROM conversations) i
        LEFT JOIN counts n ON i.c = n.c LEFT JOIN costs v ON i.c = v.c AND v.pos = 1 LEFT JOIN ended e ON i.c = e.c
    """,
    "op12_bitmap_ranks": f"""
        WITH RECURSIVE {CRC_TABLE},
        leaves AS (
            SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("n_chars")} AS leaf,
                   CASE WHEN {CRC.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS claimed
            FROM documents, crc_table
        ),
        placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
        levels AS (
            SELECT g, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY g
            UNION ALL
            SELECT g, level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
            FROM levels WHERE len(nodes) > 1
        ),
        subroots AS (SELECT g, nodes[1] AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos FROM levels WHERE len(nodes) = 1),
        tops AS (
            SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM subroots
            UNION ALL
            SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
            FROM tops WHERE len(nodes) > 1
        ),
        steps AS (
            SELECT p.g, p.pos, 0 AS tree, l.level, xor(p.pos >> l.level, 1) AS j, p.pos >> l.level AS own, l.nodes
            FROM placed p JOIN levels l ON p.g = l.g AND len(l.nodes) > 1
            UNION ALL
            SELECT p.g, p.pos, 1, t.level, xor(s.pos >> t.level, 1), s.pos >> t.level, t.nodes
            FROM placed p JOIN subroots s ON p.g = s.g JOIN tops t ON len(t.nodes) > 1
        ),
        paths AS (
            SELECT g, pos, list(coalesce(CASE WHEN j < own THEN 'L' ELSE 'R' END || nodes[j + 1], 'N') ORDER BY tree, level) AS path
            FROM steps GROUP BY g, pos
        ),
        proven AS (
            SELECT p.doc_id, p.leaf, p.claimed, s.subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root, coalesce(h.path, []) AS path
            FROM placed p JOIN subroots s ON p.g = s.g LEFT JOIN paths h ON p.g = h.g AND p.pos = h.pos
        ),
        folded AS (
            SELECT *, sha256(array_to_string(list_transform(path, lambda x: x[2:]), '')) AS proof_sha256,
                   list_reduce([coalesce(claimed, leaf)] || path, lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
            FROM proven
        )
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
    """,
    "op1_warc_archives": """
        WITH p AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), g AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM g
    """,
}
