"""One query per operator of this package, over its whole table, and SQL where that can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from salesloom.llm import bpe, decontaminate, fingerprints, language, language_model, line_dedup, manifest, ngram_join, prefix_trie, quality, substring_dedup, top_k, url_filter
from salesloom.llm.frames import read

RANKS = "byte_bpe_multi_50k.tiktoken"
QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def codec() -> bpe.Codec:
    return bpe.Codec(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op1_byte_bpe(spark, folder):
    return bpe.round_trip(read(spark, folder, "documents").select("doc_id", "text"), codec())


@query
def op2_substring_dedup(spark, folder):
    kept = substring_dedup.dedup_substrings(read(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op3_line_dedup(spark, folder):
    return line_dedup.drop_boilerplate(read(spark, folder, "documents").select("doc_id", "source", "text"))


@query
def op4_url_filter(spark, folder):
    return url_filter.judge_urls(read(spark, folder, "pages").select("page_id", "url")).drop("url")


@query
def op5_fingerprints(spark, folder):
    return fingerprints.compare_with_edited(read(spark, folder, "documents").select("doc_id", "text"))


@query
def op6_ngram_join(spark, folder):
    found = ngram_join.near_duplicates(read(spark, folder, "documents").select("doc_id", "text"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op7_decontamination(spark, folder):
    return decontaminate.find_contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op8_lm_score(spark, folder):
    return language_model.score_documents(read(spark, folder, "documents").select("doc_id", "text"))


@query
def op9_language_id(spark, folder):
    return language.identify_languages(read(spark, folder, "documents").select("doc_id", "text", "lang")).drop("lang")


@query
def op10_quality(spark, folder):
    return quality.score_quality(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "labels"))


@query
def op11_manifest(spark, folder):
    return manifest.prove_against_edits(read(spark, folder, "documents"))


@query
def op12_top_k(spark, folder):
    return top_k.top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op13_prefix_trie(spark, folder):
    return prefix_trie.rebuilt_trie(read(spark, folder, "conversations"))


def crc32_sql(value: str) -> str:
    """DuckDB SQL for the CRC-32 of a number's decimal text, bit by bit."""
    bits = f"list_transform(string_split({value}::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])"
    step = "lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)"
    return f"xor(list_reduce(list_concat([4294967295], flatten({bits})), {step}), 4294967295)"


ORACLES = {
    "op2_substring_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), windows AS (
            SELECT row, i, array_to_string(words[i:i + 34], ' ') AS run
            FROM (SELECT row, words, unnest(range(1, len(words) - 33)) AS i FROM docs)
        ), repeated AS (
            SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY run) > 1
        ), covered AS (
            SELECT DISTINCT row, unnest(range(i, i + 35)) AS place FROM repeated
        ), gone AS (
            SELECT row, list(place) AS places FROM covered GROUP BY row
        )
        SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
            sha256(CASE WHEN places IS NULL THEN array_to_string(words, ' ')
                ELSE (SELECT coalesce(string_agg(w, ' ' ORDER BY p), '') FROM (SELECT unnest(words) AS w, unnest(range(1, len(words) + 1)) AS p)
                      WHERE NOT list_contains(places, p)) END) AS kept_sha256
        FROM docs LEFT JOIN gone USING (row)""",
    "op3_line_dedup": """
        WITH pages AS (SELECT row_number() OVER () AS row, doc_id, source, text FROM documents),
        hosts AS (SELECT source, count(DISTINCT coalesce(text, '')) AS pages FROM pages GROUP BY source),
        lines AS (
            SELECT row, source, coalesce(text, '') AS body, trim(line, ' ') AS line, line AS raw, place
            FROM (SELECT *, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM pages)
        ),
        found AS (
            SELECT source, line FROM (SELECT source, line, count(DISTINCT body) AS n FROM lines WHERE line <> '' GROUP BY source, line)
            JOIN hosts USING (source) WHERE n > 1 AND n > 0.05 * pages
        ),
        marked AS (SELECT l.*, f.line IS NOT NULL AS hit FROM lines l LEFT JOIN found f ON l.source = f.source AND l.line = f.line),
        counts AS (
            SELECT row, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (hit) AS hits,
                string_agg(raw, chr(10) ORDER BY place) FILTER (NOT hit) AS kept
            FROM marked GROUP BY row
        )
        SELECT doc_id, source, CASE WHEN coalesce(hits, 0) = 0 THEN text ELSE coalesce(kept, '') END AS text,
            coalesce(n_lines, 0) AS n_lines, coalesce(hits, 0) AS n_dropped
        FROM pages LEFT JOIN counts USING (row)""",
    "op4_url_filter": r"""
        WITH parts AS (
            SELECT page_id, url,
                translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages
        ), rules(verdict, rule_host, rule_path) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
        ), judged AS (
            SELECT p.*, (SELECT min({'long': -length(rule_host || rule_path), 'rule': rule_host || rule_path, 'verdict': verdict}) FROM rules
                WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best
            FROM parts p
        )
        SELECT page_id, host, path, best.rule AS rule,
            CASE WHEN best IS NOT NULL THEN best.verdict
                WHEN regexp_matches(lower(url), '[/.](login|cart)([/?#.]|$)') OR regexp_matches(lower(url), '[?&](sessionid|(ad|click|track)_?id)=') THEN 'block'
                ELSE 'allow' END AS verdict
        FROM judged""",
    "op11_manifest": """
        WITH RECURSIVE parts AS (
            SELECT doc_id, lang, n_chars,
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                coalesce(strlen(text) || ':' || text, '-') AS tail,
                n_chars + CASE WHEN {crc} % 7 = 0 THEN 1 ELSE 0 END AS claimed
            FROM documents
        ), rows AS (
            SELECT doc_id, coalesce('=' || lang, '') AS lang,
                sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                sha256(head || coalesce(strlen(claimed::VARCHAR) || ':' || claimed, '-') || tail) AS claim
            FROM parts
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS total FROM rows
        ), nodes AS (
            SELECT lang, 0 AS level, place, leaf AS h, total AS many FROM leaves
            UNION ALL
            SELECT lang, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (many + 1) // 2
            FROM nodes WHERE many > 1 GROUP BY lang, level, place // 2, many
        ), subroots AS (
            SELECT lang, h, row_number() OVER (ORDER BY lang) - 1 AS place, count(*) OVER () AS total FROM nodes WHERE many = 1
        ), tops AS (
            SELECT 0 AS level, place, h, total AS many FROM subroots
            UNION ALL
            SELECT level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (many + 1) // 2 FROM tops WHERE many > 1 GROUP BY level, place // 2, many
        ), paths AS (
            SELECT l.lang, l.place, list({'first': (l.place >> v.level) % 2, 'h': o.h} ORDER BY v.level) AS path
            FROM leaves l JOIN (SELECT DISTINCT lang, level FROM nodes WHERE many > 1) v USING (lang)
            LEFT JOIN nodes o ON o.lang = l.lang AND o.level = v.level AND o.place = xor(l.place >> v.level, 1)
            GROUP BY l.lang, l.place
        ), top_paths AS (
            SELECT s.lang, list({'first': (s.place >> v.level) % 2, 'h': o.h} ORDER BY v.level) AS path
            FROM subroots s CROSS JOIN (SELECT DISTINCT level FROM tops WHERE many > 1) v
            LEFT JOIN tops o ON o.level = v.level AND o.place = xor(s.place >> v.level, 1)
            GROUP BY s.lang
        ), proofs AS (
            SELECT l.doc_id, l.leaf, l.claim, s.h AS subroot, (SELECT h FROM tops WHERE many = 1) AS root, list_concat(p.path, t.path) AS path
            FROM leaves l JOIN subroots s USING (lang) LEFT JOIN paths p ON p.lang = l.lang AND p.place = l.place LEFT JOIN top_paths t ON t.lang = l.lang
        ), folded AS (
            SELECT *, list_reduce(list_concat([{'first': 0::BIGINT, 'h': claim}], path), lambda a, x: {'first': 0::BIGINT, 'h': sha256(
                CASE WHEN x.h IS NULL THEN a.h WHEN x.first = 1 THEN x.h || a.h ELSE a.h || x.h END)}).h AS folded_root
            FROM proofs
        )
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(path, lambda x: x.h), ''), '')) AS proof_sha256,
            folded_root, folded_root = root AS verified
        FROM folded""".replace("{crc}", crc32_sql("doc_id")),
    "op12_top_k": """
        WITH parts AS (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        ), scored AS (
            SELECT q.row, q.vec_id AS query_id, c.vec_id, c.row AS other, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM parts q JOIN parts c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST, other) AS rank FROM scored
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op13_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, tag, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tag) AS pos
            FROM (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tag, strlen(coalesce(text, '')) AS size
                FROM conversations WHERE conv_id IS NOT NULL)
        ), heads AS (
            SELECT conv_id, conv_id - conv_id % 5 AS base, {crc} % 9 AS head FROM (SELECT DISTINCT conv_id FROM turns)
        ), parts AS (
            SELECT h.conv_id, 1 AS part, pos, tag, size FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND pos > head
            UNION ALL SELECT h.conv_id, 0, pos, tag, size FROM heads h JOIN turns t ON t.conv_id = base AND pos <= head
        ), passed AS (
            SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS size FROM heads
            UNION ALL SELECT conv_id, row_number() OVER w, string_agg(tag, '') OVER w,
                coalesce(string_agg(tag, '') OVER (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), size
            FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
        ), ended AS (
            SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM passed
        ), nodes AS (
            SELECT node, min(parent) AS parent, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
            FROM ended GROUP BY node
        ), children AS (
            SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
        ), below AS (
            SELECT DISTINCT a.node AS top, b.node FROM passed a JOIN passed b ON a.conv_id = b.conv_id AND b.depth >= a.depth
        ), sums AS (
            SELECT top AS node, sum((n_children IS NULL)::BIGINT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
            FROM below b JOIN nodes n ON n.node = b.node LEFT JOIN children c ON c.node = b.node GROUP BY top
        )
        SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
            coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes p ON p.node = n.parent""".replace("{crc}", crc32_sql("conv_id")),
}
