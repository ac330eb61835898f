"""Driver queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, langid, licenses, quality, secrets, token_count, toxicity
from .common import table
from .exact_dedup import exact_dedup
from .filter_audit import audit
from .mixing import mix
from .ngram_join import ngram_join
from .prefix_trie import prefix_trie
from .simhash_dedup import simhash_dedup


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3, mod=4, held=2)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3, share=1.0, seed=42)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), threshold=0.5, containment=0.6)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"), mod=4, held=2)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"), max_ratio=2.0)


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.report(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5, mod=3, held=1)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), shingle=4, threshold=85)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), every=5, heads=9)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_simhash_dedup, op3_decontaminate, op4_mixing, op5_licenses, op6_language_id, op7_secrets, op8_token_count, op9_quality, op10_exact_dedup, op11_ngram_join, op12_filter_audit, op13_prefix_trie)}

ORACLE_SQL = {
    "op3_decontaminate": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        sizes AS (SELECT DISTINCT least(13, len(w)) AS s FROM b WHERE len(w) > 0),
        items AS (
            SELECT DISTINCT item, s, array_to_string(w[p:p + s - 1], ' ') AS gram
            FROM (SELECT item, w, least(13, len(w)) AS s, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
        windows AS (
            SELECT doc_id, s, p, array_to_string(w[p:p + s - 1], ' ') AS gram
            FROM (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS p FROM d CROSS JOIN sizes WHERE len(w) >= s)),
        found AS (SELECT doc_id, p, windows.s, item FROM windows JOIN items ON windows.s = items.s AND windows.gram = items.gram),
        hits AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + s)) AS x FROM found) GROUP BY doc_id),
        names AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(names.n, 0) AS n_items,
               sha256(coalesce(names.l, '')) AS items_sha256,
               coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)
    """,
    "op4_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                   md5('42|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS total,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM d GROUP BY source),
        -- if the j sources with the least size for their weight stop at three times their size, the others share the rest
        r AS (
            SELECT *, row_number() OVER o AS j, CAST(sum(total) OVER () AS BIGINT) AS everything,
                   CAST(coalesce(sum(3 * total) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS stopped,
                   CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS sharing
            FROM s WINDOW o AS (ORDER BY total / weight, source NULLS LAST)),
        level AS (
            SELECT CAST(everything - stopped AS DOUBLE) / sharing AS l
            FROM r WHERE weight * (CAST(everything - stopped AS DOUBLE) / sharing) <= 3 * total ORDER BY j LIMIT 1),
        t AS (SELECT source, total, least(CAST(3 * total AS DOUBLE), weight * l) AS target FROM s CROSS JOIN level),
        b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM t),
        x AS (
            SELECT d.doc_id, d.size, b.total, b.target, CASE WHEN total > 0 THEN budget // total ELSE 0 END AS epochs, budget,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, size, total AS source_size, target,
               CAST(epochs * size + greatest(0, least(size, budget - epochs * total - before)) AS BIGINT) AS taken
        FROM x
    """,
    "op10_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM n
        WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id ASC NULLS LAST)
    """,
    "op12_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
        marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        flags AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   MAP {'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
                        'C': 100 * len(regexp_extract_all(d.t, '[A-Z]')) > 10 * length(d.t),
                        'D': regexp_matches(d.t, '[#$%&*|]'), 'E': coalesce(doc_id > first, false)} AS fails
            FROM d JOIN firsts ON d.t = firsts.t LEFT JOIN marks USING (doc_id)),
        letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
        orders AS (
            SELECT a.x || b.x || c.x || e.x || f.x AS o
            FROM letters a, letters b, letters c, letters e, letters f
            WHERE len(list_distinct([a.x, b.x, c.x, e.x, f.x])) = 5),
        cells AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM flags GROUP BY part, fails),
        steps AS (
            SELECT part, o, s, o[s] AS f, n, good, toxic, fails[o[s]] AS bad,
                   len(list_filter(range(1, s), lambda i: fails[o[i]])) > 0 AS gone,
                   len(list_filter(map_values(fails), lambda b: b)) AS n_bad
            FROM cells, orders, range(1, 6) AS r(s)),
        sums AS (
            SELECT part, o AS filter_order, s, f,
                   coalesce(sum(n) FILTER (WHERE NOT gone AND NOT bad), 0) AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND bad), 0) AS removed,
                   coalesce(sum(n) FILTER (WHERE gone AND bad), 0) AS redundant, coalesce(sum(n) FILTER (WHERE bad AND n_bad = 1), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (WHERE NOT gone AND bad), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE NOT gone AND bad), 0) AS toxic_lost
            FROM steps GROUP BY ALL)
        SELECT part, filter_order, CAST(s AS INTEGER) AS step, f AS filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
        FROM sums
    """,
    "op13_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                      md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT c, list({'r': role, 't': text} ORDER BY pos) AS turns FROM t GROUP BY c),
        -- CRC-32 of the decimal id, bit by bit
        h AS (
            SELECT c, turns, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                       lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                                lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 9 AS h
            FROM own),
        paths AS (
            SELECT h.c, list_concat(coalesce(b.turns, [])[1:h.h], h.turns[h.h + 1:]) AS path
            FROM h LEFT JOIN own b ON b.c = h.c - h.c % 5),
        steps AS (SELECT c, d, path[1:d] AS k, len(path) AS n FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM paths)),
        nodes AS (
            SELECT d, k, min(c) AS first, count(*) AS n, bool_and(n = d) AS childless,
                   (count(*) - 1) * (CASE WHEN d = 0 THEN 0 ELSE strlen(k[d].t) END) AS saves,
                   coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends
            FROM steps GROUP BY d, k),
        sums AS (
            SELECT s.d, s.k, sum(saves) AS saved, count(*) FILTER (WHERE childless) AS leaves
            FROM nodes x JOIN steps s ON s.c = x.first AND s.d <= x.d GROUP BY s.d, s.k),
        kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL)
        SELECT x.first AS conv_id, x.d AS depth, p.first AS parent_conv_id, x.n AS n_convs, coalesce(kids.n, 0) AS n_children,
               sums.leaves AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
        FROM nodes x JOIN sums ON sums.d = x.d AND sums.k = x.k LEFT JOIN kids ON kids.d = x.d AND kids.k = x.k
        LEFT JOIN nodes p ON p.d = x.d - 1 AND p.k = x.k[1:x.d - 1]
    """,
}
