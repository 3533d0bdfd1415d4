"""DuckDB SQL for the queries that SQL can express."""

WS = r"[\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op7_warc_round_trip": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id < page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op8_exact_dedup": rf"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{WS}', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op11_quality_rules": rf"""
        WITH d AS (
            SELECT doc_id, coalesce('=' || lang, 'null') AS stratum, coalesce(text, '') AS t FROM documents),
        w AS (
            SELECT doc_id, stratum, list_filter(regexp_split_to_array(t, '{WS}'), lambda x: x <> '') AS words,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
                   length(regexp_replace(t, '{WS}', '', 'g')) AS word_chars,
                   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols
            FROM d),
        g AS (SELECT doc_id, i, words[i:i + 2] AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
        r AS (
            SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
                  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1)
            GROUP BY doc_id),
        c AS (
            SELECT doc_id, stratum, len(words) AS n_words, word_chars, n_symbols, len(lines) AS n_lines,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM w LEFT JOIN r USING (doc_id)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
        v AS (
            SELECT doc_id, stratum, base_failed, u.rule AS rule, u.x AS x, u.per AS per, u.cuts AS cuts
            FROM (SELECT *, unnest([
                {{rule: 'symbols', x: n_symbols, per: n_words, cuts: [2000, 1500, 1000, 700, 500, 400, 300, 200, 100]}},
                {{rule: 'dup_lines', x: n_dup_lines, per: n_lines, cuts: [900, 800, 700, 600, 500, 400, 300]}},
                {{rule: 'repeats', x: n_repeat_words, per: n_words, cuts: [450, 400, 350, 300, 250]}},
                {{rule: 'long_words', x: word_chars, per: n_words, cuts: [12000, 10000, 9000, 8000, 7500, 7000]}}]) AS u FROM b)),
        good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
        held AS (SELECT stratum, rule, x, per, unnest(range(1, len(cuts) + 1)) AS place, unnest(cuts) AS cut
                 FROM v SEMI JOIN good USING (doc_id) WHERE NOT base_failed),
        k AS (SELECT stratum, rule, place, cut, count(*) AS n, count(*) FILTER (1000 * x > cut * per) AS k FROM held GROUP BY ALL),
        p AS (
            SELECT *, CASE WHEN k >= n * 0.005 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(
                       lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.005::DOUBLE) + (n - i) * ln(0.995::DOUBLE)))) END
                   > 0.05 / (4 * (SELECT count(DISTINCT stratum) FROM held)) AS fails
            FROM k),
        s AS (SELECT *, bool_or(fails) OVER (PARTITION BY stratum, rule ORDER BY place) AS ended FROM p),
        cut AS (SELECT stratum, rule, min(cut) AS cut FROM s WHERE NOT ended GROUP BY ALL),
        f AS (SELECT doc_id, string_agg(rule, ',' ORDER BY list_position(['symbols', 'dup_lines', 'repeats', 'long_words'], rule)) AS failed
              FROM v JOIN cut USING (stratum, rule) WHERE 1000 * x > cut * per GROUP BY doc_id)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND failed IS NULL AS kept, coalesce(failed, '') AS failed_rules
        FROM b LEFT JOIN f USING (doc_id)""",
    "op12_ranked_search": rf"""
        WITH t AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
        n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
        s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
        m AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // terms) AS m FROM n, s),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, docs),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark),
        x AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM x WHERE score > 0 QUALIFY rank <= 50""",
}
