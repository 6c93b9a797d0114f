"""DuckDB SQL for the queries that SQL can express."""

# Line frequency rules: words and windows as lists, lines counted as texts instead of hashes.
OP10 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM d
), g AS (
    SELECT r, i, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS win
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)
), rep AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM g) WHERE n > 1
), cov AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM rep, range(0, 5) AS s(k) GROUP BY r
), l AS (
    SELECT r, source, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
    FROM (SELECT r, source, unnest(lines) AS line FROM w)
), hosts AS (
    SELECT source, count(*) AS n FROM d GROUP BY source
), freq AS (
    SELECT l.source, line FROM l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
    GROUP BY l.source, line, h.n
    HAVING count(DISTINCT r) > 20 AND count(DISTINCT r) > h.n * 0.005::DOUBLE
), gone AS (
    SELECT r, sum(len(string_split(l.line, ' ')))::BIGINT AS n
    FROM l JOIN freq f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line GROUP BY r
), f AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
           length(array_to_string(words, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(gone.n, 0) AS removed
    FROM w LEFT JOIN cov USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed,
       NOT (n_words < 10 OR n_repeat_words * 100 > n_words * 20)
       AND NOT (removed > 0 AND (n_words - removed < 10 OR (n_words - removed) * 100 < n_words * 30)) AS kept
FROM f
"""



def _fill(source, parents, level, weight):
    """One level of the budget tree: (parents, level, capacity, budget) to a budget per node."""
    part = f"PARTITION BY {', '.join(parents)}" if parents else ""
    keys = ", ".join([*parents, level])
    return f"""
    SELECT {keys}, CASE WHEN filled THEN capacity ELSE (
               (budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({part})) * weight
               // greatest(sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({part}), 1)) END::BIGINT AS budget
    FROM (SELECT *, capacity * sum(weight) OVER (
                     {part} ORDER BY capacity / weight, {level} NULLS FIRST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                 <= (budget - coalesce(sum(capacity) OVER (
                     {part} ORDER BY capacity / weight, {level} NULLS FIRST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS filled
          FROM (SELECT *, {weight} AS weight FROM ({source})))"""


def _order(*parts):
    text = " || ':' || ".join(["'mix'", *parts])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


# Hierarchical mixture: the budget tree level by level, then prefixes of seeded shuffles.
OP1 = f"""
WITH d AS (
    SELECT doc_id, lang, source,
           coalesce('domain' || nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '')::BIGINT % 4, 'other') AS domain,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
    FROM documents
), leaves AS (
    SELECT domain, lang, source, sum(tokens)::BIGINT AS supply, 2 * sum(tokens)::BIGINT AS cap FROM d GROUP BY ALL
), l1 AS ({_fill("SELECT domain, sum(cap) AS capacity, (SELECT least(sum(supply) * 600 // 1000, sum(cap)) FROM leaves) AS budget FROM leaves GROUP BY domain",
                 [], "domain", "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END")}
), l2 AS ({_fill("SELECT l.domain, lang, sum(cap) AS capacity, any_value(budget) AS budget FROM leaves l JOIN l1 USING (domain) GROUP BY l.domain, lang",
                 ["domain"], "lang", "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 3 WHEN 'fr' THEN 3 WHEN 'es' THEN 2 ELSE 1 END")}
), l3 AS ({_fill("SELECT l.domain, l.lang, source, sum(cap) AS capacity, any_value(budget) AS budget FROM leaves l JOIN l2 ON l.domain = l2.domain AND l.lang IS NOT DISTINCT FROM l2.lang GROUP BY l.domain, l.lang, source",
                 ["domain", "lang"], "source", "CASE source WHEN 'src0' THEN 3 WHEN 'src1' THEN 2 ELSE 1 END")}
), plan AS (
    SELECT l.*, budget, CASE WHEN supply = 0 THEN 1 ELSE budget // supply END AS epochs
    FROM leaves l JOIN l3 ON l.domain = l3.domain AND l.lang IS NOT DISTINCT FROM l3.lang
                         AND l.source IS NOT DISTINCT FROM l3.source
), placed AS (
    SELECT d.*, epochs, budget - epochs * supply AS rest,
           {_order("epochs", "coalesce(doc_id::VARCHAR, '')")} AS h
    FROM d JOIN plan p ON d.domain = p.domain AND d.lang IS NOT DISTINCT FROM p.lang
                      AND d.source IS NOT DISTINCT FROM p.source
), taken AS (
    SELECT *, epochs + CASE WHEN coalesce(sum(tokens) OVER (
                 PARTITION BY domain, lang, source ORDER BY h
                 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest THEN 1 ELSE 0 END AS copies
    FROM placed
)
SELECT doc_id, domain AS mix_domain, lang, source, unnest(range(copies))::INTEGER AS mix_epoch FROM taken
"""

# Exact duplicates after lower-casing A-Z only.
OP5 = """
WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM d WINDOW g AS (PARTITION BY body)
"""

# Ranked search: every document scored for every item.
OP12 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), s AS (
    SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d
), q AS (
    SELECT item_id, unnest(list_distinct(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
    FROM benchmark
), p AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
    WHERE term IN (SELECT term FROM q) GROUP BY r, term
), w AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), scored AS (
    SELECT item_id, d.doc_id, r, sum(w * ((1000000000 * tf)
               // (1000 * tf + 8 * (100 - 90 + (90 * len(terms) * n_docs) // n_terms))))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (r), s
    GROUP BY item_id, d.doc_id, r
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {
    "op12_hybrid_ranked_search": OP12,
    "op5_extendible_hash_dedup": OP5,
    "op1_hierarchical_mixture": OP1,
    "op10_line_frequency_rules": OP10,
}
