"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from plumeline.llm import quality

_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

def _quartiles(name: str, keys: str) -> str:
    prefix = f"{keys}, " if keys else ""
    return f"""{name} AS (
        SELECT {prefix}metric, count(*) AS total,
               min(CASE WHEN 4 * upto >= total_rows THEN rounded END) AS q25,
               min(CASE WHEN 4 * upto >= 3 * total_rows THEN rounded END) AS q75
        FROM (SELECT *, count(*) OVER (PARTITION BY {prefix}metric ORDER BY rounded) AS upto,
                     count(*) OVER (PARTITION BY {prefix}metric) AS total_rows FROM rounded)
        GROUP BY ALL)"""


def quality_rules() -> str:
    low = ", ".join(f"'{m}'" for m, rule in quality.METRICS.items() if rule[-1])
    share = "if({1} = 0, 0, 10000 * {0} // {1})".format
    error = 1 << (quality.SKETCH_BITS - 1)
    rank = " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(quality.METRICS))
    values = " UNION ALL ".join(
        f"SELECT row, lang, source, base_failed, '{m}' AS metric, {share(top, per)} AS value, {share(event * quality.EVENTS, per)} AS events FROM counted"
        for m, (top, per, event, _) in quality.METRICS.items()
    )
    return rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    split AS (
        SELECT *, {_WORDS.format("text")} AS w,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
    triples AS (
        SELECT row, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
    repeated AS (
        SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS n FROM triples) WHERE n > 1),
    covered AS (
        SELECT row, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS t(k) GROUP BY row),
    counted AS (
        SELECT s.row, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
               len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
               (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
               len(w) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(w) AS base_failed
        FROM split s LEFT JOIN covered c ON c.row = s.row),
    long AS ({values}),
    rounded AS (
        SELECT *, (value >> greatest(length(bin(value)) - {quality.SKETCH_BITS}, 0)::BIGINT)
                  << greatest(length(bin(value)) - {quality.SKETCH_BITS}, 0)::BIGINT AS rounded FROM long WHERE NOT base_failed),
    {_quartiles("own", "lang, source")},
    {_quartiles("language", "lang")},
    {_quartiles("corpus", "")},
    chosen AS (
        SELECT o.lang, o.source, o.metric,
               CASE WHEN o.total >= {quality.MIN_GROUP} THEN o.q25 WHEN l.total >= {quality.MIN_GROUP} THEN l.q25 ELSE c.q25 END AS q25,
               CASE WHEN o.total >= {quality.MIN_GROUP} THEN o.q75 WHEN l.total >= {quality.MIN_GROUP} THEN l.q75 ELSE c.q75 END AS q75,
               CASE WHEN l.total >= {quality.MIN_GROUP} THEN l.q75 - l.q25 ELSE 0 END AS width
        FROM own o JOIN language l ON l.metric = o.metric AND l.lang IS NOT DISTINCT FROM o.lang
        JOIN corpus c ON c.metric = o.metric),
    outside AS (
        SELECT v.row, string_agg(v.metric, ' ' ORDER BY CASE v.metric {rank} END) AS failed_rules
        FROM long v JOIN chosen t ON t.metric = v.metric AND t.lang IS NOT DISTINCT FROM v.lang
                                 AND t.source IS NOT DISTINCT FROM v.source
        WHERE v.value - v.events > t.q75 + {quality.FENCE} * greatest(t.q75 - t.q25, t.width) + t.q75 // {error}
           OR (v.metric IN ({low}) AND v.value + v.events < t.q25 - {quality.FENCE} * greatest(t.q75 - t.q25, t.width) - t.q25 // {error})
        GROUP BY v.row)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           base_failed, NOT base_failed AND failed_rules IS NULL AS kept,
           coalesce(failed_rules, '') AS failed_rules
    FROM counted LEFT JOIN outside USING (row)
    """


MIXING = rf"""
    WITH sized AS (
        SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size,
               ('0x' || substr(md5('20240229:' || doc_id), 1, 15))::BIGINT AS h FROM documents),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
        FROM sized GROUP BY source),
    -- Fill sources up in the order in which they reach twice their size.
    levels AS (
        SELECT *, 2 * source_size / weight AS full_at,
               sum(2 * source_size) OVER o AS capped, sum(weight) OVER () - sum(weight) OVER o AS open_weight,
               1.5::DOUBLE * sum(source_size) OVER () AS budget
        FROM sources WINDOW o AS (ORDER BY 2 * source_size / weight, source NULLS LAST)),
    rates AS (
        SELECT max(budget) / sum(weight) AS rate, -1.0::DOUBLE AS full_at FROM levels
        UNION ALL SELECT (budget - capped) / open_weight, full_at FROM levels WHERE open_weight > 0),
    rate AS (
        SELECT min(rate) AS rate FROM rates r
        WHERE rate >= full_at AND NOT EXISTS (SELECT 1 FROM levels l WHERE l.full_at > r.full_at AND l.full_at < r.rate)),
    targets AS (
        SELECT source, source_size, least(weight * rate, (2 * source_size)::DOUBLE) AS target FROM sources, rate),
    served AS (
        SELECT s.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
        FROM sized s JOIN targets t ON t.source IS NOT DISTINCT FROM s.source),
    copies AS (SELECT *, copy * source_size + ahead AS start FROM served, (VALUES (0), (1)) AS t(copy)),
    lined AS (
        SELECT *, coalesce(sum(size) OVER (ORDER BY if(target > 0, (start + size) / target, 0), h, doc_id, copy
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS mix_start FROM copies),
    mixed AS (
        SELECT *, least(size, greatest((SELECT sum(size) FROM sized)::BIGINT * 150 // 100 - mix_start, 0))::BIGINT AS words FROM lined)
    SELECT doc_id, size, source_size, target, sum(words)::BIGINT AS taken,
           min(CASE WHEN words > 0 THEN mix_start END)::BIGINT AS mix_start
    FROM mixed GROUP BY doc_id, size, source_size, target
    """

MINHASH = rf"""
    WITH RECURSIVE split AS (
        SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
        FROM split),
    members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
    common AS (
        SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS nu, any_value(b.n) AS nv, count(*) AS n_common
        FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
             AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id),
    links AS (SELECT u, v FROM common WHERE 100 * n_common >= 85 * (nu + nv - n_common)),
    near(u, v) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT near.u, e.v FROM near JOIN (SELECT u, v FROM links UNION ALL SELECT v, u FROM links) e ON e.u = near.v)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, min(near.v)::BIGINT AS component_id, min(near.v) = doc_id AS kept
    FROM sets JOIN near ON near.u = doc_id GROUP BY doc_id, len(s)
    """

# Aliases here: canonical links with double-quoted attributes, rel first, of absolute urls.
URLS = r"""
    WITH RECURSIVE rules(host, path, verdict) AS (
        VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
               ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    links AS (
        SELECT regexp_replace(url, '#.*', '') AS u,
               regexp_replace(unnest(regexp_extract_all(html, '<link rel="canonical" href="([^"]*)"', 1)), '#.*', '') AS v FROM pages),
    near(u, v) AS (
        SELECT u, u FROM (SELECT u FROM links UNION SELECT v FROM links)
        UNION SELECT near.u, e.v FROM near JOIN (SELECT u, v FROM links UNION ALL SELECT v, u FROM links) e ON e.u = near.v),
    urls AS (SELECT url FROM pages UNION SELECT u FROM near),
    rests AS (SELECT url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM urls),
    parsed AS (
        SELECT url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
    fitting AS (
        SELECT p.url, r.host || r.path AS rule, r.verdict,
               row_number() OVER (PARTITION BY p.url ORDER BY length(r.host || r.path) DESC) AS nth
        FROM parsed p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
    best AS (SELECT url, rule, verdict FROM fitting WHERE nth = 1),
    aliases AS (
        SELECT n.u, CASE WHEN bool_or(b.verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict
        FROM near n JOIN best b ON b.url = n.v GROUP BY n.u)
    SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, b.rule,
           coalesce(b.verdict, a.verdict, 'allow') AS verdict, a.verdict AS alias_verdict
    FROM pages g LEFT JOIN parsed p ON p.url = g.url LEFT JOIN best b ON b.url = g.url
    LEFT JOIN aliases a ON a.u = regexp_replace(g.url, '#.*', '')
    """

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEXICAL = rf"""
    WITH held AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents),
    items AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS t FROM benchmark),
    totals AS (SELECT (count(*) FILTER (len(t) > 0))::BIGINT AS n_all, sum(len(t))::BIGINT AS l_all FROM held),
    asked AS (SELECT item, item_id, term, count(*) AS c FROM (SELECT item, item_id, unnest(t) AS term FROM items) GROUP BY ALL),
    postings AS (
        SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM held)
        WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(n_all) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM postings, totals GROUP BY term),
    scored AS (
        SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id,
               sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_all) // l_all))))::BIGINT AS score
        FROM postings JOIN weights USING (term) JOIN asked USING (term), totals GROUP BY item, row)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    WHERE rank <= 20
    """

# CRC-32 by bytes, from a table of the polynomial's remainders.
IMPORTANCE = rf"""
    WITH remainders AS (
        SELECT list_transform(range(256), lambda n: list_reduce(
            list_prepend(n, range(8)), lambda c, k: if(c % 2 = 1, xor(c >> 1, 3988292384), c >> 1))) AS r),
    held AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents),
    words AS (SELECT row, unnest(t) AS word FROM held),
    asked AS (SELECT unnest({_TERMS}) AS word FROM benchmark),
    spelled AS (
        SELECT word, list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(word), 2 * i + 1, 2))::BIGINT) AS b
        FROM (SELECT word FROM words UNION SELECT word FROM asked)),
    buckets AS (
        SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, r[xor(c, x) % 256 + 1])), 4294967295)
                     % 10000 AS bucket
        FROM spelled, remainders),
    corpus AS (SELECT bucket, count(*) AS s FROM words JOIN buckets USING (word) GROUP BY bucket),
    target AS (SELECT bucket, count(*) AS t FROM asked JOIN buckets USING (word) GROUP BY bucket),
    totals AS (SELECT (SELECT count(*) FROM words) AS s_all, (SELECT count(*) FROM asked) AS t_all),
    gains AS (
        SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
        FROM corpus LEFT JOIN target USING (bucket), totals),
    weights AS (SELECT row, sum(gain)::BIGINT AS weight FROM words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY row),
    scored AS (
        SELECT row, doc_id, len(t)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
               + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
        FROM held LEFT JOIN weights USING (row)),
    placed AS (
        SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank
    FROM scored LEFT JOIN placed USING (row)
    """

ORACLES = {
    "op1_quality_rules": quality_rules(),
    "op6_mixing": MIXING,
    "op9_minhash": MINHASH,
    "op10_url_rules": URLS,
    "op11_lexical_search": LEXICAL,
    "op12_importance": IMPORTANCE,
}
