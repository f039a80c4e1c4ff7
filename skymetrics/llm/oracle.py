"""SQL for the queries that SQL can express, over the same tables."""

from skymetrics.llm import mixing
from skymetrics.llm import phrase_mining as mining
from skymetrics.llm import quality_rules as rules
from skymetrics.llm import ranked_search as ranked
from skymetrics.llm import topk_search as search

WORD = r"[^\x20\x09-\x0D]+"


def _texts(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


# -- mixing: targets by source, then a running sum in the order of the keys ------------------------

_WEIGHTS = ", ".join(map(str, mixing.WEIGHTS))
OP1 = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
        coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS seed,
        coalesce(1.1e0 - length(regexp_replace(text, '{mixing.LETTERS}', '', 'g'))
            / CAST(greatest(length(text), 1) AS DOUBLE), 0.1e0) AS weight
    FROM documents),
ranked AS (
    SELECT source, sum(size) AS source_size, 
        [{_WEIGHTS}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}]
            AS share
    FROM sized GROUP BY source),
steps AS (
    SELECT *, {mixing.MOST_PASSES} * source_size AS cap,
        ({mixing.SHARE}e0 * sum(source_size) OVER () - coalesce(sum({mixing.MOST_PASSES} * source_size)
            OVER (ORDER BY {mixing.MOST_PASSES} * source_size / CAST(share AS DOUBLE), source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(share) OVER (ORDER BY {mixing.MOST_PASSES} * source_size / CAST(share AS DOUBLE), source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked),
targets AS (
    SELECT source, source_size, least(CAST(cap AS DOUBLE),
        coalesce((SELECT arg_min(level, cap / CAST(share AS DOUBLE)) FROM steps WHERE cap > level * share) * share,
            CAST(cap AS DOUBLE))) AS target
    FROM steps),
plans AS (
    SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS passes FROM targets),
keyed AS (
    SELECT *, -ln((CAST(concat('0x', substr(md5(concat('mix:', seed)), 1, 13))
        AS BIGINT) + 1) / 4503599627370497e0) / weight AS key
    FROM sized),
running AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM keyed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
    CAST(passes * size + greatest(0, least(size, round(target) - passes * source_size - before)) AS BIGINT)
        AS taken
FROM running JOIN plans ON running.source IS NOT DISTINCT FROM plans.source"""


# -- quality rules ----------------------------------------------------------------------------------


def _distance(a: str, b: str) -> str:
    p, q = f"({a}[i] / CAST(list_sum({a}) AS DOUBLE))", f"({b}[i] / CAST(list_sum({b}) AS DOUBLE))"
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0e0 END"
    both = part.format(p, q) + " + " + part.format(q, p)
    total = f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: {both}))"
    return f"CASE WHEN {total} <= 0 THEN 0e0 ELSE sqrt({total} / 2) END"


def _summed(name: str, source: str) -> str:
    """The summed histograms of each language of ``source``."""

    def one(column: str) -> str:
        return f"""(SELECT language, list(n ORDER BY pos) AS {column}_of FROM (
            SELECT language, pos, sum({column}[pos]) AS n
            FROM {source}, LATERAL (SELECT unnest(range(1, len({column}) + 1)) AS pos)
            GROUP BY language, pos) GROUP BY language)"""

    return f"{name} AS MATERIALIZED (SELECT * FROM {one('kinds')} JOIN {one('common')} USING (language))"


_LISTS = " ".join(f"WHEN language = '{k}' THEN {_texts(v)}" for k, v in rules.COMMON_WORDS.items())
_FAILED = f"(n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED_PERCENT} * n_words)"
_POINTS = rules.PUNCTUATION.replace("'", "''")
OP8 = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
        CASE WHEN lang IN ({_texts(rules.COMMON_WORDS)[1:-1]}) THEN lang ELSE '{rules.OTHER}' END AS language
    FROM documents),
w AS MATERIALIZED (SELECT *, regexp_extract_all(text, '{WORD}') AS words FROM d),
windows AS (
    SELECT rid, i, array_to_string(list_slice(words, i, i + {rules.RUN - 1}), ' ') AS g
    FROM w, LATERAL (SELECT unnest(range(1, len(words) - {rules.RUN - 2})) AS i)),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (
    SELECT rid, sum(least({rules.RUN}, coalesce(following - i, {rules.RUN}))) AS n
    FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM again) GROUP BY rid),
lines AS (
    SELECT rid, count(*) - count(DISTINCT line) AS n
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '{WORD}') GROUP BY rid),
counted AS (
    SELECT w.*, len(words) AS n_words, length(regexp_replace(text, '{rules.SPACE}', '', 'g')) AS word_chars,
        len(regexp_extract_all(text, '{rules.SYMBOLS}')) AS n_symbols,
        coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
        length(text) - length(regexp_replace(text, '\\p{{L}}+', '', 'g')) AS letters,
        len(regexp_extract_all(text, '\\p{{Lu}}')) AS uppers, len(regexp_extract_all(text, '[0-9]')) AS digits,
        len(regexp_extract_all(text, '{_POINTS}')) AS points,
        list_transform(words, lambda x: lower(x)) AS low,
        CASE {_LISTS} ELSE {_texts(rules.MIXED_WORDS)} END AS listed
    FROM w LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
histograms AS (
    SELECT *, [uppers, letters - uppers, digits, points, n_symbols, length(text) - word_chars,
            word_chars - letters - digits - points - n_symbols] AS kinds,
        list_transform(listed, lambda k: len(list_filter(low, lambda x: x = k))) AS found
    FROM counted),
measured AS MATERIALIZED (
    SELECT * EXCLUDE (text, words, low, listed), list_append(found, n_words - list_sum(found)) AS common
    FROM histograms),
long AS MATERIALIZED (SELECT * FROM measured WHERE n_words >= {rules.COMPARED_WORDS} AND NOT {_FAILED}),
{_summed("rough", "long")},
near AS MATERIALIZED (
    SELECT long.*, {_distance("kinds", "kinds_of")} AS dk, {_distance("common", "common_of")} AS dc
    FROM long JOIN rough USING (language)),
half AS (
    SELECT language, quantile_disc(dk, 0.5) AS hk, quantile_disc(dc, 0.5) AS hc FROM near GROUP BY language),
core AS MATERIALIZED (SELECT near.* FROM near JOIN half USING (language) WHERE dk <= hk OR dc <= hc),
{_summed("refs", "core")},
judged AS (
    SELECT measured.*, {_distance("kinds", "kinds_of")} AS dk, {_distance("common", "common_of")} AS dc
    FROM measured LEFT JOIN refs USING (language))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, {_FAILED} AS base_failed,
    NOT {_FAILED} AND (n_words < {rules.COMPARED_WORDS} OR NOT coalesce(dk > {rules.CHARACTER_LIMIT}
        OR dc > {rules.WORD_LIMIT} OR dk + dc > {rules.JOINT_LIMIT}, false)) AS kept
FROM judged"""


# -- search: every document scored for every query -------------------------------------------------

OP6 = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
    FROM documents),
t AS MATERIALIZED (
    SELECT rid, word, count(*) AS n FROM (SELECT rid, unnest(words) AS word FROM d) GROUP BY rid, word),
totals AS MATERIALIZED (
    SELECT count(*) AS n_docs, greatest(sum(len(words)), 1) / CAST(greatest(count(*), 1) AS DOUBLE) AS mean
    FROM d),
weighed AS MATERIALIZED (
    SELECT word, ln(1 + (CAST(n_docs AS DOUBLE) - count(*) + 0.5e0) / (count(*) + 0.5e0)) AS weight
    FROM t, totals GROUP BY word, n_docs HAVING count(*) > 1),
asked AS MATERIALIZED (
    SELECT doc_id AS query_id, word, weight, row_number() OVER (PARTITION BY doc_id
        ORDER BY (1 + ln(max(n))) * weight DESC, word) AS place
    FROM t JOIN d USING (rid) JOIN weighed USING (word)
    WHERE doc_id % {search.EVERY} = 0 GROUP BY doc_id, word, weight
    QUALIFY place <= {search.QUERY_WORDS}),
parts AS (
    SELECT query_id, doc_id, rid, place, n * ({search.K1}e0 + 1)
        / (n + {search.K1}e0 * (1 - {search.B}e0 + {search.B}e0 * len(words) / mean)) * weight AS part
    FROM asked JOIN t USING (word) JOIN d USING (rid), totals),
scored AS (
    SELECT query_id, doc_id, list_sum(list(part ORDER BY place)) AS score
    FROM parts GROUP BY query_id, doc_id, rid)
SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id
    ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, round(score, 6) AS score
FROM scored QUALIFY rank <= {search.K}"""


# -- ranked lexical search ----------------------------------------------------------------------------


def _terms(table: str, row: str, key: str) -> str:
    """A row for each term of each row of a table."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""SELECT {row}, {key}, unnest(regexp_extract_all({lowered},
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS {row}, {key}, text FROM {table})"""


OP11 = f"""
WITH times AS (
    SELECT row, doc_id, term, count(*) AS tf FROM ({_terms("documents", "row", "doc_id")}) GROUP BY ALL),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM times GROUP BY row),
stats AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2e0 * any_value(docs) + 2) / (2e0 * count(*) + 1))) AS BIGINT) AS w
    FROM times, stats GROUP BY term),
asked AS (
    SELECT item, item_id, term, count(*) AS occurs FROM ({_terms("benchmark", "item", "item_id")}) GROUP BY ALL),
scored AS (
    SELECT item, item_id, row, doc_id, CAST(sum(occurs * w * (({ranked.SCALE} * tf)
        // (1000 * tf + 8 * ({100 - ranked.LENGTH_SHARE} + ({ranked.LENGTH_SHARE} * n * docs) // terms)))) AS BIGINT)
            AS score
    FROM asked JOIN times USING (term) JOIN weights USING (term) JOIN sizes USING (row), stats
    GROUP BY ALL)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place
    FROM scored WHERE score > 0)
WHERE place <= {ranked.K}"""


# -- phrase collocation mining ------------------------------------------------------------------------

# Parts of a list of words, of ``m`` words each, joined.
_OF_LENGTH = "unnest([array_to_string(w[i : i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)])"

OP12 = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
counts AS (
    SELECT lang, phrase, count(*) AS f
    FROM (SELECT lang, {_OF_LENGTH} AS phrase FROM split, range(1, {mining.LONGEST + 1}) AS sizes(m))
    GROUP BY ALL HAVING count(*) >= {mining.LEAST}),
phrases AS (SELECT lang, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE contains(phrase, ' ')),
cuts AS (
    SELECT p.lang, p.phrase, p.f AS a, k, x.f AS l, y.f AS r,
        CAST(CAST({mining.SCALE} AS HUGEINT) * p.f // (x.f + y.f) AS BIGINT) AS score
    FROM phrases AS p JOIN range(1, {mining.LONGEST}) AS ks(k) ON k < len(w)
    JOIN counts AS x ON x.lang = p.lang AND x.phrase = array_to_string(w[1 : k], ' ')
    JOIN counts AS y ON y.lang = p.lang AND y.phrase = array_to_string(w[k + 1 :], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covers AS (
    SELECT lang, part AS phrase, max(f) AS cover
    FROM (SELECT lang, f, {_OF_LENGTH} AS part
        FROM phrases JOIN range(2, {mining.LONGEST}) AS sizes(m) ON m < len(w))
    GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score
FROM scored LEFT JOIN covers USING (lang, phrase) JOIN totals USING (lang)
WHERE cover IS NULL OR CAST(cover AS HUGEINT) * 100 < CAST(a AS HUGEINT) * {mining.COVERED}
QUALIFY rank <= {mining.MOST}"""


ORACLE = {
    "op1_mixing": OP1,
    "op6_topk_search": OP6,
    "op8_quality_rules": OP8,
    "op11_ranked_search": OP11,
    "op12_phrase_mining": OP12,
}
