"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from shelfline.llm import license_scan, url_filter

OP9 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x).lower() for x in r) + ")" for r in rows)


def _op1() -> str:
    """Rules as a table, then each order of the models as two CTEs."""
    n, size = url_filter.ORDER, url_filter.SYMBOLS
    orders = ["p0_ AS (SELECT 0 AS g, 1.0::DOUBLE / " + str(size) + " AS pa, 1.0::DOUBLE / " + str(size) + " AS pb)"]
    for k in range(n + 1):
        share = lambda c: f"CASE WHEN n{c} = 0 THEN l.p{c} ELSE (o.{c} + t{c} * l.p{c}) / (n{c} + t{c}) END AS p{c}"
        orders.append(f"o{k + 1} AS (SELECT gram % {size ** (k + 1)} AS g, sum(a)::BIGINT AS a, sum(b)::BIGINT AS b FROM counts GROUP BY 1)")
        orders.append(f"c{k + 1} AS (SELECT g // {size} AS x, sum(a)::BIGINT AS na, sum(b)::BIGINT AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb FROM o{k + 1} GROUP BY 1)")
        orders.append(f"p{k + 1}_ AS (SELECT o.g, {share('a')}, {share('b')} FROM o{k + 1} o JOIN c{k + 1} c ON c.x = o.g // {size} JOIN p{k}_ l ON l.g = o.g % {size**k})")
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
    code = " + ".join(f"{size**j} * instr('{url_filter.LETTERS}', substring(padded, i - {j}, 1))" for j in range(n, -1, -1))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH rules AS (SELECT * FROM (VALUES {rules}) AS v(verdict, rule_host, rule_path)), parsed AS (
    SELECT row_number() OVER () AS r, page_id, {lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
           regexp_replace(regexp_replace({lower.format("regexp_extract(coalesce(url, ''), '(?s)^(?:.*?://)?(.*)$', 1)")}, '[0-9]+', '0', 'g'), '[^a-z0/.-]', '?', 'g') AS spelled
    FROM pages
), ruled AS (
    SELECT r, page_id, host, path, spelled, rule_host || rule_path AS rule, verdict AS by_rule
    FROM parsed LEFT JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST) = 1
), urls AS (
    SELECT *, by_rule IS NOT NULL AND md5(spelled) < '{url_filter.HELD}' AS held, repeat(' ', {n}) || spelled || ' ' AS padded FROM ruled
), grams AS (
    SELECT r, by_rule, held, {code} AS gram FROM urls, unnest(range({n + 1}, length(padded) + 1)) AS s(i)
), counts AS (
    SELECT gram, count(*) FILTER (NOT held AND by_rule = 'allow') AS a, count(*) FILTER (NOT held AND by_rule = 'block') AS b FROM grams GROUP BY 1
), {", ".join(orders)}, weights AS (
    SELECT g AS gram, round((ln(pa) - ln(pb)) * {url_filter.UNIT})::BIGINT AS weight FROM p{n + 1}_
), sums AS (
    SELECT r, floor(sum(weight)::DOUBLE / count(*))::BIGINT AS score FROM grams JOIN weights USING (gram) GROUP BY 1
), moments AS (
    SELECT by_rule, count(*) AS n, sum(score)::DOUBLE / count(*) AS mean, sqrt(greatest(sum(score::HUGEINT * score)::DOUBLE / count(*) - (sum(score)::DOUBLE / count(*)) ^ 2, 0)) + 1 AS spread
    FROM urls JOIN sums USING (r) WHERE held GROUP BY 1
), cut AS (
    SELECT coalesce((SELECT (a.mean * b.spread + b.mean * a.spread) / (a.spread + b.spread) FROM moments a, moments b WHERE a.by_rule = 'allow' AND b.by_rule = 'block'), 0.0) AS threshold
)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN score >= (SELECT threshold FROM cut) THEN 'allow' ELSE 'block' END) AS verdict, score
FROM urls JOIN sums USING (r)
"""


OP3 = """
WITH last AS (
    SELECT conv_id, arg_max(turn, (turn, coalesce(text, ''))) AS turn, arg_max(coalesce(text, ''), (turn, coalesce(text, ''))) AS text
    FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL GROUP BY 1
), sides AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, 'good' AS side FROM conversations WHERE conv_id IS NOT NULL
    UNION ALL
    SELECT c.conv_id, c.turn, coalesce(c.role, ''), CASE WHEN c.role = 'assistant' AND c.turn = a.turn AND coalesce(c.text, '') = a.text AND b.text IS NOT NULL THEN b.text ELSE coalesce(c.text, '') END, 'bad'
    FROM conversations c LEFT JOIN last a ON a.conv_id = c.conv_id LEFT JOIN last b ON b.conv_id = xor(c.conv_id, 1) WHERE c.conv_id IS NOT NULL
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn NULLS FIRST, role, text) AS place FROM sides
), prefix AS (
    SELECT conv_id, coalesce(min(least(g.place, b.place)) FILTER (g.text IS NULL OR b.text IS NULL OR g.role != b.role OR g.text != b.text), max(g.place) + 1) - 1 AS n_prefix
    FROM (SELECT * FROM numbered WHERE side = 'good') g FULL JOIN (SELECT * FROM numbered WHERE side = 'bad') b USING (conv_id, place) GROUP BY 1
), lines AS (
    SELECT conv_id, n_prefix, side, place, role, length('<|' || role || '|>
') AS head, length(text) + 1 AS body, '<|' || role || '|>
' || text || '
' AS line
    FROM numbered JOIN prefix USING (conv_id)
), placed AS (
    SELECT *, sum(head + body) OVER (PARTITION BY conv_id, side, place > n_prefix ORDER BY place) - body AS first FROM lines
)
SELECT conv_id, n_prefix::BIGINT AS n_prefix,
       coalesce(string_agg(line, '' ORDER BY place) FILTER (side = 'good' AND place <= n_prefix), '') AS prompt,
       coalesce(string_agg(line, '' ORDER BY place) FILTER (side = 'good' AND place > n_prefix), '') AS chosen,
       coalesce(string_agg(first || '-' || (first + body), ',' ORDER BY place) FILTER (side = 'good' AND place > n_prefix AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(line, '' ORDER BY place) FILTER (side = 'bad' AND place > n_prefix), '') AS rejected,
       coalesce(string_agg(first || '-' || (first + body), ',' ORDER BY place) FILTER (side = 'bad' AND place > n_prefix AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id, n_prefix
"""

OP8 = f"""
WITH phrases(template, label, phrase, words) AS (
    SELECT a, b, c, string_split(d, ' ')
    FROM (VALUES {_values([(i, a, True, t) for i, (a, t) in enumerate(license_scan.PHRASES.items())] + [(100 + i, a, False, t) for i, (a, t) in enumerate(license_scan.NOTICES)])}) AS v(a, b, c, d)
), template_grams AS (
    SELECT template, label, phrase, len(words) AS length, p - 1 AS position, array_to_string(words[p:p + 2], ' ') AS gram
    FROM phrases, unnest(range(1, len(words) - 1)) AS r(p)
), texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), votes AS (
    SELECT DISTINCT r, template, label, phrase, length, position, a - 1 AS spot, a - 1 - position AS diagonal
    FROM (SELECT r, a, array_to_string(words[a:a + 2], ' ') AS gram FROM texts, unnest(range(1, len(words) - 1)) AS s(a)) JOIN template_grams USING (gram)
), marked AS (
    SELECT *, CASE WHEN phrase OR ((diagonal - lag(diagonal) OVER w) <= {license_scan.NEAR}) IS NOT TRUE THEN 1 ELSE 0 END AS fresh
    FROM (SELECT DISTINCT r, template, phrase, diagonal FROM votes) AS d WINDOW w AS (PARTITION BY r, template ORDER BY diagonal)
), banded AS (
    SELECT r, template, diagonal, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal) AS band FROM marked
), bands AS (
    SELECT r, template, label, phrase, length, band, count(DISTINCT position) AS grams, min(spot) AS first, max(spot) + {license_scan.K} AS stop,
           len(list_distinct(flatten(list([position, position + 1, position + 2])))) / length AS share
    FROM votes JOIN banded USING (r, template, diagonal) GROUP BY r, template, label, phrase, length, band
), judged AS (
    SELECT r, label, first, stop, phrase AND grams = length - {license_scan.K - 1} AS exact,
           CASE WHEN phrase AND grams = length - {license_scan.K - 1} THEN 1.0
                WHEN NOT phrase AND share >= {license_scan.COVER} AND stop - first <= length * {license_scan.STRETCH} THEN share END AS share
    FROM bands
), reached AS (
    SELECT *, CASE WHEN first < max(stop) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
    FROM judged WHERE share IS NOT NULL WINDOW w AS (PARTITION BY r ORDER BY first, stop, label)
), runs AS (
    SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY first, stop, label ROWS UNBOUNDED PRECEDING) AS run FROM reached
), best AS (
    SELECT r, label, first, exact, share FROM runs QUALIFY share = max(share) OVER (PARTITION BY r, run)
)
SELECT any_value(doc_id) AS doc_id, any_value(len(words)) AS n_words, count(*) FILTER (exact) AS n_base,
       min(first) FILTER (exact) AS first_word, max(first) FILTER (exact) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (share IS NOT NULL), '') AS labels,
       coalesce(max(share), 0.0)::DOUBLE AS score
FROM texts LEFT JOIN best USING (r) GROUP BY r
"""


OP11 = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), counts AS (
    SELECT lang, w[i:i + k - 1] AS phrase, k, count(*) AS a
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (VALUES (1), (2), (3), (4), (5)) AS v(k)) GROUP BY 1, 2, 3
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY 1
), frequent AS (
    SELECT * FROM counts WHERE a >= 100
), covered AS (
    SELECT DISTINCT c.lang, c.phrase
    FROM (SELECT lang, a, phrase[i:i + j - 1] AS phrase FROM frequent, unnest(range(2, k)) AS s(j), unnest(range(1, k - j + 2)) AS t(i)) AS x JOIN frequent c ON c.lang = x.lang AND c.phrase = x.phrase AND x.a >= c.a
), cuts AS (
    SELECT f.lang, f.phrase, f.a, c AS cut, l.a AS l, r.a AS r, n, (1000::HUGEINT * f.a * n // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS c FROM frequent WHERE k > 1) f
    JOIN frequent l ON l.lang = f.lang AND l.phrase = f.phrase[1:c] JOIN frequent r ON r.lang = f.lang AND r.phrase = f.phrase[c + 1:f.k] JOIN totals t ON t.lang = f.lang
    WHERE NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = f.lang AND v.phrase = f.phrase)
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
FROM scored QUALIFY rank <= 2000
"""

OP13 = """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT q.r AS q, q.vec_id AS anchor_id, p.r, p.vec_id, q.label = p.label AS same, list_dot_product(q.v, p.v)::BIGINT AS score
    FROM rows q JOIN rows p ON p.r != q.r WHERE q.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, r) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY p.q, p.r ORDER BY n.score DESC, n.vec_id, n.r))::INTEGER AS rank, n.vec_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.q = p.q AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": _op1(), "op3_preference_format": OP3, "op8_license_scan": OP8, "op9_exact_dedup": OP9, "op11_phrase_mining": OP11, "op13_hard_negatives": OP13}
