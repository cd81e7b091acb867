"""The registered queries of this subpackage and the SQL that some are checked against."""

from __future__ import annotations

from tidemark.llm import backoff, language, lexical, mixing, neardup, neighbours, passages, pii, quality, repair, rules, tokens, urls

QUERIES = {
    "op1_language": language.op1_language,
    "op2_rules": rules.op2_rules,
    "op3_neardup": neardup.op3_neardup,
    "op4_passages": passages.op4_passages,
    "op5_quality": quality.op5_quality,
    "op6_bpe": tokens.op6_bpe,
    "op7_pii": pii.op7_pii,
    "op8_backoff": backoff.op8_backoff,
    "op9_mixing": mixing.op9_mixing,
    "op10_neighbours": neighbours.op10_neighbours,
    "op11_urls": urls.op11_urls,
    "op12_lexical": lexical.op12_lexical,
    "op13_repair": repair.op13_repair,
}

NEARDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh
  FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
rare AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
f AS (SELECT e.* FROM e JOIN rare USING (g)),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM f a JOIN f b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n_shingles + y.n_shingles - c)),
undirected AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, u.b FROM reach r JOIN undirected u ON r.b = u.a)
SELECT n.doc_id, n.n_shingles, min(reach.b) AS component_id, n.doc_id = min(reach.b) AS kept
FROM n JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '')) AS BIGINT) AS size
  FROM documents),
k AS (SELECT *, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 3 * source_size AS ceiling,
    [1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
r AS (
  SELECT *, row_number() OVER o AS place,
    CAST(sum(source_size) OVER () - coalesce(sum(ceiling) OVER b, 0) AS BIGINT) AS left_over,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS open_weight
  FROM w WINDOW o AS (ORDER BY ceiling / weight, source NULLS LAST),
    b AS (ORDER BY ceiling / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT left_over AS lo, open_weight AS ow FROM r WHERE ceiling * open_weight >= left_over * weight ORDER BY place LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN ceiling * ow <= lo * weight THEN CAST(ceiling AS DOUBLE)
    ELSE CAST(lo * weight AS DOUBLE) / CAST(ow AS DOUBLE) END AS target FROM r, l),
e AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(round(target) AS BIGINT) // source_size END AS epochs,
    CASE WHEN source_size = 0 THEN 0 ELSE CAST(round(target) AS BIGINT) % source_size END AS rest FROM t),
p AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.rest,
    sum(size) OVER (PARTITION BY k.source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - sum(size) OVER (PARTITION BY k.source, key) AS ahead,
    count(*) OVER (PARTITION BY k.source, key) AS ties
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  CAST(size * epochs + greatest(0, least(size, CAST(rest - ahead AS BIGINT) // ties)) AS BIGINT) AS taken
FROM p
"""

# CRC-32 of a text, byte by byte, from a table of 256 remainders
RULES = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws FROM documents),
n AS (SELECT *, row_number() OVER () AS row, CAST(len(ws) AS BIGINT) AS n_words FROM d),
g AS (
  SELECT row, doc_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS gram FROM n),
crc AS (
  SELECT list_transform(range(256), lambda c: list_reduce(
    list_concat([c], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS step),
h AS (
  SELECT gram, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode(gram))),
    lambda i: CAST('0x' || substr(hex(encode(gram)), 2 * i + 1, 2) AS BIGINT))),
    lambda a, b: xor(a >> 8, step[1 + xor(a & 255, b)]))) % 65536 AS bucket
  FROM (SELECT DISTINCT gram FROM g), crc),
tgt AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
c AS (
  SELECT bucket, count(*) AS raw, count(tgt.doc_id) AS target
  FROM g JOIN h USING (gram) LEFT JOIN tgt ON tgt.doc_id = g.doc_id GROUP BY bucket),
s AS (SELECT sum(raw) AS raw_sum, sum(target) AS target_sum FROM c),
w AS (
  SELECT bucket, CASE WHEN target_sum = 0 THEN 0 ELSE CAST(round(
    ln(((target + 1.0::DOUBLE) * (raw_sum + 65536)) / ((target_sum + 65536) * (raw + 1.0::DOUBLE))) * 1e6) AS BIGINT) END AS ratio FROM c, s),
r AS (SELECT row, sum(ratio) AS total FROM g JOIN h USING (gram) JOIN w USING (bucket) GROUP BY row),
v AS (SELECT row, i, array_to_string(ws[i + 1:i + 8], ' ') AS win FROM (SELECT row, ws, unnest(range(len(ws) - 7)) AS i FROM n)),
p AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, win) AS k FROM v) WHERE k > 1),
q AS (SELECT row, count(DISTINCT i + j) AS n_repeat_words FROM p, (SELECT unnest(range(8)) AS j) GROUP BY row),
a AS (
  SELECT doc_id, n_words, length(translate(t, E' \t\n\x0b\x0c\r', '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, total
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) AS lines FROM n)
    LEFT JOIN q USING (row) LEFT JOIN r USING (row)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  CASE WHEN n_words > 0 THEN round(CAST(total AS DOUBLE) / ((2 * n_words - 1) * 1e6::DOUBLE), 9) END AS ratio,
  NOT base_failed AND total >= -100000 * (2 * n_words - 1) AS kept
FROM f
"""

# exact: at the size of the check the graphs find every one
NEIGHBOURS = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_prepend(0.0::DOUBLE,
    list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - v.e[i]) * (q.e[i] - v.e[i]))), lambda a, b: a + b)) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

PASSAGES = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws FROM documents),
v AS (SELECT row, i, md5(array_to_string(ws[i + 1:i + 50], ' ')) AS win FROM (SELECT row, ws, unnest(range(len(ws) - 49)) AS i FROM d)),
p AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY win) AS k FROM v) WHERE k > 1),
c AS (SELECT DISTINCT row, i + j AS at FROM p, (SELECT unnest(range(50)) AS j)),
e AS (SELECT row, i, lag(i) OVER (PARTITION BY row ORDER BY i) AS before FROM p),
s AS (SELECT row, count(*) AS n FROM e WHERE before IS NULL OR i > before + 50 GROUP BY row),
t AS (SELECT row, count(*) AS n FROM c GROUP BY row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(t.n, 0) AS BIGINT) AS n_repeated, CAST(coalesce(s.n, 0) AS INTEGER) AS n_passages
FROM d LEFT JOIN t USING (row) LEFT JOIN s USING (row)
"""

# counts of all documents, less the document's own
BACKOFF = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT row, i, ws[i] AS w, ws[i - 1] AS b, ws[i - 2] AS a FROM (SELECT row, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
o1 AS (SELECT row, w, count(*) AS n FROM w GROUP BY ALL),
o2 AS (SELECT row, b, w, count(*) AS n FROM w WHERE i > 1 GROUP BY ALL),
o3 AS (SELECT row, a, b, w, count(*) AS n FROM w WHERE i > 2 GROUP BY ALL),
c1 AS (SELECT row, w, sum(n) OVER (PARTITION BY w) - n AS c FROM o1),
c2 AS (SELECT row, b, w, sum(n) OVER (PARTITION BY b, w) - n AS c FROM o2),
c3 AS (SELECT row, a, b, w, sum(n) OVER (PARTITION BY a, b, w) - n AS c FROM o3),
n AS (SELECT sum(len(ws)) AS n FROM d),
x AS (
  SELECT w.row, avg(CASE
    WHEN c3.c > 0 THEN ln(c3.c) - ln(ab.c)
    WHEN bw.c > 0 THEN ln(bw.c) - ln(b.c) + CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END
    WHEN u.c > 0 THEN ln(u.c) - ln(n.n - len(d.ws)) + least(i - 1, 2) * ln(0.4)
    ELSE -ln(greatest(n.n - len(d.ws), 1)) + (least(i - 1, 2) + 1) * ln(0.4) END) AS score
  FROM w JOIN d USING (row) CROSS JOIN n JOIN c1 u ON u.row = w.row AND u.w = w.w
    LEFT JOIN c1 b ON i > 1 AND b.row = w.row AND b.w = w.b
    LEFT JOIN c2 bw ON i > 1 AND bw.row = w.row AND bw.b = w.b AND bw.w = w.w
    LEFT JOIN c2 ab ON i > 2 AND ab.row = w.row AND ab.b = w.a AND ab.w = w.b
    LEFT JOIN c3 ON i > 2 AND c3.row = w.row AND c3.a = w.a AND c3.b = w.b AND c3.w = w.w
  GROUP BY w.row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(score, 6) AS lm_score FROM d LEFT JOIN x USING (row)
"""

# every combination of a labelled URL's frequent tokens, counted outright
URLS = r"""
WITH u AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(url, ''), '(?s)://[^?#]*(.*)', 1) AS rest
  FROM pages),
w AS (
  SELECT *, list_transform(['h:' || host, 'p:' || path, 'q:' || rest], lambda t: list_transform(list_filter(string_split_regex(
    regexp_replace(translate(substr(t, 3), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> ''), lambda x: substr(t, 1, 2) || x)) AS parts FROM u),
p AS (SELECT row_number() OVER () AS row, page_id, url, host, path, list_distinct(flatten(parts)) AS tokens FROM w),
known AS (
  SELECT doc_id, bool_or(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
l AS (
  SELECT row, tokens, bad FROM p JOIN known ON known.doc_id = try_cast(regexp_extract(path, '^/[^/]*/([0-9]{1,18})', 1) AS BIGINT) WHERE url IS NOT NULL),
least AS (SELECT greatest(CAST(ceil(0.002::DOUBLE * count(*)) AS BIGINT), 3) AS least FROM l),
t AS (SELECT row, bad, unnest(tokens) AS token FROM l),
f AS (SELECT token, count(*) AS n FROM t GROUP BY token HAVING count(*) >= (SELECT least FROM least)),
k AS (
  SELECT row, bad, list_sort(list(token)) AS items
  FROM (SELECT row, bad, token, row_number() OVER (PARTITION BY row ORDER BY n, token) AS place FROM t JOIN f USING (token))
  WHERE place <= 10 GROUP BY row, bad),
s AS (
  SELECT bad, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS tokens
  FROM (SELECT bad, items, unnest(range(1, 1 << len(items))) AS mask FROM k)),
c AS (SELECT tokens, count(*) AS n, count(*) FILTER (bad) AS right_of FROM s GROUP BY tokens),
r AS (
  SELECT tokens, right_of, CAST(right_of AS DOUBLE) / n AS confidence FROM c, least WHERE right_of >= least AND CAST(right_of AS DOUBLE) / n >= 0.5),
m AS (
  SELECT *, array_to_string(tokens, ' ') AS pattern FROM r
  WHERE NOT EXISTS (SELECT 1 FROM r b WHERE len(b.tokens) < len(r.tokens) AND list_has_all(r.tokens, b.tokens))),
g AS (SELECT * FROM (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block'))
  AS g(rule, name, begins, verdict)),
a AS (
  SELECT row, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM p JOIN g ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, begins) GROUP BY row),
b AS (
  SELECT row, pattern, row_number() OVER (PARTITION BY row ORDER BY confidence DESC, right_of DESC, pattern) AS place
  FROM p JOIN m ON list_has_all(p.tokens, m.tokens) WHERE row NOT IN (SELECT row FROM a))
SELECT page_id, host, path, rule, coalesce(a.verdict, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, pattern
FROM p LEFT JOIN a USING (row) LEFT JOIN (SELECT * FROM b WHERE place = 1) USING (row)
"""

LEXICAL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
n AS (SELECT row_number() OVER () AS row, doc_id, ws, CAST(len(ws) AS BIGINT) AS n FROM d WHERE len(ws) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ws) AS term FROM n) GROUP BY row, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM t, s GROUP BY term, docs),
i AS (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i) GROUP BY item_id, term),
x AS (
  SELECT item_id, row, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN n USING (row), s GROUP BY item_id, row)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM x JOIN n USING (row) WHERE score > 0)
WHERE rank <= 10
"""

def _repair() -> str:
    """Row after row, the least (cost, audit) and its lines for each of the four states, for every way to get there."""
    role = {2: "user", 3: "assistant"}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    into = {0: 2, 1: 2, 2: 3, 3: 2}  # where an insertion or a new label leads

    def inserted(state: int, n: int) -> tuple[int, str]:
        lines = ""
        for _ in range(n):
            state = into[state]
            lines += f" || chr(10) || '{role[state]}:'"
        return state, lines

    ways: dict[int, list[str]] = {j: [] for j in range(4)}
    for i in range(4):
        for n in range(3):
            m, lines = inserted(i, n)
            said, audit = f"s{i}.t{lines}", f"s{i}.a || '{'I' * n}"
            ways[m].append(f"{{'c': s{i}.c + {3 * n + 4}, 'a': {audit}D', 't': {said}}}")
            late = f"s{i}.c + {3 * n} + CASE WHEN must THEN 1000000000 WHEN truncated THEN 3 ELSE 0 END"
            for (state, letter), j in step.items():
                if state == m:
                    ways[j].append(f"{{'c': {late} + CASE WHEN letter = '{letter}' THEN 0 ELSE 1000000000 END, 'a': {audit}K', 't': {said} || chr(10) || role || ':' || text}}")
            j = into[m]
            ways[j].append(f"{{'c': {late} + 3, 'a': {audit}R', 't': {said} || chr(10) || '{role[j]}:' || text}}")
    ends = ", ".join(f"{{'c': s{i}.c + {3 * n}, 'a': s{i}.a || '{'I' * n}', 't': s{i}.t{inserted(i, n)[1]}}}" for i, n in enumerate((0, 2, 1, 0)))
    best = ", ".join(f"list_min([{', '.join(ways[j])}]) AS s{j}" for j in range(4))
    start = ", ".join(f"{{'c': {0 if j == 0 else 1000000000}::BIGINT, 'a': '', 't': ''}} AS s{j}" for j in range(4))
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda c: list_reduce(
    list_concat([c], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS step),
k AS (SELECT *, encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS key FROM conversations),
h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(list_concat([4294967295],
    list_transform(range(octet_length(key)), lambda i: CAST('0x' || substr(hex(key), 2 * i + 1, 2) AS BIGINT))),
    lambda a, b: xor(a >> 8, step[1 + xor(a & 255, b)]))) % 20 AS how FROM k, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN how = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM h WHERE how <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS r,
    substr(role, 1, 1) AS letter, regexp_replace(text, '[ \t-\r]+$', '') AS core FROM d),
f AS (
  SELECT *, core = '' AS blank, core <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY r) > 1 AS again,
    right(core, 1) NOT IN ('.', '!', '?') AS open FROM o),
g AS (
  SELECT *, blank OR again AS must, NOT blank AND NOT again AND open AS truncated,
    coalesce(lag(letter) OVER (PARTITION BY conv_id ORDER BY r) || letter NOT IN ('su', 'ua', 'au'), false) AS wrong FROM f),
s AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS r, {start} FROM conversations
  UNION ALL
  SELECT s.conv_id, g.r, {best}
  FROM s JOIN g ON s.conv_id IS NOT DISTINCT FROM g.conv_id AND g.r = s.r + 1),
e AS (SELECT conv_id, list_min([{ends}]) AS best FROM s QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY r DESC) = 1),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (wrong) AS illegal FROM g GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
FROM e LEFT JOIN c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE: dict[str, str] = {
    "op13_repair": _repair(),
    "op11_urls": URLS,
    "op12_lexical": LEXICAL,
    "op4_passages": PASSAGES,
    "op8_backoff": BACKOFF,
    "op10_neighbours": NEIGHBOURS,
    "op2_rules": RULES,
    "op9_mixing": MIXING,
    "op3_neardup": NEARDUP,
}
