"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from shardwise.llm import chosen_path, licenses, ngram_join, url_filter

#: the word class of ``textvec`` as a regular expression over lower-case text
WORD = r"[0-9a-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{1FFF}\x{2070}-\x{2FFF}\x{3040}-\x{10FFFF}]+"


def ngram_join_sql(n: int = ngram_join.N, threshold: float = ngram_join.THRESHOLD) -> str:
    """The exact self-join: pairs that share an n-gram, their Jaccard
    similarity on full sets, and the components of the linked pairs."""
    return f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {n - 1}], ' ') gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {n - 1}, 1) + 1)) i FROM w WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) k FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id x, b.doc_id y, count(*) k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
pairs AS (SELECT x, y, s.k = a.k AND a.k = b.k same FROM shared s JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE s.k * {1 + threshold} >= {threshold} * (a.k + b.k) - 1e-6),
reach(x, y) AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
class AS (SELECT x, min(y) y FROM reach GROUP BY x),
links AS (SELECT x, count(*) n, count(*) FILTER (same) c FROM pairs GROUP BY x)
SELECT d.doc_id, least(d.doc_id, coalesce(class.y, d.doc_id)) AS class_id, CAST(coalesce(c, 0) + 1 AS BIGINT) AS copies, CAST(coalesce(links.n, 0) AS BIGINT) AS n_links
FROM documents d LEFT JOIN class ON class.x = d.doc_id LEFT JOIN links ON links.x = d.doc_id"""


def url_filter_sql(order: int = url_filter.ORDER, alphabet: int = url_filter.ALPHABET) -> str:
    """Rules and the Witten-Bell recursion, one table per order."""
    upper, lower = url_filter.UPPER, url_filter.LOWER
    rules = sorted(url_filter.RULES, key=lambda r: -len(r.text))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    case = lambda f: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{f(r)}'" for r in rules) + " END"
    orders = []
    for k in range(order + 1):
        mixed = lambda v, low: f"CASE WHEN n{v} = 0 THEN {low} ELSE (c.{v} + t{v} * {low}) / (n{v} + t{v}) END p{v}"
        low = ("l.pa", "l.pb") if k else (f"1.0::DOUBLE / {alphabet}",) * 2
        orders.append(f"""c{k} AS (SELECT right(gram, {k + 1}) g, sum(a) a, sum(b) b FROM grams GROUP BY 1),
t{k} AS (SELECT g[:{k}] ctx, sum(a) na, sum(b) nb, count(*) FILTER (a > 0) ta, count(*) FILTER (b > 0) tb FROM c{k} GROUP BY 1),
p{k} AS (SELECT c.g, {mixed("a", low[0])}, {mixed("b", low[1])}
  FROM c{k} c JOIN t{k} ON ctx = c.g[:{k}]{f" JOIN p{k - 1} l ON l.g = right(c.g, {k})" if k else ""})""")
    chains = ",\n".join(orders)
    return f"""WITH p AS (SELECT DISTINCT url, instr(url, '://') > 0 has,
  CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END rest FROM pages WHERE url IS NOT NULL),
hp AS (SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{lower}') host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path FROM p),
fit AS (SELECT *, {case(lambda r: r.text)} rule, {case(lambda r: r.verdict)} given, md5(url)[1] IN ('0', '1', '2') held,
  repeat(chr(2), {order}) || translate(rest, '{upper}', '{lower}') || chr(3) s FROM hp),
cut AS (SELECT url, given, held, substr(s, i, {order + 1}) gram FROM (SELECT *, unnest(range(1, length(s) - {order} + 1)) i FROM fit WHERE has)),
grams AS (SELECT gram, count(*) FILTER (given = 'allow' AND NOT held) a, count(*) FILTER (given = 'block' AND NOT held) b FROM cut GROUP BY gram),
{chains},
score AS (SELECT url, avg(ln(pa) - ln(pb)) lm FROM cut JOIN p{order} ON g = gram GROUP BY url),
scored AS (SELECT fit.*, lm FROM fit LEFT JOIN score USING (url)),
stat AS (SELECT given, avg(lm) FILTER (held) hm, stddev_pop(lm) FILTER (held) hs, count(*) FILTER (held) n, avg(lm) m, stddev_pop(lm) s
  FROM scored WHERE given IS NOT NULL AND lm IS NOT NULL GROUP BY given),
pick AS (SELECT given, CASE WHEN (SELECT min(n) FROM stat) > 0 THEN hm ELSE m END m, CASE WHEN (SELECT min(n) FROM stat) > 0 THEN hs ELSE s END s FROM stat),
sides AS (SELECT count(*) n, max(m) FILTER (given = 'allow') ma, max(s) FILTER (given = 'allow') sa, max(m) FILTER (given = 'block') mb, max(s) FILTER (given = 'block') sb FROM pick),
bar AS (SELECT CASE WHEN n = 2 AND sa + sb > 0 THEN (ma * sb + mb * sa) / (sa + sb) WHEN n = 2 THEN (ma + mb) / 2
  WHEN mb IS NOT NULL THEN 'infinity'::DOUBLE ELSE '-infinity'::DOUBLE END bar FROM sides)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(given, CASE WHEN lm >= bar THEN 'allow' ELSE 'block' END, 'block') AS verdict, round(lm, 6) AS lm_score
FROM pages LEFT JOIN scored USING (url), bar"""


def licenses_sql() -> str:
    """Base phrases by comparing word slices; rules on text whose words each
    have a blank on both sides, so that neighbouring matches do not share one."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rules = licenses.signature_rules()
    wide = lambda r: " (?:" + r.replace(" ?", "(?:#)?").replace(" ", "  ").replace("#", "  ") + ") "
    rule_rows = ", ".join(f"({i}, {quote(r.label)}, {r.priority}, {r.weight}::DOUBLE, {quote(wide(r.regex))})" for i, r in enumerate(rules))
    word_rows = ", ".join(f"({i}, {quote(f' {k} ')})" for i, r in enumerate(rules) for k in r.keywords)
    places = lambda phrase: f"list_filter(range(0, len(ws) - {len(phrase.split()) - 1}), lambda i: ws[i + 1:i + {len(phrase.split())}] = {phrase.split()!r})"
    columns = ", ".join(f"{places(phrase)} b{i}" for i, phrase in enumerate(licenses.BASE))
    every = " || ".join(f"b{i}" for i in range(len(licenses.BASE)))
    names = " || ".join(f"CASE WHEN len(b{i}) > 0 THEN [{quote(label)}] ELSE CAST([] AS VARCHAR[]) END" for i, label in enumerate(licenses.BASE.values()))
    n = lambda x: f"(length({x}) - length(replace({x}, ' ', ''))) // 2"
    return rf"""WITH rule(rule, label, priority, weight, regex) AS (VALUES {rule_rows}),
keyword(rule, word) AS (VALUES {word_rows}),
t AS (SELECT row_number() OVER () rid, doc_id, trim(lower(regexp_replace(coalesce(text, ''), '[^0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+', ' ', 'g'))) s FROM documents),
d AS (SELECT rid, doc_id, ' ' || s || ' ' p, CASE WHEN s = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(s, ' ') END ws FROM t),
b AS (SELECT *, {columns} FROM d),
f AS (SELECT *, {every} places, {names} names FROM b),
c AS (SELECT rid, rule, regexp_extract_all(q, regex) ms, regexp_split_to_array(q, regex) ps
  FROM (SELECT DISTINCT rid, rule, ' ' || replace(trim(p), ' ', '  ') || ' ' q FROM d JOIN keyword ON contains(p, word)) JOIN rule USING (rule)),
m AS (SELECT rid, rule, i, {n("ms[i]")} size,
  CAST(list_sum(list_transform(ps[1:i], lambda x: {n("x")})) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: {n("x")})), 0) AS BIGINT) a
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) i FROM c)),
x AS (SELECT m.*, a + size z, label, priority, weight FROM m JOIN rule USING (rule)),
kept AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM x e WHERE e.rid = x.rid AND e.a <= x.a AND e.z >= x.z
  AND (e.priority > x.priority OR e.priority = x.priority AND (e.size > x.size OR e.a = x.a AND e.z = x.z AND e.rule < x.rule)))),
k AS (SELECT rid, list(label) ls, max(weight) w FROM kept GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(names)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(names || coalesce(ls, CAST([] AS VARCHAR[])))), ','), '') AS labels,
  greatest(coalesce(w, 0), CASE WHEN len(names) > 0 THEN 0.5 ELSE 0 END) AS score
FROM f LEFT JOIN k USING (rid)"""


def chosen_path_sql(n: int = chosen_path.N, percent: int = chosen_path.PERCENT) -> str:
    """All pairs that share a shingle, their exact similarity, and components."""
    upper, lower = url_filter.UPPER, url_filter.LOWER
    return rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {n - 1}], ' ') gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {n - 1}, 1) + 1)) i FROM w WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) k FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id x, b.doc_id y, count(*) k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
pairs AS (SELECT x, y FROM shared s JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y WHERE 100 * s.k >= {percent} * (a.k + b.k - s.k)),
reach(x, y) AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
class AS (SELECT x, min(y) y FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(size.k, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(class.y, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(class.y, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN class ON class.x = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id"""


def signature_search_sql(k: int = 10) -> str:
    """The scores of all documents that share a term with an item."""
    upper, lower = url_filter.UPPER, url_filter.LOWER
    terms = rf"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""WITH t AS (SELECT doc_id, term, count(*) tf FROM (SELECT doc_id, {terms} term FROM documents) GROUP BY ALL),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) n FROM t GROUP BY doc_id),
total AS (SELECT count(*) docs, CAST(sum(n) AS BIGINT) length FROM d),
m AS (SELECT doc_id, 25 + (75 * n * docs) // length m FROM d, total),
q AS (SELECT item_id, term, count(*) r FROM (SELECT item_id, {terms} term FROM benchmark) GROUP BY ALL),
df AS (SELECT term, count(*) df FROM t WHERE term IN (SELECT term FROM q) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) w FROM df, total),
s AS (SELECT item_id, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) rank FROM s WHERE score > 0) WHERE rank <= {k}"""
