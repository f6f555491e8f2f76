"""The same results in DuckDB SQL, in the direct form, for the operators that SQL can express."""

from __future__ import annotations

from spokecast.llm import registered
from spokecast.llm.repetition import Rules
from spokecast.llm.sharding import PRIME, ROUNDS, round_keys

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str, pattern: str, fold: bool) -> str:
    """Rows (key, words) of a table."""
    text = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')" if fold else "coalesce(text, '')"
    return f"SELECT {key}, regexp_extract_all({text}, '{pattern}') AS words FROM {table}"


BLANK = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def op2() -> str:
    return f"""
WITH RECURSIVE w AS ({_words("documents", "doc_id", BLANK, True)}),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * n_both >= 90 * (p.n + q.n - n_both)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS node FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.node)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(node)::BIGINT AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""


def op3() -> str:
    cases = sorted(registered.RULES, key=lambda r: -len(r.pattern))

    def fits(rule) -> str:
        host, slash, rest = rule.pattern.partition("/")
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{rest}')"

    rule = " ".join(f"WHEN {fits(r)} THEN '{r.pattern}'" for r in cases)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in cases)
    return f"""
WITH a AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, rest, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM a),
q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'),
  lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)='))) AS kept FROM p),
c AS (SELECT page_id, host, path, CASE WHEN rest IS NOT NULL THEN
  regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical FROM q),
listed AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '{registered.LISTED_SITES}'))
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict FROM c"""


def op4() -> str:
    keys = ", ".join(f"({i}, {f}::BIGINT, {s}::BIGINT)" for i, (f, s) in enumerate(round_keys(registered.SHARD_SEED)))
    scramble = lambda v: f"((o >> 13) * 40503 + o % 8192 * 9973) % {PRIME}".replace("o", f"(({v} % {PRIME} * f + s) % {PRIME})")
    return f"""
WITH RECURSIVE poly AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, coalesce(text, '') AS text, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM documents),
c AS (SELECT doc_id, (len(bytes) + 8)::BIGINT AS size,
  xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM d, poly),
o AS (SELECT *, row_number() OVER (ORDER BY md5(coalesce(doc_id::VARCHAR, 'null') || '|' || size || '|' || text_crc32),
  doc_id NULLS FIRST, size, text_crc32) - 1 AS num, count(*) OVER () AS n FROM c),
g AS (SELECT *, ceil(sqrt(n))::BIGINT AS a FROM o),
h AS (SELECT *, ((n + a - 1) // a)::BIGINT AS b FROM g),
k(i, f, s) AS (VALUES {keys}),
w AS (
  SELECT num, n, a, b, 0 AS i, num % a AS l, num // a AS r FROM h
  UNION ALL (
  SELECT w.num, n, a, b, w.i + 1,
    CASE WHEN w.i % 2 = 0 THEN (l + {scramble("r")}) % a ELSE l END,
    CASE WHEN w.i % 2 = 1 THEN (r + {scramble("l")}) % b ELSE r END FROM w JOIN k ON k.i = w.i
  UNION ALL
  SELECT num, n, a, b, 0, (r * a + l) % a, (r * a + l) // a FROM w WHERE w.i = {ROUNDS} AND r * a + l >= n)),
p AS (SELECT num, r * a + l AS to_ FROM w WHERE i = {ROUNDS} AND r * a + l < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (to_ % {registered.SHARDS})::INTEGER AS shard,
  (to_ // {registered.SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM h JOIN p USING (num)"""


def op5() -> str:
    return f"""
WITH w AS ({_words("documents", "doc_id", ALNUM, True)}),
i AS ({_words("benchmark", "item_id", ALNUM, True)}),
win AS (SELECT DISTINCT item_id, least(13, len(words)) AS size, unnest(list_transform(range(1, greatest(len(words) - 12, 1) + 1),
  lambda p: array_to_string(words[p:p + 12], ' '))) AS win FROM i WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM win),
pos AS (SELECT doc_id, size, unnest(range(1, len(words) - size + 2)) AS p, words FROM w, sizes),
hit AS (SELECT doc_id, p, pos.size, item_id FROM pos JOIN win ON pos.size = win.size AND array_to_string(words[p:p + pos.size - 1], ' ') = win.win),
cover AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)"""


def op7() -> str:
    return f"""
WITH w AS ({_words("documents", "doc_id", BLANK, False)}),
win AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS p,
  unnest(list_transform(range(1, len(words) - 18), lambda p: array_to_string(words[p:p + 19], ' '))) AS win FROM w),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(range(p, p + 20)) AS q FROM again)),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS q FROM w),
left_ AS (SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS kept FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_ USING (doc_id) LEFT JOIN n USING (doc_id)"""


def op10() -> str:
    rules = Rules()
    widths = sorted({rules.repeat_width, *(n for n, _ in rules.widths)})
    covers = ",\n".join(
        f"""g{n} AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS k
  FROM (SELECT doc_id, unnest(range(1, len(words) - {n - 2})) AS p,
    unnest(list_transform(range(1, len(words) - {n - 2}), lambda p: array_to_string(words[p:p + {n - 1}], ' '))) AS win FROM w)) WHERE k > 1),
c{n} AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS chars FROM word
  SEMI JOIN (SELECT DISTINCT doc_id, unnest(range(p, p + {n})) AS q FROM g{n}) USING (doc_id, q) GROUP BY doc_id)"""
        for n in widths
    )
    joins = " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in widths)
    fails = " OR ".join(f"100 * coalesce(c{n}.chars, 0) > {limit} * word_chars" for n, limit in rules.widths)
    return f"""
WITH w AS ({_words("documents", "doc_id", BLANK, False)}),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS q FROM w),
chars AS (SELECT doc_id, sum(length(word)) AS word_chars FROM word GROUP BY doc_id),
line AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS k
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '{BLANK}')),
dup AS (SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS line_chars
  FROM line WHERE k > 1 GROUP BY doc_id),
{covers},
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
  coalesce(c{rules.repeat_width}.n_words, 0)::BIGINT AS n_repeat_words,
  100 * coalesce(line_chars, 0) > {rules.line_limit} * word_chars OR {fails} AS repeats
  FROM w JOIN documents USING (doc_id) LEFT JOIN chars USING (doc_id) LEFT JOIN dup USING (doc_id) {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeat_limit} * n_words AS base_failed,
  NOT (n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeat_limit} * n_words OR coalesce(repeats, false)) AS kept FROM m"""


def op11() -> str:
    return f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p),
n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2),
  lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 5) t(k)) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2),
cut AS (SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[cut + 1:c.k], ' ')),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sub AS (SELECT lang, array_to_string(words[i:i + s - 1], ' ') AS phrase, a AS longer FROM
  (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM c WHERE k >= 3))),
kept AS (SELECT * FROM low WHERE NOT EXISTS (SELECT 1 FROM sub WHERE sub.lang = low.lang AND sub.phrase = low.phrase AND 100::HUGEINT * longer >= 80::HUGEINT * a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""


def op13() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""
WITH d AS ({_words("documents", "doc_id", term, True)}),
n AS (SELECT doc_id, len(words)::BIGINT AS n FROM d WHERE len(words) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM n, c),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(words) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
i AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest(words) AS term FROM ({_words("benchmark", "item_id", term, True)})) GROUP BY ALL),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


ORACLES = {
    "op2_ngram_jaccard": op2(),
    "op3_url_filter": op3(),
    "op4_sharding": op4(),
    "op5_decontamination": op5(),
    "op7_substring_dedup": op7(),
    "op10_quality_rules": op10(),
    "op11_phrases": op11(),
    "op13_ranked_search": op13(),
}
