"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _ascii_lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _words(text: str) -> str:
    return rf"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"


QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, {_words("text")} AS w
  FROM documents),
windows AS (
  SELECT rid, i, md5(array_to_string(w[i:i + 7], ' ')) AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
repeated AS (
  SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
repeat_words AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest(range(8)) AS k) GROUP BY rid),
lines AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines l USING (rid) LEFT JOIN repeat_words r USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
hosts AS (
  SELECT source, count(*) AS n, sum((base_failed OR n_symbols > 0.1 * word_chars
    OR coalesce(word_chars / nullif(n_words, 0) NOT BETWEEN 2.0 AND 15.0, false))::INT) AS f
  FROM b WHERE source IS NOT NULL GROUP BY source),
spread AS (SELECT avg(f / n) AS mean, coalesce(var_samp(f / n), 0) AS v FROM hosts),
prior AS (
  SELECT mean, coalesce(least(greatest(CASE WHEN v > 0 THEN mean * (1 - mean) / v - 1 END, 1.0),
    10000.0), 10000.0) AS s FROM spread),
refused AS (SELECT source FROM hosts, prior WHERE (f + mean * s) / (n + s) >= 0.8)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM refused)) AS kept
FROM b
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS w FROM documents),
windows AS (
  SELECT rid, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
owners AS (SELECT g, min(doc_id) AS owner FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)),
hit AS (
  SELECT DISTINCT rid, i + k AS i
  FROM (SELECT rid, i FROM windows JOIN owners USING (g) WHERE owner < doc_id),
    (SELECT unnest(range(50)) AS k)),
lists AS (SELECT rid, list(i) AS removed FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(removed), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN removed IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
    list_filter(w, lambda x, i: NOT list_contains(removed, i)), ' ') END) AS kept_sha256
FROM d LEFT JOIN lists USING (rid)
"""

LINES = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
l AS (
  SELECT rid, doc_id, line, pos, {_ascii_lower(f"trim(line, {_SPACE})")} AS key
  FROM (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d)),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT rid, l.doc_id, line, pos, keeper IS NOT NULL AND keeper <> l.doc_id AS dropped
  FROM l LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, sum(dropped::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY rid, doc_id
"""


def _index_words(text: str) -> str:
    return (
        rf"regexp_extract_all({_ascii_lower(f'coalesce({text}, chr(32))')},"
        r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_index_words("text")} AS w FROM documents),
b AS (SELECT item_id, {_index_words("text")} AS w FROM benchmark),
items AS (SELECT item_id, w, least(13, len(w)) AS width FROM b WHERE len(w) > 0),
parts AS (
  SELECT DISTINCT item_id, width, md5(array_to_string(w[i:i + width - 1], ' ')) AS g
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM items)),
widths AS (SELECT DISTINCT width FROM items),
windows AS (
  SELECT rid, width, i, md5(array_to_string(w[i:i + width - 1], ' ')) AS g
  FROM (SELECT rid, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM d, widths)),
found AS (SELECT rid, width, i, item_id FROM windows JOIN parts USING (width, g)),
hit AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM (SELECT DISTINCT rid, i, unnest(range(width)) AS k FROM found) GROUP BY rid),
owned AS (
  SELECT rid, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
  FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
  coalesce(o.n, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit h USING (rid) LEFT JOIN owned o USING (rid)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS w FROM documents),
keyed AS (
  SELECT rid, doc_id, w, CASE WHEN len(w) > 0 THEN array_to_string(w, ' ')
    ELSE 'row ' || rid END AS k FROM d),
classes AS (
  SELECT k, min(doc_id) AS node, count(*) AS n_copies, any_value(w) AS w FROM keyed GROUP BY k),
grams AS (
  SELECT DISTINCT node, md5(array_to_string(w[i:i + size - 1], ' ')) AS g
  FROM (SELECT node, w, least(5, len(w)) AS size, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
    FROM classes WHERE len(w) > 0)),
sizes AS (SELECT node, count(*) AS n FROM grams GROUP BY node),
common AS (
  SELECT a.node AS a, b.node AS b, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.node <> b.node GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b
  WHERE 5 * c.n >= 4 * (x.n + y.n - c.n)),
reach AS (
  SELECT node, node AS root FROM classes
  UNION SELECT links.a AS node, reach.root FROM reach JOIN links ON links.b = reach.node),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
degrees AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, root AS class_id, coalesce(n, 0)::BIGINT AS n_links, n_copies,
  doc_id = root AS is_first
FROM keyed JOIN classes USING (k) JOIN roots USING (node) LEFT JOIN degrees USING (node)
"""

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_index_words("text")} AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id, list_distinct({_index_words("text")}) AS w FROM benchmark),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM d),
counts AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n + 2) / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), c),
factors AS (SELECT rid, doc_id, 50 + (50 * len(w) * n) // l AS m FROM d, c WHERE len(w) > 0),
scores AS (
  SELECT bid, item_id, rid, doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM (SELECT bid, item_id, unnest(w) AS term FROM b) JOIN counts USING (term)
    JOIN weights USING (term) JOIN factors USING (rid)
  GROUP BY bid, item_id, rid, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY bid ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _field(name: str, text: str) -> str:
    return f"coalesce(octet_length(encode(({text})::VARCHAR)) || ':' || ({text}), '-')"


def _leaf(text: str) -> str:
    fields = [_field(c, c) for c in ("doc_id", "source", "lang", "n_chars")] + [_field("text", text)]
    return f"sha256({' || '.join(fields)})"


_TREE_STEP = """
  SELECT tree, level + 1 AS level, i // 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h,
    any_value((n + 2) // 3) AS n
  FROM {0} WHERE n > 1 GROUP BY tree, level, i // 3"""

MANIFEST = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda b: ascii(b)::BIGINT)),
    lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256]))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table),
d AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN crc % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claimed
  FROM documents LEFT JOIN crc USING (doc_id)),
trees AS (
  SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM d GROUP BY source),
leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, leaf, claimed, tree, n, row_number() OVER (
    PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM d JOIN trees ON d.source IS NOT DISTINCT FROM trees.source),
low AS (
  SELECT tree, 0 AS level, i, leaf AS h, n FROM leaves
  UNION ALL {_TREE_STEP.format("low")}),
subroots AS (SELECT tree, h AS subroot FROM low WHERE n = 1),
high AS (
  SELECT -1 AS tree, 0 AS level, tree AS i, subroot AS h, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL {_TREE_STEP.format("high")}),
root AS (SELECT h AS root FROM high WHERE n = 1),
levels AS (
  SELECT rid, low.level, 0 AS top, low.i, leaves.i // (3 ** low.level)::BIGINT AS own, h
  FROM leaves JOIN low USING (tree)
  WHERE low.n > 1 AND low.i // 3 = leaves.i // (3 ** low.level)::BIGINT // 3
  UNION ALL
  SELECT rid, high.level, 1 AS top, high.i, leaves.tree // (3 ** high.level)::BIGINT AS own, h
  FROM leaves, high
  WHERE high.n > 1 AND high.i // 3 = leaves.tree // (3 ** high.level)::BIGINT // 3),
steps AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY top, level) AS k,
    coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS left_part,
    coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS right_part
  FROM levels GROUP BY rid, top, level),
proofs AS (
  SELECT rid, count(*) AS n_steps, string_agg(left_part || right_part, '' ORDER BY k) AS proof
  FROM steps GROUP BY rid),
fold AS (
  SELECT rid, 0::BIGINT AS k, claimed AS h FROM leaves
  UNION ALL
  SELECT rid, steps.k, sha256(left_part || h || right_part) FROM fold JOIN steps USING (rid)
  WHERE steps.k = fold.k + 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
  fold.h AS folded_root, fold.h = root AS verified
FROM leaves JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN proofs USING (rid)
  JOIN fold ON fold.rid = leaves.rid AND fold.k = coalesce(n_steps, 0)
"""


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The kinds in their order, with the patterns of the contract and of the further rules.
_SECRETS = (
    (
        "assign",
        "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
        + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("userinfo", r"[a-z][a-z0-9+.-]*://[^\x09-\x0D\x20/:@?#]+:[^\x09-\x0D\x20/@?#]+@", 0, 1),
)


def _secret_matches(rank: int, kind: str, pattern: str, group: int, shortest: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT rid, {rank} AS rank, '{kind}' AS kind, length(g) >= {shortest} AS kept,
    (list_sum(list_transform(gaps[:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0))::BIGINT AS s,
    length(hits[i]) AS n
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i, unnest(groups) AS g
    FROM (SELECT rid, regexp_extract_all(t, '{quoted}', 0) AS hits,
      regexp_extract_all(t, '{quoted}', {group}) AS groups,
      string_split_regex(t, '{quoted}') AS gaps FROM d))"""


_SECRET_SPANS = " UNION ALL ".join(_secret_matches(i, *rule) for i, rule in enumerate(_SECRETS))

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
spans AS (
  SELECT rid, rank, kind, s, kind || ':' || s || ':' || (s + n) AS label
  FROM ({_SECRET_SPANS}) WHERE kept)
SELECT doc_id,
  count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(label, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256,
  coalesce(string_agg(label, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN spans USING (rid) GROUP BY rid, doc_id
"""

_URL_WORDS = (
    "adserver|banner|bet|betting|casino|doubleclick|escort|jackpot|pills|poker|porn|sex|slots|spam"
    "|tracker|viagra|warez|xxx"
)

URLS = f"""
WITH u AS (
  SELECT page_id,
    {_ascii_lower(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT u.*, (SELECT max(struct_pack(n := length(h || p), rule := h || p, v := v)) FROM rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS b FROM u)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.v, CASE WHEN regexp_matches(
    {_ascii_lower("host || path")}, '(^|[^a-z0-9])({_URL_WORDS})([^a-z0-9]|$)')
  THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""

ARCHIVES = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest
  FROM pages),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM kept
"""

ORACLE: dict[str, str] = {
    "op2_quality_rules": QUALITY,
    "op3_substring_dedup": SUBSTRINGS,
    "op4_line_dedup": LINES,
    "op5_secret_scans": SECRETS,
    "op6_url_filters": URLS,
    "op8_benchmark_decontamination": CONTAMINATION,
    "op9_warc": ARCHIVES,
    "op10_ngram_jaccard_join": NEAR_DUPLICATES,
    "op11_ranked_lexical_search": SEARCH,
    "op12_merkle_dataset_manifest": MANIFEST,
}
