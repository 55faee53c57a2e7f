"""SQL answers to those queries that SQL can express, from the definitions alone."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"


def url_rules(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(str(r) for r in rules)
    return f"""WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://')
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
      cut AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM rest),
      parts AS (SELECT page_id, {_LOWER.format('h')} AS host,
        regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM cut),
      rules(h, p, v) AS (VALUES {values})
      SELECT page_id, host, path, max(h || p) FILTER (n = 1) AS rule,
        coalesce(max(v) FILTER (n = 1), 'allow') AS verdict
      FROM (SELECT parts.*, rules.*, row_number() OVER (PARTITION BY page_id
          ORDER BY length(h) + length(p) DESC, length(h) DESC, v DESC) AS n
        FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
      GROUP BY page_id, host, path"""


LINE_RULES = f"""WITH src AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS words FROM documents),
  win AS (SELECT doc_id, i, words[i:i + 4] AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM src WHERE len(words) >= 5)),
  twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win) WHERE n > 1),
  hits AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id),
  raw AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM src),
  lines AS (SELECT *, lower(trim(regexp_replace(line, '{_SPACE}+', ' ', 'g'))) AS norm,
    row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS i
    FROM raw WHERE regexp_matches(line, '{_WORD}')),
  placed AS (SELECT *, len(string_split(norm, ' ')) AS n FROM lines JOIN (SELECT doc_id, text FROM src) USING (doc_id)),
  dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
  common AS (SELECT c.host, norm FROM (
      SELECT host, norm, count(DISTINCT text) AS texts FROM placed GROUP BY host, norm) c
    JOIN (SELECT host, count(DISTINCT text) AS texts FROM placed GROUP BY host) h ON h.host = c.host
    WHERE c.texts > 20 AND c.texts > 0.01 * h.texts),
  gone AS (SELECT doc_id, sum(n) AS n FROM placed JOIN common USING (host, norm) GROUP BY doc_id),
  counts AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      coalesce(dups.n, 0) AS n_dup_lines, coalesce(hits.n, 0) AS n_repeat_words, gone.n AS gone
    FROM src LEFT JOIN hits USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN gone USING (doc_id)),
  judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    gone IS NOT NULL AND 100 * (n_words - gone) < 20 * n_words AS depleted FROM counts)
  SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
    base_failed, depleted, NOT base_failed AND NOT depleted AS kept FROM judged"""

_BENCH_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("text"))
FM_INDEX = f"""WITH items AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_BENCH_WORDS} AS words
      FROM benchmark WHERE item_id IS NOT NULL),
    phrases AS (SELECT DISTINCT item, words[i:i + 9] AS w FROM (SELECT item, words,
      unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
    sizes AS (SELECT DISTINCT len(w) AS size FROM phrases),
    docs AS (SELECT doc_id, coalesce({_BENCH_WORDS}, []) AS words FROM documents),
    spots AS (SELECT doc_id, i, size, words[i:i + size - 1] AS w FROM (SELECT doc_id, words, size,
      unnest(range(1, len(words) - size + 2)) AS i FROM docs, sizes WHERE len(words) >= size)),
    found AS (SELECT doc_id, i, size, item FROM spots JOIN phrases USING (w)),
    hit AS (SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM found)
      GROUP BY doc_id),
    names AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
      FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(names.n, 0) AS n_items,
      sha256(coalesce(names, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)"""

LSH_FOREST = f"""WITH RECURSIVE docs AS (SELECT doc_id,
      regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}+') AS words FROM documents),
    grams AS (SELECT DISTINCT doc_id, words[i:i + 4] AS g FROM (SELECT doc_id, words,
      unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM docs WHERE len(words) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    same AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b USING (g)
      WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    links AS MATERIALIZED (SELECT a, b, s.n = x.n AND s.n = y.n AS equal FROM same s JOIN sizes x ON x.doc_id = a
      JOIN sizes y ON y.doc_id = b WHERE 5 * s.n >= 4 * (x.n + y.n - s.n)),
    reach(doc_id, root) AS (SELECT doc_id, doc_id FROM docs
      UNION SELECT links.b, root FROM reach JOIN links ON links.a = reach.doc_id),
    class AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY doc_id)
    SELECT doc_id, class_id, coalesce(l.n, 0) AS n_links, 1 + coalesce(l.equal, 0) AS copies,
      coalesce(sizes.n, 0) AS n_shingles
    FROM class LEFT JOIN sizes USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, count(*) AS n, count(*) FILTER (equal) AS equal FROM links GROUP BY a) l
      USING (doc_id)"""

#: crc32 of a text, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    range(1, length({0}) + 1), lambda i: list_transform(range(8),
      lambda b: ((ascii(substr({0}, i, 1)) >> b) & 1)::BIGINT)))),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)"""

CONVERSATION_TRIE = f"""WITH own AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
      ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    heads AS (SELECT c, turns, c - c % 20 AS base, {_CRC32.format("c::VARCHAR")} % 4 AS h FROM own),
    seqs AS (SELECT a.c, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS seq
      FROM heads a LEFT JOIN own b ON b.c = a.base),
    spots AS (SELECT c, d, seq[1:d] AS path, len(seq) = d AS ends
      FROM (SELECT c, seq, unnest(range(len(seq) + 1)) AS d FROM seqs)),
    nodes AS (SELECT path, d, min(c) AS conv_id, count(*) AS n,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
        CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].t, '{_WORD}+')) END AS words
      FROM spots GROUP BY path, d),
    kids AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
    full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (path, d)),
    below AS (SELECT path[1:k] AS path, k AS d, count(*) FILTER (n_children = 0) AS n_leaves,
        sum((n - 1) * words) AS saved FROM (SELECT *, unnest(range(d + 1)) AS k FROM full_nodes) GROUP BY ALL)
    SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, b.n_leaves,
      b.saved::BIGINT AS saved_tokens, v.ends_sha256
    FROM full_nodes v JOIN below b USING (path, d)
    LEFT JOIN nodes p ON p.d = v.d - 1 AND p.path = v.path[1:v.d - 1]"""
