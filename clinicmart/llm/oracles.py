"""SQL over the same tables, where SQL can express a query."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_mix"] = """
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY source
), sums AS (
  SELECT sum(size) AS whole, sum(CASE WHEN size > 0 THEN sqrt(size) END) AS weights FROM sizes
), rates AS (
  SELECT source, CASE WHEN size > 0 THEN whole * sqrt(size) / weights / size ELSE 0 END AS rate
  FROM sizes, sums
), keyed AS (
  SELECT *, coalesce(doc_id::VARCHAR,
    '~' || md5(concat_ws(chr(31), coalesce(text, ''), coalesce(lang, ''), coalesce(source, ''),
      coalesce(n_chars::VARCHAR, '')))
      || ':' || row_number() OVER (PARTITION BY doc_id, text, lang, source, n_chars)) AS key
  FROM documents
), drawn AS (
  SELECT d.*, rate,
    ('0x' || substr(md5('mix-1:' || key || ':1'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM keyed d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), counted AS (
  SELECT *,
    len(list_filter(
      list_transform(range(0, 200), lambda k:
        list_sum(list_transform(range(0, k + 1), lambda j: exp(j * ln(rate) - rate - lgamma(j + 1))))),
      lambda f: f <= u)) AS n
  FROM drawn WHERE rate > 0
), copied AS (
  SELECT * EXCLUDE (rate, u, n), unnest(range(0, n)) AS copy_no FROM counted WHERE n > 0
)
SELECT * EXCLUDE (copy_no, key), copy_no::INTEGER AS copy_no,
  md5('mix-1:' || key || ':' || copy_no) AS shuffle_key
FROM copied
"""

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op5_decontaminate"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
    regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
      lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS win
  FROM b WHERE len(w) > 0
), dw AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM bw)
  WHERE len(w) >= n
), hit AS (
  SELECT r, i, dw.n, item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.win = array_to_string(w[i : i + dw.n - 1], ' ')
), per AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per USING (r) LEFT JOIN items USING (r)
"""


def _found(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: a match starts after the pieces up to it and the matches before it."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT r, {rank} AS k, '{kind}' AS kind, sum(piece + len_m) OVER w - len_m AS s,
    sum(piece + len_m) OVER w AS e, fits
  FROM (
    SELECT r, i, length(pieces[i]) AS piece, length(m[i]) AS len_m, length(g[i]) >= {least} AS fits
    FROM (
      SELECT r, unnest(range(1, len(m) + 1)) AS i, m, g, pieces
      FROM (
        SELECT r, regexp_extract_all(text, '{p}') AS m, regexp_extract_all(text, '{p}', {group}) AS g,
          regexp_split_to_array(text, '{p}') AS pieces
        FROM d
      )
    )
  ) WINDOW w AS (PARTITION BY r ORDER BY i)"""


ORACLES["op3_secrets"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), found AS ({
    " UNION ALL ".join(
        [
            _found(
                "assign",
                0,
                r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                2,
                12,
            ),
            _found("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
            _found("hex", 2, r"[0-9a-f]+", 0, 16),
        ]
    )
}
), per AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
    count(*) FILTER (kind = 'hex') AS h,
    string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) AS spans
  FROM found WHERE fits GROUP BY r
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access,
  coalesce(h, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (r)
"""


def _bytes_of(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


#: crc32 of the decimal digits of an id, a bit at a time.
_CRC = """xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)),
      lambda x, i: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""

#: More than any table here has: 3^13 documents of a source, and as many sources.
_LEVELS = 13


def _tree(name: str, base: str, levels: int) -> str:
    """Nodes (t, p, h) of each level, until one is left; a run of one is hashed as well."""
    out = f"{name}0 AS ({base})"
    for i in range(levels):
        out += f""",
{name}{i + 1} AS (
  SELECT t, p // 3 AS p, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE max(h) END AS h,
    (max(n) + 2) // 3 AS n FROM {name}{i} GROUP BY t, p // 3
)"""
    return out


def _proof(name: str, start: str, levels: int) -> str:
    """Per request (r, t, p): the others of each level as ``pre`` and ``post``, in columns of lists."""
    out = f"{start}"
    for i in range(levels):
        out = f"""
  SELECT q.* REPLACE (
    CASE WHEN n > 1 THEN list_concat(others, [coalesce(pre, '') || coalesce(post, '')]) ELSE others END AS others,
    CASE WHEN n > 1 THEN list_concat(sides, [{{'a': coalesce(pre, ''), 'b': coalesce(post, '')}}]) ELSE sides END AS sides)
  FROM ({out}) q JOIN (
    SELECT t AS tt, p AS pp, n,
      string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pre,
      string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS post
    FROM {name}{i} WINDOW w AS (PARTITION BY t, p // 3 ORDER BY p)
  ) ON t = tt AND p // {3**i} = pp"""
    return out


_FIELDS = " || ".join(_bytes_of(c) for c in ("doc_id", "source", "lang", "n_chars"))

ORACLES["op12_manifest"] = f"""
WITH l AS (
  SELECT doc_id, source, sha256({_FIELDS} || {_bytes_of("text")}) AS leaf,
    CASE WHEN {_CRC} % 2 = 0 THEN sha256({_FIELDS} || {_bytes_of("replace(text, chr(10), '')")})
      ELSE sha256({_FIELDS} || {_bytes_of("text")}) END AS claimed
  FROM documents
), o AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
    count(*) OVER (PARTITION BY source) AS n
  FROM l
),
{_tree("g", "SELECT t, p, leaf AS h, n FROM o", _LEVELS)},
{_tree("s", f"SELECT 0 AS t, t AS p, h, (SELECT count(*) FROM g{_LEVELS}) AS n FROM g{_LEVELS}", _LEVELS)},
low AS ({_proof("g", "SELECT t, p, doc_id, leaf, claimed, []::VARCHAR[] AS others, []::STRUCT(a VARCHAR, b VARCHAR)[] AS sides FROM o", _LEVELS)}),
high AS ({_proof("s", "SELECT 0 AS t, t AS p, []::VARCHAR[] AS others, []::STRUCT(a VARCHAR, b VARCHAR)[] AS sides FROM (SELECT DISTINCT t FROM o)", _LEVELS)}),
joined AS (
  SELECT doc_id, leaf, claimed, g{_LEVELS}.h AS subroot, s{_LEVELS}.h AS root,
    list_concat(low.others, high.others) AS others, list_concat(low.sides, high.sides) AS sides
  FROM low JOIN high ON low.t = high.p JOIN g{_LEVELS} ON low.t = g{_LEVELS}.t, s{_LEVELS}
), folded AS (
  SELECT *, list_reduce(
    list_concat([{{'a': claimed, 'b': ''}}], sides),
    lambda x, y: {{'a': sha256(y.a || x.a || y.b), 'b': ''}}).a AS folded_root
  FROM joined
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(others, '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM folded
"""

#: Bytes as hexadecimal digits, two for each; ids without a value come after all others.
ORACLES["op13_suffixes"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k,
    hex(encode(coalesce(text, ''))) AS h
  FROM documents
), w AS (
  SELECT r, k, unnest(range(0, len(h) // 2 - 49)) AS i, h FROM d
), low AS (
  SELECT r, k, i, min(k) OVER (PARTITION BY substr(h, 2 * i + 1, 100)) AS least FROM w
), hit AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh
  FROM low WHERE least < k
), spans AS (
  SELECT r, min(i) AS s, max(i) + 50 AS e
  FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS run FROM hit) GROUP BY r, run
), per AS (
  SELECT r, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS ee, count(*) AS n, sum(e - s) AS gone
  FROM spans GROUP BY r
), whole AS (
  SELECT d.*, coalesce(n, 0) AS n, coalesce(gone, 0) AS gone, [0] || coalesce(ee, []) AS froms,
    coalesce(ss, []) || [len(h) // 2] AS tos
  FROM d LEFT JOIN per USING (r)
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, gone::BIGINT AS n_removed, n::BIGINT AS n_spans,
  sha256(unhex(array_to_string(list_transform(range(1, len(tos) + 1),
    lambda x: substr(h, 2 * froms[x] + 1, 2 * (tos[x] - froms[x]))), ''))) AS kept_sha256
FROM whole
"""
