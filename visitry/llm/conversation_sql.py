"""Check SQL (DuckDB) of the operators on conversations."""

# crc32 of a text, bit by bit: a byte is mixed in, then eight shifts (the -1s) follow
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({0}) + 1),
    lambda k: list_concat([ascii(substr({0}, k, 1))::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT)"""

TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS b, {CRC.format('s')} % 9 AS h FROM (SELECT DISTINCT c, c::VARCHAR AS s FROM turns)),
built AS (
  SELECT v.c, 0 AS part, i, r, x FROM convs v JOIN turns t ON t.c = v.b WHERE i < h
  UNION ALL SELECT v.c, 1, i, r, x FROM convs v JOIN turns t ON t.c = v.c WHERE i >= h),
placed AS (SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM built),
paths AS (
  SELECT c, d, strlen(x) AS bytes, md5(string_agg(length(r) || ':' || r || length(x) || ':' || x, '') OVER (PARTITION BY c ORDER BY d)) AS p FROM placed
  UNION ALL SELECT c, 0, 0, '' FROM convs),
ends AS (SELECT c, max(d) AS d, arg_max(p, d) AS p FROM paths GROUP BY c),
lists AS (SELECT d, p, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha FROM ends GROUP BY d, p),
nodes AS (SELECT d, p, min(c) AS c, count(*) AS n, any_value(bytes) AS bytes FROM paths GROUP BY d, p),
up AS (SELECT n.*, q.d AS ud, q.p AS uq, u.c AS uc FROM nodes n LEFT JOIN paths q ON q.c = n.c AND q.d = n.d - 1 LEFT JOIN nodes u ON u.d = q.d AND u.p = q.p),
kids AS (SELECT ud AS d, uq AS p, count(*) AS kids FROM up WHERE ud IS NOT NULL GROUP BY ud, uq),
own AS (SELECT n.d, n.p, n.c, (n.n - 1) * n.bytes AS v, CASE WHEN kids IS NULL THEN 1 ELSE 0 END AS leaf FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.p = n.p),
below AS (
  SELECT q.d, q.p, sum(v)::BIGINT AS saved, sum(leaf)::BIGINT AS leaves
  FROM own o JOIN paths q ON q.c = o.c AND q.d <= o.d GROUP BY q.d, q.p)
SELECT u.c AS conv_id, u.d AS depth, u.uc AS parent_conv_id, u.n AS n_convs, coalesce(kids, 0) AS n_children,
  leaves AS n_leaves, saved AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM up u JOIN below b ON b.d = u.d AND b.p = u.p
LEFT JOIN kids k ON k.d = u.d AND k.p = u.p LEFT JOIN lists l ON l.d = u.d AND l.p = u.p
"""


def _least(*options: str) -> str:
    return "list_sort([" + ", ".join(options) + "])[1]"


def _to(letter: str, cost: str, rest: str, condition: str = "") -> str:
    """The option of a letter that costs so much before `rest`; one without its condition is out of reach."""
    price = f"{cost} + {rest}.c" if not condition else f"CASE WHEN {condition} THEN {cost} + {rest}.c ELSE 1000000000 END"
    return f"{{'c': {price}, 'a': '{letter}' || {rest}.a}}"


# states: z nothing yet, s after s, u after u, a after a; the recursion goes from the last row to the first
REPAIR_SQL = f"""
WITH RECURSIVE named AS (
  SELECT conv_id AS c, turn AS t, coalesce(role, ' ') AS r, coalesce(text, ' ') AS x,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
hashed AS (SELECT *, {CRC.format("s")} % 20 AS kind FROM named),
broken AS (
  SELECT c, t, CASE WHEN kind = 4 THEN 'user' ELSE r END AS r,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS x,
    unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed),
placed AS (
  SELECT c, t, r, x, row_number() OVER w AS i, substr(r, 1, 1) AS o, lag(substr(r, 1, 1)) OVER w AS before,
    regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g') AS bare, row_number() OVER (PARTITION BY c, r, x ORDER BY t NULLS FIRST, copy) AS nth
  FROM broken WINDOW w AS (PARTITION BY c ORDER BY t NULLS FIRST, r, x)),
faulty AS (
  SELECT *, bare = '' AS blank, bare <> '' AND nth > 1 AS dup, bare <> '' AND nth = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS cut,
    CASE WHEN bare <> '' AND nth = 1 AND right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS p, bare <> '' AND nth = 1 AS ok FROM placed),
tally AS (
  SELECT c, max(i) AS n, coalesce(max(t) - min(t) + 1 - count(DISTINCT t), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (i > 1 AND before || o NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY c),
go AS (
  SELECT c, n AS i, {{'c': 0, 'a': ''}} AS z, {{'c': 6, 'a': 'II'}} AS s, {{'c': 3, 'a': 'I'}} AS u, {{'c': 0, 'a': ''}} AS a FROM tally
  UNION ALL
  SELECT c, i, {_least("bz", _to("I", "3", "nu"))}, {_least("bs", _to("I", "3", "nu"))}, nu, na
  FROM (SELECT *, {_least("bu", _to("I", "3", "ba"))} AS nu, {_least("ba", _to("I", "3", "bu"))} AS na FROM (
    SELECT g.c, g.i - 1 AS i,
      {_least(_to("D", "4", "z"), _to("R", "p + 3", "u", "ok"), _to("K", "p", "s", "ok AND o = 's'"), _to("K", "p", "u", "ok AND o = 'u'"))} AS bz,
      {_least(_to("D", "4", "s"), _to("R", "p + 3", "u", "ok"), _to("K", "p", "u", "ok AND o = 'u'"))} AS bs,
      {_least(_to("D", "4", "u"), _to("R", "p + 3", "a", "ok"), _to("K", "p", "a", "ok AND o = 'a'"))} AS bu,
      {_least(_to("D", "4", "a"), _to("R", "p + 3", "u", "ok"), _to("K", "p", "u", "ok AND o = 'u'"))} AS ba
    FROM go g JOIN faulty f ON f.c IS NOT DISTINCT FROM g.c AND f.i = g.i))),
best AS (SELECT c, z.c AS cost, z.a AS audit FROM go WHERE i = 0),
letters AS (SELECT c, k, substr(audit, k, 1) AS l FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)),
counted AS (SELECT *, count(*) FILTER (l <> 'I') OVER (PARTITION BY c ORDER BY k) AS i, count(*) FILTER (l <> 'D') OVER (PARTITION BY c ORDER BY k) AS j FROM letters),
joined AS (SELECT q.c, k, l, j, f.r, f.x, CASE WHEN first_value(l || substr(f.r, 1, 1)) OVER (PARTITION BY q.c ORDER BY k) = 'Ks' THEN 1 ELSE 0 END AS led
  FROM counted q LEFT JOIN faulty f ON f.c IS NOT DISTINCT FROM q.c AND f.i = q.i WHERE l <> 'D'),
texts AS (SELECT c, sha256(string_agg(CASE WHEN l = 'K' THEN r WHEN (j - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN l = 'I' THEN '' ELSE x END, chr(10) ORDER BY k)) AS sha FROM joined GROUP BY c)
SELECT v.c AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id AS c FROM conversations) v LEFT JOIN tally t ON t.c IS NOT DISTINCT FROM v.c
LEFT JOIN best b ON b.c IS NOT DISTINCT FROM v.c LEFT JOIN texts x ON x.c IS NOT DISTINCT FROM v.c
"""
