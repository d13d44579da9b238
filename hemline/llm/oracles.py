"""The operators' queries in DuckDB SQL, where SQL can express them."""

MIXING = r"""
WITH d AS (
    SELECT doc_id, source,
           CASE WHEN text IS NULL THEN 0
                ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
    FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
    SELECT source, source_size,
           ([5, 2, 1])[1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::BIGINT AS weight
    FROM s),
n AS (SELECT *, source_size * 2.0::DOUBLE / weight AS need FROM w),
l AS (
    SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
               - coalesce(sum(source_size) OVER below, 0) * 2.0::DOUBLE)
              / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
    FROM n
    WINDOW below AS (ORDER BY need, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
    SELECT source, source_size,
           least(source_size * 2.0::DOUBLE,
                 coalesce(weight * max(CASE WHEN need > level THEN level END) OVER (), 'inf'::DOUBLE)) AS target
    FROM l),
b AS (SELECT *, length(bin(size)) AS bits, ((coalesce(doc_id, 0) % 256) + 256) % 256 AS salt FROM d),
p AS (
    SELECT *, row_number() OVER (
        PARTITION BY source
        ORDER BY bits, floor(size / pow(2.0, greatest(bits - 5, 0))), salt, size, doc_id) AS place
    FROM b),
r AS (
    SELECT p.doc_id, p.size, t.source_size, t.target, p.place,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
           ('0x' || substr(md5(coalesce('s' || p.source, '')), 1, 5))::INT / 1048576.0::DOUBLE AS start
    FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       least(floor(start + place * rate) - floor(start + (place - 1) * rate), 2)::BIGINT * size AS taken
FROM r
"""

EXACT = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
    FROM documents),
g AS (
    SELECT *, count(*) OVER (PARTITION BY h) AS group_size,
           first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST) AS keep_id
    FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256 FROM g
"""

ORACLES = {
    "op3_source_mixing": MIXING,
    "op8_exact_dedup": EXACT,
}


def _secrets() -> str:
    from hemline.llm import secrets as S

    quote = lambda p: p.replace("'", "''")
    kinds = " UNION ALL ".join(
        f"""SELECT row, {k} AS kind, unnest(list_transform(string_split_regex(text, '{quote(p)}'), lambda x: length(x))) AS gap,
               unnest(regexp_extract_all(text, '{quote(p)}', 0)) AS whole,
               unnest(regexp_extract_all(text, '{quote(p)}', {g})) AS value,
               generate_subscripts(string_split_regex(text, '{quote(p)}'), 1) AS pos
        FROM d WHERE regexp_matches(text, '{quote(p)}')"""
        for k, (p, g) in enumerate([(S.ASSIGN, 2), (S.ACCESS, 0), (S.HEX, 0), (S.CANDIDATE, 0)]))
    allowed = " AND ".join(f"NOT regexp_matches(value, '{quote(p)}')" for p in S.ALLOW)
    w, n = S.WINDOW, len(S.KINDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({kinds}),
g AS (SELECT *, coalesce(length(whole), 0) AS n,
             sum(gap + coalesce(length(whole), 0)) OVER (PARTITION BY row, kind ORDER BY pos) AS stop FROM f),
c AS (SELECT row, stop - n AS start, value FROM g
      WHERE kind = 3 AND whole IS NOT NULL AND regexp_matches(value, '[0-9]')
        AND regexp_matches(value, '[A-Za-z]') AND {allowed}),
o AS (SELECT DISTINCT value FROM c),
win AS (SELECT value, i, substr(value, i, {w}) AS text
        FROM (SELECT value, unnest(range(1, length(value) - {w} + 2)) AS i FROM o)),
ch AS (SELECT value, i, substr(text, j, 1) AS a, count(*) AS k
       FROM (SELECT *, unnest(range(1, {w} + 1)) AS j FROM win) GROUP BY ALL),
sm AS (SELECT value, i, sum(({S.BITS})[k + 1]) AS s FROM ch GROUP BY ALL),
hot AS (SELECT value, min(i) AS first, max(i) + {w - 1} AS last FROM sm
        WHERE s <= CASE WHEN regexp_matches(value, '{S.HEX_CLASS}') THEN {S.most_sum(S.HEX_BITS)}
                        ELSE {S.most_sum(S.BASE64_BITS)} END GROUP BY value),
sp AS (SELECT row, kind, (stop - n)::BIGINT AS start, stop::BIGINT AS stop FROM g
       WHERE (kind = 0 AND length(value) >= {S.LEAST_VALUE}) OR (kind IN (1, 2) AND whole IS NOT NULL)
       UNION ALL
       SELECT row, 3, (start + first - 1)::BIGINT, (start + last)::BIGINT FROM c JOIN hot USING (value)),
t AS (SELECT row, kind, start, stop,
             ({list(S.KINDS)})[kind + 1] || ':' || start || ':' || stop AS txt FROM sp)
SELECT doc_id, count(kind) FILTER (kind = 0) AS n_assign, count(kind) FILTER (kind = 1) AS n_access,
       count(kind) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(txt, ',' ORDER BY start, kind, stop) FILTER (kind < {n - 1}), '')) AS base_sha256,
       coalesce(string_agg(txt, ',' ORDER BY start, kind, stop), '') AS spans
FROM d LEFT JOIN t USING (row) GROUP BY row, doc_id
"""


ORACLES["op9_secret_scan"] = _secrets()


ORACLES["op13_maxscore"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, min(vec) AS vec FROM v GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
      FROM u q JOIN u c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def _conversations() -> str:
    """The damage, and the table of (cost, audit, lines) by state, row after row."""
    def add(way: str, cost: str, letters: str, lines: str = "''") -> str:
        return f"{{'c': ({way}).c + {cost}, 'a': ({way}).a || '{letters}', 'l': ({way}).l || {lines}}}"

    def some(way: str, test: str) -> str:
        return f"CASE WHEN ({way}) IS NOT NULL AND {test} THEN {{0}} END"

    def least(ways: list[tuple[str, str, str]]) -> str:
        return "list_min(list_filter([" + ", ".join(some(w, t).format(x) for w, t, x in ways) + \
            "], lambda x: x IS NOT NULL))"

    u, a = "chr(10) || 'user:'", "chr(10) || 'assistant:'"

    def inserts(state: int) -> list[tuple[int, str, str]]:
        """State reached, letters and lines of no, one and two inserts."""
        out, letters, lines = [(state, "", "''")], "", []
        for _ in range(2):
            state = 3 if state == 2 else 2
            letters, lines = letters + "I", lines + [a if state == 3 else u]
            out.append((state, letters, " || ".join(lines)))
        return out

    middle = {t: [] for t in range(4)}
    for s in range(4):
        for t, letters, lines in inserts(s):
            middle[t].append((f"w.s{s}", "true", add(f"w.s{s}", str(5 * len(letters)), letters, lines)))
    before = ", ".join(f"{least(ways)} AS m{t}" for t, ways in middle.items())
    own, text = "chr(10) || d.role || ':' || d.text", "d.text"
    stays, more = "d.fault IN (0, 3)", "CASE WHEN d.fault = 3 THEN 5 ELSE 0 END"
    into = {t: [(f"m{t}", "true", add(f"m{t}", "2", "D"))] for t in range(4)}
    for s, letter, t in ((0, "s", 1), (0, "u", 2), (1, "u", 2), (3, "u", 2), (2, "a", 3)):
        into[t].append((f"m{s}", f"{stays} AND d.role[1] = '{letter}'", add(f"m{s}", more, "K", own)))
        if letter != "s":
            into[t].append((f"m{s}", stays, add(f"m{s}", f"1 + {more}", "R", f"{u if letter == 'u' else a} || {text}")))
    after = ", ".join(f"{least(ways)} AS s{t}" for t, ways in into.items())
    ends = least([("s0", "true", "s0"), ("s1", "true", add("s1", "10", "II", f"{u} || {a}")),
                  ("s2", "true", add("s2", "5", "I", a)), ("s3", "true", "s3")])
    way = "NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR)"
    white = r"[\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(n::BIGINT, range(8)),
                          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n)),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             list_reduce(list_prepend(4294967295, list_transform(
                 string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                 lambda x: ord(x)::BIGINT)), lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1])) AS crc
      FROM conversations, tab),
p AS (SELECT *, xor(crc, 4294967295) % 20 AS part FROM k),
g AS (SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
             CASE part WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN part = 3 THEN [0, 1] ELSE [0] END) AS time
      FROM p WHERE part <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time) AS i,
             regexp_replace(text, '{white}+$', '') AS shown FROM g),
d AS (SELECT *, CASE WHEN shown = '' THEN 1
                     WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                     WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
             lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
w AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'l': ''}} AS s0, {way} AS s1, {way} AS s2, {way} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT d.conv_id, d.i, {after}
  FROM (SELECT w.conv_id, w.i, {before} FROM w) w JOIN d ON d.conv_id IS NOT DISTINCT FROM w.conv_id AND d.i = w.i + 1),
z AS (SELECT conv_id, {ends} AS best FROM w
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
             count(*) FILTER (fault = 3) AS truncated,
             count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM d GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.c AS cost, best.a AS audit,
       sha256(substr(best.l, 2)) AS repaired_sha256
FROM z LEFT JOIN n ON z.conv_id IS NOT DISTINCT FROM n.conv_id
"""


ORACLES["op12_conversation_repair"] = _conversations()
