"""DuckDB SQL of the queries that SQL can express."""

OP4 = r"""
WITH parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
ruled AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parsed)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN list_has_any(string_split(host, '.'),
                              ['ads-track', 'spam-farm', 'casino-win', 'adult-x', 'cheap-pills', 'free-bets']) THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
"""

OP7 = """
WITH rows AS MATERIALIZED (
  SELECT row_number() OVER () AS line, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND NOT coalesce(list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))), FALSE)),
scored AS (
  SELECT q.line, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND c.line <> q.line)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


# CRC-32 of a list of bytes, by the usual table (its generator is a fixed value)
CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t
  FROM range(256) r(i))"""


def crc32(octets: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: "
            "xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _merkle(within: int = 8, over: int = 3) -> str:
    """The manifest with as many levels written out within languages and over
    them; a level on which a tree has one node changes nothing."""
    head = " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [CRC_TABLE, f"""hashed AS MATERIALIZED (
  SELECT doc_id, lang, lang IS NOT NULL AS named, coalesce(lang, '') AS l, sha256({head} || {_framed("text")}) AS leaf,
         CASE WHEN {crc32("list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda p: ord(substr(doc_id::VARCHAR, p, 1)))")} % 3 = 0
              THEN sha256({head} || {_framed(lower)}) ELSE sha256({head} || {_framed("text")}) END AS offered
  FROM documents, crc_table)""", """leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY named, l ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY named, l) AS n FROM hashed)""",
             "w0 AS MATERIALIZED (SELECT named, l, i, leaf AS h, n FROM leaves)"]

    def level(name: str, k: int, group: str) -> None:
        parts.append(f"""{name}r{k} AS MATERIALIZED (
  SELECT {group}, i // 8 AS run, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {name}{k} GROUP BY {group}, i // 8)""")
        parts.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT {group}, run AS i, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h, (n + 7) // 8 AS n FROM {name}r{k})""")

    def climb(name: str, k: int, before: str, after: str, on: str, place: str) -> None:
        left, right = "array_to_string(hs[1:p % 8], '')", "array_to_string(hs[p % 8 + 2:], '')"
        parts.append(f"""{after} AS MATERIALIZED (
  SELECT c.* REPLACE (CASE WHEN r.n = 1 THEN f ELSE sha256({left} || f || {right}) END AS f,
                      CASE WHEN r.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof, p // 8 AS p)
  FROM (SELECT * REPLACE ({place} AS p) FROM {before}) c JOIN {name}r{k} r ON {on} r.run = c.p // 8)""")

    for k in range(within):
        level("w", k, "named, l")
    parts.append(f"""o0 AS MATERIALIZED (
  SELECT 0 AS g, row_number() OVER (ORDER BY named, l) - 1 AS i, named, l, h, count(*) OVER () AS n FROM w{within})""")
    for k in range(over):
        level("o", k, "g")
    parts.append("c0 AS MATERIALIZED (SELECT doc_id, named, l, leaf, offered AS f, '' AS proof, i AS p FROM leaves)")
    for k in range(within):
        climb("w", k, f"c{k}", f"c{k + 1}", "r.named = c.named AND r.l = c.l AND", "p")
    parts.append(f"""d0 AS MATERIALIZED (
  SELECT c.doc_id, c.leaf, o.h AS subroot, c.f, c.proof, o.i AS p FROM c{within} c JOIN o0 o ON o.named = c.named AND o.l = c.l)""")
    for k in range(over):
        climb("o", k, f"d{k}", f"d{k + 1}", "", "p")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM d{over}, o{over} t"""


OP13 = _merkle()

OP12 = f"""
WITH {CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
spoken AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS c
  FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT w, c, {crc32("flatten(list_transform(string_split(doc_id::VARCHAR || ':' || w, ''), lambda x: "
                      "CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [192 + (ord(x) >> 6), 128 + (ord(x) & 63)] END))")} AS h
  FROM spoken, crc_table),
words AS MATERIALIZED (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word,
         sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3),
holes AS MATERIALIZED (
  SELECT word, substr(word, 1, p - 1) || '*' || substr(word, p + 1) AS hole, substr(word, 1, p - 1) || substr(word, p + 1) AS less
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (
  SELECT a.word, b.word AS near FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON h.less = w.word
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON h.less = w.word),
ranked AS (
  SELECT p.word, p.near, f.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY f.n DESC, p.near) AS k
  FROM pairs p JOIN words f ON f.word = p.near),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
steps AS (
  WITH RECURSIVE s(word, ahead, form) AS (
    SELECT word, word, form FROM formed
    UNION ALL SELECT s.word, f.word, f.form FROM s JOIN formed f ON s.form = f.word)
  SELECT word, ahead AS root FROM s WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN steps USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": OP4, "op7_topk": OP7, "op12_spelling": OP12, "op13_merkle": OP13}
