"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from tillroll.llm.url_filter import LIST_TERMS, RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


TOPK = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


VARIANTS = f"""
WITH RECURSIVE
crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_lower("text")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
each AS (
  SELECT doc_id, run, count(*) AS k, hex(encode(doc_id || ':' || run)) AS code
  FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
summed AS (
  SELECT doc_id, run, k, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(code) // 2),
      lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT))),
    lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1]))) AS h
  FROM each, crc),
typed AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, k FROM summed),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS (
  SELECT x.word AS word, y.word AS other, y.n AS other_n
  FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION
  SELECT x.word, y.word, y.n FROM less x JOIN words y ON x.rest = y.word
  UNION
  SELECT y.word, x.word, x.n FROM less x JOIN words y ON x.rest = y.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
chosen AS (
  SELECT best.word, n_near, most, min(other) AS other
  FROM best JOIN near ON best.word = near.word AND near.other_n = best.most GROUP BY best.word, n_near, most),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN most >= 10 * n THEN other END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words LEFT JOIN chosen ON words.word = chosen.word),
followed AS (
  SELECT word, word AS root FROM forms
  UNION
  SELECT followed.word, forms.form FROM followed JOIN forms ON followed.root = forms.word WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, followed.root, forms.n, CAST(forms.n_near AS BIGINT) AS n_near, forms.form_n
FROM forms JOIN followed ON forms.word = followed.word
JOIN forms AS last ON last.word = followed.root AND last.form IS NULL
"""


def _url_sql() -> str:
    rules = " ".join(
        f"WHEN (host = '{t.split('/', 1)[0]}' OR host LIKE '%.{t.split('/', 1)[0]}')"
        f" AND starts_with(path, '/{t.split('/', 1)[1]}') THEN '{said}:{t}'"
        for said, t in sorted(RULES, key=lambda r: -len(r[1])))
    words = "(^|[.-])(" + "|".join(LIST_TERMS) + ")($|[.-])"
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, {_lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(regexp_extract(rest, '^[^#]*'), '^[^?]*[?]?(.*)$', 1, 's') AS query
  FROM cut),
canon AS (
  SELECT page_id, host, path,
    array_to_string(list_sort(list_filter(string_split(query, '&'),
      lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS kept,
    CASE {rules} END AS fits
  FROM parts),
keyed AS (
  SELECT page_id, host, path, fits,
    regexp_replace(host, '^(www|m)[.]', '')
    || regexp_replace(regexp_replace(path, '/+$', ''), '[.]html$', '')
    || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canon
  FROM canon),
listed AS (SELECT DISTINCT canon FROM keyed WHERE regexp_matches(host, '{words}') AND canon <> '')
SELECT page_id, host, path,
  CASE WHEN fits IS NOT NULL THEN substr(fits, strpos(fits, ':') + 1) END AS rule,
  CASE WHEN fits IS NOT NULL THEN substr(fits, 1, strpos(fits, ':') - 1)
       WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM keyed LEFT JOIN listed l USING (canon)
"""


JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({_lower("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'),
                             lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 90 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
least_id AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id
FROM sizes JOIN least_id ON a = doc_id
"""


SQL = {"op6_jaccard_join": JACCARD, "op3_exact_topk": TOPK, "op5_url_filter": _url_sql(),
       "op11_spelling_variants": VARIANTS}
