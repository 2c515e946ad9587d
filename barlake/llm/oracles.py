"""DuckDB twins of the registered queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op2_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

ORACLES["op1_decontaminate"] = r"""
WITH fold AS (
  SELECT 'D' AS side, doc_id AS id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 'B', item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark),
wins AS (
  SELECT DISTINCT id AS item, least(len(w), 10) AS width, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM fold WHERE side = 'B' AND len(w) > 0)),
widths AS (SELECT DISTINCT width FROM wins),
places AS (
  SELECT id AS doc_id, width, unnest(range(1, len(w) - width + 2)) AS i, w
  FROM fold, widths WHERE side = 'D' AND len(w) >= width),
hits AS (
  SELECT p.doc_id, p.i, p.width, wins.item
  FROM places p JOIN wins ON wins.width = p.width AND wins.win = array_to_string(p.w[p.i:p.i + p.width - 1], ' ')),
words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT f.id AS doc_id, CAST(len(f.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM fold f LEFT JOIN words_hit h ON h.doc_id = f.id LEFT JOIN items n ON n.doc_id = f.id
WHERE f.side = 'D'
"""

# A-Z lower-cased, as the contract asks; lower() would change other letters too.
FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op13_url_filter"] = rf"""
WITH cut AS (
  SELECT page_id, {FOLD.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT page_id, h, p, verdict FROM cut, rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
  GROUP BY page_id)
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, CASE
    WHEN regexp_matches(host, '(?s)spam|^(.*\.)?cheap-pills\.|^(.*\.)?porn\.|^(.*\.)?ads\.') THEN 'block'
    WHEN path <> '' AND regexp_matches(host, '(?s)casino|viagra') THEN 'block'
    WHEN regexp_matches(path, '(?s)/(wp-login|xmlrpc)\.php$|/(wp-admin|cgi-bin)/|/cart/checkout') THEN 'block'
    ELSE 'allow' END) AS verdict
FROM cut c LEFT JOIN fits f USING (page_id)
"""


def integers(scale: int, extra: str = "") -> str:
    """The usable vectors of 64 components as lists of integers, with a row number."""
    return f"""
SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id{extra},
       list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
FROM embeddings
WHERE embedding IS NOT NULL AND len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def floored(total: str, count: str) -> str:
    return f"CAST(({total} - ((({total} % {count}) + {count}) % {count})) // {count} AS BIGINT)"


def clusters_sql(rounds: int = 3, k: int = 16) -> str:
    """Every round spelled out: assign all vectors, then replace the centroids."""
    def assign(i: int) -> str:
        far = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
        return f"""a{i} AS (SELECT rid, vec_id, v, cluster, distance FROM (
  SELECT rid, vec_id, v, cluster, CAST({far} AS BIGINT) AS distance, row_number() OVER (
    PARTITION BY rid ORDER BY {far}, cluster) AS place FROM kept, c{i}) WHERE place = 1)"""

    steps = [f"""c0 AS (SELECT CAST(n - 1 AS INTEGER) AS cluster, v AS c FROM (
  SELECT v, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) AS n FROM kept) WHERE n <= {k})"""]
    for i in range(rounds):
        steps += [assign(i), f"""m{i} AS (SELECT cluster, list(x ORDER BY j) AS moved FROM (
  SELECT cluster, j, {floored("sum(v[j])", "count(*)")} AS x FROM a{i}, range(1, 65) r(j) GROUP BY cluster, j)
  GROUP BY cluster)""", f"c{i + 1} AS (SELECT cluster, coalesce(moved, c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))"]
    steps.append(assign(rounds))
    return f"WITH kept AS ({integers(64)}),\n" + ",\n".join(steps) + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""


def codes_sql(rounds: int = 2, entries: int = 64, parts: int = 16) -> str:
    size = 64 // parts

    def assign(i: int) -> str:
        far = " + ".join(f"(x[{j}] - e[{j}]) * (x[{j}] - e[{j}])" for j in range(1, size + 1))
        return f"""a{i} AS (SELECT rid, part, x, entry, far FROM (
  SELECT rid, part, x, entry, {far} AS far, row_number() OVER (PARTITION BY rid, part ORDER BY {far}, entry) AS place
  FROM cut JOIN e{i} USING (part)) WHERE place = 1)"""

    moved = ", ".join(floored(f"sum(x[{j}])", "count(*)") for j in range(1, size + 1))
    steps = [f"""cut AS (SELECT rid, part, v[{size} * part + 1:{size} * part + {size}] AS x
  FROM kept, range(0, {parts}) r(part))""",
             f"e0 AS (SELECT part, rid - 1 AS entry, x AS e FROM cut WHERE rid <= {entries})"]
    for i in range(rounds):
        steps += [assign(i), f"""m{i} AS (SELECT part, entry, [{moved}] AS moved FROM a{i} GROUP BY part, entry)""",
                  f"e{i + 1} AS (SELECT part, entry, coalesce(moved, e) AS e FROM e{i} LEFT JOIN m{i} USING (part, entry))"]
    steps.append(assign(rounds))
    return f"WITH kept AS ({integers(256, ', label')}),\n" + ",\n".join(steps) + f""",
rows AS (SELECT rid, string_agg(lower(printf('%02x', CAST(entry AS INTEGER))), '' ORDER BY part) AS code,
         CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
book AS (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: CAST(x AS VARCHAR)), ','), ','
         ORDER BY part, entry)) AS codebooks_sha256 FROM e{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM rows JOIN kept USING (rid), book"""


# Both for tables of distinct ids without vectors too long for exact distances in a long.
ORACLES["op11_centroids"] = clusters_sql()
ORACLES["op12_vector_codes"] = codes_sql()
