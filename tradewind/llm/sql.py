"""DuckDB statements for the queries that SQL can express at the size of the whole tables."""

from __future__ import annotations

from tradewind.llm.queries import MIX_EPOCHS, MIX_EXPONENT, MIX_SEED, URL_RULES

SQL: dict[str, str] = {}

_RULES = ", ".join(f"('{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}', '{verdict}')" for rule, verdict in URL_RULES)

SQL["op1_url_rules"] = rf"""
WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {_RULES}),
split AS (
  SELECT page_id,
         lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')) AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
),
fits AS (
  SELECT s.page_id, s.host, s.path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS place
  FROM split s LEFT JOIN rules r
    ON (s.host = r.rule_host OR s.host LIKE '%.' || r.rule_host) AND starts_with(s.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

SQL["op10_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
),
told AS (
  SELECT doc_id, body,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY n_points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM told
"""

SQL["op7_source_mix"] = f"""
WITH sizes AS (
  SELECT source, CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS DOUBLE) AS size FROM documents GROUP BY source
),
rates AS (
  SELECT source, {MIX_EPOCHS} * sum(size) OVER () * (power(size, {MIX_EXPONENT}) / sum(power(size, {MIX_EXPONENT})) OVER ()) / size AS rate
  FROM sizes
),
cdfs AS (
  SELECT source, list(p ORDER BY k) AS cdf FROM (
    SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
    FROM rates, range(0, 200) AS r(k)) GROUP BY source
),
draws AS (
  SELECT d.*, cdf, CAST(('0x' || substr(md5('{MIX_SEED}:' || doc_id), 1, 13)) AS BIGINT) / power(2, 52) AS u
  FROM documents d JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source
),
copies AS (
  SELECT doc_id, text, lang, source, n_chars, unnest(range(1, len(list_filter(cdf, lambda c: c <= u)) + 1)) AS copy_no FROM draws
)
SELECT *, md5('{MIX_SEED} order:' || doc_id || ':' || copy_no) AS mix_key FROM copies
"""

SQL["op12_near_vectors"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
reach AS (
  SELECT vec_id, vec_id AS seen FROM embeddings
  UNION
  SELECT r.vec_id, l.w FROM reach r JOIN links l ON r.seen = l.u
),
lowest AS (SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM lowest LEFT JOIN counts ON vec_id = u
"""

# The CRC-32 of an id's digits, byte by byte and bit by bit: DuckDB has no function for it.
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({value} AS VARCHAR))) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, bottom: str) -> str:
    """All nodes of the trees over ``bottom`` (tree, i, digest), from level 0 up to the root."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, i, digest FROM {bottom}
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, i // 8
)"""


SQL["op13_manifest"] = f"""
WITH RECURSIVE bottom AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
         {_leaf("text")} AS digest, {_leaf("seen")} AS checked
  FROM (SELECT *, CASE WHEN {_CRC} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                       ELSE text END AS seen FROM documents)
),
{_levels("low", "bottom")},
height AS (SELECT tree, max(level) AS h, arg_max(digest, level) AS subroot FROM low GROUP BY tree),
heads AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, subroot AS digest, tree AS of FROM height),
{_levels("high", "heads")},
root AS (SELECT arg_max(digest, level) AS root FROM high),
steps AS (
  SELECT d.doc_id, n.level AS step, n.i, n.digest, n.i = CAST(floor(d.i / power(8, n.level)) AS BIGINT) AS own
  FROM bottom d JOIN height USING (tree) JOIN low n
    ON n.tree = d.tree AND n.level < h AND n.i // 8 = CAST(floor(d.i / power(8, n.level + 1)) AS BIGINT)
  UNION ALL
  SELECT d.doc_id, h + n.level, n.i, n.digest, n.i = CAST(floor(t.i / power(8, n.level)) AS BIGINT)
  FROM bottom d JOIN height USING (tree) JOIN heads t ON t.of = d.tree JOIN high n
    ON n.level < (SELECT max(level) FROM high) AND n.i // 8 = CAST(floor(t.i / power(8, n.level + 1)) AS BIGINT)
),
proofs AS (SELECT doc_id, sha256(string_agg(digest, '' ORDER BY step, i)) AS proof FROM steps WHERE NOT own GROUP BY doc_id),
fold AS (
  SELECT doc_id, 0 AS step, checked AS digest FROM bottom
  UNION ALL
  SELECT doc_id, step + 1, sha256(string_agg(part, '' ORDER BY i)) FROM (
    SELECT f.doc_id, f.step, s.i, CASE WHEN s.own THEN f.digest ELSE s.digest END AS part
    FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.step = f.step)
  GROUP BY doc_id, step
),
folded AS (SELECT doc_id, arg_max(digest, step) AS folded_root FROM fold GROUP BY doc_id)
SELECT d.doc_id, d.digest AS leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM bottom d JOIN height USING (tree) CROSS JOIN root JOIN folded f ON f.doc_id = d.doc_id LEFT JOIN proofs p ON p.doc_id = d.doc_id
"""
