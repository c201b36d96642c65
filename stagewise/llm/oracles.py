"""DuckDB text of the queries that SQL can express."""

from __future__ import annotations

import math

from .quality_rules import CUTOFFS, SYMBOLS, WINDOW

_WORD = r"[^\x20\x09-\x0D]+"
_ALPHA, _DELTA = 0.005, 0.05


def op4_sql(alpha: float = _ALPHA, delta: float = _DELTA) -> str:
    """Counts by unnesting windows; binomial tails as sums of terms."""
    grid = [(rule, c) for rule, cs in CUTOFFS.items() for c in cs]
    rows = ", ".join(f"('{rule}', {c!r}::DOUBLE)" for rule, c in grid)
    share = " ".join(f"WHEN '{rule}' THEN {rule}" for rule in CUTOFFS)
    log_a, log_b = math.log(alpha), math.log(1 - alpha)
    return f"""
WITH base AS (
  SELECT doc_id, lang AS stratum, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i:i + {WINDOW - 1}] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM base) t),
places AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1) r, range(0, {WINDOW}) t(k)
  GROUP BY doc_id),
counted AS (
  SELECT doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(places.n, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines, len(list_distinct(words)) AS n_distinct_words
  FROM base LEFT JOIN places USING (doc_id)),
shares AS (
  SELECT *, n_symbols / greatest(word_chars, 1) AS symbol_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
         n_repeat_words / greatest(n_words, 1) AS repeat_share,
         1 - n_distinct_words / greatest(n_words, 1) AS same_word_share
  FROM counted),
grid(rule, cutoff) AS (VALUES {rows}),
good AS (SELECT doc_id FROM labels WHERE quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = 1),
tallies AS (
  SELECT stratum, rule, cutoff, count(*) AS n,
         sum(CASE WHEN CASE rule {share} END > cutoff THEN 1 ELSE 0 END) AS k
  FROM shares SEMI JOIN good USING (doc_id) CROSS JOIN grid GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN k >= n * {alpha} THEN 1.0 ELSE list_sum(list_transform(range(0, CAST(k + 1 AS BIGINT)), lambda i:
           exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * {log_a!r} + (n - i) * {log_b!r}))) END AS tail
  FROM tallies),
cuts AS (
  SELECT stratum, rule, min(cutoff) AS cutoff FROM tails
  WHERE tail <= {delta} / (SELECT count(*) FROM tails) GROUP BY stratum, rule),
failed AS (
  SELECT DISTINCT doc_id FROM shares JOIN cuts ON cuts.stratum IS NOT DISTINCT FROM shares.stratum
  WHERE CASE rule {share} END > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
FROM shares"""


def near_sql(words: int, more: str = "") -> str:
    """Near duplicates on shingles of ``words`` words: all pairs that share a
    shingle, then the closure of their links."""
    return f"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, w[i:i + {words - 1}] AS s
  FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) >= {words} THEN range(1, len(w) - {words - 2})
                                      WHEN len(w) > 0 THEN [1] ELSE [] END) AS i
        FROM base) t),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b)
SELECT base.doc_id, CAST(coalesce(any_value(sizes.n), 0) AS BIGINT) AS n_shingles,
       least(base.doc_id, coalesce(min(reach.b), base.doc_id)) AS component_id{more}
FROM base LEFT JOIN sizes ON sizes.doc_id = base.doc_id LEFT JOIN reach ON reach.a = base.doc_id GROUP BY base.doc_id"""


_FINITE = "embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)"


def op12_sql() -> str:
    """All scores of the anchors, ranked twice."""
    return f"""
WITH base AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND {_FINITE}),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM base a JOIN base b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, s.other_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER best <= 3"""


def op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The rounds as a chain of tables: squared distances to every entry, the
    least one per part, floored means."""
    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (
  SELECT id, part, min(struct_pack(d := d, e := entry)) AS best
  FROM (SELECT p.id, p.part, c.entry, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM pieces p JOIN c{k} c ON c.part = p.part) t
  GROUP BY id, part)"""
    def improved(k: int) -> str:
        return f"""
c{k + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.v, c.v) AS v
  FROM c{k} c LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v
    FROM (SELECT a.part, a.best.e AS entry, place, sum(p.v[place]) AS s, count(*) AS n
          FROM a{k} a JOIN pieces p ON p.id = a.id AND p.part = a.part, range(1, len(p.v) + 1) t(place)
          GROUP BY ALL) u
    GROUP BY part, entry) m ON m.part = c.part AND m.entry = c.entry)"""
    steps = ",".join(assigned(k) + "," + improved(k) for k in range(rounds))
    return f"""
WITH base AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE {_FINITE}),
pieces AS MATERIALIZED (
  SELECT id, part, q[part * (len(q) // {parts}) + 1:(part + 1) * (len(q) // {parts})] AS v FROM base, range(0, {parts}) t(part)),
c0 AS MATERIALIZED (SELECT part, id - 1 AS entry, v FROM pieces WHERE id <= {entries}),{steps},{assigned(rounds)},
codes AS (
  SELECT id, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY id),
book AS (
  SELECT sha256(string_agg(CAST(v[place] AS VARCHAR), ',' ORDER BY part, entry, place)) AS digest
  FROM c{rounds}, range(1, len(v) + 1) t(place))
SELECT b.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY b.label) AS BIGINT) AS label_error,
       book.digest AS codebooks_sha256
FROM base b JOIN codes c USING (id), book"""


ORACLES = {
    "op4_risk_controlled_rules": op4_sql(), "op8_ngram_jaccard_join": near_sql(5),
    "op11_minhash_near_dedup": near_sql(4, ", base.doc_id = least(base.doc_id, coalesce(min(reach.b), base.doc_id)) AS kept"),
    "op12_residue_hard_negatives": op12_sql(), "op13_walsh_vector_codes": op13_sql()}
