"""SQL for those pN_ queries that SQL can express over whole tables in reasonable time."""

_LATEST = """
WITH newest AS (
  SELECT shard_id, doc_index, bits_per_char,
         row_number() OVER (PARTITION BY shard_id, doc_index
                            ORDER BY measured_at DESC NULLS LAST, loaded_at DESC NULLS LAST, bits_per_char DESC NULLS LAST) AS rn
  FROM doc_scores),
goals AS (
  SELECT shard_id, max(target_fraction) AS target_fraction, max("language") AS "language", max(max_bits_per_char) AS max_bits_per_char
  FROM keep_targets WHERE shard_id IS NOT NULL GROUP BY shard_id),
scored AS (
  SELECT shard_id, doc_index, bits_per_char AS score FROM newest
  WHERE rn = 1 AND bits_per_char IS NOT NULL AND shard_id IN (SELECT shard_id FROM goals)),
spread AS (
  SELECT shard_id, score, count(*) OVER (PARTITION BY shard_id ORDER BY score RANGE UNBOUNDED PRECEDING) AS upto,
         count(*) OVER (PARTITION BY shard_id) AS n FROM scored),
cuts AS (
  SELECT s.shard_id, min(s.score) AS cutoff, min(s.upto) AS kept, max(s.n) AS scored
  FROM spread s JOIN goals g USING (shard_id) WHERE s.upto >= g.target_fraction * s.n GROUP BY s.shard_id)
"""

# Everything a hash reaches over links; its least is the group.
_GROUPS = """
WITH RECURSIVE pairs AS (SELECT left_hash AS a, right_hash AS b FROM neardup_pairs WHERE agree >= 21 AND left_hash <> right_hash),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
groups AS (SELECT least(a, min(b)) AS group_hash, a AS doc_hash FROM reached GROUP BY a)
"""

SQL = {
    "p2_found": _GROUPS + "SELECT group_hash, doc_hash FROM groups",
    "p2_sweep": _GROUPS
    + """SELECT count(*) AS clusters, coalesce(sum(n), 0)::BIGINT AS hashes_in_clusters, coalesce(max(n), 0) AS largest_cluster, coalesce(sum(n - 1), 0)::BIGINT AS dropped_unique_hashes
  FROM (SELECT group_hash, count(*) AS n FROM groups GROUP BY group_hash)""",
    "p4_found": _LATEST + "SELECT s.shard_id, s.doc_index FROM scored s JOIN cuts c USING (shard_id) WHERE s.score > c.cutoff",
    "p4_report": _LATEST
    + """SELECT g.shard_id, g."language", g.target_fraction, g.max_bits_per_char, c.cutoff,
  coalesce(c.scored, 0) AS scored, coalesce(c.kept, 0) AS kept FROM goals g LEFT JOIN cuts c USING (shard_id)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
