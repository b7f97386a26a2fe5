"""SQL of the queries that SQL can express."""

MIXING = r"""
    WITH d AS (SELECT doc_id, source, len([x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''])::BIGINT AS size,
                      ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key FROM documents),
         t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
         r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM t),
         w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(rank % 3 + 1)::INTEGER] AS weight, [-0.5::DOUBLE, 0.0, 0.5][(rank % 3 + 1)::INTEGER] AS slope, source_size * 2.0::DOUBLE AS cap FROM r),
         l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(cap) OVER ahead, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0.0)) AS level
               FROM w WINDOW ahead AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
         g AS (SELECT *, least(cap, weight * max(level) OVER ()) AS target FROM l),
         s AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::INTEGER AS passes FROM g),
         j AS (SELECT d.*, s.source_size, s.slope, s.target, s.passes, s.target - s.passes * s.source_size AS rest, d.size * 64 > s.source_size AS big
               FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
         b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, big ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + size / 2 AS middle,
                      (sum(size) OVER (PARTITION BY source, big))::DOUBLE AS words FROM j),
         k AS (SELECT source AS of_source, sum(size) FILTER (WHERE middle <= rest * words / source_size) AS large_taken FROM b WHERE big GROUP BY 1),
         m AS (SELECT b.*, CASE WHEN big THEN rest * words / source_size ELSE greatest(rest - coalesce(large_taken, 0), 0.0) END AS due
               FROM b LEFT JOIN k ON b.source IS NOT DISTINCT FROM k.of_source),
         u AS (SELECT *, [CASE WHEN passes > 0 THEN coalesce(least(1.0, (0 * source_size + middle / nullif(words, 0) * source_size) / nullif(target, 0)), 0.0) END,
                          CASE WHEN passes > 1 THEN coalesce(least(1.0, (1 * source_size + middle / nullif(words, 0) * source_size) / nullif(target, 0)), 0.0) END,
                          CASE WHEN rest > 0 AND middle <= due THEN coalesce(least(1.0, (passes * source_size + middle / nullif(due, 0) * rest) / nullif(target, 0)), 0.0) END] AS shares FROM m),
         v AS (SELECT *, [least(1.0, 2 * x / ((1.0 - slope) + sqrt((1.0 - slope) * (1.0 - slope) + 4 * slope * x))) for x in shares if x IS NOT NULL] AS times FROM u)
    SELECT doc_id, size, source_size, target, size * len(times) AS taken, round(times[1], 9) AS first_time, round(times[2], 9) AS second_time FROM v"""


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": MIXING}
