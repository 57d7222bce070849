"""Queries of chart patterns over swing points, and of weekly pipes and horns with their SQL."""

from __future__ import annotations

from tickloom.operators import charts
from tickloom.plans.registry import query
from tickloom.sources import bars as B

PIPES_SQL = """, wk AS (
    SELECT symbol, date_trunc('week', date + INTERVAL 2 DAY) AS week, max(high) AS h, min(low) AS l, arg_max(close, t) AS c, max(t) AS t, max(date) AS date,
        round(max(high) - min(low), 6) AS rng
    FROM b GROUP BY 1, 2
), x AS (
    SELECT *, row_number() OVER w AS nth, count(*) OVER (PARTITION BY symbol) AS total, (h + l) / 2 AS middle,
        lag(h) OVER w AS ha, lag(h, 2) OVER w AS hb, lag(l) OVER w AS la, lag(l, 2) OVER w AS lb, lag(rng) OVER w AS ra, lag(rng, 2) OVER w AS rb,
        avg(rng) OVER (PARTITION BY symbol ORDER BY week ROWS BETWEEN 11 PRECEDING AND 2 PRECEDING) AS u,
        min(l) OVER (PARTITION BY symbol ORDER BY week ROWS BETWEEN 6 PRECEDING AND 2 PRECEDING) AS l5,
        max(h) OVER (PARTITION BY symbol ORDER BY week ROWS BETWEEN 6 PRECEDING AND 2 PRECEDING) AS h5,
        min(l) OVER (PARTITION BY symbol ORDER BY week ROWS BETWEEN 7 PRECEDING AND 3 PRECEDING) AS l6,
        max(h) OVER (PARTITION BY symbol ORDER BY week ROWS BETWEEN 7 PRECEDING AND 3 PRECEDING) AS h6
    FROM wk WINDOW w AS (PARTITION BY symbol ORDER BY week)
), y AS (SELECT * REPLACE (round(u, 8) AS u) FROM x WHERE total >= 20 AND nth > 12), ph AS (
    SELECT *, 'Pipe bottom (weekly)' AS pattern, 1 AS dir FROM y
    WHERE round(rng - 1.5 * u, 8) > 0 AND round(ra - 1.5 * u, 8) > 0 AND round(abs(l - la) - 0.25 * ra, 8) <= 0 AND round(greatest(l, la) + 0.3 * u - l5, 8) < 0 AND round(c - middle, 8) > 0
    UNION ALL SELECT *, 'Pipe top (weekly)' AS pattern, -1 AS dir FROM y
    WHERE round(rng - 1.5 * u, 8) > 0 AND round(ra - 1.5 * u, 8) > 0 AND round(abs(h - ha) - 0.25 * ra, 8) <= 0 AND round(least(h, ha) - 0.3 * u - h5, 8) > 0 AND round(c - middle, 8) < 0
    UNION ALL SELECT *, 'Horn bottom (weekly)' AS pattern, 1 AS dir FROM y
    WHERE nth > 13 AND lb < la AND l < la AND round(abs(lb - l) - 0.25 * rb, 8) <= 0 AND round(least(rb, rng) - 1.3 * u, 8) > 0 AND round(c - middle, 8) > 0 AND lb < l6 AND l < l6
    UNION ALL SELECT *, 'Horn top (weekly)' AS pattern, -1 AS dir FROM y
    WHERE nth > 13 AND hb > ha AND h > ha AND round(abs(hb - h) - 0.25 * rb, 8) <= 0 AND round(least(rb, rng) - 1.3 * u, 8) > 0 AND round(c - middle, 8) < 0 AND hb > h6 AND h > h6
) SELECT symbol, date, t, pattern, 'Pipes & horns' AS family, dir, floor(round(c, 9) * 1e6 + 0.5) / 1e6 AS level FROM ph"""
query("pat_pipes_horns", PIPES_SQL)(lambda spark, sf: charts.pipes_and_horns(B.walk(spark, sf)))
