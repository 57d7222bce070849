"""Queries of events on swing points and of price figures, with their SQL: walks over bars as recursive tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tickloom.functions.sqltext import S, r, roll
from tickloom.operators import charts, figures, indicators, swings
from tickloom.operators.charts import POINTS, SCALES, TEMPLATES, at, choose
from tickloom.operators.tables import derive_sql
from tickloom.plans.registry import query
from tickloom.sources import bars as B


def swing_sql(values: tuple[str, ...] = ()) -> str:
    """Table `sw` of confirmed swing points (symbol, scale, n, side, i, px, a, values, t, date, close), by a walk over the bars of each scale."""
    columns = indicators.COLUMNS | swings.RANGES
    tables, last = derive_sql("b", columns, ["atr", "atr50", *values], "zb")
    kept = "".join(f", round({v}, 8) AS {v}" for v in values)
    scales = ", ".join(f"('{s}', {k}::DOUBLE)" for s, (k, *_) in SCALES.items())
    step = """
        SELECT symbol, scale, t, CASE WHEN turned AND st = 0 THEN CASE WHEN hi_i > lo_i THEN 1 ELSE -1 END WHEN turned THEN -st ELSE st END,
            CASE WHEN turned AND st = -1 THEN high ELSE hi END, CASE WHEN turned AND st = -1 THEN t ELSE hi_i END, CASE WHEN turned AND st = 1 THEN low ELSE lo END, CASE WHEN turned AND st = 1 THEN t ELSE lo_i END,
            CASE WHEN NOT turned THEN NULL WHEN st = 1 OR (st = 0 AND hi_i <= lo_i) THEN 1 ELSE -1 END,
            CASE WHEN NOT turned THEN NULL WHEN st = 1 OR (st = 0 AND hi_i <= lo_i) THEN hi_i ELSE lo_i END
        FROM (
            SELECT *, coalesce(CASE WHEN st = 0 THEN hi - lo >= need WHEN st = 1 THEN NOT fresh AND hi - low >= need ELSE NOT fresh AND high - lo >= need END, false) AS turned
            FROM (
                SELECT x.symbol, x.scale, x.t, x.high, x.low, x.need, k.st, CASE WHEN k.st >= 0 AND x.high > k.hi THEN x.high ELSE k.hi END AS hi, CASE WHEN k.st >= 0 AND x.high > k.hi THEN x.t ELSE k.hi_i END AS hi_i,
                    CASE WHEN k.st <= 0 AND x.low < k.lo THEN x.low ELSE k.lo END AS lo, CASE WHEN k.st <= 0 AND x.low < k.lo THEN x.t ELSE k.lo_i END AS lo_i,
                    CASE WHEN k.st = 1 THEN x.high > k.hi WHEN k.st = -1 THEN x.low < k.lo ELSE false END AS fresh
                FROM zk k JOIN zx x ON x.symbol = k.symbol AND x.scale = k.scale AND x.t = k.t + 1
            )
        )"""
    return tables + f""",
    zv AS MATERIALIZED (SELECT symbol, date, t, high, low, close, coalesce(atr50, atr) AS a{kept} FROM {last}),
    zx AS MATERIALIZED (SELECT symbol, scale, t, high, low, round(k * a, 6) - 1e-7 AS need FROM zv, (VALUES {scales}) v(scale, k)),
    zk AS (SELECT symbol, scale, t, 0 AS st, high AS hi, t AS hi_i, low AS lo, t AS lo_i, NULL::INT AS side, NULL::BIGINT AS i FROM zx WHERE t = 0 UNION ALL {step}),
    sw AS MATERIALIZED (
        SELECT z.symbol, z.scale, row_number() OVER (PARTITION BY z.symbol, z.scale ORDER BY z.t) - 1 AS n, z.side, z.i, CASE WHEN z.side > 0 THEN p.high ELSE p.low END AS px, p.a{"".join(f", p.{v}" for v in values)}, z.t, c.date, c.close
        FROM zk z JOIN zv p ON p.symbol = z.symbol AND p.t = z.i JOIN zv c ON c.symbol = z.symbol AND c.t = z.t WHERE z.side IS NOT NULL
    )"""


SHOWN = f"SELECT symbol, date, t, pattern, family, dir, {r('level')} AS level, {r('target')} AS target, {r('stop')} AS stop, scale, start FROM ev"
SHORT = "scale IN (" + ", ".join(f"'{s}'" for s in swings.SHORT_SCALES) + ")"
WIDEST = "CASE scale " + " ".join(f"WHEN '{s}' THEN {v[2]}" for s, v in SCALES.items()) + " END"

_o = swings.OSCILLATORS
DIVERGENCES = swing_sql(tuple(_o.values())) + (
    ", dp AS (SELECT *, lag(i) OVER w AS i0, lag(px) OVER w AS px0, " + ", ".join(f"lag({c}) OVER w AS {c}0" for c in _o.values()) + f" FROM sw WHERE {SHORT} WINDOW w AS (PARTITION BY symbol, scale, side ORDER BY n)), "
    "dq AS (" + " UNION ALL ".join(f"SELECT *, '{n}' AS osc, {c} AS x, {c}0 AS x0 FROM dp" for n, c in _o.items()) + "), "
    "ev AS (SELECT symbol, date, t, CASE WHEN (px - px0) * side > 0 THEN '' ELSE 'Hidden ' END || CASE WHEN side < 0 THEN 'bullish' ELSE 'bearish' END || ' divergence (' || osc || ')' AS p0, upper(p0[1]) || p0[2:] AS pattern, "
    f"'Divergence' AS family, -side AS dir, close AS level, NULL::DOUBLE AS target, px AS stop, scale, i0 AS start FROM dq WHERE i - i0 BETWEEN {swings.LEAST_APART} AND {WIDEST} AND (px - px0) * (x - x0) < 0) "
) + SHOWN
query("g20_divergences", DIVERGENCES)(lambda spark, sf: swings.divergences(B.walk(spark, sf)))

LEVELS = swing_sql() + f"""
    , ln AS (SELECT *, row_number() OVER w AS k, lead(t) OVER w AS next FROM sw WHERE {SHORT} WINDOW w AS (PARTITION BY symbol, scale, side ORDER BY n)),
    cl AS (
        SELECT l.symbol, l.scale, l.side, l.n, l.t, l.i, l.next, count(*) AS touches, max(p.px * l.side) * l.side AS line, min(p.i) AS start
        FROM ln l JOIN ln p ON p.symbol = l.symbol AND p.scale = l.scale AND p.side = l.side AND p.k BETWEEN l.k - {swings.LOOK_BACK} AND l.k
        WHERE round(abs(p.px - l.px), 8) <= round({swings.NEAR} * l.a, 8) AND l.i - p.i <= {swings.LOOK_BARS} GROUP BY l.symbol, l.scale, l.side, l.n, l.t, l.i, l.next HAVING count(*) >= {swings.TOUCHES}
    ),
    pr AS (SELECT symbol, date, t, close, lag(close) OVER ({S}) AS before FROM b),
    hit AS (
        SELECT c.*, p.t AS hit_t, p.date FROM cl c JOIN pr p ON p.symbol = c.symbol AND p.t BETWEEN greatest(c.t, 1) AND least(c.i + {swings.LIVES}, coalesce(c.next, 1000000000))
        WHERE (p.close - line) * side > 0 AND NOT (before - line) * side > 0 QUALIFY row_number() OVER (PARTITION BY c.symbol, c.scale, c.side, c.n ORDER BY p.t) = 1
    ),
    ev AS (
        SELECT symbol, date, hit_t AS t, CASE WHEN side > 0 THEN 'Horizontal resistance breakout (3+ touches)' ELSE 'Horizontal support breakdown (3+ touches)' END AS pattern, 'Support / resistance' AS family, side AS dir, line AS level,
            NULL::DOUBLE AS target, NULL::DOUBLE AS stop, scale, start
        FROM hit QUALIFY row_number() OVER (PARTITION BY symbol, scale, side, start ORDER BY n) = 1
    ) """ + SHOWN
query("g21_tested_levels", LEVELS)(lambda spark, sf: swings.tested_levels(B.walk(spark, sf)))

FIBONACCI = swing_sql() + f"""
    , mj AS (SELECT *, lag(i) OVER w AS i0, lag(px) OVER w AS px0 FROM sw WHERE scale = 'major' WINDOW w AS (PARTITION BY symbol ORDER BY n)),
    fp AS (
        SELECT p.*, m.side AS mside, m.px AS mpx, m.i AS mi, m.i0, m.px0, m.px - m.px0 AS swing FROM (SELECT * FROM sw WHERE scale = 'minor') p ASOF JOIN mj m ON m.symbol = p.symbol AND p.t >= m.t
    ),
    ev AS (
        SELECT symbol, date, t, CASE WHEN mside > 0 THEN 'Fibonacci 38-62% pullback bounce (uptrend)' ELSE 'Fibonacci 38-62% rally failure (downtrend)' END AS pattern, 'Fibonacci' AS family, mside AS dir, close AS level,
            mpx AS target, px0 + {swings.STOP} * swing AS stop, scale, i0 AS start
        FROM fp WHERE i0 IS NOT NULL AND i > mi AND side = -mside AND swing * mside > 0 AND round((mpx - px) / swing, 8) BETWEEN {swings.ZONE[0]!r}::DOUBLE AND {swings.ZONE[1]!r}::DOUBLE
        QUALIFY row_number() OVER (PARTITION BY symbol, side, i0 ORDER BY n) = 1
    ) """ + SHOWN
query("g19_fibonacci", FIBONACCI)(lambda spark, sf: swings.fibonacci(B.walk(spark, sf)))
query("n30_swing_points", swing_sql() + f" SELECT symbol, scale, n, side, i, {r('px')} AS px, t, date FROM sw")(lambda spark, sf: swings.swing_points(B.walk(spark, sf)).select("symbol", "scale", "n", "side", "i", F.round("px", 6).alias("px"), "t", "date"))

BOXES = f""", bx AS MATERIALIZED (SELECT symbol, date, t, floor(round(ln(high) / ln(1 + {figures.BOX} / 100), 9))::BIGINT AS up, ceil(round(ln(low) / ln(1 + {figures.BOX} / 100), 9))::BIGINT AS dn FROM b),
    bk AS (
        SELECT symbol, date, t, 0 AS k, 1 AS side, t AS first, up AS reach, true AS fresh FROM bx WHERE t = 0
        UNION ALL
        SELECT symbol, date, t, k + turns::INT, CASE WHEN turns THEN -side ELSE side END, CASE WHEN turns THEN t ELSE first END, CASE WHEN turns THEN -back ELSE greatest(reach, ahead) END, turns OR ahead > reach
        FROM (SELECT *, ahead <= reach AND reach - back >= {figures.REVERSAL} AS turns FROM (SELECT x.symbol, x.date, x.t, k.k, k.side, k.first, k.reach, CASE WHEN k.side > 0 THEN up ELSE -dn END AS ahead, CASE WHEN k.side > 0 THEN dn ELSE -up END AS back FROM bk k JOIN bx x ON x.symbol = k.symbol AND x.t = k.t + 1))
    ),
    bc AS (SELECT symbol, k, side, first, max(reach) AS reach FROM bk GROUP BY ALL),
    bl AS (SELECT *, lag(reach, 1) OVER w AS r1, lag(reach, 2) OVER w AS r2, lag(reach, 3) OVER w AS r3, lag(reach, 4) OVER w AS r4, lag(first, 4) OVER w AS start FROM bc WINDOW w AS (PARTITION BY symbol ORDER BY k)),
    ev AS (
        SELECT c.symbol, x.date, x.t, CASE WHEN r2 = r4 THEN CASE WHEN c.side > 0 THEN 'P&F triple-top buy' ELSE 'P&F triple-bottom sell' END
            WHEN r2 > r4 AND r1 < r3 THEN CASE WHEN c.side > 0 THEN 'P&F bullish ascending breakout' ELSE 'P&F bearish descending breakdown' END ELSE CASE WHEN c.side > 0 THEN 'P&F double-top buy' ELSE 'P&F double-bottom sell' END END AS pattern,
            'Point & figure' AS family, c.side AS dir, pow(1 + {figures.BOX} / 100, c.side * r2) AS level, NULL::DOUBLE AS target, pow(1 + {figures.BOX} / 100, c.side * (1 - r1)) AS stop, 'bar' AS scale, start
        FROM bl c JOIN bk x ON x.symbol = c.symbol AND x.k = c.k AND x.fresh AND x.reach > r2 WHERE r4 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c.symbol, c.k ORDER BY x.t) = 1
    ) """ + SHOWN
query("n28_point_figure", BOXES)(lambda spark, sf: figures.point_figure(B.walk(spark, sf)))

_hw = f"({S} ROWS BETWEEN {figures.HIGH_BARS - 1} PRECEDING AND CURRENT ROW)"
DARVAS = f""", dx AS MATERIALIZED (SELECT symbol, date, t, high, low, close, high >= max(high) OVER {_hw} AND count(high) OVER {_hw} >= {figures.LEAST_HIGH} AS opens FROM b),
    dk AS (
        SELECT symbol, t, 0 AS stage, NULL::DOUBLE AS top, NULL::BIGINT AS first, NULL::DOUBLE AS bottom, NULL::BIGINT AS low_t, 0 AS broke, NULL::DOUBLE AS was_top, NULL::DOUBLE AS was_bottom, NULL::BIGINT AS was_first FROM dx WHERE t = 2
        UNION ALL
        SELECT symbol, t, CASE WHEN opened THEN 1 WHEN side < 0 THEN 0 WHEN stage = 1 AND t - first >= {figures.STANDS} THEN 2 WHEN stage = 2 AND t - (CASE WHEN low < bottom THEN t ELSE low_t END) >= {figures.STANDS} THEN 3 ELSE stage END,
            CASE WHEN opened THEN high ELSE top END, CASE WHEN opened THEN t ELSE first END,
            CASE WHEN opened THEN NULL WHEN stage IN (1, 2) THEN least(low, bottom) ELSE bottom END, CASE WHEN opened THEN NULL WHEN stage IN (1, 2) AND (bottom IS NULL OR low < bottom) THEN t ELSE low_t END,
            side, top, bottom, first
        FROM (
            SELECT *, (stage = 0 AND opens) OR (stage IN (1, 2) AND high > top) OR side > 0 AS opened
            FROM (SELECT x.*, k.stage, k.top, k.first, k.bottom, k.low_t, CASE WHEN k.stage = 3 AND x.close > k.top THEN 1 WHEN k.stage = 3 AND x.close < k.bottom THEN -1 ELSE 0 END AS side FROM dk k JOIN dx x ON x.symbol = k.symbol AND x.t = k.t + 1)
        )
    ),
    ev AS (
        SELECT k.symbol, x.date, k.t, CASE WHEN broke > 0 THEN 'Darvas box breakout' ELSE 'Darvas box breakdown' END AS pattern, 'Darvas box' AS family, broke AS dir, CASE WHEN broke > 0 THEN was_top ELSE was_bottom END AS level,
            CASE WHEN broke > 0 THEN was_top + (was_top - was_bottom) ELSE was_bottom - (was_top - was_bottom) END AS target, CASE WHEN broke > 0 THEN was_bottom ELSE was_top END AS stop, 'bar' AS scale, was_first AS start
        FROM dk k JOIN dx x ON x.symbol = k.symbol AND x.t = k.t WHERE broke <> 0 QUALIFY row_number() OVER (PARTITION BY k.symbol, broke, was_first ORDER BY k.t) = 1
    ) """ + SHOWN
query("n29_darvas", DARVAS)(lambda spark, sf: figures.darvas(B.walk(spark, sf)))

_atr, _al = derive_sql("b", swings.RANGES, ["atr"], "fa")
FLAGS = _atr + f""", fl AS (
        SELECT symbol, date, t, side, close * side AS c, list(CASE WHEN side > 0 THEN high ELSE -low END) OVER w AS hs, list(CASE WHEN side > 0 THEN low ELSE -high END) OVER w AS ls, list(close * side) OVER w AS cs, list(atr) OVER w AS ats
        FROM {_al}, (VALUES (1), (-1)) v(side) WINDOW w AS (PARTITION BY symbol, side ORDER BY t ROWS BETWEEN 31 PRECEDING AND CURRENT ROW)
    ),
    fc AS (SELECT * FROM fl WHERE t >= 60 AND c > list_max(hs[-4:-2]) AND cs[-2] <= list_max(hs[-4:-2])),
    fq AS (
        SELECT *, hs[-1 - f] AS peak, ls[-1 - f - p] AS base, list_max(hs[-1 - f : -2]) AS top, list_min(ls[-1 - f : -2]) AS bottom, round(peak - base, 9) AS height, ats[-1 - f] AS a,
            list_sum(list_transform(range(f - 1), lambda j: (j - (f - 2) / 2.0) * hs[1 - f + j - 1])) AS bh, list_sum(list_transform(range(f - 1), lambda j: (j - (f - 2) / 2.0) * ls[1 - f + j - 1])) AS bl
        FROM fc, (SELECT unnest(range({figures.FLAGS.start}, {figures.FLAGS.stop})) AS f), (VALUES {", ".join(f"({p})" for p in figures.POLES)}) poles(p)
    ),
    fb AS (
        SELECT * FROM fq WHERE t - f - p >= 1 AND round(height - {figures.POLE_RANGES} * a, 8) >= 0 AND peak >= list_max(hs[-1 - f - p : -1 - f]) - 1e-9 AND round(top - peak - {figures.TOPS} * a, 8) <= 0
            AND round(top - bottom - {figures.GIVES} * height, 8) <= 0 AND c > top AND cs[-2] <= top QUALIFY row_number() OVER (PARTITION BY symbol, side, t ORDER BY f, p) = 1
    ),
    fh AS (
        SELECT symbol, date, t, f, min(close) OVER (PARTITION BY symbol, f ORDER BY t ROWS BETWEEN {figures.RISE_BARS} + f PRECEDING AND f PRECEDING) AS base, lag(close, f) OVER w AS peak, close, lag(close) OVER w AS before,
            max(high) OVER (PARTITION BY symbol, f ORDER BY t ROWS BETWEEN f + 5 PRECEDING AND 1 PRECEDING) AS top, min(low) OVER (PARTITION BY symbol, f ORDER BY t ROWS BETWEEN f PRECEDING AND 1 PRECEDING) AS bottom
        FROM b, (VALUES {", ".join(f"({f})" for f in figures.TIGHT_FLAGS)}) v(f) WINDOW w AS (PARTITION BY symbol, f ORDER BY t)
    ),
    fg AS (
        SELECT 2 - (side > 0)::INT - 1 AS rank, symbol, date, t, CASE WHEN side > 0 AND base <> 0 AND round(height / abs(base) - {figures.TIGHT_GAIN}, 9) >= 0 THEN 'High tight flag' ELSE CASE WHEN side > 0 THEN 'Bull ' ELSE 'Bear ' END || CASE WHEN f >= 4 AND round(bh, 9) < 0 AND round(bl, 9) > 0 THEN 'pennant' ELSE 'flag' END END AS pattern,
            side AS dir, side * top AS level, side * (top + height) AS target, side * bottom AS stop, t - f - p AS start FROM fb
        UNION ALL
        SELECT * FROM (SELECT 2, symbol, date, t, 'High tight flag', 1, top, top * {figures.TIGHT_TARGET}, bottom, t - f - {figures.RISE_BARS} FROM fh
            WHERE t >= 80 AND base > 0 AND round(peak - {figures.RISE} * base, 8) >= 0 AND round(bottom - {figures.LEFT} * top, 8) >= 0 AND close > top AND before <= top QUALIFY row_number() OVER (PARTITION BY symbol, t ORDER BY f) = 1)
    ),
    ev AS (SELECT *, 'Flag / pennant' AS family, 'bar' AS scale FROM fg QUALIFY row_number() OVER (PARTITION BY symbol, pattern, start ORDER BY rank, t) = 1) """ + SHOWN
query("pat_flags", FLAGS)(lambda spark, sf: figures.flags(B.walk(spark, sf)))


def duck(text: str) -> str:
    """A template's text in DuckDB's dialect: casts to whole numbers cut, and div is //."""
    return re.sub(r"CAST\((.*?) AS long\) ", r"trunc(\1)::BIGINT ", text + " ").strip().replace(" div ", " // ")


def charts_sql() -> str:
    """Table `ev` of chart patterns: stretches of bars from the walk `zk`, the templates' conditions, what they count, and crossings."""
    lags = ", ".join(f"lag({x}, {j}) OVER w AS {x}_{j}" for x in ("i", "px", "a", "atr") for j in range(1, POINTS))
    name = {"i": "i", "px": "p", "a": "a", "atr": "b"}
    signed = lambda x, v: f"-side * {v}" if x == "px" else v
    known = ", ".join(f"{signed(x, x if j == 0 else f'{x}_{j}')} AS {name[x]}{j}" for x in name for j in range(POINTS))
    older = lambda x, j: f"x_{x}" if j == 0 else x if j == 1 else f"{x}_{j - 1}"
    running = ", ".join(f"{signed(x, older(x, j))} AS {name[x]}{j}" for x in name for j in range(POINTS))
    limits = ", ".join("CASE scale " + " ".join(f"WHEN '{s}' THEN {v[j]}" for s, v in SCALES.items()) + f" END AS {n}" for j, n in enumerate(("k", "least_width", "most_width", "wider")))
    sql = swing_sql(("atr",)) + f""",
    cn AS (SELECT *, lead(t) OVER w AS next, {lags} FROM sw WINDOW w AS (PARTITION BY symbol, scale ORDER BY n)),
    en AS (SELECT symbol, max(t) AS e FROM b GROUP BY 1),
    mv AS (SELECT symbol, t, coalesce(close > m50 AND m50 > m150 AND m150 > m200, false) AS stacked FROM (SELECT *, {", ".join(f"round({roll('mean', 'close', n)}, 8) AS m{n}" for n in (50, 150, 200))} FROM b)),
    ex AS (SELECT symbol, scale, t + 1 AS t, st, CASE WHEN st = 1 THEN hi_i ELSE lo_i END AS x FROM zk WHERE st <> 0),
    tb AS (
        SELECT c.symbol, c.scale, c.n, x, any_value(st) AS st, min(ex.t) AS first, max(ex.t) AS last FROM cn c JOIN en USING (symbol) JOIN ex ON ex.symbol = c.symbol AND ex.scale = c.scale AND ex.t > c.t AND ex.t <= least(coalesce(next, e), e) AND x > c.i
        GROUP BY c.symbol, c.scale, c.n, x
    ),
    t0 AS (
        SELECT symbol, scale, n AS pt, side, t AS first, coalesce(next - 1, e) AS last, false AS running, {known} FROM cn JOIN en USING (symbol)
        UNION ALL
        SELECT symbol, scale, pt, side, first, last, true AS running, {running}
        FROM (SELECT c.* EXCLUDE (side, n, t), c.n AS pt, tb.st AS side, tb.first, tb.last, tb.x AS x_i, CASE WHEN tb.st > 0 THEN z.high ELSE z.low END AS x_px, z.a AS x_a, z.atr AS x_atr
            FROM tb JOIN cn c ON c.symbol = tb.symbol AND c.scale = tb.scale AND c.n = tb.n JOIN zv z ON z.symbol = tb.symbol AND z.t = tb.x)
    ),
    t1 AS (SELECT t0.*, -side AS up, stacked, {limits} FROM t0 JOIN mv ON mv.symbol = t0.symbol AND mv.t = t0.i0)"""
    last = "t1"
    for j, level in enumerate(zip(*(charts.line_columns(n) for n in (6, 5, 4)), strict=True)):
        sql += f", t{j + 2} AS MATERIALIZED (SELECT *, " + ", ".join(f"{duck(v)} AS {k}" for part in level for k, v in part.items()) + f" FROM {last})"
        last = f"t{j + 2}"
    parts = []
    for n, x in enumerate(TEMPLATES):
        cond = re.sub(r"\bh\b", f"({x.height})", x.when)
        end = f"least(last, i0 + greatest(15, i0 - {x.start})" + (f", {x.expires})" if x.expires else ")")
        parts.append(f"SELECT *, {n} AS template, {x.way} AS way, ({duck(x.start)})::BIGINT AS start, ({duck(end)})::BIGINT AS until, ({duck(x.height)})::DOUBLE AS h, {x.pick if x.pick is not None else 'NULL'}::INT AS rank FROM {last} WHERE p{x.points - 1} IS NOT NULL AND ({x.height}) IS NOT NULL AND {duck(cond)}")
    bound = lambda j: duck(choose(x.counted and f"({x.counted[j]})" for x in TEMPLATES))
    shown = lambda f: choose(getattr(x, f) if x.named else f"'{getattr(x, f)}'" for x in TEMPLATES)
    sql += ", ca AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM (" + " UNION ALL ".join(parts) + ")), "
    sql += f"cb AS (SELECT *, greatest(0, {bound(0)}) AS from_, {bound(1)} AS to_ FROM ca), "
    sql += f"cs AS (SELECT id, sum({duck(choose(x.counted and x.counted[2] for x in TEMPLATES))}) AS n, count(*) AS m FROM (SELECT cb.*, b.t, up * b.close AS c, CASE WHEN up > 0 THEN b.low ELSE -b.high END AS l FROM cb JOIN b ON b.symbol = cb.symbol AND b.t BETWEEN from_ AND to_) GROUP BY id), "
    sql += f"cc AS (SELECT ca.*, n, m FROM ca LEFT JOIN cs USING (id) WHERE {duck(choose((x.share if x.counted else 'true' for x in TEMPLATES), 'true'))}), "
    sql += "cd AS (SELECT * FROM cc QUALIFY rank IS NULL OR rank = min(rank) OVER (PARTITION BY symbol, scale, pt, running, first)), "
    sql += f"pr AS (SELECT symbol, date, t, close, lag(close) OVER ({S}) AS before FROM b), "
    line, was = (duck(choose(at(x.line, v) for x in TEMPLATES)) for v in ("t", "(t - 1)"))
    sql += f"cr AS (SELECT *, {line} AS _line, {was} AS _was FROM (SELECT cd.*, pr.date, pr.t, pr.close, pr.before FROM cd JOIN pr ON pr.symbol = cd.symbol AND pr.t BETWEEN greatest(first, 1) AND until)), "
    sql += "cx AS (SELECT * FROM cr WHERE way * up * close > way * _line AND NOT way * up * before > way * _was QUALIFY row_number() OVER (PARTITION BY id ORDER BY t) = 1), "
    sql += f"cy AS (SELECT *, CASE WHEN up > 0 THEN {shown('bull')} ELSE {shown('bear')} END AS pattern, {shown('family')} AS family, {duck(choose(x.variant for x in TEMPLATES))} AS variant, {duck(choose(x.target or f'_line + way * ({x.height})' for x in TEMPLATES))} AS aim, {duck(choose(x.stop for x in TEMPLATES))} AS out_ FROM cx), "
    return sql + "ev AS (SELECT symbol, date, t, pattern, family, up * way AS dir, up * _line AS level, up * aim AS target, up * out_ AS stop, scale, start, variant FROM cy QUALIFY row_number() OVER (PARTITION BY symbol, scale, pattern, start ORDER BY pt, running, first, template) = 1) "


CHARTS = charts_sql()
_tie = lambda x: f"floor(round({x}, 9) * 1e6 + 0.5001) / 1e6 AS {x}"
query("g_chart_patterns", CHARTS + f"SELECT symbol, date, t, pattern, family, dir, {_tie('level')}, {_tie('target')}, {_tie('stop')}, scale, start, variant FROM ev")(lambda spark, sf: charts.chart_patterns(B.walk(spark, sf)))
