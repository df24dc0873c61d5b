"""SQL that grows the same trees as ``models.boosting`` and ``models.extra_trees``, for the oracles.

A recursive query holds one row for each training row and step: its node, its
whole-numbered gradient and hessian, and its margin. A step splits the nodes
of a level (or the best leaf), or closes a tree and adds its values to the
margins. Nothing is taken from the fitted models.
"""

from __future__ import annotations

from weakspot.models.boosting import MOST_BINS, Growth
from weakspot.models.extra_trees import MULTIPLIERS, PRIME

UNIT = "1073741824.0::DOUBLE"


def bins_sql(rows: str, train: str) -> list[str]:
    """``bins`` (row_id, feature, bin, x) of all ``rows`` (row_id, v), with
    quantile edges of the ``train`` rows."""
    return [
        f"""sorted AS (SELECT pos, list(v[pos] ORDER BY v[pos]) AS s FROM (SELECT v, unnest(range(1, len(v) + 1)) AS pos FROM {train}) GROUP BY pos)""",
        f"""edges AS MATERIALIZED (SELECT pos - 1 AS feature, list_sort(list_distinct(list_filter(
    list_transform(range(1, {MOST_BINS}), lambda i: s[ceil(len(s) * i / {MOST_BINS})::BIGINT]), lambda q: q < s[len(s)]))) AS edge FROM sorted)""",
        f"""bins AS MATERIALIZED (SELECT row_id, feature, len(list_filter(edge, lambda e: e < x)) AS bin
    FROM (SELECT row_id, unnest(range(len(v))) AS feature, unnest(v) AS x FROM {rows}) JOIN edges USING (feature))""",
    ]


def _gradients(margin: str) -> str:
    p = f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({margin}))))"
    return f"round(({p} - y) * w * {UNIT})::BIGINT AS g, round({p} * (1.0::DOUBLE - {p}) * w * {UNIT})::BIGINT AS h"


def _best(how: Growth, source: str) -> str:
    """CTEs ``hist``, ``cum``, ``best`` (node, gain, feature, bin) of the nodes of ``source``."""
    return f"""hist AS (SELECT node, b.feature, b.bin, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) FILTER (w > 0) AS n FROM {source} JOIN bins b USING (row_id) GROUP BY ALL),
    cum AS (SELECT node, feature, bin, nl, nt - nl AS nr, gl / {UNIT} AS gl, hl / {UNIT} AS hl, (gt - gl) / {UNIT} AS gr, (ht - hl) / {UNIT} AS hr,
        gt / {UNIT} AS gt, ht / {UNIT} AS ht FROM (SELECT node, feature, bin, (sum(g) OVER up)::DOUBLE AS gl, (sum(h) OVER up)::DOUBLE AS hl, (sum(n) OVER up)::BIGINT AS nl,
          (sum(g) OVER whole)::DOUBLE AS gt, (sum(h) OVER whole)::DOUBLE AS ht, (sum(n) OVER whole)::BIGINT AS nt
        FROM hist WINDOW up AS (PARTITION BY node, feature ORDER BY bin), whole AS (PARTITION BY node, feature))),
    gains AS (SELECT node, feature, bin, gl * gl / (hl + {how.l2}::DOUBLE) + gr * gr / (hr + {how.l2}::DOUBLE) - gt * gt / (ht + {how.l2}::DOUBLE) AS gain
        FROM cum WHERE nl > 0 AND nr > 0 AND nl >= {how.least_rows} AND nr >= {how.least_rows} AND hl >= {how.least_hessian}::DOUBLE AND hr >= {how.least_hessian}::DOUBLE),
    best AS (SELECT node, gain, feature, bin FROM gains WHERE gain > {how.least_gain}::DOUBLE
        QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin) = 1)"""


def _value(how: Growth) -> str:
    below = f"sum(h) / {UNIT} + {how.l2}::DOUBLE"
    return f"{how.rate}::DOUBLE * (-(sum(g) / {UNIT}) / ({below}))"


def _start(how: Growth, rows: str) -> str:
    return f"(SELECT ln(sum(w) FILTER (y = 1) / sum(w) FILTER (y = 0)) FROM {rows})" if how.prior else "0.0::DOUBLE"


def trees_sql(how: Growth, rows: str) -> list[str]:
    """CTEs up to ``nodes`` (tree, node, feature, bin, edge, gain, gradient,
    hessian, rows, value) of all trees fitted to ``rows`` (row_id, y, w), and
    ``margins`` (row_id, margin) of all of them; needs ``bins``. Rows of
    weight 0 are sent through the trees and take no part in growing them."""
    if how.leaves:
        steps = f"""steps AS (SELECT 0 AS tree, 0 AS step, row_id, y, w, m, 1::BIGINT AS node, NULL::DOUBLE AS gain, 0::BIGINT AS feature, 0::BIGINT AS bin, false AS known,
      NULL::BIGINT AS split, NULL::DOUBLE AS split_gain, {_gradients('m')} FROM (SELECT *, {_start(how, rows)} AS m FROM {rows})
    UNION ALL (WITH fresh AS (SELECT * FROM steps WHERE NOT known AND tree < {how.rounds}), {_best(how, 'fresh')},
    told AS (SELECT s.tree, s.step, s.row_id, s.y, s.w, s.m, s.node, CASE WHEN s.known THEN s.gain ELSE best.gain END AS gain,
      CASE WHEN s.known THEN s.feature ELSE best.feature END AS feature, CASE WHEN s.known THEN s.bin ELSE best.bin END AS bin, s.g, s.h FROM steps s LEFT JOIN best ON best.node = s.node),
    chosen AS (SELECT node, gain FROM told WHERE gain IS NOT NULL AND step < {how.leaves - 1} AND tree < {how.rounds} ORDER BY gain DESC, node LIMIT 1),
    leaf AS (SELECT node, {_value(how)} AS value FROM told GROUP BY node),
    goes AS (SELECT count(*) AS n, max(node) AS node, max(gain) AS gain FROM chosen)
    SELECT t.tree, t.step + 1, t.row_id, t.y, t.w, t.m, CASE WHEN t.node = goes.node THEN 2 * t.node + (b.bin > t.bin)::INT ELSE t.node END,
      CASE WHEN t.node = goes.node THEN NULL ELSE t.gain END, t.feature, t.bin, t.node <> goes.node, goes.node, goes.gain, t.g, t.h
    FROM told t JOIN goes ON goes.n = 1 LEFT JOIN bins b ON b.row_id = t.row_id AND b.feature = t.feature
    UNION ALL SELECT tree + 1, 0, row_id, y, w, m, 1, NULL, 0, 0, false, NULL, NULL, {_gradients('m')}
    FROM (SELECT t.tree, t.row_id, t.y, t.w, t.m + leaf.value AS m FROM told t JOIN leaf USING (node) JOIN goes ON goes.n = 0) WHERE tree < {how.rounds}))"""
    else:
        steps = f"""steps AS (SELECT 0 AS tree, 0 AS step, row_id, y, w, m, 1::BIGINT AS node, true AS open, NULL::DOUBLE AS gain, 0::BIGINT AS feature, 0::BIGINT AS bin,
      {_gradients('m')} FROM (SELECT *, {_start(how, rows)} AS m FROM {rows})
    UNION ALL (WITH live AS (SELECT * FROM steps WHERE open AND step < {how.depth} AND tree < {how.rounds}), {_best(how, 'live')},
    leaf AS (SELECT node, {_value(how)} AS value FROM steps GROUP BY node),
    goes AS (SELECT count(*) AS n FROM best)
    SELECT s.tree, s.step + 1, s.row_id, s.y, s.w, s.m, CASE WHEN best.node IS NOT NULL THEN 2 * s.node + (b.bin > best.bin)::INT ELSE s.node END,
      best.node IS NOT NULL, best.gain, best.feature, best.bin, s.g, s.h
    FROM steps s JOIN goes ON goes.n > 0 LEFT JOIN best ON best.node = s.node AND s.open LEFT JOIN bins b ON b.row_id = s.row_id AND b.feature = best.feature
    UNION ALL SELECT tree + 1, 0, row_id, y, w, m, 1, true, NULL, 0, 0, {_gradients('m')}
    FROM (SELECT s.tree, s.row_id, s.y, s.w, s.m + leaf.value AS m FROM steps s JOIN leaf USING (node) JOIN goes ON goes.n = 0) WHERE tree < {how.rounds}))"""
    places = "made AS (SELECT tree, node, min(step) AS shown FROM steps GROUP BY tree, node)"
    # a node's rows are those that hold its number when it first appears
    parts = f"""parts AS (SELECT tree, node, sum(g) / {UNIT} AS gradient, sum(h) / {UNIT} AS hessian, count(*) FILTER (w > 0) AS rows, {_value(how)} AS value
    FROM steps JOIN made USING (tree, node) WHERE step = shown AND tree < {how.rounds} GROUP BY tree, node)"""
    if how.leaves:
        splits = """cuts AS (SELECT tree, split AS node, any_value(feature) AS feature, any_value(bin) AS bin, any_value(split_gain) AS gain FROM steps
      WHERE split IS NOT NULL AND node >> 1 = split GROUP BY tree, split)"""
    else:
        splits = "cuts AS (SELECT tree, node >> 1 AS node, any_value(feature) AS feature, any_value(bin) AS bin, any_value(gain) AS gain FROM steps WHERE gain IS NOT NULL AND open GROUP BY tree, node >> 1)"
    nodes = """nodes AS (SELECT p.tree, p.node, c.feature, c.bin, e.edge[c.bin + 1] AS edge, c.gain, gradient, hessian, rows,
    CASE WHEN c.node IS NULL THEN value END AS value FROM parts p LEFT JOIN cuts c USING (tree, node) LEFT JOIN edges e ON e.feature = c.feature)"""
    margins = f"margins AS (SELECT row_id, m AS margin FROM steps WHERE tree = {how.rounds} AND step = 0)"
    return [steps, places, parts, splits, nodes, margins]


def draw_sql(seed: int, feature: str, salt: int) -> str:
    """The draw of a node's feature, step by step as whole numbers."""
    a, b, c, d = MULTIPLIERS
    first = f"({seed * d} + tree * {a} % {PRIME} + node % {PRIME} * {b} % {PRIME} + {feature} * {c} % {PRIME} + {salt * 7_919}) % {PRIME}"
    return f"list_reduce([{first}, 0, 0, 0], lambda s, i: (s * s % {PRIME} * 48271 + s * 69621 + 12345) % {PRIME})"


def extra_trees_sql(trees: int, depth: int, seed: int, rows: str, drawn: str) -> list[str]:
    """CTEs up to ``nodes`` (tree, node, feature, cut, n0, n1) of random trees
    on ``rows`` (row_id, v, y); ``drawn`` features of each node."""
    steps = f"""steps AS (SELECT tree, row_id, y, 1::BIGINT AS node, 0 AS step, true AS open, NULL::BIGINT AS feature, NULL::DOUBLE AS cut
      FROM {rows}, (SELECT unnest(range({trees})) AS tree)
    UNION ALL (WITH live AS (SELECT tree, node FROM steps WHERE open AND step < {depth} GROUP BY tree, node HAVING count(DISTINCT y) = 2),
    drawn AS (SELECT tree, node, f AS feature, {draw_sql(seed, 'f', 1)}::DOUBLE / {PRIME}::DOUBLE AS share
      FROM (SELECT tree, node, unnest(range((SELECT len(v) FROM {rows} LIMIT 1))) AS f FROM live)
      QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY {draw_sql(seed, 'f', 0)}, f) <= {drawn}),
    held AS (SELECT s.tree, s.node, s.row_id, s.y, d.feature, d.share, r.v[d.feature + 1] AS x FROM steps s JOIN drawn d USING (tree, node) JOIN {rows} r USING (row_id)),
    cuts AS (SELECT tree, node, feature, min(x) + any_value(share) * (max(x) - min(x)) AS cut FROM held GROUP BY tree, node, feature HAVING max(x) > min(x)),
    sides AS (SELECT tree, node, feature, cut, count(*) FILTER (x <= cut AND y = 0) AS l0, count(*) FILTER (x <= cut AND y = 1) AS l1,
      count(*) FILTER (x > cut AND y = 0) AS r0, count(*) FILTER (x > cut AND y = 1) AS r1 FROM held JOIN cuts USING (tree, node, feature) GROUP BY ALL),
    best AS (SELECT tree, node, feature, cut FROM sides WHERE l0 + l1 > 0 AND r0 + r1 > 0
      QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY (l0 * l0 + l1 * l1)::DOUBLE / (l0 + l1) + (r0 * r0 + r1 * r1)::DOUBLE / (r0 + r1) DESC, feature) = 1)
    SELECT s.tree, s.row_id, s.y, 2 * s.node + (r.v[b.feature + 1] > b.cut)::INT, s.step + 1, true, b.feature, b.cut
    FROM steps s JOIN best b ON b.tree = s.tree AND b.node = s.node JOIN {rows} r ON r.row_id = s.row_id))"""
    nodes = """nodes AS (SELECT s.tree, s.node, any_value(c.feature) AS feature, any_value(c.cut) AS cut, count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1
    FROM steps s LEFT JOIN (SELECT DISTINCT tree, node >> 1 AS node, feature, cut FROM steps WHERE feature IS NOT NULL) c USING (tree, node) GROUP BY s.tree, s.node)"""
    return [steps, nodes]
