"""DuckDB SQL for the registered queries (the correctness oracle).

Every statement is self-contained: the network views are spelled out as
common table expressions over the driver's tables.  Bounds and parameters
match those used by :mod:`flowstrata.plans.catalog`.
"""

from __future__ import annotations

MIN_SIZE = 3
MAX_SIZE = 40

# Network views over the driver tables (same definitions as sources.tables).
VIEWS = f"""
vertices AS (
  SELECT p_partkey AS node_id, 'part#' || CAST(p_partkey AS VARCHAR) AS node_name FROM part
),
edges AS (
  SELECT DISTINCT a.l_partkey AS source, b.l_partkey AS target
  FROM lineitem a JOIN lineitem b
    ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber
),
tree AS (
  SELECT cl_top || ':' || CAST(row_number() OVER (PARTITION BY cl_top ORDER BY p_retailprice DESC, p_partkey) AS VARCHAR) AS cl,
         p_retailprice / sum(p_retailprice) OVER () AS flow,
         'part#' || CAST(p_partkey AS VARCHAR) AS node_name
  FROM (SELECT *, CAST(CASE WHEN p_size <= 25 THEN dense_rank() OVER (ORDER BY p_brand)
                            ELSE 100 + dense_rank() OVER (ORDER BY p_brand, p_type) END AS VARCHAR) AS cl_top
        FROM part) t
),
members AS (
  SELECT v.node_id, t.node_name, t.cl, t.flow, split_part(t.cl, ':', 1) AS cl_top
  FROM tree t JOIN vertices v ON t.node_name = v.node_name
),
sizes AS (
  SELECT cl_top, CAST(count(*) AS BIGINT) AS n FROM members GROUP BY cl_top
),
kept AS (
  SELECT cl_top, n FROM sizes WHERE n >= {MIN_SIZE} AND n <= {MAX_SIZE}
),
kept_members AS (
  SELECT m.* FROM members m WHERE m.cl_top IN (SELECT cl_top FROM kept)
),
within AS (
  SELECT e.source, e.target, a.cl_top FROM edges e
  JOIN kept_members a ON e.source = a.node_id
  JOIN kept_members b ON e.target = b.node_id AND a.cl_top = b.cl_top
)"""


def with_views(body: str) -> str:
    return f"WITH {VIEWS}\n{body}"


def flow_views(links: str, nodes: str) -> str:
    """undirdir flow CTEs (``link_flow``, ``node_flow``) for a link query
    ``(g, source, target)`` and a node query ``(g, node_id)``."""
    return f""",
wl AS (SELECT g, source, target, CAST(count(*) AS DOUBLE) AS w FROM ({links}) x GROUP BY 1, 2, 3),
wout AS (SELECT g, source AS node_id, sum(w) AS w_out FROM wl GROUP BY 1, 2),
win AS (SELECT g, target AS node_id, sum(w) AS w_in FROM wl GROUP BY 1, 2),
deg AS (
  SELECT coalesce(o.g, i.g) AS g, coalesce(o.node_id, i.node_id) AS node_id,
         coalesce(o.w_out, 0) AS w_out, coalesce(i.w_in, 0) AS w_in
  FROM wout o FULL JOIN win i ON o.g = i.g AND o.node_id = i.node_id
),
tot AS (SELECT g, sum(w) AS w_tot FROM wl GROUP BY 1),
p0 AS (SELECT d.*, (d.w_out + d.w_in) / (2 * t.w_tot) AS p0 FROM deg d JOIN tot t ON d.g = t.g),
lf0 AS (SELECT l.g, l.source, l.target, p.p0 * l.w / p.w_out AS f
        FROM wl l JOIN p0 p ON l.g = p.g AND l.source = p.node_id),
ftot AS (SELECT g, sum(f) AS f_tot FROM lf0 GROUP BY 1),
link_flow AS (SELECT l.g, l.source, l.target, l.f / t.f_tot AS flow FROM lf0 l JOIN ftot t ON l.g = t.g),
allnodes AS (SELECT g, node_id FROM ({nodes}) y UNION SELECT g, node_id FROM deg),
node_flow AS (
  SELECT a.g, a.node_id, coalesce(sum(l.flow), 0) AS flow
  FROM allnodes a LEFT JOIN link_flow l ON l.g = a.g AND l.target = a.node_id
  GROUP BY 1, 2
)"""


WITHIN_FLOW = flow_views("SELECT cl_top AS g, source, target FROM within",
                         "SELECT cl_top AS g, node_id FROM kept_members")
NETWORK_FLOW = flow_views("SELECT 0 AS g, source, target FROM edges",
                          "SELECT 0 AS g, node_id FROM vertices")


def plogp(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ({x}) * log2({x}) ELSE 0 END)"


def codelength_sql(assignment: str, group_out: str) -> str:
    """Codelength per group for ``assignment (g, node_id, module)`` over the
    ``node_flow``/``link_flow`` CTEs.  ``group_out`` is the select list for
    the group column (e.g. ``g AS cl_top`` or empty)."""
    sel = f"{group_out}, " if group_out else ""
    return f""",
asg AS ({assignment}),
nfm AS (SELECT n.g, n.node_id, n.flow, a.module FROM node_flow n JOIN asg a ON n.g = a.g AND n.node_id = a.node_id),
pm AS (SELECT g, module, sum(flow) AS p_m FROM nfm GROUP BY 1, 2),
hp AS (SELECT g, sum({plogp('flow')}) AS h_nodes FROM nfm GROUP BY 1),
qm AS (
  SELECT l.g, a.module, sum(l.flow) AS q_m
  FROM link_flow l JOIN asg a ON l.g = a.g AND l.source = a.node_id
  JOIN asg b ON l.g = b.g AND l.target = b.node_id
  WHERE a.module <> b.module GROUP BY 1, 2
),
mods AS (SELECT p.g, p.module, p.p_m, coalesce(q.q_m, 0) AS q_m FROM pm p LEFT JOIN qm q ON p.g = q.g AND p.module = q.module),
per AS (SELECT g, sum(q_m) AS exit_flow, sum({plogp('q_m')}) AS s_q, sum({plogp('q_m + p_m')}) AS s_qp,
               CAST(count(*) AS BIGINT) AS num_modules FROM mods GROUP BY 1)
SELECT {sel}round({plogp('p.exit_flow')} - 2 * p.s_q - h.h_nodes + p.s_qp, 9) AS codelength,
       p.num_modules, round(p.exit_flow, 9) AS exit_flow
FROM per p JOIN hp h ON p.g = h.g"""


def hierarchical_sql(paths: str, group_out: str) -> str:
    """Hierarchical codelength per group for ``paths (g, node_id, inside)``,
    ``inside`` the list of the modules of a node from the top down."""
    return f""",
placed AS ({paths}),
hn AS (SELECT n.g, n.flow, p.inside, coalesce(p.inside[-1], '') AS parent FROM node_flow n JOIN placed p ON n.g = p.g AND n.node_id = p.node_id),
hq AS (
  SELECT g, module, sum(flow) AS q FROM (
    SELECT l.g, l.flow, unnest(list_filter(a.inside, lambda x: NOT list_contains(b.inside, x))) AS module
    FROM link_flow l JOIN placed a ON l.g = a.g AND l.source = a.node_id JOIN placed b ON l.g = b.g AND l.target = b.node_id) GROUP BY 1, 2),
hm AS (SELECT m.g, m.module, coalesce(q, 0) AS q FROM (SELECT DISTINCT g, unnest(inside) AS module FROM hn) m
       LEFT JOIN hq ON m.g = hq.g AND m.module = hq.module),
hu AS (SELECT g, module, sum(u) AS u, sum({plogp('u')}) AS h FROM (
         SELECT g, regexp_replace(module, ':?[^:]*$', '') AS module, q AS u FROM hm UNION ALL SELECT g, parent, flow FROM hn) GROUP BY 1, 2),
hp2 AS (SELECT hu.g, hu.module, u, h, coalesce(q, 0) AS q FROM hu LEFT JOIN hm ON hu.g = hm.g AND hu.module = hm.module)
SELECT {group_out}, round(sum({plogp('q + u')} - {plogp('q')} - h), 9) AS codelength, CAST(count(*) - 1 AS BIGINT) AS num_modules,
       CAST(max(CASE WHEN module = '' THEN 0 ELSE len(string_split(module, ':')) END) AS INTEGER) AS depth
FROM hp2 GROUP BY g"""
