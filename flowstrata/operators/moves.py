"""Two-level partition by map-equation local moving.

All groups (clusters being refined, or one group for the whole network) move
at once.  Nodes move to the neighbouring module (or a new, empty one) that
shortens the codelength most, until no single move shortens it.  Modules are
contracted into nodes and the next level starts, until nothing merges; passes
start again from the single nodes until a pass changes nothing.  There is no
limit on rounds, levels or passes, and the codelength never rises.

A group is moved in one of two ways, both of which end when no node of the
group has an improving move:

* a group of at most ``task_links`` link rows (the bound on what a task holds)
  is swept node after node by one task (:func:`sweep`), with its levels and
  passes (:func:`all_levels`), all such groups in one job;
* a larger group moves in parallel rounds of DataFrame aggregates
  (:class:`_Level`), in which no node, module or group is gathered in a task.

One round of aggregates:

1. links are joined with the module of their other end and summed to the flow
   between a node and every module next to it;
2. from these, module flow ``p_m``, exit flow ``q_m`` and the codelength per
   group are aggregates; a group whose codelength rose takes its last moves
   back;
3. the change of the codelength is a closed form per (node, module), the empty
   module included, and the best module of a node is a minimum;
4. moves that would spoil each other are sorted out: of the moves from one
   module into another only the best counts, and a module either gives or
   takes nodes, whichever of its best moves is worth more.  The best move of a
   group always stays, so a round without moves has none to make.  A group
   that had to take moves back allows one move per module afterwards, then a
   thinner and thinner share of those.

After the first round only the *frontier* is judged: nodes that moved and
their neighbours (for the others the flow to their own module is kept).  When
the frontier makes no move, all nodes are judged once more, and a group is
done if none of them moves.  Ties are broken by hashes of module numbers,
never by the place of a row.

Hot keys: the state of a node, module or group that owns more than
``hot_rows`` rows is replicated to them (``functions.joins``), so the links of
a hub stay spread.  The tables of a round are written under
``spark.checkpoint.dir`` (lineage is cut), the link table once per level.
"""

from __future__ import annotations

import logging
import sys
import uuid
from dataclasses import dataclass
from math import log2

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.joins import split_join
from ..session import SMALL_BROADCASTS, conf_override, release, round_options, stage
from .flow import plogp

G = "g"
_LOG = logging.getLogger(__name__)

# The sweep travels to the workers by value (they need no installed package).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class MoveConfig:
    # link rows (two a link) of a group that one task may hold, at 130 to 150 bytes each
    task_links: int = 4_000_000
    # smallest change of the codelength that counts as an improvement
    min_delta: float = 1e-10
    # of the hashes that break ties
    seed: int = 999
    # rows of a key that are spread; None: a ten-thousandth of all links, 100,000 at least
    hot_rows: int | None = None


def both_directions(links: DataFrame) -> DataFrame:
    """``(g, s, t, f)`` without self-links to ``(g, v, u, o, i)``."""
    zero = F.lit(0.0)
    out = links.select(G, F.col("s").alias("v"), F.col("t").alias("u"), F.col("f").alias("o"), zero.alias("i"))
    back = links.select(G, F.col("t").alias("v"), F.col("s").alias("u"), zero.alias("o"), F.col("f").alias("i"))
    return out.unionByName(back).groupBy(G, "v", "u").agg(F.sum("o").alias("o"), F.sum("i").alias("i"))


def _xlog(x: float) -> float:
    return x * log2(x) if x > 0.0 else 0.0


def _heads(v: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array begins."""
    return np.flatnonzero(np.r_[True, v[1:] != v[:-1]])


def sweep(rows: pd.DataFrame, min_delta: float) -> tuple[np.ndarray, list[int]]:
    """Move the nodes of one group until no move shortens the codelength:
    the nodes and their new modules.

    ``rows``, sorted by v and u, has one line per node v and neighbour u: flows
    o, i; v's flow p, out-flow ``out`` and module m.  Links stay in arrays, a
    node's are taken out when it is judged; ``p log p`` of modules is kept.

    Once few nodes move, a node is passed over while it provably has no
    improving move (:class:`_Drift`): the moves are those of judging all."""
    low = rows["v"].to_numpy()
    first = _heads(low)
    v, m0 = low[first], rows["m"].to_numpy()[first]
    # modules as places among all numbers a module can have, in their order
    labels = np.union1d(v, m0)
    own, module = np.searchsorted(labels, v).tolist(), np.searchsorted(labels, m0).tolist()
    us, to_u, from_u = np.searchsorted(v, rows["u"].to_numpy()).astype(np.int32), rows["o"].to_numpy(), rows["i"].to_numpy()
    flows, outs = rows["p"].to_numpy()[first].tolist(), rows["out"].to_numpy()[first].tolist()
    cuts = [*first.tolist(), len(low)]
    flow, exits, size = [0.0] * len(labels), [0.0] * len(labels), [0] * len(labels)
    for n, here in enumerate(module):
        flow[here] += flows[n]
        size[here] += 1
        lo, hi = cuts[n], cuts[n + 1]
        leaves = outs[n] - sum(o for u, o in zip(us[lo:hi].tolist(), to_u[lo:hi].tolist()) if module[u] == here)
        exits[here] = max(0.0, exits[here] + leaves)
    total = sum(exits[x] for x in dict.fromkeys(module))
    exit_log = [_xlog(q) for q in exits]
    all_log = [_xlog(q + p) for q, p in zip(exits, flow)]
    total_log = _xlog(total)
    moves, drift = len(v), None
    while moves:
        if drift is None and moves <= len(v) * FEW_MOVES and len(v) > 1:
            weight = np.add.reduceat(from_u, first) + np.array(outs) + np.array(flows)
            drift = _Drift(us, cuts, own, module, len(labels), weight)
        moves = 0
        for n, here in enumerate(module):
            if drift is not None and drift.sure[n] > drift.sum:
                continue
            lo, hi = cuts[n], cuts[n + 1]
            near_o: dict[int, float] = {}
            near_i: dict[int, float] = {}
            for u, fo, fi in zip(us[lo:hi].tolist(), to_u[lo:hi].tolist(), from_u[lo:hi].tolist()):
                there = module[u]
                if there in near_o:
                    near_o[there] += fo
                    near_i[there] += fi
                else:
                    near_o[there], near_i[there] = fo, fi
            own_o, own_i = near_o.pop(here, 0.0), near_i.pop(here, 0.0)
            if size[own[n]] == 0:  # a new module under the node's own number
                near_o[own[n]] = near_i[own[n]] = 0.0
            node_p, node_out, here_q = flows[n], outs[n], exits[here]
            left_q = max(0.0, here_q - node_out + own_o + own_i)
            left_p = flow[here] - node_p
            leaving = -2 * (_xlog(left_q) - exit_log[here]) + _xlog(left_q + left_p) - all_log[here]
            others = total - here_q
            # what is not below the limit is neither the best nor equal to it once rounded
            best, to, joined, limit, least = 0.0, here, (0.0, 0.0), 1e-11 - min_delta, float("inf")
            for there, so in near_o.items():
                q0 = exits[there]
                q1 = q0 + node_out - so - near_i[there]
                if q1 < 0.0:
                    q1 = 0.0
                p1 = flow[there] + node_p
                new_total = others - q0 + left_q + q1
                both = q1 + p1
                d = ((new_total * log2(new_total) if new_total > 0.0 else 0.0) - total_log + leaving
                     - 2 * ((q1 * log2(q1) if q1 > 0.0 else 0.0) - exit_log[there])
                     + (both * log2(both) if both > 0.0 else 0.0) - all_log[there])
                if d < least:
                    least = d
                if d < limit:
                    d = round(d, 12)
                    if d < best or (d == best and d < 0.0 and there < to):
                        best, to, joined, limit = d, there, (q1, p1), d + 1e-11
            if best < -min_delta:
                moves += 1
                before = (total, exits[here], flow[here], exits[to], flow[to])
                total = max(0.0, total - here_q - exits[to] + left_q + joined[0])
                exits[here], flow[here], size[here] = left_q, left_p, size[here] - 1
                exits[to], flow[to] = joined
                size[to] += 1
                module[n] = to
                total_log = _xlog(total)
                for x in (here, to):
                    exit_log[x], all_log[x] = _xlog(exits[x]), _xlog(exits[x] + flow[x])
                if drift is not None:
                    drift.moved(n, here, to, before, (total, exits[here], flow[here], exits[to], flow[to]))
            elif drift is not None:
                drift.judged(n, least + min_delta - 1e-11)
    return v, labels[module].tolist()


#: Share of the nodes that a sweep moves at most for the next one to pass nodes over.
FEW_MOVES = 0.02


class _Drift:
    """Which nodes of a sweep surely have no improving move.

    A node that was judged and stayed lacked some bits (``slack``) for its best
    move.  Until its own links meet another module, that changes only by what
    its module, the modules next to it and the total exit flow have changed
    since.  With w the flow at the node, a module of exit flow q >= 4 w whose
    exit and module flow change by dq and dp changes it by less than
    10 w (dq + dp) / q bits, the total exit flow T >= 4 w by less than
    10 w dT / T (mean value theorem on the closed form).  ``sum`` adds these up
    without w, twice as much as needed; a node is ``sure`` up to the sum at which
    its slack is used up.  After a change of a small module, its nodes and their
    neighbours are judged again; so are all nodes where q or T is too small."""

    def __init__(self, us: np.ndarray, cuts: list[int], own: list[int], module: list[int], labels: int, weight: np.ndarray):
        self.us, self.cuts, self.weight, self.most = us, cuts, weight.tolist(), 4.0 * float(weight.max())
        self.sum, self.sure = 0.0, [-1.0] * len(module)
        self.members: list[set[int]] = [set() for _ in range(labels)]
        for n, here in enumerate(module):
            self.members[here].add(n)
        self.owner = dict(zip(own, range(len(own))))

    def judged(self, n: int, slack: float) -> None:
        w = self.weight[n]
        self.sure[n] = -1.0 if slack <= 0.0 else self.sum + slack / w if w > 0.0 else float("inf")

    def _near(self, n: int) -> None:
        self.sure[n] = -1.0
        for u in self.us[self.cuts[n]:self.cuts[n + 1]].tolist():
            self.sure[u] = -1.0

    def moved(self, n: int, here: int, to: int, before: tuple, after: tuple) -> None:
        self.members[here].remove(n)
        self.members[to].add(n)
        self._near(n)
        if not self.members[here] and here in self.owner:  # its owner can found it anew
            self.sure[self.owner[here]] = -1.0
        spent, least = 20.0 * abs(after[0] - before[0]), min(before[0], after[0])
        add = spent / least if least >= self.most and least > 0.0 else float("inf")
        for x, at in ((here, 1), (to, 3)):
            if len(self.members[x]) <= 1000:
                for member in self.members[x]:
                    self._near(member)
                continue
            q = min(before[at], after[at])
            change = abs(after[at] - before[at]) + abs(after[at + 1] - before[at + 1])
            add += 20.0 * change / q if q >= self.most and q > 0.0 else float("inf")
        if add == float("inf"):
            self.sum, self.sure = 0.0, [-1.0] * len(self.sure)
        else:
            self.sum += add


def contracted(rows: pd.DataFrame, v: np.ndarray, to: np.ndarray) -> pd.DataFrame:
    """The rows of :func:`sweep` one level up: modules as nodes, each its own module."""
    low, high = rows["v"].to_numpy(), rows["u"].to_numpy()
    mv, mu = to[np.searchsorted(v, low)], to[np.searchsorted(v, high)]
    at = np.flatnonzero(mv != mu)
    if not len(at):
        return rows.iloc[:0]
    at = at[np.lexsort((mu[at], mv[at]))]
    mv, mu = mv[at], mu[at]
    starts = np.flatnonzero(np.r_[True, (mv[1:] != mv[:-1]) | (mu[1:] != mu[:-1])])
    o, i = (np.add.reduceat(rows[c].to_numpy()[at], starts) for c in ("o", "i"))
    mv, mu = mv[starts], mu[starts]
    _, first, times = np.unique(mv, return_index=True, return_counts=True)
    heads = _heads(low)
    modules, inverse = np.unique(to[np.searchsorted(v, low[heads])], return_inverse=True)
    flow = np.bincount(inverse, rows["p"].to_numpy()[heads])
    return pd.DataFrame({G: np.full(len(mv), rows[G].iloc[0], object), "v": mv, "u": mu, "o": o, "i": i, "p": flow[np.searchsorted(modules, mv)],
                         "out": np.repeat(np.add.reduceat(o, first), times), "m": mv})


def all_levels(rows: pd.DataFrame, min_delta: float) -> tuple[np.ndarray, list[int]]:
    """:func:`sweep`, then its modules as nodes until nothing merges, in passes
    until one changes nothing (as :func:`_passes`); a module is named by its
    smallest node."""
    low = rows["v"].to_numpy()
    first = _heads(low)
    v, before, degree = low[first], rows["m"].to_numpy()[first], np.diff(np.r_[first, len(low)])
    while True:
        _, to = sweep(rows, min_delta)
        nodes, modules, top, level, levels = v, np.array(to, np.int64), np.array(to, np.int64), rows, 0
        while True:
            level = contracted(level, nodes, modules)
            if not len(level):
                break
            nodes, up = sweep(level, min_delta)
            modules = np.array(up, np.int64)
            if (modules == nodes).all():
                break
            levels += 1
            at = np.minimum(np.searchsorted(nodes, top), len(nodes) - 1)  # a module without links stays
            top = np.where(nodes[at] == top, modules[at], top)
        _, inverse = np.unique(top, return_inverse=True)
        least = np.full(inverse.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, inverse, v)
        after = least[inverse]
        if not levels or (after == before).all():
            return v, after.tolist()
        # the other columns are shared, not copied
        before, rows = after, pd.DataFrame({c: rows[c].to_numpy() for c in rows} | {"m": np.repeat(after, degree)}, copy=False)


def guarded(move, rows: pd.DataFrame, min_delta: float) -> tuple[np.ndarray, list, str | None]:
    """``move`` (:func:`sweep`, :func:`all_levels`) whose failure is an error
    text beside the nodes instead of the end of the job."""
    try:
        return *move(rows, min_delta), None
    except Exception as fault:  # noqa: BLE001 - any fault of one group
        v = rows["v"].unique()
        return v, [None] * len(v), f"{type(fault).__name__}: {fault}"


def whole_groups(frames):
    """Frames sorted by group, cut anew so that no group is in two of them.
    Holds one frame and the rows of one group."""
    held: list[dict[str, np.ndarray]] = []

    def joined() -> pd.DataFrame:  # column by column, so that no second copy of all rows is held
        return pd.DataFrame({c: np.concatenate([part.pop(c) for part in held]) for c in list(held[0])}, copy=False)
    for pdf in frames:
        if not len(pdf):
            continue
        g = pdf[G].to_numpy()
        last = int(np.flatnonzero(g != g[-1])[-1]) + 1 if g[0] != g[-1] else 0
        if last or held and held[0][G][0] != g[0]:
            if last:
                held.append({c: pdf[c].to_numpy()[:last] for c in pdf})
            if held:
                yield joined()
            held = []
        held.append({c: pdf[c].to_numpy()[last:].copy() for c in pdf})
    if held:
        yield joined()


def moved_groups(frames, move, min_delta: float, guard: bool):
    """``(g, v, to[, error])`` of all groups of frames sorted by g, v and u."""
    for pdf in whole_groups(frames):
        g = pdf[G].to_numpy()
        cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
        group, v, to, error = [], [], [], []
        for lo, hi in zip(cuts, cuts[1:]):
            rows = pdf.iloc[lo:hi]
            nodes, modules, *fault = guarded(move, rows, min_delta) if guard else move(rows, min_delta)
            group += [g[lo]] * len(modules)
            v.append(nodes)
            to += modules
            error += fault * len(modules)
        out = pd.DataFrame({G: group, "v": np.concatenate(v), "to": pd.array(to, "Int64")})
        yield out.assign(error=error) if guard else out


def _swept(nodes: DataFrame, adj: DataFrame, cfg: MoveConfig, failures: list | None, whole: bool = False) -> DataFrame:
    """``nodes`` after a sweep of every group, or with ``whole`` after all
    levels and passes (nodes without links stay).

    With ``failures`` a group whose sweep fails loses its nodes and is noted
    there as ``(g, error)``; without it the fault ends the job."""
    kind, delta, move = nodes.schema[G].dataType.simpleString(), cfg.min_delta, all_levels if whole else sweep
    # many groups are small, so a task streams its groups instead of a call for each
    rows = adj.join(nodes.select(G, "v", "p", "out", "m"), [G, "v"]).repartition(G).sortWithinPartitions(G, "v", "u")
    if failures is None:
        to = rows.mapInPandas(lambda it: moved_groups(it, move, delta, False), f"{G} {kind}, v long, to long")
        return stage(nodes.join(to, [G, "v"], "left").withColumn("m", F.coalesce("to", "m")).drop("to"), "nodes")
    to = rows.mapInPandas(lambda it: moved_groups(it, move, delta, True), f"{G} {kind}, v long, to long, error string")
    moved = nodes.join(to, [G, "v"], "left").withColumn("m", F.coalesce("to", "m")).drop("to")
    seen = Observation(f"faults-{uuid.uuid4().hex[:8]}")
    out = stage(moved.observe(seen, F.count("error").alias("n")), "nodes")
    if not seen.get["n"]:
        return _like(out, out.drop("error"))
    bad = stage(out.where("error is not null").groupBy(G).agg(F.min("error").alias("error")), "failures")
    failures.append(bad)
    sized = out.groupBy(G).agg(F.count(F.lit(1)).alias("n")).join(bad.select(G, F.lit(1).alias("_bad")), G)
    whole = stage(split_join(out.drop("error"), sized, [G], "n", ["v"], "left").where("_bad is null").drop("_bad", "n"), "nodes")
    release(out)
    return whole


def _like(staged: DataFrame, view: DataFrame) -> DataFrame:
    """``view`` of a staged table, released with it."""
    view._staged_path = staged._staged_path
    return view


#: State of a node besides ``g, v, p, out, deg``: module, flow to and from the
#: other nodes of the module, both as they were before the last moves, and
#: whether it moved.
_STATE = ["m", "so", "si", "m_prev", "so_prev", "si_prev", "moved"]


def _fresh(nodes: DataFrame) -> DataFrame:
    """Nodes ``(g, v, p, out, deg, m)`` before the first round of a level."""
    zero = F.lit(0.0)
    return nodes.select(G, "v", "p", "out", "deg", "m", zero.alias("so"), zero.alias("si"), F.col("m").alias("m_prev"),
                        zero.alias("so_prev"), zero.alias("si_prev"), F.lit(False).alias("moved"))


class _Level:
    """Rounds of one level over the links ``adj``."""

    def __init__(self, adj: DataFrame, cfg: MoveConfig, rows: int):
        self.adj, self.cfg, self.rows = adj, cfg, rows
        self.limit = max(100_000, rows // 10_000) if cfg.hot_rows is None else cfg.hot_rows

    def attach(self, rows: DataFrame, table: DataFrame, keys: list[str], count: str, spread: str, how: str = "inner") -> DataFrame:
        return split_join(rows, table, keys, count, [spread], how, self.limit, self.rows)

    def frontier(self, nodes: DataFrame, groups: DataFrame) -> DataFrame:
        """Nodes with the state of their group and ``dirty``: to be judged."""
        cur = self.attach(nodes, groups, [G], "n", "v")
        moved = nodes.where("moved").select(G, F.col("v").alias("u"), "deg")
        near = self.attach(self.adj.select(G, "v", "u"), moved, [G, "u"], "deg", "v").select(G, "v").distinct()
        return (cur.join(near.withColumn("near", F.lit(True)), [G, "v"], "left")
                .withColumn("dirty", ~F.col("done") & (F.col("full") | F.col("moved") | F.coalesce("near", F.lit(False)))).drop("near"))

    def module_flows(self, cur: DataFrame) -> DataFrame:
        """``(g, v, x, o, i)``: flows of the judged nodes to all modules next
        to them."""
        dirty = cur.where("dirty").select(G, "v", "deg")
        at = cur.where("not done").select(G, F.col("v").alias("u"), F.col("m").alias("x"), "deg")
        links = self.attach(self.attach(self.adj, dirty, [G, "v"], "deg", "u"), at, [G, "u"], "deg", "v")
        return links.groupBy(G, "v", "x").agg(F.sum("o").alias("o"), F.sum("i").alias("i"))

    @staticmethod
    def with_own(cur: DataFrame, flows: DataFrame) -> DataFrame:
        """``cur`` with the flows to the own module, fresh for judged nodes."""
        cur = cur.join(flows.select(G, "v", F.col("x").alias("m"), "o", "i"), [G, "v", "m"], "left")
        for kept, new in (("so", "o"), ("si", "i")):
            cur = cur.withColumn(kept, F.when(F.col("dirty"), F.coalesce(new, F.lit(0.0))).otherwise(F.col(kept)))
        return cur.drop("o", "i")

    @staticmethod
    def modules(cur: DataFrame) -> DataFrame:
        """``(g, m, n, ends, pm, q)``: exit flow = out-flow of the members
        minus what stays inside the module."""
        q = F.sum("out") - F.sum("so")
        return (cur.groupBy(G, "m").agg(F.count(F.lit(1)).alias("n"), F.sum("deg").alias("ends"), F.sum("p").alias("pm"), q.alias("q"))
                # what summation leaves of a closed module
                .withColumn("q", F.when(F.col("q") < 1e-14, 0.0).otherwise(F.col("q"))))

    @staticmethod
    def objective(mod: DataFrame) -> DataFrame:
        agg = mod.groupBy(G).agg(F.sum("n").alias("n"), F.sum("q").alias("Q"), F.sum(plogp(F.col("q"))).alias("sq"),
                                 F.sum(plogp(F.col("q") + F.col("pm"))).alias("sqp"))
        return agg.select(G, "n", "Q", (plogp(F.col("Q")) - 2 * F.col("sq") + F.col("sqp")).alias("L"))

    def best_moves(self, state: DataFrame, flows: DataFrame, mod: DataFrame) -> DataFrame:
        """``(g, v, a, x, d)``: for each judged node with an improving move
        its best one.  ``state`` has the node's module a with ``pa, qa``."""
        node = state.select(G, "v", "deg", "p", "out", F.col("m").alias("a"), "so", "si", "pa", "qa", "Q")
        zero = F.lit(0.0)
        # the empty module under the node's own number, if the node is not alone in it
        empty = node.where("a <> v").select(G, "v", F.col("v").alias("x"), zero.alias("o"), zero.alias("i"))
        cand = self.attach(flows.unionByName(empty).groupBy(G, "v", "x").agg(F.sum("o").alias("o"), F.sum("i").alias("i")),
                           node, [G, "v"], "deg", "x").where("x <> a")
        there = mod.select(G, F.col("m").alias("x"), "ends", F.col("pm").alias("px"), F.col("q").alias("qx"))
        cand = self.attach(cand, there, [G, "x"], "ends", "v", "left").fillna(0.0, ["px", "qx"])

        def c(name: str) -> Column:
            return F.col(name)
        left_q = F.greatest(zero, c("qa") - c("out") + c("so") + c("si"))
        left_p = c("pa") - c("p")
        q1, p1 = F.greatest(zero, c("qx") + c("out") - c("o") - c("i")), c("px") + c("p")
        total = F.greatest(zero, c("Q") - c("qa") - c("qx") + left_q + q1)
        d = (plogp(total) - plogp(c("Q")) - 2 * (plogp(left_q) - plogp(c("qa")) + plogp(q1) - plogp(c("qx")))
             + plogp(left_q + left_p) - plogp(c("qa") + c("pa")) + plogp(q1 + p1) - plogp(c("qx") + c("px")))
        choice = F.struct(F.round(d, 12).alias("d"), F.xxhash64("x", F.lit(self.cfg.seed)).alias("tie"), c("x").alias("to"))
        best = cand.groupBy(G, "v", "a").agg(F.min(choice).alias("b"))
        return best.select(G, "v", "a", F.col("b.to").alias("x"), F.col("b.d").alias("d")).where(F.col("d") < -self.cfg.min_delta)

    def allowed(self, best: DataFrame) -> DataFrame:
        """``(g, v, to, alone)`` of the moves that do not spoil each other;
        ``alone``: the best in and out of both its modules."""
        mover = F.struct(F.col("d"), F.xxhash64("v", F.lit(self.cfg.seed)).alias("tie"), F.col("v").alias("who"))
        pair = (best.groupBy(G, "a", "x").agg(F.min(mover).alias("b"))
                .select(G, "a", "x", F.col("b.who").alias("v"),
                        F.struct(F.col("b.d").alias("d"), F.xxhash64("a", "x", F.lit(self.cfg.seed)).alias("tie"), "a", "x").alias("key")))
        none = F.lit(None).cast("struct<d:double,tie:bigint,a:bigint,x:bigint>")
        ends = (pair.select(G, F.col("a").alias("m"), F.col("key").alias("gives"), none.alias("takes"))
                .unionByName(pair.select(G, F.col("x").alias("m"), none.alias("gives"), F.col("key").alias("takes"))))
        roles = ends.groupBy(G, "m").agg(F.min("gives").alias("gives"), F.min("takes").alias("takes"), F.count(F.lit(1)).alias("n"))
        giver = roles.where(F.col("takes").isNull() | (F.col("gives") < F.col("takes"))).where("gives is not null")
        taker = roles.where(F.col("gives").isNull() | (F.col("takes") < F.col("gives"))).where("takes is not null")
        kept = self.attach(pair, giver.select(G, F.col("m").alias("a"), "n", "gives"), [G, "a"], "n", "v")
        kept = self.attach(kept, taker.select(G, F.col("m").alias("x"), "n", "takes"), [G, "x"], "n", "v")
        return kept.select(G, "v", F.col("x").alias("to"),
                           ((F.col("key") == F.col("gives")) & (F.col("key") == F.col("takes"))).alias("alone"))

    def round(self, nodes: DataFrame, groups: DataFrame) -> DataFrame:
        """The node table after one round, with the group's ``L`` before the
        moves and ``rose``."""
        front = stage(self.frontier(nodes, groups), "frontier")
        flows = stage(self.module_flows(front), "module_flows")
        cur = stage(self.with_own(front, flows), "nodes_own")
        live = cur.where("not done")
        mod = stage(self.modules(live), "modules")
        score = self.attach(live, self.objective(mod), [G], "n", "v").withColumn(
            "rose", F.col("changed") & (F.col("L") > F.col("L_prev") - 1e-12))
        here = mod.select(G, "m", "ends", F.col("pm").alias("pa"), F.col("q").alias("qa"))
        state = self.attach(score.where("dirty and not rose"), here, [G, "m"], "ends", "v")
        best = stage(self.best_moves(state, flows, mod), "best_moves")
        moves = self.allowed(best)
        thin = F.pmod(F.xxhash64("v", "turn", F.lit(self.cfg.seed)), F.expr("shiftleft(1, least(30, 2 * (greatest(strict, 1) - 1)))"))
        may = (F.col("strict") == 0) | (F.col("alone") & ((F.col("strict") == 1) | (thin == 0)))
        after = cur.where("done").select(*cur.columns, F.lit(0.0).alias("Q"), F.col("L_prev").alias("L"), F.lit(False).alias("rose"))
        after = score.select(after.columns).unionByName(after).join(moves, [G, "v"], "left").withColumn(
            "to", F.when(F.col("to").isNotNull() & may, F.col("to")))
        back = F.col("rose")

        def either(a, b):
            return F.when(back, F.col(a)).otherwise(b if isinstance(b, Column) else F.col(b))
        out = stage(after.select(
            G, "v", "p", "out", "deg", either("m_prev", F.coalesce("to", "m")).alias("m"),
            either("so_prev", "so").alias("so"), either("si_prev", "si").alias("si"),
            either("m_prev", "m").alias("m_prev"), either("so_prev", "so").alias("so_prev"), either("si_prev", "si").alias("si_prev"),
            (~back & F.col("to").isNotNull()).alias("moved"), either("L_prev", "L").alias("L"), "rose", "dirty",
            "strict", "full", "turn"), "nodes")
        release(front, flows, cur, mod, best)
        return out


def _next_groups(after: DataFrame) -> DataFrame:
    """Group table ``(g, n, L_prev, changed, strict, full, turn, done)`` for
    the round after ``after``."""
    g = after.groupBy(G).agg(F.count(F.lit(1)).alias("n"), F.max("L").alias("L_prev"), F.max("moved").alias("changed"),
                             F.max("rose").alias("rose"), F.max("strict").alias("strict"), F.max("full").alias("full"),
                             F.max("turn").alias("turn"))
    idle = ~F.col("rose") & ~F.col("changed")
    return g.select(
        G, "n", "L_prev", "changed", F.col("turn").alias("_t"), (idle & F.col("full") & (F.col("strict") < 2)).alias("done"),
        # one move per module stays the rule once more than that was too much
        F.when(F.col("rose"), F.col("strict") + 1).when(F.col("strict") > 1, F.col("strict") - 1).otherwise(F.col("strict")).alias("strict"),
        (F.col("rose") | idle).alias("full")).withColumn("turn", F.col("_t") + 1).drop("_t")


def _local_moving(nodes: DataFrame, adj: DataFrame, cfg: MoveConfig, level: int, rows: int,
                  history: list | None, failures: list | None) -> tuple[DataFrame, int]:
    """One level from the modules ``m`` of ``nodes``; the result has their
    columns ``(g, v, p, out, deg, m)``."""
    if rows <= cfg.task_links:  # no group has more links than that
        return _swept(nodes, adj, cfg, failures), 1
    ends = nodes.groupBy(G).agg(F.count(F.lit(1)).alias("n"), F.sum("deg").alias("ends")).withColumn("large", F.col("ends") > cfg.task_links)
    run = _Level(adj, cfg, rows)
    sized = run.attach(nodes, ends.select(G, "n", "large"), [G], "n", "v")
    large, small = stage(sized.where("large").drop("large"), "nodes"), sized.where("not large").drop("large")
    few = run.attach(adj, ends.where("not large").select(G, "ends"), [G], "ends", "v")
    done = _swept(small, few, cfg, failures)
    moved, rounds = _rounds(large, adj, cfg, level, rows, history)
    out = stage(done.unionByName(moved), "nodes")
    release(done, large, moved)
    return out, rounds + 1


def _rounds(nodes: DataFrame, adj: DataFrame, cfg: MoveConfig, level: int, rows: int,
            history: list | None) -> tuple[DataFrame, int]:
    """Rounds of aggregates over the groups of ``nodes``."""
    run = _Level(adj, cfg, rows)
    now = stage(_fresh(nodes), "nodes")
    groups = stage(now.groupBy(G).agg(F.count(F.lit(1)).alias("n")).select(
        G, "n", F.lit(float("inf")).alias("L_prev"), F.lit(False).alias("changed"), F.lit(False).alias("done"),
        F.lit(0).alias("strict"), F.lit(True).alias("full"), F.lit(0).alias("turn")), "groups")
    aside, rounds = [], 0
    left = groups.agg(F.sum("n")).first()[0] or 0
    while left:
        after = run.round(now, groups)
        state = stage(_next_groups(after), "groups")
        rounds += 1
        if history is not None:
            length = {r[G]: r["L"] for r in after.where("not rose").groupBy(G).agg(F.max("L").alias("L")).collect()}
            history.append((level, rounds, length, after.where("dirty").agg(F.sum("deg")).first()[0] or 0))
        done = state.agg(F.sum(F.when(F.col("done"), F.col("n")).otherwise(0))).first()[0]
        _LOG.debug("level %d round %d: %s of %s nodes done", level, rounds, done, left)
        release(now, groups)
        if 2 * done >= left:  # groups that are done move out of the rounds once they own half of the nodes
            ready = run.attach(after, state.where("done").select(G, "n"), [G], "n", "v")
            aside.append(stage(ready.select(G, "v", "p", "out", "deg", "m"), "nodes_done"))
            now = stage(run.attach(after, state.where("not done").select(G, "n"), [G], "n", "v").select(
                G, "v", "p", "out", "deg", *_STATE), "nodes")
            groups = stage(state.where("not done"), "groups")
            release(after, state)
            left -= done
        else:
            now, groups = after, state
            now = after.select(G, "v", "p", "out", "deg", *_STATE)
            now._staged_path = after._staged_path
    if not aside:
        return nodes, rounds
    result = aside[0] if len(aside) == 1 else stage(_union(aside), "nodes")
    if len(aside) > 1:
        release(*aside)
    return result, rounds


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def _contract(nodes: DataFrame, run: _Level) -> tuple[DataFrame, DataFrame]:
    """Modules as nodes (each its own module) and the flows between them."""
    at = nodes.select(G, "v", "deg", "m")
    links = run.attach(run.adj, at.withColumnRenamed("m", "mv"), [G, "v"], "deg", "u")
    links = run.attach(links, at.select(G, F.col("v").alias("u"), "deg", F.col("m").alias("mu")), [G, "u"], "deg", "v")
    links = stage(links.where(F.col("mv") != F.col("mu")).groupBy(G, F.col("mv").alias("v"), F.col("mu").alias("u"))
                  .agg(F.sum("o").alias("o"), F.sum("i").alias("i")), "links")
    flow = nodes.groupBy(G, F.col("m").alias("v")).agg(F.sum("p").alias("p"))
    return stage(_singletons(flow, links), "nodes"), links


def _singletons(flow: DataFrame, adj: DataFrame) -> DataFrame:
    """Nodes ``(g, v, p)`` with out-flow, number of neighbours and themselves
    as module."""
    ends = adj.groupBy(G, "v").agg(F.sum("o").alias("out"), F.count(F.lit(1)).alias("deg"))
    return (flow.join(ends, [G, "v"], "left").fillna(0.0, ["out"]).fillna(0, ["deg"])
            .select(G, "v", "p", "out", "deg", F.col("v").alias("m")))


def _renamed(nodes: DataFrame, names: DataFrame, run: _Level) -> DataFrame:
    """``nodes`` with the module names of ``(g, m, new)``."""
    sizes = nodes.groupBy(G, "m").agg(F.count(F.lit(1)).alias("n"))
    table = names.join(sizes, [G, "m"])
    return run.attach(nodes, table, [G, "m"], "n", "v").select(G, "v", "p", "out", "deg", F.col("new").alias("m"))


def two_level_partition(node_flow: DataFrame, link_flow: DataFrame, group: str | None = None,
                        config: MoveConfig | None = None, history: list | None = None,
                        start: DataFrame | None = None, failures: list | None = None) -> tuple[DataFrame, dict]:
    """Partition the nodes of every group into modules.

    ``node_flow``: ``([group,] node_id, flow)``; ``link_flow``:
    ``([group,] source, target, flow)``; ``start``: modules to start from,
    ``([group,] node_id, module)`` (nodes without one start alone).  Returns
    ``([group,] node_id, module)`` - the module id is its smallest node - and
    a dict of statistics (rounds per level of every pass).  ``history``
    collects ``(level, round, codelength per group, links judged)`` (a test
    aid).  ``failures`` collects tables ``(g, error)`` of the groups that failed
    in their task at any level; such a group has no rows in the result and all
    others are as without it.  Without the list a fault ends the job."""
    cfg = config or MoveConfig()
    gcol = F.col(group) if group else F.lit(0)
    with conf_override(link_flow.sparkSession, SMALL_BROADCASTS):
        links = stage(link_flow.where(F.col("source") != F.col("target"))
                      .select(gcol.alias(G), F.col("source").alias("s"), F.col("target").alias("t"),
                              F.col("flow").alias("f")), "links")
    rows = 2 * links.count()
    with conf_override(links.sparkSession, round_options(links.sparkSession, rows)):
        adj = stage(both_directions(links), "links")
        release(links)
        flow = node_flow.select(gcol.alias(G), F.col("node_id").alias("v"), F.col("flow").alias("p"))
        nodes = _singletons(flow, adj)
        if start is not None:
            given = start.select(gcol.alias(G), F.col("node_id").alias("v"), F.col("module").alias("given"))
            # a module is named by one of its nodes, as everywhere in the rounds
            least = given.groupBy(G, "given").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("n"))
            named = split_join(given, least, [G, "given"], "n", ["v"]).select(G, "v", "least")
            nodes = nodes.join(named, [G, "v"], "left").withColumn("m", F.coalesce("least", "m")).drop("least")
        base = stage(nodes, "nodes")
        result, stats = _partitioned(base, adj, cfg, rows, history, failures, start is not None)
        release(base, adj)
    name = [F.col(G).alias(group)] if group else []
    return result.select(*name, "node_id", "module"), stats


def _partitioned(base: DataFrame, adj: DataFrame, cfg: MoveConfig, rows: int, history: list | None,
                 failures: list | None, started: bool) -> tuple[DataFrame, dict]:
    """Groups that a task holds in one job; larger ones, and all that start from
    given modules, level by level."""
    if started:
        return _passes(base, adj, cfg, rows + base.count(), history, failures)
    once = {"rounds": [[1]], "passes": 1, "levels": 1}
    if rows <= cfg.task_links:  # no group has more links than that
        return _named(_swept(base, adj, cfg, failures, whole=True)), once
    ends = stage(base.groupBy(G).agg(F.count(F.lit(1)).alias("n"), F.sum("deg").alias("ends")), "groups")
    large, small = ends.where(F.col("ends") > cfg.task_links), ends.where(F.col("ends") <= cfg.task_links)
    if large.isEmpty():
        release(ends)
        return _named(_swept(base, adj, cfg, failures, whole=True)), once
    run = _Level(adj, cfg, rows)

    def of(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
        return (stage(run.attach(base, groups.select(G, "n"), [G], "n", "v"), "nodes"),
                stage(run.attach(adj, groups.select(G, "ends"), [G], "ends", "v"), "links"))
    if small.isEmpty():
        return _passes(base, adj, cfg, rows + base.count(), history, failures)
    (few, few_adj), (many, many_adj) = of(small), of(large)
    done = _swept(few, few_adj, cfg, failures, whole=True)
    result, stats = _passes(many, many_adj, cfg, rows + many.count(), history, failures)
    release(ends, few, few_adj, many, many_adj)
    return _named(done).unionByName(result), stats


def _named(nodes: DataFrame) -> DataFrame:
    return nodes.select(G, F.col("v").alias("node_id"), F.col("m").alias("module"))


def _passes(base: DataFrame, adj: DataFrame, cfg: MoveConfig, rows: int, history: list | None,
            failures: list | None) -> tuple[DataFrame, dict]:
    stats: dict = {"rounds": []}
    before = base
    while True:
        nodes, rounds = _local_moving(before, adj, cfg, 0, rows, history, failures)
        per_level, level_nodes, level_adj, tops = [rounds], nodes, adj, []
        while True:
            up, up_adj = _contract(level_nodes, _Level(level_adj, cfg, rows))
            if level_adj is not adj:
                release(level_adj)
            moved, rounds = _local_moving(up, up_adj, cfg, len(per_level), rows, history, failures)
            per_level.append(rounds)
            tops.append(moved)
            level_nodes, level_adj = moved, up_adj
            if moved.where(F.col("m") != F.col("v")).isEmpty():
                break
        release(level_adj)
        stats["rounds"].append(per_level)
        # modules of the nodes after all levels, named by their smallest node
        run = _Level(adj, cfg, rows)
        assigned = nodes
        for t in tops[:-1]:  # the last level merged nothing
            assigned = _renamed(assigned, t.select(G, F.col("v").alias("m"), F.col("m").alias("new")), run)
        low = assigned.groupBy(G, "m").agg(F.min("v").alias("new"))
        after = stage(_renamed(assigned, low, run), "nodes")
        # a pass that merged nothing above the nodes judged the nodes last
        changed = len(tops) > 1 and _differs(before, after)
        release(*[x for x in (before, nodes, *tops) if x is not base])
        before = after
        if not changed:
            break
    stats["passes"], stats["levels"] = len(stats["rounds"]), max(map(len, stats["rounds"]))
    return _named(after), stats


def _differs(a: DataFrame, b: DataFrame) -> bool:
    """Whether two assignments of the same nodes differ anywhere."""
    return not (a.select(G, "v", F.col("m").alias("ma")).join(b.select(G, "v", "m"), [G, "v"])
                .where(F.col("ma") != F.col("m")).isEmpty())
