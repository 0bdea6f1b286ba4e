"""Mixing sources to target weights by Pfair scheduling.

A source is cut into blocks of ``block_rows`` rows in random order.  With
weight w its block j (from 1) is released at slot floor((j-1)/w) and due at
ceil(j/w); in every slot the released block with the earliest deadline runs.
With weights that add up to one this meets all deadlines, so after any slot
t every source has had between w t - 1 and w t + 1 blocks.

Weights are ratios of whole units, so the schedule repeats after as many slots
as there are units and the bound holds for ever.  A mapping of source to weight
is taken exactly: whole numbers and fractions as they are, floats as the nearest
fraction with a denominator of at most ``MOST_UNITS`` (1/7 is 1/7, 1e-6 is one
in a million).  Only a mapping whose common period is over ``MOST_UNITS`` is
rounded to that many units (each weight is off by half a unit at most, a
present source has one at least).  Without a mapping the target weights *are*
whole units: the tempered shares rows^alpha in ``resolution`` units, one at
least for each source.

One frame is folded by an SQL aggregate.  Sources of equal units have equal
releases and deadlines and run in turn, so the fold judges each distinct number
of units once a slot: with T units there are fewer than sqrt(2 T) of them, however
many sources there are.  A block then looks up its slot in the frame by (source,
block modulo units): the rows themselves need one rank inside their source.
Sources without a weight are left out, as asked.  ``cover`` ends the mix when
every row has been used once and repeats the sources that need more blocks
(epochs); otherwise the mix ends before a source would have to repeat.

All row work is DataFrame functions.  Cases: a null source is a source of its
own; repeated rows and null ids are rows like any other; an empty table gives
an empty result; of equal deadlines the one of the units whose first source
name is smallest runs first, among sources of equal units in order of names."""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import fresh
from .numbering import numbered, rank_within

RESOLUTION, BLOCK_ROWS, ALPHA, SEED = 10_000, 64, 0.9, 5
MOST_UNITS = 1_000_000  # longest frame of given weights
BROADCAST_SLOTS = 2_000_000  # frames up to this many slots and sources are broadcast, longer ones joined

# One slot: the released block with the earliest deadline.  Class i has m sources of u units each; its job k
# is block k div m of its source k % m.  Slots are folded in parts, so that no long array grows step by step.
_FRAME = """
flatten(aggregate(
  sequence(0L, (total - 1) div 1000),
  named_struct('done', transform(classes, c -> 0L), 'parts', cast(array() as array<array<int>>)),
  (all, part) -> transform(array(aggregate(
    sequence(part * 1000, least(total, (part + 1) * 1000) - 1),
    named_struct('done', all.done, 'picks', cast(array() as array<int>)),
    (acc, t) -> transform(
      array(array_min(filter(
        transform(classes, (c, i) -> if((acc.done[i] div c.m) * total < (t + 1) * c.u,
          named_struct('due', ((acc.done[i] div c.m + 1) * total + c.u - 1) div c.u, 'i', i), null)),
        x -> x is not null)).i),
      p -> named_struct('done', transform(acc.done, (d, i) -> d + if(i = p, 1L, 0L)),
                        'picks', concat(acc.picks, array(p))))[0])),
    x -> named_struct('done', x.done, 'parts', concat(all.parts, array(x.picks))))[0]).parts)"""


def exact_units(weights: Mapping, most: int = MOST_UNITS) -> dict:
    """Whole units in the ratio of the positive weights (see the module text)."""
    share = {k: Fraction(w).limit_denominator(most) if isinstance(w, float) else Fraction(w)
             for k, w in weights.items() if w > 0}
    total = sum(weights[k] for k in share)
    period = lcm(*(w.denominator for w in share.values()))
    units = {k: int(w * period) for k, w in share.items()}
    common = gcd(*units.values()) or 1
    units = {k: u // common for k, u in units.items()}
    if min(units.values(), default=1) < 1 or sum(units.values()) > most:
        units = {k: max(1, round(weights[k] / total * most)) for k in share}
    return units


def schedule(sources: DataFrame, resolution: int = RESOLUTION, block_rows: int = BLOCK_ROWS,
             cover: bool = True) -> DataFrame:
    """``(name, rows, units)``, or ``(name, rows, weight)`` whose shares are
    rounded to ``resolution`` units, to one row per source with its number
    ``sid``, ``units``, the ``total`` of them, its ``slots`` in a frame,
    ``blocks`` it has and blocks ``wanted`` from it."""
    if "units" not in sources.columns:
        share = F.col("weight") / F.sum("weight").over(Window.partitionBy())  # one row a source
        sources = (sources.where("weight > 0")
                   .withColumn("units", F.greatest(F.lit(1), F.round(share * resolution)).cast("long")))
    table = (sources.where("rows > 0 and units > 0").select("name", "rows", "units")
             .withColumn("sid", F.row_number().over(Window.orderBy("name")).cast("long"))
             .withColumn("turn", F.row_number().over(Window.partitionBy("units").orderBy("name")) - 1))
    frame = (table.groupBy("units").agg(F.count("*").alias("m"), F.min("name").alias("first"))
             .agg(F.sort_array(F.collect_list(F.struct("first", F.col("units").alias("u"), "m"))).alias("classes"),
                  F.sum(F.col("units") * F.col("m")).alias("total"))
             .where("total > 0").selectExpr("classes", "total", f"{_FRAME} as picks"))
    jobs = (frame.selectExpr("total", "classes", "posexplode(picks) as (t, i)")
            .selectExpr("total", "classes[i].u as units", "classes[i].m as m", "cast(t as bigint) as t")
            .withColumn("turn", ((F.row_number().over(Window.partitionBy("units").orderBy("t")) - 1) % F.col("m"))
                        .cast("int")))
    each = (jobs.join(table, ["units", "turn"]).groupBy("name", "sid", "rows", "units", "total")
            .agg(F.sort_array(F.collect_list("t")).alias("slots"))
            .withColumn("blocks", F.expr(f"cast(ceil(rows / {block_rows}) as bigint)")))
    slot = "((({j}) div units) * total + slots[cast(({j}) % units as int)])"
    end = (f"max({slot.format(j='blocks - 1')} + 1)" if cover else f"min({slot.format(j='blocks')})")
    # the schedule ends at one slot for all sources (a window over one row a source)
    return (each.withColumn("until", F.expr(end).over(Window.partitionBy()))
            .withColumn("wanted", F.expr("(until div total) * units + size(filter(slots, t -> t < until % total))"))
            .drop("until"))


def interleave(df: DataFrame, weights: Mapping[str, float] | None = None, source: str = "source",
               alpha: float = ALPHA, resolution: int = RESOLUTION, block_rows: int = BLOCK_ROWS,
               cover: bool = True, seed: int = SEED) -> DataFrame:
    """``df`` with ``mix_slot`` (slot of the row's block), ``mix_place`` (place
    in the block) and ``mix_epoch`` (0 for the first use of a row)."""
    df = df.drop("mix_slot", "mix_place", "mix_epoch")
    rows, rid, key = numbered(df, seed)
    name = fresh(rows, "_name")
    # a name that is never null: "1" + the source, or "0" for a null source
    rows = rows.withColumn(name, F.coalesce(F.concat(F.lit("1"), F.col(source).cast("string")), F.lit("0")))
    sizes = rows.groupBy(F.col(name).alias("name")).agg(F.count("*").alias("rows"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(alpha)))
    else:
        asked = df.sparkSession.createDataFrame(
            [("0" if k is None else f"1{k}", u) for k, u in exact_units(weights).items()], "name string, units long")
        sizes = sizes.join(asked, "name")
    plan = stage(schedule(sizes, resolution, block_rows, cover), "mix_plan")
    length = plan.agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]  # at least one unit a source
    small = F.broadcast if length <= BROADCAST_SLOTS else lambda table: table
    rank = fresh(rows, "_rank")
    ranked = rank_within(rows, [name], key, rank)
    p = plan.select(F.struct("sid", "units", "total", "blocks", "wanted").alias("_plan"), F.col("name").alias(name))
    placed = ranked.join(small(p), name)
    block = F.floor(F.col(rank) / block_rows)
    uses = F.when(F.col("_plan.wanted") > block,
                  F.floor((F.col("_plan.wanted") - 1 - block) / F.col("_plan.blocks")) + 1).otherwise(0)
    used = (placed.withColumn("mix_epoch", F.explode(F.when(uses > 0, F.sequence(F.lit(0).cast("long"), uses - 1))))
            .withColumn("_j", block + F.col("mix_epoch") * F.col("_plan.blocks"))
            .withColumn("_sid", F.col("_plan.sid")).withColumn("_k", F.col("_j") % F.col("_plan.units")))
    # (source, block modulo units) spreads a hot source over its slots, should the frame not be broadcast
    slots = (plan.select(F.col("sid").alias("_sid"), F.posexplode("slots").alias("_k", "_slot"))
             .withColumn("_k", F.col("_k").cast("long")))
    return (used.join(small(slots), ["_sid", "_k"])
            .withColumn("mix_slot", F.floor(F.col("_j") / F.col("_plan.units")) * F.col("_plan.total") + F.col("_slot"))
            .withColumn("mix_place", (F.col(rank) % block_rows).cast("int"))
            .withColumn("mix_epoch", F.col("mix_epoch").cast("int"))
            .drop("_sid", "_k", "_slot", "_j", "_plan", rank, key, rid, name))


def mixed(df: DataFrame, **options) -> DataFrame:
    """The rows of the mix in its order (range partitions in slot order), with
    the columns of ``df`` only."""
    out = interleave(df, **options)
    return (out.repartitionByRange("mix_slot", "mix_place")
            .sortWithinPartitions("mix_slot", "mix_place").select(*[F.col(f"`{c}`") for c in df.columns]))
