"""Cluster-path expressions.  A path is a ``:``-separated string, root
first, the last part being the leaf ordinal.  All helpers return built-in
Column expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = ":"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cl_top(cl: str | Column) -> Column:
    """Top-level cluster: text before the first ``:``; a path without
    ``:`` is its own top; null stays null."""
    return F.substring_index(_c(cl), SEP, 1)


def combined_path(top: str | Column, sub_path: str | Column) -> Column:
    """``top:sub_path`` (null if either part is null)."""
    return F.concat(_c(top), F.lit(SEP), _c(sub_path))


def combined_or_original(cl: str | Column, top: str | Column,
                         sub_path: str | Column) -> Column:
    """Combined path, falling back to the original ``cl`` when there is no
    sub-cluster path."""
    return F.when(_c(sub_path).isNull(), _c(cl)).otherwise(
        combined_path(top, sub_path))


def path_join(parts: str | Column) -> Column:
    """Array of integers -> path string."""
    return F.array_join(F.transform(_c(parts), lambda x: x.cast("string")), SEP)


def path_replace_head(cl: str | Column, new_top: str | Column) -> Column:
    """Replace the first component of a path, keep the rest."""
    rest = F.substring(_c(cl), F.length(cl_top(cl)) + 2, 1 << 30)
    return F.when(F.instr(_c(cl), SEP) > 0,
                  F.concat(_c(new_top).cast("string"), F.lit(SEP), rest)
                  ).otherwise(_c(new_top).cast("string"))


def path_depth(cl: str | Column) -> Column:
    return F.size(F.split(_c(cl), SEP))


def zero_padded(rank: str | Column, width: str | Column) -> Column:
    """Rank as text, left-padded with zeros to ``width`` characters."""
    return F.lpad(_c(rank).cast("string"), _c(width), "0")


def cluster_file_name(rank: str | Column, width: str | Column, stem: str,
                      top: str | Column) -> Column:
    """``<zero padded rank>_<stem>_cluster-<top>.txt``."""
    return F.concat(zero_padded(rank, width), F.lit(f"_{stem}_cluster-"),
                    _c(top).cast("string"), F.lit(".txt"))
