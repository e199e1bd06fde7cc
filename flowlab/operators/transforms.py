"""Stateless row operators: prefix filter (P7), equality filter (P8),
conditional step (P9), ratio (P10), typed split into branches (P11),
tagging a row with one of its fields (P5) and pairing with 1 (P6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.functions.parse import _regex_literal


def prefix_filter(df: DataFrame, col: str, prefix) -> DataFrame:
    """Keep rows whose ``col`` starts with ``prefix`` (case-sensitive).
    A list of prefixes keeps rows matching any of them."""
    prefixes = [prefix] if isinstance(prefix, str) else list(prefix)
    cond = None
    for p in prefixes:
        c = F.col(col).startswith(p)
        cond = c if cond is None else (cond | c)
    return df.filter(cond)


def pair_one(df: DataFrame, col: str, name: str = "one") -> DataFrame:
    """``word -> (word, 1)``."""
    return df.select(F.col(col), F.lit(1).alias(name))


def tag_field(df: DataFrame, line_col: str, index: int, name: str, sep: str = ",") -> DataFrame:
    """P5: tag a line with one of its fields, keeping the whole line."""
    return df.withColumn(name, F.split(F.col(line_col), _regex_literal(sep), -1).getItem(index))


def conditional_step(done: Column, step: dict[str, Column]):
    """Column expressions ``when(done, col).otherwise(step[col])``."""
    return [F.when(done, F.col(c)).otherwise(e).alias(c) for c, e in step.items()]


def ratio(num, den, name: str = "ratio") -> Column:
    """P10: ``num * 1.0 / den`` as a double."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return (n.cast("double") / d).alias(name)


def split_by(df: DataFrame, branches: dict[str, Column], cast: dict[str, dict[str, str]] | None = None,
             persist: bool = False) -> dict[str, DataFrame]:
    """Named branches of one parent, each with its own filter (and its
    own column types through ``cast``).  ``main`` is the unchanged parent.

    With several sinks reading the branches, ``persist=True`` keeps the
    parent from being recomputed once per branch."""
    parent = df.persist() if persist else df
    out = {"main": parent}
    for name, cond in branches.items():
        branch = parent.filter(cond)
        for c, t in (cast or {}).get(name, {}).items():
            branch = branch.withColumn(c, F.col(c).cast(t))
        out[name] = branch
    return out


def parity_split(df: DataFrame, col: str) -> dict[str, DataFrame]:
    """The reference's split: all rows as int in ``main``, evens as strings,
    odds as ints.  ``%`` keeps the dividend's sign, so negative odds are odd."""
    return split_by(df, {"even": F.col(col) % 2 == 0, "odd": F.col(col) % 2 != 0},
                    cast={"even": {col: "string"}})


def tag_branches(df: DataFrame, branches: dict[str, Column], main: str | None = "main",
                 name: str = "branch") -> DataFrame:
    """P11 as one tagged output: every row once per branch it belongs to
    (plus once as ``main``), in a single pass over ``df`` (an ``explode`` of
    the matching tags) instead of one scan per branch."""
    tags = ([F.lit(main)] if main else []) + [F.when(cond, F.lit(b)) for b, cond in branches.items()]
    return df.withColumn(name, F.explode(F.array_compact(F.array(*tags))))
