"""Column-name hygiene shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def make_room(df: DataFrame, outputs: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Rename input columns so that ``outputs`` can be added without a clash.

    An input column whose name equals an output's (case aside) comes out as ``<name>_input`` (with more ``_input``
    appended while that is taken as well). Of several input columns with one name the first keeps it. Names in
    ``keep`` are the operator's own inputs: they stay untouched.
    """
    keep_set, taken = set(keep), {o.lower() for o in outputs}
    kept = {k.lower() for k in keep_set}
    names, seen = [], set()
    for name in df.columns:
        new = name
        if name in keep_set and name.lower() not in seen:
            seen.add(name.lower())
            names.append(name)
            continue
        while new.lower() in taken or new.lower() in seen or (new.lower() in kept):
            new += "_input"
        seen.add(new.lower())
        names.append(new)
    return df.toDF(*names) if names != df.columns else df


def fenced(df: DataFrame, **made: Column) -> DataFrame:
    """``df`` with the columns ``made``, computed once: each comes out of a generator, so the optimizer can't copy
    their expressions into filters and projections above. For costly nested expressions that are used several times."""
    taken = {k.lower() for k in made}
    kept = [c for c in df.columns if c.lower() not in taken]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))
