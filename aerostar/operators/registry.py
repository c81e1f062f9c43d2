"""Surrogate keys that stay.

``dense_key`` numbers the members of one table; numbered again with more
members, the old ones move, and rows that hold their keys name other members.
Here the members that have keys are a table that only grows: new members are
those an anti-join finds missing from it, and they are numbered on from the last
key given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.operators.joins import fits_broadcast
from aerostar.operators.keys import dense_key


def new_members(members: DataFrame, known: DataFrame | None, natural: Sequence[str]) -> DataFrame:
    """Distinct members (null is one) that ``known`` lacks."""
    found = members.select(*natural).distinct()
    if known is None:
        return found
    held = known.select(*[F.col(c).alias(f"__known_{c}") for c in natural])
    if fits_broadcast(held):
        held = F.broadcast(held)
    same = [F.col(c).eqNullSafe(F.col(f"__known_{c}")) for c in natural]
    return found.join(held, same, "left_anti")


def extend_keys(members: DataFrame, known: DataFrame | None, natural: Sequence[str], key: str,
                last: int | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """The new members, keyed last + 1, last + 2, ... in the order of their
    natural columns. ``last``: the last key given; without it the greatest key
    in ``known`` (0 where there is none). ``known`` itself is never changed:
    append the result to it."""
    if last is None:
        last = 0 if known is None else known.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    return dense_key(new_members(members, known, natural), list(order or natural), key, start=last + 1)
