"""Small fixed tables inside expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])


def lookup(key: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """The entry of ``key``; ``default`` (null if not given) where there is none."""
    found = F.try_element_at(fixed_map(table), key) if table else F.lit(None).cast("string")
    return found if default is None else F.coalesce(found, default)


def relabel(key: Column, table: dict[str, str]) -> Column:
    """The entry of ``key``, or ``key`` itself where the table does not name it."""
    return lookup(key, table, key)


def member_of(key: Column, groups: dict[str, list[str]]) -> Column:
    """The first group that lists ``key``."""
    owner: dict[str, str] = {}
    for group, members in groups.items():
        for member in members:
            owner.setdefault(member, group)
    return lookup(key, owner)
