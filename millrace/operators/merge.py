"""The keyed merge (upsert) as a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import Columns, quoted

ACTION = "_merge_action"

# What a merge can do with a row.
MERGE_ACTIONS = ("keep", "update", "insert")

_HIT = "_merge_hit"


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with the spelling, order and types its columns have in ``target``."""
    own, given = Columns(target), Columns(source)
    unknown = [c for c in given.names if own.find(c) is None]
    if unknown:
        raise ValueError(f"merge source has columns the target lacks: {unknown}")
    types = {field.name: field.dataType.simpleString() for field in target.schema}
    shared = [(c, given.find(c)) for c in own.names if given.find(c) is not None]
    return source.selectExpr(*[f"CAST({quoted(g)} AS {types[c]}) AS {quoted(c)}" for c, g in shared])


def merge_frames(
    target: DataFrame, source: DataFrame, keys: Sequence[str], found: DataFrame | None = None
) -> DataFrame:
    """``target`` after the merge, with ``_merge_action`` = keep, update or insert.

    A target row whose key is in ``source`` takes every source column; target
    columns the source lacks keep their value. Source rows without a match are
    inserted. A NULL in a key never matches. ``source`` must not repeat a key (see
    :func:`repeated_key`), and gives the same rows whenever it is evaluated. A caller
    that already has the keys of ``source`` that ``target`` holds gives them as
    ``found``; the target is then read once.

    Matched rows come from a left join and inserts from an anti-join against the
    keys found, rather than from one full outer join: a source that measures
    small is then broadcast and the target is never shuffled, and with a large
    source AQE can split a hot target key, which it cannot do in a full outer join.
    """
    source = conform(source, target)
    keys = Columns(target).require(keys)
    Columns(source).require(keys)
    shared = source.columns
    updated = [c for c in shared if c not in keys]

    incoming = source.selectExpr(*[f"{quoted(c)} AS {_arriving(c)}" for c in shared])
    match = F.expr(key_match(keys))
    if updated:
        taken = {c: f"CASE WHEN {_HIT} THEN {_arriving(c)} ELSE {quoted(c)} END AS {quoted(c)}" for c in updated}
        present = target.join(incoming.withColumn(_HIT, F.lit(True)), match, "left").selectExpr(
            *[taken.get(c, quoted(c)) for c in target.columns],
            f"CASE WHEN {_HIT} THEN 'update' ELSE 'keep' END AS {ACTION}",
        )
    else:
        present = target.withColumn(ACTION, F.lit("keep"))

    if found is None:
        found = matched_keys(target, source, keys).distinct()
    given = {c: f"{_arriving(c)} AS {quoted(c)}" for c in shared}
    absent = {f.name: f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in target.schema}
    inserted = incoming.join(found, match, "left_anti").selectExpr(
        *[given.get(c, absent[c]) for c in target.columns], f"'insert' AS {ACTION}"
    )
    return present.unionByName(inserted)


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """Keys, and other columns, of the target rows whose key is in ``source``; a row for each target row."""
    columns = [*keys, *[c for c in also if c not in keys]]
    wanted = arriving_keys(source, keys)
    return target.select(*map(quoted, columns)).join(wanted, F.expr(key_match(keys)), "left_semi")


def arriving_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key columns of a merge source, named as :func:`key_match` expects."""
    return source.selectExpr(*[f"{quoted(k)} AS {_arriving(k)}" for k in keys])


def key_match(keys: Sequence[str]) -> str:
    """The condition under which an arriving row belongs to a target row."""
    return " AND ".join(f"{quoted(k)} = {_arriving(k)}" for k in keys)


def repeated_key(source: DataFrame, keys: Sequence[str]) -> dict | None:
    """One key the source holds more than once, or None. Runs one job.

    Keys with a NULL in them are left out, since they match nothing.
    """
    keys = [quoted(k) for k in Columns(source).require(keys)]
    complete = source.select(*keys).dropna()
    repeated = complete.groupBy(*keys).count().where("count > 1").drop("count").limit(1).collect()
    return repeated[0].asDict() if repeated else None


def _arriving(column: str) -> str:
    return quoted(f"_in_{column}")
