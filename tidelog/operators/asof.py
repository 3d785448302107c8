"""Point-in-time join of facts to the dimension version valid at their instant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.skew import HOT_ROWS, hot_keys, mark_slices

_VERSION, _FACT = 0, 1


def asof_versions(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    take: list[str],
    hot_rows: int = HOT_ROWS,
    closed: bool = False,
) -> DataFrame:
    """Left join: each fact gets ``take`` of the version with valid_from <= at < valid_to.

    The intervals of one key must not overlap (zero-length ones never match).
    Versions and facts of a key are sorted together once and the last version
    seen is carried forward: linear in their number, where a range join would
    test every version of a key against every fact of it.  Facts without a key
    match nothing and skip the shuffle.

    With ``closed`` the end belongs to the interval too: a fact also matches,
    with a row of its own, every version that ends at its very instant.  Where no key
    is hot those are seen in the same window; else they are joined by key, instant and
    slice, and repeated for the slices that hold facts of their instant.
    """
    payload = [c for c in facts.columns if c != key]
    taken = f"struct({', '.join(take)})"
    versions = versions.filter(f"{key} is not null")
    rows = versions.filter("valid_from < valid_to").selectExpr(
        key, "valid_from as _at", f"{_VERSION} as _lane", f"struct(valid_from, valid_to, {taken} as taken) as _version"
    ).unionByName(
        facts.filter(f"{key} is not null").selectExpr(
            key, f"{at} as _at", f"{_FACT} as _lane", f"struct({', '.join(payload)}) as _fact"
        ),
        allowMissingColumns=True,
    )
    hot = hot_keys(rows, key, hot_rows)
    in_window = closed and hot.n == 0
    ends = versions.selectExpr(key, "valid_to as _at", f"{taken} as _ended")
    if in_window:
        rows = rows.unionByName(ends.withColumn("_lane", F.lit(_VERSION)), allowMissingColumns=True)
    marked = mark_slices(rows, key, ["_at", "_lane"], hot_rows, hot=hot)

    # border rows of hot keys: the version in force when a slice begins
    in_force = f"max(_version) over (partition by {key} order by _slice rows between unbounded preceding and 1 preceding)"
    carried = (
        marked.filter("_hot_n is not null").groupBy(key, "_slice").agg(F.expr("max(_version) as _version"))
        .selectExpr(key, "_slice", f"{in_force} as _version")
        .filter("_version is not null")
        .selectExpr("*", "_version.valid_from as _at", f"{_VERSION} as _lane")
    )
    both = marked.drop("_hot_n").unionByName(carried, allowMissingColumns=True)
    last = f"last(_version, true) over (partition by {key}, _slice order by _at, _lane rows unbounded preceding)"
    same_instant = f"over (partition by {key}, _slice order by _at range between current row and current row)"
    seen = both.selectExpr(
        key, "_at", "_lane", "_slice", "_fact", f"{last} as _version",
        *([f"collect_list(_ended) {same_instant} as _ended"] if in_window else []),
    ).filter(f"_lane = {_FACT}")
    match = "if(_at < _version.valid_to, _version.taken, null)"
    if in_window:
        match = f"explode_outer(array_compact(concat(array({match}), _ended)))"
    elif closed:
        seen = _with_ends(seen.withColumn("_match", F.expr(match)), ends, marked, key)
        match = "_match"
    matched = seen.selectExpr(key, "_fact", f"{match} as _match").selectExpr(
        key, *[f"_fact.{c}" for c in payload], *[f"_match.{c}" for c in take]
    )
    return matched.unionByName(facts.filter(f"{key} is null"), allowMissingColumns=True)


def _with_ends(seen: DataFrame, ends: DataFrame, marked: DataFrame, key: str) -> DataFrame:
    """Facts with their match in one row, if they have one, and each version that ends at their instant in another."""
    places = marked.filter(f"_lane = {_FACT}").select(key, "_at", "_slice").distinct()
    placed = ends.join(places, [key, "_at"]).withColumn("_half", F.lit(False))
    halves = seen.withColumn("_half", F.explode(F.array(F.lit(True), F.lit(False))))
    joined = halves.join(placed, [key, "_at", "_slice", "_half"], "left")
    shown = joined.filter("if(_half, _match is not null, _ended is not null or _match is null)")
    return shown.withColumn("_match", F.expr("if(_half, _match, _ended)"))
