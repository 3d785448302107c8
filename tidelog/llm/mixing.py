"""Mixing sources to target weights by hierarchical budgets.

Documents hang in a tree, for instance domain, language, source.  A token budget
goes down the tree: each node's children share it by their weights, and none gets
more than its documents can give in ``max_epochs`` passes.  What one child cannot
use goes to its siblings first, since a node's own limit is the sum of its
children's; only what all of them cannot use goes to the siblings of their
ancestors.  A leaf then reads its documents in seeded order, epoch after epoch,
until its budget is used: whole epochs, and of the next one the prefix of documents
that begin before the budget ends.

Null levels form a node of their own, named ''.  Null texts have no tokens.  A
document without tokens is taken if its place lies in the prefix; a leaf without
tokens gives nothing.  Rows with one id (null: the empty id) have one place and are
taken together.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

WORDS = r"[^\x20\x09-\x0D]+"
SEED, MAX_EPOCHS, BUDGET_SHARE = 11, 2, 1.0


def _path(levels: int) -> list[str]:
    return [f"_l{i}" for i in range(levels)]


def shared_out(children: DataFrame, parent: list[str]) -> DataFrame:
    """Add ``_given`` to rows of ``_limit`` and ``_weight``: their parts of ``_budget``, which is the same for a ``parent``.

    Children in the order of limit per weight are full as long as the rest of the
    budget, dealt by weight over the rest of the children, covers their limit.
    The others share what is left, rounded down to whole tokens.
    """
    order = Window.partitionBy(*parent).orderBy(F.expr("_limit / _weight"), "_name").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    rows = (
        children.withColumn("_rest", F.expr("double(_budget)") - F.coalesce(F.sum("_limit").over(order), F.lit(0)).cast("double"))
        .withColumn("_others", (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(order), F.lit(0))).cast("double"))
        .withColumn("_full", F.expr("double(_limit) * _others <= _rest * double(_weight)"))
        .withColumn("_level", F.max(F.expr("if(_full, null, _rest / _others)")).over(whole))
    )
    given = "if(_full, _limit, least(_limit, bigint(floor(greatest(_level, 0D) * _weight))))"
    return rows.withColumn("_given", F.expr(given)).drop("_rest", "_others", "_full", "_level")


def budgets(leaves: DataFrame, levels: int, weights: dict[tuple[str, ...], int], share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``_given`` tokens for each leaf of ``_l0 ..`` and ``_tokens``; weights are positive, 1 where a path is not named.

    Works on one row for each leaf; each level is one window over the children of a node.
    """
    path = _path(levels)
    known = leaves.withColumn("_limit", F.col("_tokens") * max_epochs)
    total = leaves.agg(F.floor(F.coalesce(F.sum("_tokens"), F.lit(0)) * F.lit(share)).cast("bigint").alias("_budget"))
    parents = None
    for depth in range(1, levels + 1):
        nodes = known.groupBy(*path[:depth]).agg(F.sum("_limit").alias("_limit"), F.sum("_tokens").alias("_tokens"))
        named = {p: w for p, w in weights.items() if len(p) == depth}
        weight = F.lit(1).cast("bigint")
        for names, value in sorted(named.items()):
            matches = F.lit(True)
            for level, name in zip(path, names):
                matches = matches & (F.col(level) == name)
            weight = F.when(matches, F.lit(value).cast("bigint")).otherwise(weight)
        nodes = nodes.withColumn("_weight", weight).withColumn("_name", F.col(path[depth - 1]))
        # the root budget is one row
        nodes = nodes.crossJoin(F.broadcast(total)) if parents is None else nodes.join(parents, path[: depth - 1])
        nodes = shared_out(nodes, path[: depth - 1])
        parents = nodes.select(*path[:depth], F.col("_given").alias("_budget"))
    return nodes.select(*path, "_tokens", "_given")


def mix(
    documents: DataFrame,
    levels: list,
    weights: dict[tuple[str, ...], int] | None = None,
    text: str = "text",
    id_: str = "doc_id",
    seed: int = SEED,
    share: float = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """One row for each time a document is taken: struct ``_doc`` of its columns, ``_epoch``, ``_n_tokens``, and ``_l0 ..``.

    ``levels`` are column expressions from the root down.  The end of a leaf's
    prefix is found as one order key: running sums are taken per slice of 4,096
    slices of a leaf, so a leaf holding a third of the rows is dealt over all tasks.
    Texts are read twice and never shuffled unless leaves are too many to broadcast.
    """
    path = _path(len(levels))
    named = [F.coalesce(level.cast("string"), F.lit("")).alias(p) for p, level in zip(path, levels)]
    place = lambda epoch: F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(F.col(f"_doc.`{id_}`").cast("string"), F.lit(""))).cast("binary"))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_doc"), *named)
    rows = rows.withColumn("_n_tokens", F.coalesce(F.regexp_count(F.col(f"_doc.`{text}`"), F.lit(WORDS)), F.lit(0)).cast("bigint"))
    counted = stored(rows.select(*path, F.col(f"_doc.`{id_}`").alias("_id"), "_n_tokens"), "mixing")
    plan = budgets(counted.groupBy(*path).agg(F.sum("_n_tokens").alias("_tokens")), len(levels), weights or {}, share, max_epochs)
    plan = plan.withColumn("_whole", F.expr("if(_tokens = 0, 0L, _given div _tokens)")).withColumn("_part", F.expr("_given - _whole * _tokens"))
    plan = stored(plan, "mixing-plan")

    placed = counted.join(plan.filter("_part > 0"), path).select(*path, "_n_tokens", "_part", F.struct("_id").alias("_doc"), "_whole")
    if id_ != "_id":
        placed = placed.withColumn("_doc", F.struct(F.col("_doc._id").alias(id_)))
    placed = placed.withColumn("_key", place(F.col("_whole"))).withColumn("_slice", F.substring("_key", 1, 3)).drop("_doc")
    sums = placed.groupBy(*path, "_slice").agg(F.sum("_n_tokens").alias("_n"))
    earlier = Window.partitionBy(*path).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*path, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    slice_ = Window.partitionBy(*path, "_slice")
    within = placed.withColumn("_own", F.sum("_n_tokens").over(Window.partitionBy(*path, "_slice", "_key"))).withColumn(
        "_upto", F.sum("_n_tokens").over(slice_.orderBy("_key"))
    )
    taken = within.join(sums, [*path, "_slice"]).filter("_before + _upto - _own < _part")
    ends = taken.groupBy(*path).agg(F.max("_key").alias("_end"))
    reach = stored(plan.join(ends, path, "left").select(*path, "_whole", "_end"), "mixing-ends")

    chosen = rows.join(reach, path).withColumn("_times", F.expr("int(_whole)") + F.coalesce((place(F.col("_whole")) <= F.col("_end")).cast("int"), F.lit(0)))
    return chosen.filter("_times > 0").select("_doc", "_n_tokens", *path, F.explode(F.expr("sequence(0, _times - 1)")).alias("_epoch"))
