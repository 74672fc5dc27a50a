"""Mixing sources to target weights: hierarchical token budgets and seeded epochs.

The tree is domain, language, source. A node's budget goes to its children by weight; what a
child cannot supply (its tokens times ``max_epochs``) goes to its siblings by weight, and only
what no sibling can take reaches the level above. With the supply of a whole subtree as a child's
limit, this is one water level per parent, found from the top by running sums over the children.

A leaf's budget is ``full`` whole epochs and the rest as a prefix of the next epoch, whose order
is the hash of (seed, epoch, row). The place where the prefix ends is narrowed down by sums over
hash ranges, twice, so that only the rows of a tiny range are sorted, whatever the leaf holds; the
last row is cut at the token.

Defined results: null level values are nodes of their own, written ``(none)``; texts without
words are never selected; nodes without a weight weigh 1; negative weights are refused; equal
rows stand next to each other in an epoch; input columns named like the added ones are replaced,
all others come out as they went in, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kpiweave.llm.common import stored, text_key

LEVELS = ("domain", "lang", "source")
BITS = 10  # of the hash, in each of two steps
NONE = "(none)"
Weights = Mapping[tuple[str, ...], float]


def token_count(text: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.size(F.filter(parts, lambda p: p != "")).cast("bigint")


def _weight_of(weights: Weights, levels: Sequence[str]) -> Column:
    """The weight of the node that ``levels`` name; 1 if none is given."""
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    known = {p: w for p, w in weights.items() if len(p) == len(levels)}
    if not known:
        return F.lit(1.0)
    path = F.to_json(F.array(*levels))
    pairs = [F.lit(x) for p, w in known.items() for x in (_json(p), float(w))]
    return F.coalesce(F.create_map(*pairs)[path], F.lit(1.0))


def _json(path: tuple[str, ...]) -> str:
    return json.dumps(list(path), ensure_ascii=False, separators=(",", ":"))


def _share_out(nodes: DataFrame, parents: Sequence[str], me: Sequence[str]) -> DataFrame:
    """Adds ``budget`` from ``parent_budget``, ``weight`` and ``supply`` by a water level: a
    child gets ``min(supply, level * weight)``."""
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col("weight") > 0, F.col("supply") / F.col("weight"))
    rising = by.orderBy(ratio.asc_nulls_last(), *me)
    below = rising.rowsBetween(Window.unboundedPreceding, -1)
    above = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weighed = F.when(F.col("weight") > 0, F.col("supply")).otherwise(0.0)
    left = F.col("parent_budget") - F.coalesce(F.sum(weighed).over(below), F.lit(0.0))
    level = left / F.sum("weight").over(above)
    fits = ratio <= level  # the children up to the last that fits are used up
    staged = nodes.withColumn("_level", F.when(F.col("weight") > 0, level)).withColumn(
        "_fits", F.coalesce(fits, F.lit(False))
    )
    water = F.max(F.when(~F.col("_fits"), F.col("_level"))).over(by)
    got = F.when(F.col("_fits"), F.col("supply")).otherwise(water * F.col("weight"))
    budget = F.when(F.col("weight") > 0, F.least("supply", F.greatest(got, F.lit(0.0))))
    return staged.withColumn("budget", F.coalesce(budget, F.lit(0.0))).drop("_level", "_fits")


def leaf_budgets(
    leaves: DataFrame, weights: Weights, budget: float, max_epochs: int,
    levels: Sequence[str] = LEVELS,
) -> DataFrame:
    """``leaves`` (the levels and tokens) with ``quota``, the tokens each may give. Works on
    one row per leaf of the tree."""
    nodes = leaves.withColumn("supply", F.col("tokens").cast("double") * max_epochs)
    # Fewer tokens than weight zero allows are not supply of the subtree.
    alive = F.lit(1.0)
    for depth in range(1, len(levels) + 1):
        name = f"_w{depth}"
        nodes = nodes.withColumn(name, _weight_of(weights, levels[:depth]))
        alive = alive * F.when(F.col(name) > 0, 1.0).otherwise(0.0)
    nodes = nodes.withColumn("supply", F.col("supply") * alive).withColumn("budget", F.lit(float(budget)))
    for depth in range(1, len(levels) + 1):
        me, parents = list(levels[:depth]), list(levels[: depth - 1])
        top = nodes.groupBy(*me).agg(
            F.sum("supply").alias("supply"),
            F.max(f"_w{depth}").alias("weight"),
            F.max("budget").alias("parent_budget"),
        )
        shared = _share_out(top, parents, me).select(*me, F.col("budget").alias("_budget"))
        nodes = nodes.join(shared, me).withColumn("budget", F.col("_budget")).drop("_budget")
    quota = F.round(F.col("budget")).cast("bigint").alias("quota")
    return nodes.select(*levels, "tokens", quota)


def _ends(rows: DataFrame, leaf: list[str], step: str, need: str) -> DataFrame:
    """Per leaf, the hash range in which its prefix ends and what is still needed there."""
    sums = rows.groupBy(*leaf, step, need).agg(F.sum("n").alias("t"))
    before = Window.partitionBy(*leaf).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    reached = sums.withColumn("before", F.coalesce(F.sum("t").over(before), F.lit(0)))
    inside = (F.col("before") < F.col(need)) & (F.col(need) <= F.col("before") + F.col("t"))
    return reached.where(inside).select(*leaf, F.col(step).alias(f"{step}_end"), (F.col(need) - F.col("before")).alias(f"{need}_next"))


def mix(
    documents: DataFrame, weights: Weights, share: float, max_epochs: int = 2, seed: int = 17,
    domain: Column | None = None,
) -> DataFrame:
    """The selected ``documents`` with domain, n_tokens, full_epochs and prefix_tokens (tokens
    taken from the last, partial epoch). ``share`` of all tokens is the budget."""
    own = domain if domain is not None else F.lit("all")
    made = ("domain", "n_tokens", "full_epochs", "prefix_tokens")
    kept = [c for c in documents.columns if c not in made]

    def level(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit(NONE))

    # The caller's columns get names of their own, so that none can clash with those used here.
    leaf = ["l0", "l1", "l2"]
    rows = documents.select(
        *[F.col(f"`{c}`").alias(f"u{i}") for i, c in enumerate(kept)],
        *[level(v).alias(n) for v, n in zip((own, F.col("lang"), F.col("source")), leaf)],
        F.col("doc_id").alias("id"),
        F.col("text").alias("body"),
        text_key().alias("key"),
    )
    # All that decides about the rows, from one reading of the texts.
    # A filter on the count would count twice; a word's first letter tells as much.
    rows = rows.where(F.col("body").rlike("[^\\x20\\x09-\\x0D]"))
    tokens = rows.select(*leaf, "id", "key", token_count("body").alias("n"))
    narrow = stored(tokens, "token-counts")
    leaves = stored(narrow.groupBy(*leaf).agg(F.sum("n").alias("tokens")), "leaves")
    whole = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    quotas = leaf_budgets(leaves, weights, whole * share, max_epochs, leaf)
    epochs = F.floor(F.col("quota") / F.col("tokens")).cast("int").alias("epochs")
    plan = quotas.select(*leaf, epochs, (F.col("quota") % F.col("tokens")).alias("need"))
    plan = stored(plan, "quotas")

    place = F.xxhash64(F.lit(seed), "epochs", "id", "key")
    high = F.shiftrightunsigned("place", 64 - BITS)
    low = F.shiftrightunsigned("place", 64 - 2 * BITS).bitwiseAND((1 << BITS) - 1)

    def placed(df: DataFrame, ends: DataFrame) -> DataFrame:
        found = df.join(ends, leaf).withColumn("place", place)
        return found.withColumns({"a": high, "b": low})

    spread = placed(narrow, plan)
    first = stored(_ends(spread, leaf, "a", "need"), "first-range")
    in_first = spread.join(first, leaf).where("a = a_end")
    second = stored(_ends(in_first, leaf, "b", "need_next"), "second-range")
    ends = stored(plan.join(first, leaf, "left").join(second, leaf, "left").drop("need"), "ends")

    bounded = placed(rows, ends)
    none = F.lit(False)
    sure = (F.col("a") < F.col("a_end")) | ((F.col("a") == F.col("a_end")) & (F.col("b") < F.col("b_end")))
    edge = (F.col("a") == F.col("a_end")) & (F.col("b") == F.col("b_end"))
    bounded = bounded.withColumns({"sure": F.coalesce(sure, none), "edge": F.coalesce(edge, none)})
    counted = token_count("body")
    # Words are counted again for the rows that are chosen, and for the few at an edge.
    plain = bounded.where("NOT edge AND (epochs > 0 OR sure)").withColumn("n", counted)
    taken = F.when(F.col("sure"), F.col("n")).otherwise(F.lit(0))
    plain = plain.withColumn("taken", taken.cast("bigint"))
    order = Window.partitionBy(*leaf).orderBy("place", "id", "key")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    most = F.greatest(F.col("need_next_next") - F.coalesce(upto, F.lit(0)), F.lit(0))
    cut = bounded.where("edge").withColumn("n", counted)
    cut = cut.withColumn("taken", F.least("n", most).cast("bigint"))
    chosen = plain.unionByName(cut.where("epochs > 0 OR taken > 0"))
    names = zip(("l0", "n", "epochs", "taken"), made)
    return chosen.select(
        *[F.col(f"u{i}").alias(c) for i, c in enumerate(kept)],
        *[F.col(a).alias(b) for a, b in names],
    )


#: The tree of the registered queries: sources fall into four domains.
DOMAIN_COUNT = 4
SHARE = 0.5
WEIGHTS: Weights = {
    ("d0",): 4.0,
    ("d1",): 3.0,
    ("d2",): 2.0,
    ("d3",): 1.0,
    **{(f"d{i}", "en"): 5.0 for i in range(4)},
    **{(f"d{i}", lang): 2.0 for i in range(4) for lang in ("de", "fr", "es")},
}


def source_domain(source: str = "source") -> Column:
    text = F.coalesce(F.col(source).cast("string"), F.lit(NONE))
    return F.concat(F.lit("d"), (F.crc32(text.cast("binary")) % DOMAIN_COUNT).cast("string"))


def production_mix(documents: DataFrame) -> DataFrame:
    return mix(documents, WEIGHTS, SHARE, domain=source_domain())
