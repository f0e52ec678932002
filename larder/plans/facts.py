"""Fact tables: orders against plan, rotation, compliancy, combinations, hierarchies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.arrays import has_intersection
from larder.functions.keys import surrogate_key
from larder.operators.aggregates import combination_id
from larder.operators.joins import as_of
from larder.operators.projections import band


def order_fact(
    lines: DataFrame, plan: DataFrame, orders: DataFrame, analysis_from: Column, plans_from: Column
) -> DataFrame:
    """Ordered against planned items.

    ``lines``: order, item, quantity, amount (one row per order and item).  ``plan``: order, item, planned_quantity.
    ``orders``: order, customer, menu_week, is_subscription.  An item only in the plan becomes a GENERATED line.
    Added, removed, swap and adjustment are known for subscription orders of menu weeks from ``analysis_from`` on and
    are NULL elsewhere.  From ``plans_from`` on every such order has a plan; one without is not a swap.
    """
    j = lines.join(plan, ["order", "item"], "full").join(orders, "order", "left")
    ordered, planned = F.col("quantity").isNotNull(), F.col("planned_quantity").isNotNull()
    counts = F.col("is_subscription") & (F.col("menu_week") >= analysis_from)
    fact = j.select(
        "order",
        "menu_week",
        counts.alias("counts"),
        "customer",
        "item",
        "quantity",
        "planned_quantity",
        "amount",
        F.when(ordered, "ORDERED").otherwise("GENERATED").alias("line_type"),
        F.when(counts, (ordered & ~planned).cast("int")).alias("added"),
        F.when(counts, (planned & ~ordered).cast("int")).alias("removed"),
        (ordered & (F.col("amount") > 0)).alias("is_plus_price"),
        (ordered & (F.col("amount") < 0)).alias("is_thrifty"),
        surrogate_key("order", "item").alias("pk_order_line"),
        surrogate_key("customer").alias("fk_customer"),
    )
    per_order = fact.groupBy("order", "menu_week", "counts").agg(
        F.sum("added").alias("n_added"),
        F.sum("removed").alias("n_removed"),
        F.count("quantity").alias("meals"),
        F.count("planned_quantity").alias("meals_planned"),
        F.sum("quantity").alias("portions"),
        F.sum("planned_quantity").alias("portions_planned"),
    )
    moved = F.col("n_added") + F.col("n_removed")
    flags = per_order.select(
        "order",
        F.when(F.col("counts") & (F.col("meals_planned") == 0) & (F.col("menu_week") >= plans_from), False)
        .when(F.col("counts"), F.coalesce(moved != F.abs(F.col("meals") - F.col("meals_planned")), F.lit(False)))
        .alias("has_swap"),
        F.when(F.col("counts"), F.coalesce((moved != 0) | (F.col("portions") != F.col("portions_planned")), F.lit(False))).alias("is_adjusted"),
    )
    return fact.drop("menu_week", "counts").join(flags, "order")


def rotation_scores(
    outputs: DataFrame, dishes: DataFrame, versions: DataFrame, version_items: DataFrame, weeks_back: int = 6,
    weeks_ahead: int = 0,
) -> DataFrame:
    """How little the dishes of an output repeat dishes of the customer's other recent weeks.

    ``outputs``: output, customer, monday, created_at.  ``dishes``: output, item, ingredient.
    ``versions``: customer, monday, version, created_at.  ``version_items``: version, item.
    Of every other week within the window the newest version known one minute after the output counts.
    Per output: weeks compared, mean repeat share, rotation and ingredient-variation scores with their bands.
    """
    offsets = [o for o in range(-weeks_back, weeks_ahead + 1) if o]
    known = (F.col("created_at") + F.expr("interval 1 minute")).alias("known_at")
    pairs = outputs.select(
        "output",
        "customer",
        known,
        F.explode(F.array(*[F.date_add("monday", 7 * o) for o in offsets])).alias("monday"),
    )
    v = versions.select("customer", "monday", "version", F.col("created_at").alias("v_at"))
    latest = as_of(pairs, v, ["customer", "monday"], "known_at", "v_at", "m", tie="version")
    latest = latest.where("m is not null").select("output", "monday", F.col("m.version").alias("version"))
    window = latest.groupBy("output").agg(F.count("*").alias("week_window"))
    # Output and version meet on the item: a version's items only pair with the same item of the output.
    seen = (
        latest.join(version_items.distinct(), "version")
        .join(dishes.select("output", "item").distinct(), ["output", "item"])
        .groupBy("output", "item")
        .agg(F.count("*").alias("repeat_weeks"))
    )
    per_dish = dishes.join(seen, ["output", "item"], "left").join(window, "output", "left")
    share = F.coalesce(F.try_divide(F.coalesce("repeat_weeks", F.lit(0)), "week_window"), F.lit(0.0))
    by_ingredient = per_dish.groupBy("output", "ingredient").agg(
        F.sum(share).alias("s"), F.count("*").alias("n"), F.max("week_window").alias("w")
    )
    scores = by_ingredient.groupBy("output").agg(
        F.coalesce(F.max("w"), F.lit(0)).alias("week_window"),
        (1 - F.sum("s") / F.sum("n")).alias("rotation_score"),
        (F.count("ingredient") / F.sum("n")).alias("variation_score"),
    )
    labels = ["Very High", "High", "Medium", "Low", "Very Low"]
    # Lower bounds of the score bands.
    rotation, r_order = band(F.round("rotation_score", 9), [1.0, 0.9, 0.8, 0.6], labels)
    variation, v_order = band(F.round("variation_score", 9), [1.0, 0.75, 0.6, 0.5], labels)
    both = F.col("rotation_score") * F.col("variation_score")
    combined, c_order = band(F.round(both, 9), [1.0, 0.8, 0.6, 0.4], labels)
    return scores.select(
        "*",
        rotation.alias("rotation_group"),
        (r_order + 1).alias("rotation_group_number"),
        variation.alias("variation_group"),
        (v_order + 1).alias("variation_group_number"),
        both.alias("combined_score"),
        combined.alias("combined_group"),
        (c_order + 1).alias("combined_group_number"),
    )


def compliancy(customers: DataFrame, menu: DataFrame, on: Sequence[str]) -> DataFrame:
    """Menu items of a customer's company and week, graded by preferences.

    Both sides carry ``allergens``, ``tastes`` and ``concepts`` lists.  1: an allergen is shared; 2: a taste is shared
    or no concept is; 3: neither.  Pairs form within one menu only, whose length is what a menu offers.
    """
    lists = ("allergens", "tastes", "concepts")
    c = customers.select(*on, "customer", *[F.col(x).alias(f"c_{x}") for x in lists])
    m = menu.select(*on, "item", *[F.col(x).alias(f"m_{x}") for x in lists])
    shares = {x: has_intersection(F.col(f"c_{x}"), F.col(f"m_{x}")) for x in lists}
    level = F.when(shares["allergens"], 1).when(shares["tastes"] | ~shares["concepts"], 2).otherwise(3)
    return c.join(m, list(on)).select(*on, "customer", "item", level.alias("compliancy"))


def combination_dim(sets: DataFrame, key: str, value: str, types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dimension of distinct combinations, bridge to their members).

    ``types``: value, name, type.  The dimension lists members by type and counts them.
    """
    combos = combination_id(sets, [key], value).select("combination_id", "members").distinct()
    bridge = combos.select("combination_id", F.explode("members").alias(value))
    typed = bridge.join(types, value, "left")
    members = lambda kind: F.array_join(
        F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.col("name")))), ", "
    ).alias(f"{kind}_names")
    dim = typed.groupBy("combination_id").agg(
        *[members(k) for k in ("allergen", "taste", "concept")],
        F.count("*").alias("n_members"),
        F.count(F.when(F.col("type") == "allergen", 1)).alias("n_allergens"),
    )
    return dim, bridge


def flatten_hierarchy(
    leaves: DataFrame, leaf: str, start: str, categories: DataFrame, levels: int = 10
) -> DataFrame:
    """Ancestors of each leaf in long form: level 0 is its own category; more than ``levels`` in all are an error.

    ``categories``: category, parent.  The category table is a small dimension, joined once per level onto one wide
    row per category, so the leaves are joined once.
    """
    chain = categories.select(F.col("category").alias("c0"), F.col("parent").alias("c1"))
    for i in range(1, levels):
        up = categories.select(F.col("category").alias(f"c{i}"), F.col("parent").alias(f"c{i + 1}"))
        chain = chain.join(up, f"c{i}", "left")
    rungs = [
        F.struct(F.lit(i).alias("level"), F.col(f"c{i}").alias("category"), F.col(f"c{i + 1}").alias("parent"))
        for i in range(levels)
    ]
    above = categories.select(F.col("category").alias(f"c{levels}"), F.lit(True).alias("deeper"))
    found = F.filter(F.array(*rungs), lambda r: r["category"].isNotNull())
    too_deep = F.raise_error(F.lit(f"hierarchy deeper than {levels}"))
    wide = chain.join(above, f"c{levels}", "left").select("c0", F.when(F.col("deeper").isNull(), found).otherwise(too_deep).alias("up"))
    return (
        leaves.join(wide, leaves[start] == F.col("c0"), "left")
        .select(leaf, F.explode("up").alias("r"))
        .select(leaf, "r.*")
    )


def hierarchy_roots(categories: DataFrame, max_depth: int = 16) -> DataFrame:
    """Root of every category; a chain longer than ``max_depth`` is an error, not a wrong root."""
    out = categories.select("category", F.col("category").alias("root"), F.col("parent").alias("next"))
    up = categories.select(F.col("category").alias("__c"), F.col("parent").alias("__p"))
    for _ in range(max_depth - 1):
        out = out.join(up, F.col("next") == F.col("__c"), "left").select(
            "category", F.coalesce("__c", "root").alias("root"), F.col("__p").alias("next")
        )
    return out.select(
        "category",
        F.when(F.col("next").isNull(), F.col("root"))
        .otherwise(F.raise_error(F.lit(f"hierarchy deeper than {max_depth}")).cast("string"))
        .alias("root"),
    )
