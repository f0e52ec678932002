"""Basket selection: customer vectors, filters, greedy choice, feedback on a menu.

A menu is the set of items one company offers in one week.  Its length is what
a menu holds (some hundred items at most), whatever the number of customers,
so a menu travels as one array value and each customer's choice is a row-local
computation on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.arrays import has_intersection
from larder.functions.dates import recency_score, year_week_diff
from larder.operators.chunked import with_totals
from larder.session import dealt, join_where_dealt


def user_vectors(baskets: DataFrame, customer: str, scalars: Sequence[str], flags: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(target vectors, importance vectors) from basket features.

    Target: the mean of each feature.  Importance of a scalar: 1 / standard deviation (at least 0.005), soft-maxed;
    of a flag: the share of baskets that have it, through a sigmoid that is low around 0.3, normalised.  Each block is
    weighted by its share of the features.  Customers with one basket have no importance vector.
    """
    both = [*scalars, *flags]
    value = lambda c: F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0))
    target = baskets.groupBy(customer).agg(*[F.avg(value(c)).alias(c) for c in both])
    raw = (
        baskets.groupBy(customer)
        .agg(
            F.count("*").alias("__n"),
            *[(1 / F.greatest(F.stddev_samp(value(c)), F.lit(0.005))).alias(c) for c in scalars],
            *[F.avg((F.col(c) > 0).cast("double")).alias(c) for c in flags],
        )
        .where("__n > 1")
    )
    center = 0.3

    def gate(c: str) -> Column:
        low, high = center / 2, (1 - center) / 2
        rising = 1 / (1 + F.exp(-(F.col(c) + low) / (0.1 * low)))
        past = 1 / (1 + F.exp(-(F.col(c) - high - center) / (0.1 * high)))
        return F.when(F.col(c) < center, rising).otherwise(past)

    gated = raw.select(customer, *scalars, *[gate(c).alias(c) for c in flags])
    total = lambda cols: sum((c for c in cols[1:]), cols[0])
    soft = total([F.exp(F.col(c)) for c in scalars])
    plain = total([F.col(c) for c in flags])
    n = len(both)
    importance = gated.select(
        customer,
        *[(F.exp(F.col(c)) / soft * (len(scalars) / n)).alias(c) for c in scalars],
        *[(F.try_divide(F.col(c), plain) * (len(flags) / n)).alias(c) for c in flags],
    )
    return target, importance


def menu_arrays(items: DataFrame, on: Sequence[str], item: str, features: Sequence[str], ingredient: str | None = None) -> DataFrame:
    """One row per menu: its items as an array of (id, feature vector, main ingredient), in id order."""
    ing = F.col(ingredient) if ingredient else F.lit(None).cast("string")
    vec = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    entry = F.struct(F.col(item).alias("id"), vec.alias("x"), ing.alias("ingredient"))
    return items.groupBy(*on).agg(F.array_sort(F.collect_list(entry)).alias("menu"))


def greedy_basket(
    customers: DataFrame, menus: DataFrame, on: Sequence[str], k: Column | int, allowed: Column | None = None,
    repeat_weight: float = 0.0, scale: float = 10.0,
) -> DataFrame:
    """Fill each customer's basket item by item, every time with the item that brings the basket closest to the target.

    ``customers``: ``on``, target and weight vectors.  The basket vector is the mean of its items; the error is
    ``sum((scale * (x - target) * weight)^2)`` with missing terms as 0, plus the share of repeated main ingredients
    (one over the number of different ones) with ``repeat_weight``.  Errors equal to nine decimals tie; ties go to the
    smallest id.  ``allowed`` may
    restrict the menu per customer (a predicate on the menu entry ``i`` built by the caller as a filtered array).
    """
    # The fold is bound by computation, not by bytes: spread the customers evenly over all cores before it.
    spark = customers.sparkSession
    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    j = customers.repartition(spread).join(menus, list(on))
    menu = allowed if allowed is not None else F.col("menu")
    k = k if isinstance(k, Column) else F.lit(k)
    start = F.struct(
        F.transform("target", lambda t: F.lit(0.0)).alias("total"),
        F.array().cast("array<string>").alias("chosen"),
        F.array().cast("array<string>").alias("ingredients"),
        F.lit(0.0).alias("error"),
    )

    def add(state: Column, step: Column) -> Column:
        n = step.cast("double")

        def error(i: Column) -> Column:
            gap = F.zip_with(
                F.zip_with(state["total"], i["x"], lambda s, x: (s + x) / n), F.col("target"), lambda m, t: m - t
            )
            terms = F.zip_with(gap, F.col("weight"), lambda g, w: F.coalesce(F.nanvl(scale * g * w, F.lit(0.0)), F.lit(0.0)))
            base = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t * t)
            if not repeat_weight:
                return base
            kinds = F.size(F.array_distinct(F.array_append(state["ingredients"], i["ingredient"])))
            return base + F.pow(F.lit(scale * repeat_weight) / kinds, F.lit(2))

        left = F.filter("__menu", lambda i: ~F.array_contains(state["chosen"], i["id"]))
        best = F.array_min(
            F.transform(
                left,
                lambda i: F.struct(F.round(error(i), 9).alias("e"), i["id"].alias("id"), i["x"].alias("x"), i["ingredient"].alias("g")),
            )
        )
        # The best entry is bound once: repeating the expression would search the menu again for every field.
        more = F.transform(
            F.array(best),
            lambda b: F.struct(
                F.zip_with(state["total"], b["x"], lambda s, x: s + x).alias("total"),
                F.array_append(state["chosen"], b["id"]).alias("chosen"),
                F.array_append(state["ingredients"], b["g"]).alias("ingredients"),
                b["e"].alias("error"),
            ),
        )[0]
        return F.when(F.size("__menu") >= step, more).otherwise(state)

    rounds = F.sequence(F.lit(1), k)
    filled = j.withColumn("__menu", menu).withColumn("__b", F.aggregate(rounds, start, add))
    return filled.select(*customers.columns, F.col("__b.chosen").alias("basket"), F.col("__b.error").alias("error"))


@dataclass(frozen=True)
class CalorieConcepts:
    """The concepts that decide on calories, and the features they set."""

    low_calorie: object
    vegetarian: object
    points: object
    low_feature: str = "is_low_calorie"
    points_feature: str = "is_roede_percentage"


def _with_sums(df: DataFrame, part: Sequence[str], **aggs: Column) -> DataFrame:
    """Attach totals of a customer's few rows.

    A window, as a total joined back would hold the plan before it twice: some steps on, the plan is too large for the driver.
    """
    return df.withColumns({n: e.over(Window.partitionBy(*part)) for n, e in aggs.items()})


def add_variation(v: DataFrame, groups: Mapping[str, tuple[float, Sequence[str]]], where: Column) -> DataFrame:
    """Variation for customers who ask for none: groups of features whose importances ``i`` are all 0 get a target.

    ``v``: customer, feature, i, t, with a row for every feature of the groups.  ``groups``: name -> (target, features);
    a feature that stands in several takes the last one that is missing.  The missing groups of a customer share an
    importance of 1 evenly, and so do the features within a group; the importances are then made to sum to 1.  Groups
    without a row are not missing.  Rows outside ``where``, a condition on the customer, stay as they are.
    """
    name = lambda group: f"__m_{group}"
    tops = {name(g): F.max(F.when(F.col("feature").isin(list(fs)), F.col("i"))) for g, (_, fs) in groups.items()}
    w = _with_sums(v, ["customer"], **tops)
    missing = {g: where & F.coalesce(F.col(name(g)) == 0, F.lit(False)) for g in groups}
    n = sum((m.cast("int") for m in missing.values()), F.lit(0))
    i, t = F.col("i"), F.col("t")
    for g, (target, features) in groups.items():
        hit = missing[g] & F.col("feature").isin(list(features))
        i = F.when(hit, F.try_divide(F.lit(1.0), n * len(features))).otherwise(i)
        t = F.when(hit, F.lit(float(target))).otherwise(t)
    w = _with_sums(w.withColumns({"i": i, "t": t}), ["customer"], __s=F.sum("i"))
    return w.withColumn("i", F.when(where, F.coalesce(F.try_divide("i", "__s"), F.lit(0.0))).otherwise(F.col("i"))).select(*v.columns)


def calorie_step(v: DataFrame, roles: DataFrame, c: CalorieConcepts, where: Column) -> DataFrame:
    """Sets the calorie features of customers by their concepts (``roles``, see ``calorie_roles``); nothing is renormalised.

    Only the low-calorie concept: that feature has importance and target 1, the points feature stays.  Else the points
    feature has importance 1, with target 1 for its concept and 0 without it; without any of the three concepts
    low-calorie dishes are avoided at importance 0.5.
    """
    only, points, none = F.col("__only"), F.col("__points"), F.col("__none")
    is_low, is_points = F.col("feature") == c.low_feature, F.col("feature") == c.points_feature
    rules = [
        (is_low & only, 1.0, 1.0),
        (is_low & none, 0.5, 0.0),
        (is_points & ~only & points, 1.0, 1.0),
        (is_points & ~only & ~points, 1.0, 0.0),
    ]
    i, t = F.col("i"), F.col("t")
    for when, importance, target in rules:
        i, t = F.when(where & when, importance).otherwise(i), F.when(where & when, target).otherwise(t)
    return v.join(roles, "customer", "left").withColumns({"i": i, "t": t}).select(*v.columns)


def calorie_roles(concepts: DataFrame, c: CalorieConcepts) -> DataFrame:
    """What a customer's concepts say about calories: the low-calorie one alone, the points one, none of the three."""
    is_one = lambda *ids: F.coalesce(F.col("concept").isin(list(ids)), F.lit(False))
    return concepts.groupBy("customer").agg(
        F.bool_and(is_one(c.low_calorie)).alias("__only"),
        F.bool_or(is_one(c.points)).alias("__points"),
        F.bool_and(~is_one(c.low_calorie, c.vegetarian, c.points)).alias("__none"),
    )


def blend_vectors(
    concepts: DataFrame, history: DataFrame, static: Mapping[str, tuple[float, float]], static_weight: float = 0.65,
    history_weight: float = 10.0, variation: Mapping[str, tuple[float, Sequence[str]]] | None = None,
    calorie: CalorieConcepts | None = None,
) -> DataFrame:
    """Importance and target per (customer, feature) from concept vectors, own history and fixed features.

    ``concepts``: customer, concept, feature, importance, target.  ``history``: customer, feature, importance, target
    (customers may be missing).  ``static``: feature -> (importance, target).  Concepts combine by importance;
    history counts ten times a concept, but a feature that a concept asks for keeps the concept's target; the fixed
    features take ``static_weight`` of the total.  Importances of a customer sum to 1.

    ``variation`` (groups of ``add_variation``) is for customers without history.  ``calorie`` sets the calorie features:
    without history before the fixed features are blended in, with history at the very end, so that those features
    outweigh the rest and the sum is above 1.

    Rows are dealt by customer once, and no step holds the plan before it twice.
    """
    join_where_dealt(concepts.sparkSession)
    concepts = dealt(concepts, "customer")
    c = _with_sums(concepts, ["customer", "concept"], __s=F.sum("importance"))
    c = c.withColumn("i", F.col("importance") / F.col("__s"))
    base = c.groupBy("customer", "feature").agg(
        F.coalesce(F.avg(F.when(F.col("i") > 0, F.col("i"))), F.lit(0.0)).alias("i"),
        F.coalesce(F.try_divide(F.sum(F.col("i") * F.col("target")), F.sum("i")), F.lit(0.0)).alias("t"),
    )
    norm = lambda df: _with_sums(df, ["customer"], __s=F.sum("i")).withColumn(
        "i", F.coalesce(F.try_divide("i", "__s"), F.lit(0.0))
    ).drop("__s")
    base = norm(base)
    h = history.select("customer", "feature", F.col("importance").alias("hi"), F.col("target").alias("ht"), F.lit(True).alias("__h"))
    j = base.withColumn("__b", F.lit(True)).join(dealt(h, "customer"), ["customer", "feature"], "full")
    # History of any feature counts; the rows of features that no concept has go after that.
    known = F.col("customer").isNotNull() & F.coalesce(F.max("__h").over(Window.partitionBy("customer")), F.lit(False))
    j = j.withColumn("has_history", known).where("__b")
    blended = (F.col("i") + history_weight * F.coalesce("hi", F.lit(0.0))) / (1 + history_weight)
    use = F.coalesce("has_history", F.lit(False))
    v = j.select(
        "customer",
        "feature",
        use.alias("has_history"),
        F.when(use, blended).otherwise(F.col("i")).alias("i"),
        F.when(use & (F.col("i") <= 0), F.coalesce("ht", F.lit(0.0))).otherwise(F.col("t")).alias("t"),
    )
    if variation:
        v = add_variation(v, variation, ~F.col("has_history"))
    if calorie:
        roles = calorie_roles(concepts, calorie)
        v = calorie_step(v, roles, calorie, ~F.col("has_history"))
    # The fixed features are a handful of literals: they join every customer's list as an exploded array.
    total = sum(i for i, _ in static.values())
    fixed = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.lit(i / total * static_weight).alias("si"), F.lit(float(t)).alias("st"))
            for f, (i, t) in static.items()
        ]
    )
    # A customer's first row brings the fixed features that the customer has no row of; NULL customers are no one customer.
    names = F.array(*[F.lit(f) for f in static])
    same = F.when(F.col("customer").isNotNull() & F.array_contains(names, F.col("feature")), F.col("feature"))
    own = Window.partitionBy("customer", "has_history")
    m = v.withColumns({"__met": F.collect_set(same).over(own), "__n": F.row_number().over(own.orderBy("feature"))})
    row = F.struct("feature", "i", "t", F.try_element_at(F.filter(fixed, lambda x: x["feature"] == same), F.lit(1)).alias("f"))
    none = F.lit(None).cast("double")
    more = F.transform(
        F.filter(fixed, lambda x: ~F.array_contains("__met", x["feature"])),
        lambda x: F.struct(x["feature"].alias("feature"), none.alias("i"), none.alias("t"), x.alias("f")),
    )
    m = m.withColumn("__x", F.explode(F.when(F.col("__n") == 1, F.concat(F.array(row), more)).otherwise(F.array(row))))
    m = m.select("customer", "has_history", "__x.feature", "__x.i", "__x.t", "__x.f.si", "__x.f.st").select(
        "customer",
        "feature",
        "has_history",
        (F.coalesce("i", F.lit(0.0)) * (1 - static_weight) + F.coalesce("si", F.lit(0.0))).alias("i"),
        F.coalesce("st", "t").alias("t"),
    )
    out = norm(m)
    if calorie:
        out = calorie_step(out, roles, calorie, F.col("has_history"))
    return out.withColumnsRenamed({"i": "importance", "t": "target"})


def filter_cascade(customers: DataFrame, menus: DataFrame, on: Sequence[str], k: Column) -> DataFrame:
    """Menu items each customer may get, with how far their preferences hold.

    ``customers``: ``on``, customer, allergies, dislikes.  ``menus``: one row per menu with ``menu`` as an array of
    (item, preferences).  3: all preferences hold and leave ``k`` items; 2: only allergies; 1: not even those, so every
    item is open.
    """
    j = customers.join(menus, list(on))
    avoid = F.array_union("allergies", "dislikes")
    free = lambda bad: F.transform(
        F.filter("menu", lambda i: ~has_intersection(i["preferences"], bad)), lambda i: i["item"]
    )
    j = j.withColumns({"__all": free(avoid), "__safe": free(F.col("allergies"))})
    level = F.when(F.size("__all") >= k, 3).when(F.size("__safe") >= k, 2).otherwise(1)
    j = j.withColumn("compliancy", level)
    items = F.when(F.col("compliancy") == 3, F.col("__all")).when(F.col("compliancy") == 2, F.col("__safe"))
    everything = F.transform("menu", lambda i: i["item"])
    return j.select(*on, "customer", "compliancy", F.coalesce(items, everything).alias("items"))


def last_order_week(orders: DataFrame, weeks: int, now: Column) -> DataFrame:
    """Last week in which a customer had an item within the newest ``weeks``, with a recency score from 1 down to 0."""
    ago = year_week_diff(now, F.col("year_week"))
    recent = orders.where(ago.between(0, weeks))
    last = recent.groupBy("customer", "item").agg(F.max("year_week").alias("last_order_week"))
    since = year_week_diff(now, F.col("last_order_week"))
    return last.select("*", since.alias("weeks_ago"), recency_score(since, weeks).alias("ordered_ago"))


def minmax_by_group(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Columns scaled to 0..1 within their group.

    A missing value counts as 0 for the maximum and as 10000 for the minimum, and becomes 0; so does a constant column.
    """
    clean = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    aggs = {}
    for c in cols:
        aggs[f"__hi_{c}"] = F.max(F.coalesce(clean(c), F.lit(0.0)))
        aggs[f"__lo_{c}"] = F.min(F.coalesce(clean(c), F.lit(10000.0)))
    t = with_totals(df, keys, **aggs)
    scaled = {
        c: F.coalesce(F.try_divide(clean(c) - F.col(f"__lo_{c}"), F.col(f"__hi_{c}") - F.col(f"__lo_{c}")), F.lit(0.0))
        for c in cols
    }
    return t.withColumns(scaled).select(*df.columns)


def menu_feedback(
    groups: DataFrame, menus: DataFrame, on: Sequence[str], previous: DataFrame, kinds: Sequence[str],
    max_basket: int = 5, max_weeks: int = 3, entropy_cut: float = 0.8, skew: float = 1.8,
) -> DataFrame:
    """What a menu offers each preference group.

    ``groups``: ``on``, group, n_users, value, preferences.  ``menus``: ``on``, menu: array of (item, ingredient,
    preferences).  ``previous``: ``on``, weeks: array (newest first) of item lists.  Per group: matching items,
    critical supply (fewer than a basket), overlap with the previous weeks, entropy and skew of the main ingredients,
    share of users and of customer value.
    """
    j = groups.join(menus, list(on)).join(previous, list(on), "left")
    match = F.filter("menu", lambda i: ~has_intersection(i["preferences"], F.col("preferences")))
    j = j.withColumn("__match", match)
    j = j.withColumns(
        {
            "items": F.transform("__match", lambda i: i["item"]),
            "__ing": F.transform("__match", lambda i: i["ingredient"]),
            "n_items": F.size("__match"),
            "__weeks": F.floor(F.size("__match") / max_basket).cast("int"),
            "__free": F.size(F.array_except(F.array(*[F.lit(x) for x in kinds]), "preferences")),
        }
    )
    back = F.slice(F.coalesce("weeks", F.array().cast("array<array<string>>")), F.lit(1), F.greatest("__weeks", F.lit(0)))
    common = F.aggregate(back, F.array_distinct("items"), lambda acc, w: F.array_intersect(acc, w))
    enough = F.size(F.coalesce("weeks", F.array().cast("array<array<string>>"))) >= F.col("__weeks")
    overlap = F.when((F.col("__weeks") <= max_weeks) & enough, common).otherwise(F.array().cast("array<string>"))
    counts = F.transform(F.array_distinct("__ing"), lambda v: F.size(F.filter("__ing", lambda x: x == v)).cast("double"))
    n = F.size("__ing").cast("double")
    entropy = -F.aggregate("__counts", F.lit(0.0), lambda a, c: a + (c / n) * F.log2(c / n))
    j = j.withColumns({"overlap_items": overlap, "__counts": counts})
    score = F.when(n == 0, 0.0).otherwise(F.coalesce(F.try_divide(entropy, F.log2(F.col("__free").cast("double"))), F.lit(1.0)))
    top = F.coalesce(F.try_divide(F.array_max("__counts"), n), F.lit(0.0))
    out = j.select(
        *on,
        "group",
        "n_users",
        "value",
        "n_items",
        (F.col("n_items") < max_basket).alias("is_critical"),
        (F.col("__weeks") == 0).alias("__none"),
        F.size("overlap_items").alias("n_overlap"),
        score.alias("entropy_score"),
        (F.col("__free") - F.size("__counts") >= 2).alias("misses_variety"),
        ((F.col("__free") > 0) & (top >= skew / F.col("__free"))).alias("is_skewed"),
    )
    out = out.withColumns(
        {"has_overlap": F.col("__none") | (F.col("n_overlap") > 0), "is_uniform": F.col("entropy_score") < entropy_cut}
    ).drop("__none")
    shares = with_totals(out, list(on), __u=F.sum("n_users"), __v=F.sum("value"))
    return shares.select(
        *out.columns,
        F.try_divide("n_users", "__u").alias("share_of_users"),
        F.try_divide("value", "__v").alias("share_of_value"),
    )


def build_requests(
    customers: DataFrame, products: DataFrame, orders: DataFrame, preferences: DataFrame, weeks: Sequence[int],
    portions: Sequence[int], today: Column,
) -> DataFrame:
    """Scoring requests: one per customer with a valid subscription, with preferences, weeks and days since delivery.

    ``customers``: customer, company, combination.  ``products``: customer, n_items, portions.  ``orders``: customer,
    monday.  ``preferences``: combination, concepts, tastes.
    """
    last = orders.groupBy("customer").agg(F.max("monday").alias("last"))
    return (
        customers.join(products.where(F.col("portions").isin(*portions)), "customer")
        .join(preferences, "combination", "left")
        .join(last, "customer", "left")
        .select(
            "customer",
            "company",
            "n_items",
            "portions",
            F.coalesce("concepts", F.array().cast("array<string>")).alias("concepts"),
            F.coalesce("tastes", F.array().cast("array<string>")).alias("tastes"),
            F.datediff(today, "last").alias("days_since_last_delivery"),
            F.array(*[F.lit(w) for w in weeks]).alias("weeks"),
        )
    )
