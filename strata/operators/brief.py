"""Business questions of the project brief (N3–N6); definitions are ours.

* ``top_products_per_category`` — top-k products by units per category and
  month (the limit is the feature of this report);
* ``demand_anomalies`` — hourly demand per status against the previous
  ``k`` hours (mean, sample stddev, z-score), silent hours included, flagging
  spikes, drops and falls to zero;
* ``discount_impact`` — sales by discount band;
* ``co_purchase_affinity`` — per product, how many orders also bought from
  each other category. Pairs are formed against the order's *distinct
  categories* (a bounded set), never against every other item of the order,
  so output per item is capped by the number of categories, exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import band, money_sum
from ..session import scratch_path

# Discount bands (upper bounds, exclusive) and anomaly settings.
DISCOUNT_BANDS = [(0.03, "low"), (0.06, "mid")]
DISCOUNT_TOP_BAND = "high"
ANOMALY_LOOKBACK_HOURS = 24
ANOMALY_Z = 3.0
PAIR_BLOCK = 64  # fixed value: items of an order that one row pairs with as many others


def top_products_per_category(items: DataFrame, products: DataFrame, orders: DataFrame, k: int = 3) -> DataFrame:
    """Rank ≤ k of products by units (desc), then product_id, per (category, year, month).

    The ranking window runs over aggregated (product, month) rows; the
    ``rank <= k`` filter lets Catalyst insert a partial WindowGroupLimit.
    """
    p = products.select("product_id", "product_category_name")
    o = orders.select("order_id", "year", "month")
    j = items.select("order_id", "product_id", "quantity", "price").join(p, "product_id").join(o, "order_id")
    agg = j.groupBy("product_category_name", "year", "month", "product_id").agg(
        F.sum("quantity").alias("units"), money_sum("price").alias("revenue"))
    w = Window.partitionBy("product_category_name", "year", "month") \
        .orderBy(F.col("units").desc(), F.col("product_id").asc())
    return agg.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def demand_anomalies(hourly: DataFrame, by: str = "order_status", k: int = ANOMALY_LOOKBACK_HOURS, z: float = ANOMALY_Z,
                     first: datetime | None = None, last: datetime | None = None, after: datetime | None = None) -> DataFrame:
    """Each hour's event count per status against the ``k`` hours before it, hours without events included.

    Input: one row per (window_start, ``by``) with ``n_events`` (for example
    ``speed.hourly_counts``). A status is scored in every hour with events and
    in up to ``k`` hours of silence after it, as far as the last hour of
    the data: after that its baseline is silence too. The baseline are the
    hours from ``k`` before to the one before, none before the first hour of the
    data; hours without events count as 0 in it.

    ``is_spike`` and ``is_drop``: the count lies more than ``z`` sample standard
    deviations above or below the mean. ``is_drop`` also if it falls to zero
    after at least k / 2 hours that all had events, however steady.

    Silent hours come out of the present ones by ``sequence`` up to the status's
    next hour, and the baseline is a window over a range of hours, exact
    integers until the last division. Windows are per status over aggregated
    hours, never over events. ``first`` and ``last`` replace the first and last
    hour of ``hourly`` (a stream knows them), ``after`` keeps later hours only.
    """
    kind = hourly.schema["window_start"].dataType

    def hour(t: Column) -> Column:
        return F.floor(F.unix_seconds(t.cast("timestamp")) / 3600)

    def bound(given: datetime | None, of) -> Column:
        if given is not None:
            return hour(F.lit(given))
        return hour(hourly.agg(of("window_start")).scalar())  # one value, found by a job of its own: no join

    h = hourly.select(F.col(by), "n_events", hour(F.col("window_start")).alias("__h"), bound(first, F.min).alias("__first"),
                      bound(last, F.max).alias("__last"))
    following = F.lead("__h").over(Window.partitionBy(by).orderBy("__h"))
    h = h.withColumn("__until", F.least(F.col("__h") + k, F.coalesce(following - 1, F.col("__last")), F.col("__last")))
    spine = h.where(F.col("__until") >= F.col("__h")).select(
        by, "n_events", "__h", "__first", F.explode(F.sequence("__h", "__until")).alias("__at"))
    n = F.when(F.col("__at") == F.col("__h"), F.col("n_events")).otherwise(F.lit(0)).cast("long")
    spine = spine.select(by, "__at", "__first", n.alias("n_events"))
    w = Window.partitionBy(by).orderBy("__at").rangeBetween(-k, -1)
    some = F.col("n_events")
    out = spine.select(
        F.col(by), "__at", "n_events", F.least(F.lit(k).cast("long"), F.col("__at") - F.col("__first")).alias("__n"),
        F.coalesce(F.sum(some).over(w), F.lit(0)).alias("__s"), F.coalesce(F.sum(some * some).over(w), F.lit(0)).alias("__q"),
        F.count_if(some > 0).over(w).alias("__busy"))
    if after is not None:
        out = out.where(F.col("__at") > hour(F.lit(after)))
    hours = F.col("__n")
    out = out.withColumns({
        "baseline_mean": F.when(hours > 0, F.col("__s") / hours),
        "baseline_std": F.when(hours > 1, F.sqrt((hours * F.col("__q") - F.col("__s") * F.col("__s")) / (hours * (hours - 1)))),
    })
    zs = F.when(F.col("baseline_std") > 0, (some - F.col("baseline_mean")) / F.col("baseline_std"))
    silence = (some == 0) & (hours * 2 >= k) & (F.col("__busy") == hours)
    return out.select(
        F.timestamp_seconds(F.col("__at") * 3600).cast(kind).alias("window_start"), by, "n_events",
        F.round("baseline_mean", 4).alias("baseline_mean"),
        F.round("baseline_std", 4).alias("baseline_std"),
        F.round(zs, 4).alias("z_score"),
        F.coalesce(zs > z, F.lit(False)).alias("is_spike"),
        (F.coalesce(zs < -z, F.lit(False)) | silence).alias("is_drop"))


def discount_band(col: str = "discount") -> F.Column:
    return band(col, DISCOUNT_BANDS, DISCOUNT_TOP_BAND)


def discount_impact(items: DataFrame) -> DataFrame:
    """Per discount band: items, units, gross and net revenue, units per item."""
    net = F.col("price") * (F.lit(1) - F.col("discount"))
    agg = items.groupBy(discount_band().alias("discount_band")).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("quantity").alias("units"),
        money_sum("price").alias("gross_revenue"),
        F.sum(net).cast("decimal(38,2)").cast("double").alias("net_revenue"),
    )
    return agg.withColumn("units_per_item", F.col("units") / F.col("n_items"))


def co_purchase_affinity(items: DataFrame, products: DataFrame) -> DataFrame:
    """(product, other category) → number of orders holding both.

    (order, product) pairs are made distinct first (partial aggregation, so
    an order repeating a product shrinks before the shuffle), and the order's
    categories are distinct too, so the join emits each (order, product,
    other category) once and the count needs no further distinct."""
    p = products.select("product_id", "product_category_name")
    ip = items.select("order_id", "product_id").distinct().join(p, "product_id")
    order_cats = ip.select("order_id", F.col("product_category_name").alias("co_category")).distinct()
    pairs = ip.join(order_cats, "order_id").filter(F.col("co_category") != F.col("product_category_name"))
    return pairs.groupBy("product_id", "co_category").agg(F.count(F.lit(1)).alias("n_orders"))


def _pairs(groups: DataFrame, by: Sequence[str], last: str, block: int = PAIR_BLOCK) -> DataFrame:
    """(by..., left, right), left < right: the pairs among every group's items (column ``items``, distinct).

    A group of more than ``block`` items is cut into blocks and each two of
    them make a row of their own, spread over all tasks, so that no task and
    no row holds the pairs of one giant group.
    """
    few = groups.where(F.size("items") <= block).select(*by, F.col("items").alias("l"), F.col("items").alias("r"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("items") - 1) / block).cast("int")),
                        lambda i: F.slice("items", i * block + 1, block))
    many = groups.where(F.size("items") > block).select(*by, F.sort_array("items").alias("items")).select(*by, parts.alias("parts"))
    many = many.select(*by, "parts", F.posexplode("parts").alias("at", "l"))
    many = many.select(*by, "l", F.posexplode(F.slice("parts", F.col("at") + 1, F.size("parts"))).alias("to", "r"))
    many = many.repartition(*by, "l", "to").drop("to")
    both = few.unionByName(many).select(*by, "r", F.explode("l").alias("left"))
    return both.select(*by, "left", F.explode("r").alias("right")).where(F.col("left") < F.col("right")) \
        .withColumnsRenamed({"left": last, "right": "__next"})


def _kept(df: DataFrame, root: str, name: str) -> DataFrame:
    df.write.parquet(f"{root}/{name}")
    return df.sparkSession.read.parquet(f"{root}/{name}")


def order_baskets(items: DataFrame, root: str, order_key: str = "order_id", product_key: str = "product_id") -> DataFrame:
    """(__o, items): the distinct products of every order, stored under ``root``; NULL orders and products take no part."""
    seen = items.where(F.col(order_key).isNotNull() & F.col(product_key).isNotNull()) \
        .select(F.col(order_key).alias("__o"), F.col(product_key).alias("__1"))
    return _kept(seen.repartition("__o").groupBy("__o").agg(F.collect_set("__1").alias("items")), root, "baskets")


def frequent_itemsets(items: DataFrame, min_orders: int, max_size: int = 3, order_key: str = "order_id",
                      product_key: str = "product_id", baskets: DataFrame | None = None) -> DataFrame:
    """Sets of 1 to ``max_size`` products that at least ``min_orders`` orders hold together (N6): items (sorted), n_orders.

    Baskets are the orders' distinct products; NULL orders and products take no
    part. Sets grow by one product at a time: two frequent sets of an order that
    differ in their last product only make a set of the next size, which is
    counted over all orders, so nothing larger than ``max_size`` is formed and
    sets that hold an infrequent one are left out early. Baskets and the
    frequent sets of each size are stored under the checkpoint folder, which
    is when they are counted. No basket is cut. A caller that has the items'
    ``order_baskets`` hands them over as ``baskets``.
    """
    root = scratch_path(items.sparkSession, "itemsets", uuid.uuid4().hex)
    baskets = order_baskets(items, root, order_key, product_key) if baskets is None else baskets
    n_orders = F.count(F.lit(1)).alias("n_orders")
    least = F.col("n_orders") >= min_orders
    one = _kept(baskets.select(F.explode("items").alias("__1")).groupBy("__1").agg(n_orders).where(least), root, "1")
    sets = one.select(F.array("__1").alias("items"), "n_orders")
    # an item of too few orders is in no frequent set; dropping it first keeps giant orders small
    giant = F.size("items") > PAIR_BLOCK
    often = baskets.where(giant).select("__o", F.explode("items").alias("__1")).join(one.select("__1"), "__1", "left_semi")
    groups = baskets.where(~giant).unionByName(often.groupBy("__o").agg(F.collect_list("__1").alias("items")))
    for size in range(2, max_size + 1):
        names = [f"__{i}" for i in range(1, size + 1)]
        held = _pairs(groups, ["__o", *names[:-2]], names[-2]).withColumnRenamed("__next", names[-1])
        often = _kept(held.groupBy(*names).agg(n_orders).where(least), root, str(size))
        sets = sets.unionByName(often.select(F.array(*names).alias("items"), "n_orders"))
        if size < max_size:
            groups = held.join(often.select(*names), names, "left_semi") \
                .groupBy("__o", *names[:-1]).agg(F.collect_list(names[-1]).alias("items")).where(F.size("items") > 1)
    return sets


def product_candidates(items: DataFrame, orders: DataFrame, min_orders: int, min_confidence: float = 0.0) -> DataFrame:
    """Products a customer has not bought that go with one they have.

    Per (customer_id, candidate): the best rule among frequent pairs, antecedent
    -> candidate: ``because`` (the product bought; the smaller on a tie),
    n_orders (orders with both) and confidence (their share of the antecedent's
    orders). Rules come from ``frequent_itemsets``; customers meet them by the
    product they bought, so work grows with purchases times rules per product.

    A candidate's rules are ranked once, from 1, before they meet the customers,
    and rank 0 is the product itself: the least rank a customer has for a product
    is its best rule, or 0 if they have bought it. Baskets are stored once, for
    the rules and for the purchases, beside the products that rules name.
    """
    root = scratch_path(items.sparkSession, "candidates", uuid.uuid4().hex)
    baskets = order_baskets(items, root)
    sets = frequent_itemsets(items, min_orders, 2, baskets=baskets)
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("because"), F.col("n_orders").alias("n_because"))
    pairs = sets.where(F.size("items") == 2)
    rules = pairs.select(F.explode(F.array(F.struct(F.col("items")[0].alias("because"), F.col("items")[1].alias("candidate")),
                                           F.struct(F.col("items")[1].alias("because"), F.col("items")[0].alias("candidate")))).alias("r"),
                         "n_orders").select("r.*", "n_orders").join(single, "because")
    rules = rules.withColumn("confidence", F.col("n_orders") / F.col("n_because")).where(F.col("confidence") >= min_confidence)
    best_first = Window.partitionBy("candidate").orderBy(F.col("confidence").desc(), F.col("n_orders").desc(), "because")
    rules = rules.select("candidate", "because", "n_orders", "confidence", F.row_number().over(best_first).alias("__rank"))
    named = _kept(pairs.select(F.explode("items").alias("because")).distinct(), root, "named")
    bought = baskets.join(orders.select(F.col("order_id").alias("__o"), "customer_id"), "__o").where(F.col("customer_id").isNotNull()) \
        .select("customer_id", F.explode("items").alias("because"))
    bought = bought.join(named, "because", "left_semi").distinct()  # products of no rule have nothing to offer
    itself = named.select("because", F.col("because").alias("candidate"), F.lit(0).alias("__rank"))
    offers = bought.join(rules.select("because", "candidate", "__rank").unionByName(itself), "because")
    best = offers.groupBy("customer_id", "candidate").agg(F.min("__rank").alias("__rank")).where(F.col("__rank") > 0)
    return best.join(rules, ["candidate", "__rank"]).select("customer_id", "candidate", "because", "n_orders", "confidence")
