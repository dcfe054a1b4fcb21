"""Customer history -> next-product rows (the flagship, SURVEY 3 E1, model stage excluded).

For every order of every customer:
  flags     the order's status and priority as 0/1 flags ("products held")
  previous  the flags of the customer's previous order (as-of, strictly earlier; zeros if none)
  new       element-wise max(flags - previous, 0); one output row per newly held flag
  lags      the flags of the ``n_lags`` orders before the labelled one, flattened, left-padded with 0
  static    clipped and scaled price, priority code from a code table
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import clip_scale, max_diff
from quarry.operators import joins, windows
from quarry.operators.sequence import previous_row

# fixed values: the flag names of an order (status F/O/P, priority 1..5)
STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FLAG_NAMES = ["st_F", "st_O", "st_P", "pr_1", "pr_2", "pr_3", "pr_4", "pr_5"]


def order_flags(orders: DataFrame, out: str = "flags") -> DataFrame:
    flags = [F.coalesce((F.col("o_orderstatus") == s).cast("int"), F.lit(0)) for s in STATUSES]
    flags += [F.coalesce((F.col("o_orderpriority") == p).cast("int"), F.lit(0)) for p in PRIORITIES]
    return orders.withColumn(out, F.array(*flags))


def priority_codes(orders: DataFrame) -> DataFrame:
    """(column, value, code) table for the priority column, codes in value order; the
    missing slot is code -1."""
    # the vocabulary of a code column is small by nature: collected once, sorted, numbered
    values = sorted(r[0] for r in orders.select("o_orderpriority").filter(F.col("o_orderpriority").isNotNull()).distinct().collect())
    rows = [("o_orderpriority", v, i) for i, v in enumerate(values)] + [("o_orderpriority", "-99", -1)]
    return orders.sparkSession.createDataFrame(rows, "column string, value string, code int")


def earlier_flags(n_lags: int, width: int):
    """Flags of the ``n_lags`` orders strictly before the row's own, oldest first, padded on the left."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-n_lags, -1)
    seen = F.flatten(F.collect_list("flags").over(w))
    return F.concat(F.array_repeat(F.lit(0), F.lit(n_lags * width) - F.size(seen)), seen)


def next_product_rows(orders: DataFrame, n_lags: int = 5, keep: list[str] | None = None) -> DataFrame:
    """Labelled rows; ``keep`` names further columns of ``previous_state`` to carry along."""
    width = len(FLAG_NAMES)
    f = order_flags(orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority",
                                  "o_orderstatus"))
    f = f.withColumn("lags", earlier_flags(n_lags, width))
    prev = previous_row(f, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["flags", "o_totalprice", "o_orderpriority"], prefix="prev_")
    prev = prev.withColumn("prev_flags", F.coalesce(F.col("prev_flags"), F.array_repeat(F.lit(0), width)))
    new = prev.withColumn("new", max_diff("flags", "prev_flags"))
    exploded = new.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority", "lags", "prev_flags", "prev_o_totalprice", "prev_o_orderpriority",
                          F.posexplode("new").alias("label", "__v")).filter(F.col("__v") > 0).drop("__v")
    coded = joins.map_codes(exploded, priority_codes(orders), "o_orderpriority", out="priority_code")
    names = F.array(*[F.lit(n) for n in FLAG_NAMES])
    return (coded
            .select("o_custkey", "o_orderkey", F.col("label").cast("int").alias("label"),
                    F.element_at(names, F.col("label") + 1).alias("label_name"),
                    clip_scale("o_totalprice", 0.0, 600000.0, 150000.0, 6).alias("price_scaled"),
                    F.col("priority_code"), F.col("lags"), *(keep or [])))


def customer_state(orders: DataFrame, n_lags: int = 5) -> DataFrame:
    """Per customer, the features at its latest order: scaled price, priority code, the
    lag vector of its last orders and the flags of its latest order (the snapshot the next
    order is compared with)."""
    width = len(FLAG_NAMES)
    f = order_flags(orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority",
                                  "o_orderstatus"))
    latest = f.groupBy("o_custkey").agg(F.max_by(F.struct("o_totalprice", "o_orderpriority", "flags"),
                                                 F.struct("o_orderdate", "o_orderkey")).alias("__s"))
    latest = latest.select("o_custkey", "__s.*")
    lags = windows.lag_vector(f, ["o_custkey"], ["o_orderdate", "o_orderkey"], "flags", n_lags, width, last=True)
    coded = joins.map_codes(latest, priority_codes(orders), "o_orderpriority", out="priority_code")
    return coded.join(lags, "o_custkey", "left").select(
        "o_custkey", clip_scale("o_totalprice", 0.0, 600000.0, 150000.0, 6).alias("price_scaled"),
        F.col("priority_code"), F.col("lags"), F.col("flags").alias("prev_flags"))


def rank_next_products(train_orders: DataFrame, test_orders: DataFrame, k: int = 8, trees: int = 20,
                       depth: int = 6, seed: int = 0) -> DataFrame:
    """The whole customer-history ranking: next-product rows of the training period (each
    newly held flag a labelled row, features = price, priority and flags of the previous order and lags), a multi-class
    forest over the flags, then for every customer of the test period the k most probable
    flags of its next order, best first, joined by spaces: (o_custkey, added_products)."""
    from quarry.operators import ml
    from quarry.operators.ranking import top_k_names
    from pyspark.ml.functions import vector_to_array

    # what is known before the labelled order: price, priority and flags of the one before it
    rows = next_product_rows(train_orders, keep=["prev_flags", "prev_o_totalprice", "prev_o_orderpriority"]).drop("priority_code", "price_scaled")
    rows = joins.map_codes(rows.withColumnRenamed("prev_o_orderpriority", "o_orderpriority"), priority_codes(train_orders), "o_orderpriority", out="priority_code")
    rows = rows.withColumn("price_scaled", clip_scale("prev_o_totalprice", 0.0, 600000.0, 150000.0, 6)).withColumn("priority_code", F.coalesce("priority_code", F.lit(-1)))
    train = ml.assemble(rows.withColumn("label", F.col("label").cast("double")),
                        ["price_scaled", "priority_code", "lags", "prev_flags"])
    model = ml.forest(train, "label", trees=trees, depth=depth, seed=seed)
    test = ml.assemble(customer_state(test_orders), ["price_scaled", "priority_code", "lags", "prev_flags"])
    probs = model.transform(test).select("o_custkey", vector_to_array("probability").alias("p"))
    names = FLAG_NAMES[: len(FLAG_NAMES)]
    # classes never seen in training have no probability slot: pad to the full flag list
    padded = F.concat(F.col("p"), F.array_repeat(F.lit(-1.0), F.greatest(F.lit(len(names)) - F.size("p"), F.lit(0))))
    return probs.select("o_custkey", top_k_names(padded, names, k).alias("added_products"))
