"""Pages: word counts, link edges, layered expansion, best-first expansion, error report
(SURVEY 2.11, web_*). Pages are an input table (url, html); no fetching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage, staged

from quarry.functions.text import count_word, links
from quarry.operators.sets import latest_per_key


def word_count(pages: DataFrame, word: str, url: str = "url", html: str = "html") -> DataFrame:
    """(url, count): non-overlapping occurrences of ``word`` in the lower-cased page."""
    return pages.select(url, count_word(html, word).alias("count"))


def edges(pages: DataFrame, must_contain: str | None = "http:", url: str = "url", html: str = "html",
          resolve: bool = False) -> DataFrame:
    """(src, dst, pos) for every quoted value after ``href=``; relative links are joined to the
    page's scheme and host when ``resolve``."""
    e = pages.select(F.col(url).alias("src"), F.posexplode(links(html, must_contain)).alias("pos", "dst"))
    if resolve:
        host = F.regexp_extract(F.col("src"), r"^(https?://[^/?#]+)", 1)
        e = e.withColumn("dst", F.when(F.col("dst").startswith("/") & (host != ""), F.concat(host, F.col("dst"))).otherwise(F.col("dst")))
    return e


def layers(edge: DataFrame, start, depth: int, src: str = "src", dst: str = "dst", checkpoint: bool = True) -> DataFrame:
    """(node, layer): nodes reachable from ``start`` and their distance, up to ``depth`` layers.

    One join per layer between the frontier and the edges, minus the nodes already reached
    (anti join). The reached set is checkpointed each layer to cut lineage. Every edge is
    followed at most once per layer.
    """
    spark = edge.sparkSession
    e = edge.select(F.col(src).alias("__s"), F.col(dst).alias("node")).distinct()
    dtype = edge.schema[src].dataType
    seen = spark.createDataFrame([(start, 0)], f"node {dtype.simpleString()}, layer int")
    frontier = seen
    for d in range(1, depth + 1):
        nxt = (frontier.select(F.col("node").alias("__s")).join(e, "__s").select("node").distinct()
               .join(seen.select("node"), "node", "left_anti").withColumn("layer", F.lit(d)))
        if checkpoint:
            nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            break
        seen = seen.unionByName(nxt)
        frontier = nxt
    return seen


#: Nodes that are sent to every task, so that a table they are looked up in stays where it is.
FEW_NODES = 200_000


def _few(nodes: DataFrame) -> DataFrame:
    """``nodes`` (a written table), broadcast if they are few."""
    return F.broadcast(nodes) if nodes.count() <= FEW_NODES else nodes


def _neighbors(frontier: DataFrame, e: DataFrame, hops: int) -> DataFrame:
    """Nodes ``hops`` edges away from the frontier nodes (e: __s -> node), deduplicated and written.
    Edges may repeat: only the nodes they lead to are shuffled, unless the frontier is large."""
    cur = frontier.select(F.col("node").alias("__s")).distinct()
    for _ in range(hops):
        cur = staged(e.join(_few(cur), "__s").select(F.col("node").alias("__s")).distinct(), "web-nodes")
    return cur.select(F.col("__s").alias("node"))


def layer_counts(reached: DataFrame) -> DataFrame:
    return reached.groupBy("layer").agg(F.count("*").alias("pages"))


def expand_above_mean(edge: DataFrame, counts: DataFrame, start, depth: int, src: str = "src", dst: str = "dst",
                      hops: int = 1) -> DataFrame:
    """Layered expansion that keeps, between layers, only the pages whose count is above the
    mean count of the results so far: (node, layer, count). ``hops`` = 2 walks a page -> link
    -> page graph one page layer at a time."""
    spark = edge.sparkSession
    e = edge.select(F.col(src).alias("__s"), F.col(dst).alias("node"))
    c = counts.select(F.col("url").alias("node"), "count")
    dtype = edge.schema[src].dataType
    res = spark.createDataFrame([(start, 0)], f"node {dtype.simpleString()}, layer int").join(c, "node", "left")
    frontier = res
    for d in range(1, depth + 1):
        mean = res.agg(F.avg("count")).first()[0] or 0.0
        new = staged(_neighbors(frontier, e, hops).join(res.select("node"), "node", "left_anti"), "web-new")
        nxt = staged(c.join(_few(new), "node").filter(F.col("count") > F.lit(mean)).select("node", F.lit(d).alias("layer"), "count"), "web-layer")
        if nxt.isEmpty():
            break
        res = res.unionByName(nxt)
        frontier = nxt
    return res


def best_first(edge: DataFrame, counts: DataFrame, start, rounds: int, src: str = "src", dst: str = "dst",
               hops: int = 1) -> DataFrame:
    """``rounds`` times: expand the best unexpanded result (highest count, ties by url); keep
    its linked pages whose count is at least the best count so far. Results are merged with
    later rounds winning: (node, count, round)."""
    spark = edge.sparkSession
    e = edge.select(F.col(src).alias("__s"), F.col(dst).alias("node"))
    c = counts.select(F.col("url").alias("node"), "count")
    dtype = edge.schema[src].dataType
    res = spark.createDataFrame([(start, 0)], f"node {dtype.simpleString()}, round int").join(c, "node", "left")
    expanded = spark.createDataFrame([], f"node {dtype.simpleString()}")
    for r in range(1, rounds + 1):
        top = res.join(expanded, "node", "left_anti").orderBy(F.desc_nulls_last("count"), F.desc("node")).first()
        if top is None:
            break
        one = spark.createDataFrame([(top["node"],)], f"node {dtype.simpleString()}")
        expanded = cut_lineage(expanded.unionByName(one))  # a row a round
        best = res.agg(F.max("count")).first()[0] or 0
        linked = _neighbors(one, e, hops).filter(F.col("node") != F.lit(top["node"]))
        nxt = (c.join(_few(linked), "node").filter(F.col("count") >= F.lit(best))
               .select("node", F.lit(r).alias("round"), "count"))
        res = staged(latest_per_key(res.unionByName(nxt), ["node"], "round"), "web-results")
    return res


def errors(pages: DataFrame, edge: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(reason, count): pages with no text ('empty'), link targets missing from the page table
    ('missing'), the rest counted as 'ok'."""
    status = pages.select(F.col(url).alias("node"),
                          F.when(F.col(html).isNull() | (F.length(html) == 0), "empty").otherwise("ok").alias("reason"))
    known = pages.select(F.col(url).alias("node"))
    missing = edge.select(F.col("dst").alias("node")).distinct().join(known, "node", "left_anti").withColumn("reason", F.lit("missing"))
    return status.unionByName(missing).groupBy("reason").agg(F.count("*").alias("count"))
