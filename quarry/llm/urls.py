"""URL filter by a dated list: each capture is judged by the entries that were active when it was fetched.

The list is a log of (entry, category, at, action). An entry is a domain, which covers its
subdomains, or a host with leading path segments. Events of an entry and category in order of time
become validity intervals from each ``add`` to the next event; the intervals of an entry are kept as
one row. A capture looks up every domain suffix and path prefix of its URL, and the as-of test picks
the intervals that hold its fetch time.

Scale: captures are reduced to distinct (URL, time) pairs before they are spread over their keys
(a handful each). The join is one row an entry, so a host with a third of all captures makes no more
rows than its captures; its partition can be split, as nothing above the join needs a key together.

Defined cases: a URL that is null or has no host matches nothing; a null fetch time is judged as
never (not blocked); events of one entry, category and time count once, and a removal beats an
addition; events with a null entry, time or action are ignored; repeated captures get equal
verdicts; an empty list blocks nothing; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import fresh, let

HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host without a closing dot; empty where there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), F.lit("."))


def keys(url: Column) -> Column:
    """Domain suffixes of the host (of two labels at least, and the host itself) and the host with
    one, two, ... leading path segments."""
    path = F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/"), lambda x: x != "")

    def all_of(h: Column) -> Column:
        labels = F.split(h, r"\.")
        suffixes = let(labels, lambda p: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(p) - 1)), lambda i: F.array_join(F.slice(p, i, F.size(p)), ".")))
        prefixes = let(path, lambda p: F.when(F.size(p) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(p))), lambda i: F.concat(h, F.lit("/"), F.array_join(F.slice(p, F.lit(1), i), "/")))).otherwise(F.array().cast("array<string>")))
        return F.when(h != "", F.array_distinct(F.concat(suffixes, prefixes))).otherwise(F.array().cast("array<string>"))
    return let(host(url), all_of)


def normal_entry(entry: Column) -> Column:
    """An entry as ``keys`` writes it: the host in lower case without a closing dot, path segments as they
    are without empty ones; empty where there is no host."""
    parts = F.split(entry, "/")
    h = F.rtrim(F.lower(parts[0]), F.lit("."))
    return F.when(h == "", "").otherwise(F.array_join(F.concat(F.array(h), F.filter(F.slice(parts, 2, F.size(parts)), lambda x: x != "")), "/"))


def intervals(events: DataFrame) -> DataFrame:
    """(entry, spans): for each entry its (category, from, to) with ``to`` null while it holds."""
    usable = events.where(F.col("entry").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove"))
    usable = usable.withColumn("entry", normal_entry(F.col("entry"))).where("entry <> ''")
    once = usable.groupBy("entry", "category", "at").agg(F.max("action").alias("action"))
    w = Window.partitionBy("entry", "category").orderBy("at")
    spans = once.withColumn("until", F.lead("at").over(w)).where("action = 'add'")
    return spans.groupBy("entry").agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("since"), "until", "category"))).alias("spans"))


def judge(captures: DataFrame, events: DataFrame, url_col: str = "url", at_col: str = "fetched_at", as_col: str = "verdict") -> DataFrame:
    """``captures`` with a struct column: blocked, n_matches, and of the longest matching entry
    (ties: the smaller) entry, category (smallest) and since."""
    u, t = F.col(url_col), F.col(at_col)
    pairs = captures.where(u.isNotNull() & t.isNotNull()).select(u.alias("u"), t.alias("t")).distinct()
    spread = pairs.select("u", "t", F.explode(keys(F.col("u"))).alias("entry"))
    active = F.filter("spans", lambda s: (s["since"] <= F.col("t")) & (s["until"].isNull() | (s["until"] > F.col("t"))))
    hits = spread.join(intervals(events), "entry").select("u", "t", "entry", active.alias("spans")).where(F.size("spans") > 0)
    hit = hits.select("u", "t", F.size("spans").cast("long").alias("n"), F.struct(
        (-F.length("entry")).alias("len"), "entry", F.array_min(F.transform("spans", lambda s: F.struct(s["category"].alias("category"), s["since"].alias("since")))).alias("first")).alias("best"))
    found = hit.groupBy("u", "t").agg(F.sum("n").alias("n"), F.min("best").alias("best"))
    (v,) = fresh(captures, as_col) if as_col in captures.columns else (as_col,)
    f = found.select(F.col("u").alias(f"{v}_u"), F.col("t").alias(f"{v}_t"), F.struct("n", "best").alias(f"{v}_b"))
    out = captures.join(f, (u == F.col(f"{v}_u")) & (t == F.col(f"{v}_t")), "left")
    b = F.col(f"{v}_b")
    return out.withColumn(v, F.struct(
        b.isNotNull().alias("blocked"), F.coalesce(b["n"], F.lit(0)).cast("long").alias("n_matches"), b["best"]["entry"].alias("entry"),
        b["best"]["first"]["category"].alias("category"), b["best"]["first"]["since"].alias("since"))).drop(f"{v}_u", f"{v}_t", f"{v}_b")
