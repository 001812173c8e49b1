"""Mixing sources to target weights by hierarchical budgeting, in SQL functions alone.

Weights run down a tree of domain, language and source. A node's budget is shared among its children
by weight; a child that cannot use its share (its tokens times the most epochs) gives the shortage to
its siblings, and since no node gets more than its children can use, a shortage leaves a node only
when all of them are full: siblings come before ancestors. Budgets are whole tokens, rounded down.

Each leaf is read in epochs, each in an order of its own drawn from the seed. Full epochs take every
document; of the last, the longest prefix of documents that fits is taken. Its end is found without
ordering the leaf: sums by leading digits of the order key name the part in which the budget ends,
the next digits the part of that part, and only what is small is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from veracast.llm.common import kept, refuse_taken

LEVELS = ("domain", "lang", "source")
# Documents of a leaf that one task may put in order, and the digits of the key a round goes on by.
ROWS_A_TASK = 4096
_DIGITS = 3


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def share(nodes: DataFrame, parent: list[str], by: str) -> DataFrame:
    """Adds ``budget`` to children with ``weight``, ``room`` and their parent's ``given``.

    The children that are full at the common level come first in the order of room over weight.
    """
    weight, room = F.col("weight").cast("decimal(18,0)"), F.col("room").cast("decimal(18,0)")
    keys = parent or [F.lit(0)]
    order = Window.partitionBy(*keys).orderBy(
        F.col("room") / F.col("weight").cast("double"), F.col(by).asc_nulls_first()
    )
    whole = Window.partitionBy(*keys)
    before = F.coalesce(
        F.sum(room).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
    left = F.col("given").cast("decimal(18,0)") - before
    used = nodes.where("weight > 0").withColumn(
        "full", room * rest.cast("decimal(18,0)") <= left.cast("decimal(18,0)") * weight
    )
    of_full = F.coalesce(F.sum(F.when(F.col("full"), room)).over(whole), F.lit(0))
    of_rest = F.sum(F.when(~F.col("full"), weight)).over(whole)
    used = used.withColumns({"_full": of_full.cast("bigint"), "_rest": of_rest.cast("bigint")})
    part = F.expr(
        "cast((cast(given - _full as decimal(18,0)) * cast(weight as decimal(18,0)))"
        " div cast(_rest as decimal(18,0)) as bigint)"
    )
    used = used.withColumn("budget", F.when(F.col("full"), F.col("room")).otherwise(part))
    unused = nodes.where("not weight > 0").withColumn("budget", F.lit(0).cast("bigint"))
    columns = [*nodes.columns, "budget"]
    return used.select(*columns).unionByName(unused.select(*columns))


def budgets(leaves: DataFrame, total: int, epochs: int) -> DataFrame:
    """Budget of every leaf. ``leaves``: the levels, their weights ``w_<level>``, tokens, docs.

    ``total`` is at most the tokens of all epochs. The levels come back as ``b_<level>``.
    """
    nodes = leaves.withColumn("room", F.col("tokens") * epochs)
    above: list[str] = []
    shared = None
    for level in LEVELS:
        path = [*above, level]
        group = nodes.groupBy(*path).agg(
            F.max(f"w_{level}").cast("bigint").alias("weight"), F.sum("room").alias("room")
        )
        if shared is None:
            group = group.withColumn("given", F.lit(total).cast("bigint"))
        else:
            group = group.join(shared, [group[c].eqNullSafe(shared[f"b_{c}"]) for c in above])
        group = share(group.select(*path, "weight", "room", "given"), above, level)
        shared = group.select(
            *[F.col(c).alias(f"b_{c}") for c in path], F.col("budget").alias("given")
        )
        above = path
    return shared.withColumnRenamed("given", "budget")


def mix(
    docs: DataFrame,
    domain: Column,
    weights: dict[str, Column],
    share_of_tokens: tuple[int, int] = (4, 5),
    epochs: int = 2,
    seed: int = 7,
    rows_a_task: int = ROWS_A_TASK,
    into: str = "_mix",
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """``docs`` with a struct column ``into``: domain, n_tokens, leaf_budget and ``copies`` to take.

    Tokens are words between white space. The total is ``share_of_tokens`` of all tokens there are;
    ``weights`` gives whole numbers for a level's nodes, 0 to leave one out. Nulls of a level are a
    node of their own. Rows with equal ids within a leaf, and rows without one, have one place in
    the order and are taken together. Texts without words cost nothing and come with the part of
    the order they lie in; a leaf without a budget gives none. An empty table gives none. A column
    ``into`` of ``docs`` is refused.
    """
    refuse_taken(docs, into)
    slim = kept(
        docs.select(
            domain.alias("domain"),
            docs[lang].alias("lang"),
            docs[source].alias("source"),
            docs[doc_id].cast("string").alias("id"),
            count_words(docs[text]).alias("tokens"),
        ),
        "mixture",
    )
    leaves = slim.groupBy(*LEVELS).agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("docs")
    )
    leaves = kept(leaves.withColumns({f"w_{k}": weights.get(k, F.lit(1)) for k in LEVELS}), "leaves")
    whole = leaves.agg(F.sum("tokens")).first()[0] or 0
    total = min(whole * share_of_tokens[0] // share_of_tokens[1], whole * epochs)
    found = budgets(leaves, total, epochs)
    same = [leaves[c].eqNullSafe(found[f"b_{c}"]) for c in LEVELS]
    plan = leaves.join(found, same, "left").select(
        *[leaves[c].alias(f"_{c}") for c in LEVELS],
        F.coalesce("budget", F.lit(0)).alias("budget"),
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("full"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest"),
        "docs",
    )
    plan = kept(plan, "plan")
    ends = _ends(slim, plan, seed, rows_a_task)
    plan = plan.join(
        ends, [plan[f"_{c}"].eqNullSafe(ends[f"e_{c}"]) for c in LEVELS], "left"
    ).select(*[f"_{c}" for c in LEVELS], "budget", "full", "end")
    plan = kept(plan, "taken")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    rows = docs.select(
        row,
        domain.alias("domain"),
        docs[lang].alias("lang"),
        docs[source].alias("source"),
        docs[doc_id].cast("string").alias("id"),
        count_words(docs[text]).alias("tokens"),
    )
    joined = rows.join(plan, [rows[c].eqNullSafe(plan[f"_{c}"]) for c in LEVELS], "left")
    last = F.coalesce((F.col("budget") > 0) & (_key(seed) <= F.col("end")), F.lit(False))
    return joined.select(
        "_row.*",
        F.struct(
            F.col("domain"),
            F.col("tokens").alias("n_tokens"),
            F.col("budget").alias("leaf_budget"),
            (F.col("full") + last.cast("bigint")).alias("copies"),
        ).alias(into),
    )


def _key(seed: int) -> Column:
    """Place of a document in its leaf's last epoch."""
    parts = [F.lit(str(seed)), F.col("full").cast("string"), F.coalesce("id", F.lit(""))]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def _ends(slim: DataFrame, plan: DataFrame, seed: int, most: int) -> DataFrame:
    """The key of the last document that fits in each leaf's last epoch.

    A leaf of more than ``most`` documents is not put in order as a whole. Each round splits the part
    of it that the end lies in by the next digits of the keys, and goes on with the part among those
    that the end lies in, until that is small or of one key. So a round orders at most 16^``_DIGITS``
    sums of a leaf, the last step at most ``most`` documents, and rounds grow with the logarithm.
    """
    leaf = [f"_{c}" for c in LEVELS]
    placed = kept(
        slim.join(plan, [slim[c].eqNullSafe(plan[f"_{c}"]) for c in LEVELS]).select(
            *leaf, "tokens", _key(seed).alias("key")
        ),
        "placed",
    )
    edges = plan.select(
        *[F.col(c).alias(f"e{c}") for c in leaf],
        "rest",
        F.lit("").alias("edge"),
        F.lit(0).cast(plan.schema["rest"].dataType).alias("before"),
        (F.col("docs") > most).alias("large"),
    )
    own = [f"e{c}" for c in leaf]
    same = [F.col(c).eqNullSafe(F.col(f"e{c}")) for c in leaf] + [F.startswith("key", "edge")]
    whole: list[DataFrame] = []
    edges = kept(edges, "edges")
    while edges.where("large").take(1):
        large = edges.where("large")
        digits = F.expr(f"substring(key, length(edge) + 1, {_DIGITS})").alias("digits")
        parts = (
            placed.join(large, same)
            .groupBy(*own, "rest", "edge", "before", digits)
            .agg(
                F.sum("tokens").alias("tokens"),
                F.count("*").alias("docs"),
                (F.min("key") < F.max("key")).alias("several"),
            )
        )
        upto = F.col("before") + F.sum("tokens").over(Window.partitionBy(*own).orderBy("digits"))
        parts = kept(parts.withColumn("upto", upto), "parts")
        first = F.min_by(F.struct("edge", "digits", "upto", "tokens", "docs", "several"), "digits").alias("p")
        found = parts.where("upto > rest").groupBy(*own, "rest").agg(first)
        finer = found.select(
            *own,
            "rest",
            F.concat("p.edge", "p.digits").alias("edge"),
            (F.col("p.upto") - F.col("p.tokens")).cast(edges.schema["before"].dataType).alias("before"),
            ((F.col("p.docs") > most) & F.col("p.several")).alias("large"),
        )
        # Leaves that fit as a whole: "z" is beyond every key.
        fits = parts.groupBy(*own, "rest").agg(F.max("upto").alias("all")).where("all <= rest")
        whole.append(fits.select(*own, F.lit("z").alias("end")))
        edges = kept(edges.where("not large").union(finer), "edges")
    # Equal keys are one place in the order.
    places = (
        placed.join(edges, same).groupBy(*own, "rest", "before", "key").agg(F.sum("tokens").alias("tokens"))
    )
    upto = F.col("before") + F.sum("tokens").over(Window.partitionBy(*own).orderBy("key"))
    fits = places.withColumn("upto", upto).where("upto <= rest")
    cut = fits.groupBy(*[F.col(c).alias(f"c{c}") for c in own]).agg(F.max("key").alias("cut"))
    # Without a document of the edge that fits, the order ends before the edge.
    out = edges.join(cut, [edges[c].eqNullSafe(cut[f"c{c}"]) for c in own], "left").select(
        *own, F.coalesce("cut", "edge").alias("end")
    )
    for part in whole:
        out = out.union(part)
    return out
