"""Operator 3: mixing sources to target weights by budgets that flow down a tree.

The leaves of the tree are (domain, language, source). The token budget is divided at the root by the
domains' weights, a domain's share by the weights of its languages, theirs by those of
the sources. Nobody gets more than it can give, its tokens times ``epochs``. What a child cannot
use goes to its siblings by their weights; only what all of them together cannot use has
never reached their parent, whose siblings got it: capacities are summed upwards first.

A leaf reads its documents in epochs, each in an own order that depends on the seed, the
epoch and the id alone: all of it as often as the budget allows, then the longest prefix that
fits. The prefix is found over ranges of the order, so no task sorts a whole leaf.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import NO_ID, aside, back, id_key, text_key, whole
from siftloom.session import materialize

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """``share``: the budget as a part of all tokens. Weights not given are 1; what has a weight of 0
    or less, or lies below such a node, gets nothing and gives its share to its siblings."""

    share: float = 0.6
    epochs: int = 2
    seed: int = 17
    weights: dict = field(default_factory=lambda: {
        "domain": {"web": 5.0, "books": 3.0, "code": 2.0}, "lang": {"en": 4.0, "de": 2.0}})


def domain_of(source) -> Column:
    """The query's own domains: sources are dealt to three of them by their number."""
    number = F.regexp_extract(F.col(source), "([0-9]+)$", 1)
    return F.when(number == "", "other").otherwise(
        F.element_at(F.array(F.lit("web"), F.lit("code"), F.lit("books")),
                     (F.try_mod(number.cast("bigint"), F.lit(3)) + 1).cast("int")))


def token_rows(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", text: str = "text",
               domain: Column | None = None) -> DataFrame:
    """Narrow rows: row key, leaf and number of words; a null label is the label ''."""
    def label(column):
        return F.coalesce(column.cast("string"), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), id_key(doc_id).alias("_d"), text_key(text).alias("_h"),
        label(domain_of("source") if domain is None else domain).alias("domain"),
        label(F.col("lang")).alias("lang"), label(F.col("source")).alias("source"),
        F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("tokens"))


def _weight(level: str, mix: Mix) -> Column:
    given = mix.weights.get(level, {})
    out = F.lit(1.0)
    for name, weight in sorted(given.items()):
        out = F.when(F.col(level) == name, float(weight)).otherwise(out)
    return out


def _divided(children: DataFrame, parents: DataFrame, keys: list[str], own: str,
             mix: Mix) -> DataFrame:
    """Budgets of the children of every parent: equal levels per weight, up to capacity.

    In the order of capacity per weight, a child is filled up while the level that the rest
    would get is not lower; all later ones get weight times that level.
    """
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    # without a weight above 0 there is no capacity either, so the weight does not matter then
    weight = _weight(own, mix)
    weighed = children.withColumn("_w", F.when(weight > 0, weight).otherwise(1.0)).withColumn(
        "_q", F.col("capacity") / F.col("_w"))
    order = w.orderBy("_q", own).rowsBetween(Window.unboundedPreceding, -1)
    joined = (weighed.join(parents, keys) if keys else weighed.crossJoin(parents))
    filled = joined.withColumns({
        "_before": F.coalesce(F.sum("capacity").over(order), F.lit(0)),
        "_rest": F.sum("_w").over(w) - F.coalesce(F.sum("_w").over(order), F.lit(0.0))})
    level = (F.col("budget") - F.col("_before")) / F.col("_rest")
    found = filled.withColumn("_full", F.col("_q") <= level).withColumn(
        "_level", F.first(F.when(~F.col("_full"), level), ignorenulls=True).over(
            w.orderBy("_q", own).rowsBetween(Window.unboundedPreceding, 0)))
    return found.select(*keys, own, "capacity", F.when(
        F.col("_level").isNull(), F.col("capacity").cast("double"))
        .otherwise(F.col("_w") * F.col("_level")).alias("budget"))


def leaf_budgets(rows: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, budget): whole tokens, at most tokens x epochs."""
    leaves = materialize(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "leaves")
    open_leaf = F.lit(True)
    for level in LEVELS:
        open_leaf = open_leaf & (_weight(level, mix) > 0)
    sized = leaves.withColumn("capacity", F.when(open_leaf, F.col("tokens") * mix.epochs).otherwise(0))
    parents = sized.agg(F.coalesce(F.least(F.sum("tokens") * mix.share, F.sum("capacity")),
                                   F.lit(0.0)).alias("budget"))
    for depth, own in enumerate(LEVELS):
        keys = list(LEVELS[:depth])
        children = sized.groupBy(*keys, own).agg(F.sum("capacity").alias("capacity"))
        parents = _divided(children, parents, keys, own, mix).drop("capacity")
    return leaves.join(parents, list(LEVELS)).withColumn(
        "budget", F.least(F.floor(F.col("budget") + 1e-6), F.col("tokens") * mix.epochs))


def _order(mix: Mix, epoch) -> Column:
    """Place in an epoch's order; rows without id are placed by their texts."""
    name = F.when(F.col("_d") == NO_ID, F.concat(F.lit("text "), F.col("_h").cast("string"))).otherwise(
        F.col("_d").cast("string"))
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), name))


def mixed(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id",
          text: str = "text", domain: Column | None = None) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, copies) and the row key of every document.

    ``copies`` says how often the mix holds the document, 0 for not at all. Null texts and
    texts without words have no tokens and ride along wherever their place in the order lies
    in the prefix. Ties of the order are broken by the text; equal rows are equal in the prefix up
    to the last that fits. Rows without id are placed by their texts. Very long texts count whole; one
    longer than what is left of a budget ends the prefix. An empty table gives no rows.
    """
    rows = materialize(token_rows(docs, mix, doc_id, text, domain), "tokens")
    budgets = leaf_budgets(rows, mix).select(
        *LEVELS, "budget",
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens")))
        .otherwise(F.lit(0)).alias("full"), F.col("tokens").alias("_all"))
    budgets = materialize(budgets.withColumn("rest", F.col("budget") - F.col("full")
                                             * F.col("_all")), "budgets")
    placed = rows.join(budgets.select(*LEVELS, "full", "rest"), list(LEVELS)).withColumn(
        "_key", _order(mix, F.col("full"))).withColumn("_bucket", F.substring("_key", 1, 3))
    sums = placed.groupBy(*LEVELS, "_bucket").agg(F.sum("tokens").alias("_sum"))
    so_far = F.sum("_sum").over(Window.partitionBy(*LEVELS).orderBy("_bucket"))
    sums = sums.select(*LEVELS, "_bucket", (so_far - F.col("_sum")).alias("_before"),
                       so_far.alias("_after"))
    found = placed.join(sums, [*LEVELS, "_bucket"])
    whole_bucket = found.where("_after <= rest OR _before > rest").withColumn(
        "_in", F.col("_after") <= F.col("rest"))
    running = F.sum("tokens").over(Window.partitionBy(*LEVELS, "_bucket")
                                   .orderBy("_key", "_h").rowsBetween(
                                       Window.unboundedPreceding, 0))
    cut = found.where("_after > rest AND _before <= rest").withColumn(
        "_in", F.col("_before") + running <= F.col("rest"))
    return whole_bucket.unionByName(cut).select(
        "doc_id", *LEVELS, F.col("tokens").alias("n_tokens"),
        (F.col("full") + F.col("_in").cast("bigint")).alias("copies"), "_d", "_h")


def mixture(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """The documents of the mix with their columns, each as often as it is taken."""
    chosen = (mixed(docs, mix, doc_id, text).where("copies > 0")
              .groupBy("_d", "_h").agg(F.max("copies").alias("_copies")))
    names = docs.columns
    keyed = docs.select(*aside(docs, names), id_key(doc_id).alias("_d"), text_key(text).alias("_h"))
    joined = keyed.join(chosen, ["_d", "_h"])
    if mix.epochs > 1:
        joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return joined.select(*back(names))
