"""Operator 2: document fingerprints by consistent weighted sampling, in built-in functions.

The terms of a text are its words, their weights how often they occur. For sample k, a term
has two gamma variates r and c of shape 2 and an offset b, all from its hash; with
t = floor(ln w / r + b), the term with the smallest ln a = ln c - r (t - b + 1) is drawn, and
the pair (term, t) is the sample. Two texts draw the same pair with the probability of their
generalised Jaccard similarity, sum of min over sum of max of the weights.

Rank and pair are packed into one long, so a sample is a plain ``min`` of a hash aggregation.
The table is dealt out once, by ranges of the id: the text after each, the counts of words
and both fingerprints are then found in the same partitions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import NO_ID, hex_sha256, id_key, text_key, whole

SAMPLES = 64
# at least so many id ranges
RANGES = 400
SPLIT = r"[\x20\x09-\x0D]+"


def _sample(term: Column, log_weight: Column, k: int) -> Column:
    """Rank (31 bits) and identity (32 bits) of the draw that a term offers for sample k."""
    def uniform(bits, low, width):
        part = F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << width) - 1))
        return (part.cast("double") + 0.5) * 2.0 ** -width
    own, other = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    offset = uniform(own, 0, 20)
    r = -F.log(uniform(own, 40, 24) * uniform(own, 20, 20))
    t = F.floor(log_weight / r + offset)
    log_a = (F.log(-F.log(uniform(other, 32, 32) * uniform(other, 0, 32)))
             - r * (t - offset + 1))
    rank = ((log_a + 100.0) * 2.0 ** 24).cast("bigint")
    # the hash also names the term; only its identity matters there
    return F.shiftleft(rank, 32).bitwiseOR(
        own.bitwiseXOR(t * 0x9E3779B1).bitwiseAND(F.lit(0xFFFFFFFF)))


def as_longs(sha: Column) -> list[Column]:
    """A SHA-256 in hex as four longs, which aggregate without sorting."""
    return [F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("bigint") for i in range(4)]


def from_longs(parts: list[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(p), 16, "0") for p in parts]))


def drawn(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """(keys, _s0, _s1, ..., _value): the smallest offer of the rows (keys, _term, _n, _value) for each
    sample, and the largest value."""
    term, log_weight = F.col("_term"), F.col("_log")
    return terms.withColumn("_log", F.log(F.col("_n").cast("double"))).groupBy(*keys).agg(
        *[F.min(_sample(term, log_weight, k)).alias(f"_s{k}") for k in range(samples)],
        F.max("_value").alias("_value"))


def signatures(counts: DataFrame, keys: list[str], told: list[str],
               samples: int = SAMPLES) -> DataFrame:
    """(keys, told, _own, _other): arrays of ``samples`` 32-bit identities, null without terms.

    ``counts`` has (keys, _term, _kind, _n0, _n1), a term's weight in either text, where _kind is 0.
    A row of kind k holds the k-th of the ``told`` longs as its term. A term that weighs the
    same in both texts offers the same to both and is drawn once.
    """
    def offer(weight, texts):
        return F.struct(weight.alias("_n"), texts.cast("int").alias("_in"))
    n0, n1, kind = F.col("_n0"), F.col("_n1"), F.col("_kind")
    offers = F.when(kind > 0, F.array(offer(F.lit(1).cast("bigint"), kind + 3))).when(
        n0 == n1, F.array(offer(n0, F.lit(3)))).otherwise(
        F.array(offer(n0, F.lit(1)), offer(n1, F.lit(2))))
    terms = counts.select(*keys, "_term", F.when(kind > 0, F.col("_term")).alias("_value"),
                          F.inline(offers)).where("_n > 0")
    of = F.col("_in")
    best = drawn(terms, [*keys, "_in"], samples).groupBy(*keys).agg(
        *[F.max(F.when(of == 4 + i, F.col("_value"))).alias(name) for i, name in enumerate(told)], *[
            F.min(F.when((of == 3) | (of == text), F.col(f"_s{k}"))).alias(f"{n}{k}")
            for text, n in ((1, "_own"), (2, "_other")) for k in range(samples)])
    return best.select(*keys, *told, *[F.when(F.col(f"{n}0").isNotNull(), F.array(*[
        F.col(f"{n}{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(samples)])).alias(n)
        for n in ("_own", "_other")])


def as_text(signature: Column) -> Column:
    """Eight hex digits a sample; a text without words has the empty fingerprint."""
    return F.coalesce(F.array_join(F.transform(
        signature, lambda v: F.lower(F.lpad(F.hex(v), 8, "0"))), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two texts without words are alike, one alone is not."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0),
                        lambda total, x: total + x)
    return (F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0)
            .otherwise(equal / F.size(a)))


def _ranges(rows: DataFrame) -> Column:
    """Number of a row's id range; the borders are quantiles.

    There are as many ranges as keep every task of the session's shuffles busy. A border is
    looked up in two steps, first among every so-manieth of them.
    """
    spark = rows.sparkSession
    n = max(RANGES, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [(i + 1) / n for i in range(n - 1)]
    borders = sorted({int(b) for b in rows.approxQuantile("_d", shares, 0.5 / n)})
    if not borders:
        return F.lit(0)
    step = int(len(borders) ** 0.5) + 1
    groups = [borders[i:i + step] for i in range(0, len(borders), step)]

    def below(values):
        return F.size(F.filter(values, lambda b: b <= F.col("_d")))

    def longs(values):
        return F.array(*[F.lit(v).cast("bigint") for v in values])
    coarse = below(longs([g[0] for g in groups]))
    fine = below(F.get(F.array(*[longs(g) for g in groups]), coarse - 1))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents by ranges, each with the first document of the next range behind it.

    Ranges are taken in descending order of the id, and the one after the last is the first.
    What the driver holds is one short row per range.
    """
    rows = docs.select(id_key(doc_id).alias("_d"), text_key(text).alias("_h"),
                       whole(text).alias("_text"))
    ranged = rows.withColumn("_range", _ranges(docs.select(id_key(doc_id).alias("_d"))))
    heads = sorted((r["_range"], r["_head"]["_d"], r["_head"]["_h"]) for r in ranged.groupBy(
        "_range").agg(F.max(F.struct("_d", "_h")).alias("_head")).collect())
    ranges = [h[0] for h in heads]
    moved = [(d, h, to) for (_, d, h), to in zip(heads, ranges[1:] + ranges[:1])]
    borders = docs.sparkSession.createDataFrame(moved, "_d bigint NOT NULL, _h bigint NOT NULL, _to int NOT NULL")
    behind = (ranged.join(F.broadcast(borders), ["_d", "_h"])
              .withColumns({"_range": F.col("_to"), "_behind": F.lit(True)}).drop("_to"))
    return ranged.withColumn("_behind", F.lit(False)).unionByName(behind)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is the text with its last third replaced by the beginning of the next
    document's. A null text counts as empty, a null id as the smallest. Rows that repeat an id
    follow each other in the order of a hash of their texts. One document alone is its own
    next; very long texts are read whole; an empty table gives no rows.
    """
    order = Window.partitionBy("_range").orderBy("_behind", F.desc("_d"), F.desc("_h"))
    third = F.floor(F.length("_text") / 3).cast("int")
    placed = in_order(docs, doc_id, text).withColumns({
        "_row": F.row_number().over(order), "_next": F.lead("_text").over(order)})
    edited = F.concat(F.substring("_text", F.lit(1), F.length("_text") - third),
                      F.substring("_next", F.lit(1), third))
    placed = placed.withColumn("_edited", F.when(~F.col("_behind"), edited)).drop("_next")

    # what is told of a document travels as a third text of seven longs, so that the texts are
    # dealt out once and nothing is joined
    keys, told = ["_range", "_row"], ["_behind", "_id", "_n_chars", *[f"_sha{i}" for i in range(4)]]
    facts = F.concat_ws(" ", *[c.cast("string") for c in (
        F.col("_behind").cast("int"), F.col("_d"), F.length("_text"),
        *as_longs(hex_sha256(F.col("_edited"))))])
    sides = placed.select(*keys, F.posexplode(F.when(F.col("_behind"), F.array("_text", F.lit(""), facts))
                                              .otherwise(F.array("_text", "_edited", facts)))
                          .alias("_side", "_of"))
    words = sides.select(*keys, "_side", F.posexplode(F.split("_of", SPLIT)).alias("_place", "_word")
                         ).where("_word <> ''")
    fact = F.col("_side") == 2
    counts = words.select(
        *keys, "_side", F.when(fact, F.expr("try_cast(_word AS bigint)")).otherwise(
            F.xxhash64("_word")).alias("_term"),
        F.when(fact, F.col("_place") + 1).otherwise(0).alias("_kind")).groupBy(
        *keys, "_term", "_kind").agg(*[F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in (0, 1)])
    signed = signatures(counts, keys, told, samples)
    after = Window.partitionBy("_range").orderBy("_row")
    joined = signed.withColumn("_following", F.lead("_own").over(after)).where("_behind = 0").select(
        F.nullif("_id", F.lit(NO_ID)).alias("doc_id"), F.col("_n_chars").alias("n_chars"),
        from_longs([F.col(c) for c in told[3:]]).alias("edited_sha256"), "_own", "_other", "_following")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_other")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_other")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_following")).alias("near_next"))
