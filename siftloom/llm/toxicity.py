"""Operator 4: toxicity categories by a chain of linear classifiers.

The categories are predicted one after the other, and each model sees the probabilities
of the earlier ones beside the words. In training, those are out-of-fold predictions:
the probability a row feeds on comes from a model that has not seen the row, as it will be
for the documents scored later.

Training uses a bounded sample (``sample_rows`` labelled rows, smallest id hashes first, and of
each the distinct words); it runs as one Spark task. Scoring covers every document.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import aside, aside_schema, back, id_key, whole
from siftloom.session import materialize

WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Chain:
    """``categories`` are columns of the labels, 1 for yes, or 0 if named with a minus."""

    categories: tuple = ("-quality", "toxic")
    sample_rows: int = 20_000
    features: int = 256
    folds: int = 4
    least_z: float = 3.0
    least_seen: int = 3
    penalty: float = 1.0
    threshold: float = 0.5


def words(text: str) -> set:
    """The distinct words, and their beginnings of four and six letters as ``abcd~``."""
    found = set(WORD.findall(text.lower()))
    return found | {w[:4] + "~" for w in found if len(w) > 4} \
        | {w[:6] + "~" for w in found if len(w) > 6}


def matrix(bags: list, vocabulary: list, earlier: list) -> np.ndarray:
    """Constant, word presence and the earlier categories' log odds."""
    place = {w: i + 1 for i, w in enumerate(vocabulary)}
    out = np.zeros((len(bags), 1 + len(place) + len(earlier)))
    out[:, 0] = 1.0
    for row, bag in enumerate(bags):
        for word in bag & place.keys():
            out[row, place[word]] = 1.0
    for i, p in enumerate(earlier):
        p = np.clip(p, 1e-4, 1 - 1e-4)
        out[:, 1 + len(place) + i] = np.log(p / (1 - p))
    return out


def fitted(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the constant is free."""
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    weights = np.zeros(x.shape[1])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    weights[0] = np.log(share / (1 - share))
    for _ in range(25):
        p = probability(x, weights)
        slope = x.T @ (p - y) + ridge * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -30, 30)))


def train(bags: list, targets: np.ndarray, folds: np.ndarray, chain: Chain,
          chosen: dict) -> list:
    """(vocabulary, weights) of each category in turn.

    ``chosen`` has the words for (category, fold), found without that fold; fold -1 is none.
    """
    earlier, models = [], []
    for category in range(targets.shape[1]):
        y = targets[:, category]
        held_out = np.full(len(bags), y.mean() if len(y) else 0.0)
        for fold in range(chain.folds):
            rest = np.flatnonzero(folds != fold)
            own = np.flatnonzero(folds == fold)
            if not len(rest) or not len(own):
                continue
            some = [bags[i] for i in rest]
            vocabulary = chosen.get((category, fold), [])
            weights = fitted(matrix(some, vocabulary, [e[rest] for e in earlier]), y[rest],
                             chain.penalty)
            held_out[own] = probability(matrix([bags[i] for i in own], vocabulary,
                                               [e[own] for e in earlier]), weights)
        vocabulary = chosen.get((category, -1), [])
        weights = fitted(matrix(bags, vocabulary, earlier), y, chain.penalty) if len(y) else \
            np.array([-30.0] + [0.0] * len(earlier))
        models.append((vocabulary, weights))
        earlier.append(held_out)
    return models


def predict(texts: list, models: list) -> list:
    """Probabilities per category; only words that some model knows are looked up."""
    known = set().union(*[set(v) for v, _ in models])
    bags = [words(t) & known for t in texts]
    out = []
    for vocabulary, weights in models:
        out.append(probability(matrix(bags, vocabulary, out), weights))
    return out


def sample(docs: DataFrame, labels: DataFrame, chain: Chain, doc_id: str, text: str) -> DataFrame:
    """(_d, _text, target columns) of the bounded sample of labelled documents.

    Of several texts of an id the one with the smallest hash is used.
    """
    named = [c.lstrip("-") for c in chain.categories]
    hit = [(F.col(c.lstrip("-")) == (0 if c.startswith("-") else 1)).cast("double")
           .alias(f"_y{i}") for i, c in enumerate(chain.categories)]
    usable = labels.where(F.col(doc_id).isNotNull())
    for name in named:
        usable = usable.where(F.col(name).isNotNull())
    bounded = (usable.select(F.col(doc_id).cast("bigint").alias("_d"), *hit)
               .groupBy("_d").agg(*[F.max(f"_y{i}").alias(f"_y{i}") for i in range(len(named))])
               .orderBy(F.xxhash64("_d"), "_d").limit(chain.sample_rows))
    texts = docs.select(id_key(doc_id).alias("_d"), whole(text).alias("_text"))
    # at most sample_rows short rows, so the broadcast has a fixed bound
    named = [f"_y{i}" for i in range(len(chain.categories))]
    return texts.join(F.broadcast(bounded), "_d").groupBy("_d").agg(
        F.min_by("_text", F.xxhash64("_text")).alias("_text"), *[F.max(c).alias(c) for c in named])


def chosen_words(bags: DataFrame, chain: Chain) -> DataFrame:
    """(category, fold, word): the words whose share differs most between the classes.

    By the two-sample z value, counted without the fold; -1 leaves none out. Of many words some
    differ by chance, the more the more words there are, so the least value grows with them.
    """
    y = range(len(chain.categories))
    folds = range(chain.folds)

    def sums(of_word):
        return [F.sum(F.when(F.col("_fold") == f, value).otherwise(0.0)).alias(name + str(f))
                for f in folds for name, value in
                [("n", F.lit(1.0)), *[(f"p{c}_", F.col(f"_y{c}")) for c in y]]] + (
                    [F.count("*").alias("_seen")] if of_word else [])
    totals = bags.agg(*sums(False)).first().asDict()
    counts = materialize(
        bags.select("_fold", *[f"_y{c}" for c in y], F.explode("_bag").alias("word"))
        .groupBy("word").agg(*sums(True)).where(F.col("_seen") >= chain.least_seen), "counts")
    least = max(chain.least_z, float(np.sqrt(2 * np.log(max(1, counts.count())))))

    def z(category, without):
        used = [f for f in folds if f != without]

        def both(name):
            return (sum(F.col(name + str(f)) for f in used),
                    sum(totals[name + str(f)] or 0.0 for f in used))
        (n, n_all), (hit, hit_all) = both("n"), both(f"p{category}_")
        miss_all = n_all - hit_all
        if not hit_all or not miss_all:
            return F.lit(0.0)
        shared = (n + 1.0) / (n_all + 2.0)
        apart = (hit + 0.5) / (hit_all + 1.0) - (n - hit + 0.5) / (miss_all + 1.0)
        return F.abs(apart) / F.sqrt(shared * (1 - shared) * (1 / hit_all + 1 / miss_all))

    scored = counts.select("word", F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.lit(f).alias("fold"), z(c, f).alias("z"))
        for c in y for f in (-1, *folds)])).alias("_of")).select("word", "_of.*")
    best = Window.partitionBy("category", "fold").orderBy(F.desc("z"), "word")
    return (scored.where(F.col("z") >= least).withColumn("_rank", F.row_number().over(best))
            .where(F.col("_rank") <= chain.features).select("category", "fold", "word", "_rank"))


def fit(docs: DataFrame, labels: DataFrame, chain: Chain = Chain(), doc_id: str = "doc_id",
        text: str = "text") -> DataFrame:
    """The model: (category, position, word, weight), at most ``features`` + 3 rows each.

    Words are counted by Spark. What the driver and the task that fits the weights see is bounded
    by ``features`` and ``sample_rows``.
    """
    y = [f"_y{i}" for i in range(len(chain.categories))]
    columns = ", ".join(f"{c} double" for c in y)

    def bagged(select):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in range(0, batch.num_rows, 256):
                    part = batch.slice(first, 256)
                    bags = [select(t) for t in part.column("_text").to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_d"), part.column("_fold"),
                         pa.array(bags, pa.list_(pa.string())), *[part.column(c) for c in y]],
                        names=["_d", "_fold", "_bag", *y])
        return run

    schema = f"_d bigint, _fold int, _bag array<string>, {columns}"
    fold = F.pmod(F.xxhash64("_d", F.lit("fold")), F.lit(chain.folds)).cast("int")
    picked = materialize(sample(docs, labels, chain, doc_id, text).withColumn("_fold", fold),
                         "sample")
    bags = picked.mapInArrow(bagged(lambda t: sorted(words(t))), schema)
    chosen: dict = {}
    for r in sorted(chosen_words(bags, chain).collect(), key=lambda r: r["_rank"]):
        chosen.setdefault((r.category, r.fold), []).append(r.word)
    known = set().union(*chosen.values()) if chosen else set()

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches) or [pd.DataFrame(columns=["_d", "_fold", "_bag", *y])])
        rows = rows.sort_values(["_d"], kind="stable").drop_duplicates("_d")
        models = train([set(b) for b in rows["_bag"]],
                       rows[y].to_numpy(dtype=float).reshape(len(rows), len(y)),
                       rows["_fold"].to_numpy(), chain, chosen)
        out = [(c, i, word, float(weight)) for c, (vocabulary, weights) in enumerate(models)
               for i, (word, weight) in enumerate(
                   zip(["", *vocabulary, *[""] * c], weights))]
        yield pd.DataFrame(out, columns=["category", "position", "word", "weight"])

    # one task: the sample is bounded by a parameter, and only chosen words are left in it
    few = materialize(picked.mapInArrow(bagged(lambda t: sorted(words(t) & known)), schema),
                      "bags")
    return few.coalesce(1).mapInPandas(
        learn, "category int, position int, word string, weight double")


def score(docs: DataFrame, model: DataFrame, chain: Chain = Chain(),
          text: str = "text") -> DataFrame:
    """The documents, their columns set aside as ``__0``, ..., with ``_p0``, ... for the categories."""
    models = []
    rows = sorted(model.collect(), key=lambda r: (r.category, r.position))
    for category in range(len(chain.categories)):
        own = [r for r in rows if r.category == category]
        models.append(([r.word for r in own if r.word], np.array([r.weight for r in own])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [n for n in batch.schema.names if n != "_text"]
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                scores = predict(part.column("_text").to_pylist(), models)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in kept], *[pa.array(s) for s in scores]],
                    names=[*kept, *[f"_p{i}" for i in range(len(scores))]])

    names = docs.columns
    return docs.select(*aside(docs, names), whole(text).alias("_text")).mapInArrow(
        run, aside_schema(docs, names) + "".join(
            f", _p{i} double" for i in range(len(chain.categories))))


def toxicity(docs: DataFrame, labels: DataFrame, chain: Chain = Chain(), doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(doc_id, p_<category>..., toxic): one row per document.

    ``toxic`` compares the last category's probability with ``threshold``. A null text counts as
    empty and gets the probabilities of a text without known words. Without usable labels
    nothing is toxic. Repeated rows get equal probabilities; rows of labels with a null are not
    used, of repeated label rows the larger value counts, of several texts of a labelled id the one
    with the smallest hash. Very long texts are read whole; an empty table gives no rows.
    """
    model = materialize(fit(docs, labels, chain, doc_id, text), "model")
    names = [c.lstrip("-") if not c.startswith("-") else f"low_{c[1:]}" for c in chain.categories]
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = score(given, model, chain)
    last = f"_p{len(names) - 1}"
    return scored.select(F.col("__0").alias("doc_id"),
                         *[F.col(f"_p{i}").alias(f"p_{n}") for i, n in enumerate(names)],
                         (F.col(last) >= chain.threshold).alias("toxic"))


def without_toxic(docs: DataFrame, labels: DataFrame, chain: Chain = Chain(),
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not toxic, with their columns."""
    model = materialize(fit(docs, labels, chain, doc_id, text), "model")
    scored = score(docs, model, chain, text)
    last = len(chain.categories) - 1
    return scored.where(F.col(f"_p{last}") < chain.threshold).select(*back(docs.columns))
