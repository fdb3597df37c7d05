"""Toxicity by a classifier chain: each category's linear model also reads the probabilities of those before it."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.rank_bpe import chunks
from segflow.llm.tables import release_memory, stored, text_slices

#: Labelled documents the models are fitted on, at most: toxic ones, and others.
TOXIC_SAMPLE, OTHER_SAMPLE = 2_000, 4_000
FOLDS = 4
#: Features that a category may use, and documents of the category that must hold each.
FEATURES, LEAST_DOCUMENTS = 120, 6
GRAM = 5
PENALTY = 0.0003
LANGUAGES = ("en", "de", "fr", "es")
#: Words whose features a task remembers.
KNOWN_WORDS = 300_000
#: Features that a task hands on at a time when they are counted.
COUNTED_ROWS = 10_000

_WORDS = re.compile(r"\w+").findall


def word_features(word: str) -> list[str]:
    """The word, and each of its runs of GRAM characters; the word is marked by a leading blank."""
    return [f" {word}", *(word[i : i + GRAM] for i in range(len(word) - GRAM + 1))]


def document_words(text: str) -> set[str]:
    return set(_WORDS(text.lower()))


class Sparse:
    """A matrix of few entries, as rows, columns and values."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        self.rows, self.columns, self.values, self.shape = rows, columns, values, shape

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * weights[self.columns], self.shape[0])

    def transposed_times(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.values * errors[self.rows], self.shape[1])

    def only(self, chosen: np.ndarray) -> Sparse:
        """The rows where `chosen` is true, numbered anew."""
        keep, number = chosen[self.rows], np.cumsum(chosen) - 1
        return Sparse(
            number[self.rows[keep]], self.columns[keep], self.values[keep], (int(chosen.sum()), self.shape[1])
        )


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Link:
    """One model of the chain: feature weights, weights of earlier probabilities, and the intercept."""

    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def probability(self, base: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return sigmoid(base + earlier @ self.earlier + self.intercept)


def fit_link(x: Sparse, earlier: np.ndarray, labels: np.ndarray, weight: np.ndarray, steps: int = 300) -> Link:
    """Logistic regression by accelerated proximal steps, with an absolute penalty on feature weights.

    Feature weights are not negative: a word can speak for a category, and no amount of other words
    in a long document speaks against it. Labels of one kind only give a constant model.
    """
    share = float((weight * labels).sum() / weight.sum()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Link(np.zeros(x.shape[1]), np.zeros(earlier.shape[1]), 30.0 if share else -30.0)
    dense = np.column_stack([earlier, np.ones(len(labels))])
    scale = weight / weight.sum()
    n = x.shape[1]
    # Columns of more equal size: else the steps that suit common features hardly move the rare ones.
    size = np.sqrt(np.bincount(x.columns, x.values**2 * scale[x.rows], n))
    unit = 1 / np.sqrt(np.maximum(size, 1e-2))
    x = Sparse(x.rows, x.columns, x.values * unit[x.columns], x.shape)

    def scores(w: np.ndarray) -> np.ndarray:
        return x.times(w[:n]) + dense @ w[n:]

    def gradient(errors: np.ndarray) -> np.ndarray:
        return np.concatenate([x.transposed_times(errors), dense.T @ errors])

    v = np.ones(n + dense.shape[1])
    for _ in range(15):
        v = gradient(scale * scores(v))
        bound = float(np.linalg.norm(v))
        v /= bound
    step = 4 / (bound * 1.1)
    w = np.zeros_like(v)
    w[-1] = np.log(share / (1 - share))
    ahead, pace = w.copy(), 1.0
    for _ in range(steps):
        after = ahead - step * gradient(scale * (sigmoid(scores(ahead)) - labels))
        after[:n] = np.maximum(0, after[:n] - step * PENALTY)
        quicker = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, w, pace = after + (pace - 1) / quicker * (after - w), after, quicker
    return Link(w[:n] * unit, w[n:-1], float(w[-1]))


def fit_chain(x: Sparse, labels: np.ndarray, weight: np.ndarray, folds: np.ndarray) -> tuple[list[Link], np.ndarray]:
    """A model for each column of labels, in order, and the out-of-fold probabilities of each.

    A later model is fitted on probabilities that earlier ones gave for documents outside their own
    training folds, so it learns how far to trust them on documents not seen before.
    """
    earlier = np.zeros((x.shape[0], 0))
    chain = []
    for k in range(labels.shape[1]):
        held_out = np.zeros(x.shape[0])
        for fold in range(FOLDS):
            inside, outside = folds != fold, folds == fold
            part = fit_link(x.only(inside), earlier[inside], labels[inside, k], weight[inside])
            held_out[outside] = part.probability(x.only(outside).times(part.weights), earlier[outside])
        chain.append(fit_link(x, earlier, labels[:, k], weight))
        earlier = np.column_stack([earlier, held_out])
    return chain, earlier


def best_threshold(p: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The probability that parts out-of-fold documents best, midway to the next lower one.

    Best by the F measure that counts precision twice: clean documents are left alone.
    """
    order = np.argsort(-p, kind="stable")
    hits, taken = np.cumsum((weight * labels)[order]), np.cumsum(weight[order])
    if not len(p) or hits[-1] in (0.0, taken[-1]):
        return 0.5
    falls = np.flatnonzero(np.r_[p[order][1:] < p[order][:-1], True])
    best = falls[np.argmax(1.25 * hits[falls] / (taken[falls] + 0.25 * hits[-1]))]
    below = p[order[best + 1]] if best + 1 < len(p) else 0.0
    return float((p[order[best]] + below) / 2)


@dataclass
class ToxicityModel:
    """Category names, the number of each feature, the chain, and the last category's least probability."""

    categories: list[str]
    features: dict[str, int]
    chain: list[Link]
    threshold: float = 0.5

    def probabilities(self, x: Sparse) -> np.ndarray:
        """A column for each category."""
        earlier = np.zeros((x.shape[0], 0))
        for link in self.chain:
            earlier = np.column_stack([earlier, link.probability(x.times(link.weights), earlier)])
        return earlier


class Reader:
    """Turns texts into features; remembers which words have any."""

    def __init__(self, features: dict[str, int]):
        self.features = features
        self.plain: set[str] = set()
        self.telling: dict[str, list[int]] = {}

    def matrix(self, texts: list[str]) -> Sparse:
        """A feature's value is the logarithm of one plus the number of distinct words that have it."""
        rows, columns, values = [], [], []
        for row, text in enumerate(texts):
            words = document_words(text)
            for word in words.difference(self.plain).difference(self.telling):
                found = [self.features[f] for f in set(word_features(word)).intersection(self.features.keys())]
                if found:
                    self.telling[word] = found
                else:
                    self.plain.add(word)
            counts = Counter(f for word in self.telling.keys() & words for f in self.telling[word])
            rows.extend([row] * len(counts))
            columns.extend(counts)
            values.extend(counts.values())
            if len(self.plain) + len(self.telling) > KNOWN_WORDS:
                self.plain, self.telling = set(), {}
        shape = (len(texts), max(1, len(self.features)))
        return Sparse(np.array(rows, np.int64), np.array(columns, np.int64), np.log1p(np.array(values, float)), shape)


def _sample(documents: DataFrame, labels: DataFrame, key: str, text: str, lang: str | None) -> tuple[DataFrame, dict]:
    """At most TOXIC_SAMPLE and OTHER_SAMPLE labelled documents, and how many there are of each kind."""
    marked = (
        labels.select(F.col(key).alias("key"), F.col("toxic").cast("int"), F.col("quality").cast("int"))
        .filter("key IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("key")
        .agg(F.max("toxic").alias("toxic"), F.min(F.coalesce("quality", F.lit(1))).alias("quality"))
    )
    there = {bool(r["toxic"]): r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.lit("sample"), "key")
    chosen = reduce(
        DataFrame.unionByName,
        [
            marked.filter(F.col("toxic") == int(toxic)).orderBy(order, "key").limit(most)
            for toxic, most in ((True, TOXIC_SAMPLE), (False, OTHER_SAMPLE))
        ],
    )
    texts = documents.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.col(lang) if lang else F.lit(None).cast("string")).alias("lang"),
    )
    # Of several rows of a key the one with the smallest hash of its text, so that a fit can be repeated.
    one = F.min(F.struct(F.xxhash64("text").alias("mark"), "text", "lang")).alias("one")
    found = texts.join(F.broadcast(chosen), "key").groupBy("key", "toxic", "quality").agg(one)
    found = found.select("key", F.col("one.text").alias("text"), F.col("one.lang").alias("lang"), "toxic", "quality")
    return stored(found.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "key"), F.lit(FOLDS)).cast("int")), "sample"), there


def _categories(languages: tuple[str, ...]) -> dict[str, Column]:
    """What each category's label is, in chain order; the last one is the verdict."""
    toxic = F.col("toxic") > 0
    first = {"junk": F.col("quality") == 0}
    tongues = {f"toxic_{c}": toxic & F.coalesce(F.col("lang") == c, F.lit(False)) for c in languages}
    return {**first, **tongues, "toxic": toxic}


def _selected_features(sample: DataFrame, names: list[str]) -> list[str]:
    """For each category, the features that most surely are commoner in its documents than elsewhere."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole, by_name = Counter(), [Counter() for _ in names]
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = {f for word in document_words(row.text) for f in word_features(word)}
                whole.update(found)
                for counter, hit in zip(by_name, row.labels):
                    if hit:
                        counter.update(found)
        counted = iter(whole)
        while some := list(islice(counted, COUNTED_ROWS)):
            yield pd.DataFrame(
                {"feature": some, "n": [whole[f] for f in some]}
                | {f"n{k}": [c[f] for f in some] for k, c in enumerate(by_name)}
            )
        del counted, whole, by_name
        release_memory()

    columns = ", ".join(f"n{k} long" for k in range(len(names)))
    counted = sample.select("text", "labels").mapInPandas(count, f"feature string, n long, {columns}")
    sums = counted.groupBy("feature").agg(
        F.sum("n").alias("n"), *[F.sum(f"n{k}").alias(f"n{k}") for k in range(len(names))]
    )
    totals = sample.agg(
        F.count("*").alias("n"), *[F.sum(F.col("labels")[k].cast("long")).alias(f"n{k}") for k in range(len(names))]
    ).first()
    sums = stored(sums, "features")
    features: list[str] = []
    for k in range(len(names)):
        inside = totals[f"n{k}"] or 0
        outside = totals["n"] - inside
        if not inside or not outside:
            continue
        share = F.col("n") / totals["n"]
        lead = F.col(f"n{k}") / inside - (F.col("n") - F.col(f"n{k}")) / outside
        sure = lead / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-6)) * (1 / inside + 1 / outside))
        best = sums.filter(F.col(f"n{k}") >= LEAST_DOCUMENTS).select("feature", sure.alias("sure")).filter("sure > 2")
        features.extend(r["feature"] for r in best.orderBy(F.desc("sure"), "feature").limit(FEATURES).collect())
    return list(dict.fromkeys(features))


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str | None = "lang",
    languages: tuple[str, ...] = LANGUAGES,
) -> ToxicityModel:
    """Fit the chain on a bounded sample of labelled documents (TOXIC_SAMPLE and OTHER_SAMPLE of them).

    The sample weighs as much as all labelled rows of its kind. The categories are junk, toxicity in
    each language, and toxicity; labels with a null key or verdict are left out, and of several
    labels for a key the harshest holds. Without labels of both kinds nothing is toxic.
    """
    categories = _categories(languages)
    names = list(categories)
    sample, there = _sample(documents, labels, key, text, lang if lang in documents.columns else None)
    sample = sample.withColumn("labels", F.array(*[c.cast("double") for c in categories.values()]))
    numbers = {f: i for i, f in enumerate(_selected_features(sample, names))}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(numbers)
        for batch in batches:
            x = reader.matrix(batch["text"].tolist())
            cut = np.searchsorted(x.rows, np.arange(1, len(batch)))
            yield pd.DataFrame(
                {
                    "key": batch["key"],
                    "fold": batch["fold"],
                    "labels": batch["labels"],
                    "columns": np.split(x.columns, cut) if len(batch) else [],
                    "values": np.split(x.values, cut) if len(batch) else [],
                }
            )
        del reader
        release_memory()

    schema = f"key {sample.schema['key'].dataType.simpleString()}, fold int, labels array<double>, columns array<long>, values array<double>"
    rows = sample.select("key", "text", "fold", "labels").mapInPandas(read, schema).orderBy("key").toPandas()
    y = np.array(rows["labels"].tolist(), float).reshape(len(rows), len(names))
    lengths = rows["columns"].map(len).to_numpy(np.int64)
    x = Sparse(
        np.repeat(np.arange(len(rows)), lengths),
        np.concatenate([*rows["columns"], np.zeros(0, np.int64)]).astype(np.int64),
        np.concatenate([*rows["values"], np.zeros(0)]),
        (len(rows), max(1, len(numbers))),
    )
    toxic = y[:, -1] > 0
    weight = np.where(
        toxic, there.get(True, 0) / max(1, toxic.sum()), there.get(False, 0) / max(1, (~toxic).sum())
    )
    chain, held_out = fit_chain(x, y, weight, rows["fold"].to_numpy(np.int64))
    return ToxicityModel(names, numbers, chain, best_threshold(held_out[:, -1], y[:, -1], weight))


def score_toxicity(documents: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, the probability p_<category> of each category, and `toxic`: whether the last reaches the model's threshold.

    Whole texts are read; null and empty ones hold no words and get the models' base rates. Repeated
    rows get equal scores, and an empty table gives no rows.
    """
    columns = [f"p_{c}" for c in model.categories]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.features)
        for batch in text_slices(batches, 1):
            found = [model.probabilities(reader.matrix(texts)) for texts in chunks(batch.column(1))]
            p = np.concatenate([np.zeros((0, len(columns))), *found])
            arrays = [batch.column(0), *(pa.array(p[:, k]) for k in range(len(columns)))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", *columns])

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    scored = source.mapInArrow(score, f"key {key_type}, " + ", ".join(f"{c} double" for c in columns))
    return scored.withColumn("toxic", F.col(columns[-1]) >= model.threshold).withColumnRenamed("key", key)


def keep_clean(documents: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The documents, all columns, that the chain does not call toxic; null and empty texts stay."""

    at = documents.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.features)
        for batch in text_slices(batches, at):
            found = [model.probabilities(reader.matrix(texts))[:, -1] for texts in chunks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *found]) < model.threshold))

    return documents.mapInArrow(keep, documents.schema)
