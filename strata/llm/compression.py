"""Quality by compression: zstandard dictionaries of good and bad text, and a calibrated score."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, content, without

OUT = ("score",)
# Texts are compressed in blocks of so many bytes, so that a dictionary counts as much at the end of a text as at its start.
BLOCK = 1024
DICTIONARY = 48 * 1024
LEVEL = 3


def blocks(text: str) -> list[bytes]:
    raw = text.encode()
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or the texts themselves if they are too few to train one."""
    samples = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY]


@dataclass
class CompressionModel:
    """Two dictionaries and the logistic calibration of what they make of a text."""

    good: bytes
    bad: bytes
    weights: list[float] = field(default_factory=list)

    def __post_init__(self):
        plain = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
        self._codecs = [plain]
        for data in (self.good, self.bad):
            shared = zstandard.ZstdCompressionDict(data)
            self._codecs.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=shared, write_dict_id=False, write_checksum=False, write_content_size=False
                )
            )

    def __reduce__(self):
        return CompressionModel, (self.good, self.bad, self.weights)

    def features(self, text: str) -> list[float]:
        """The normalised difference of the sizes with both dictionaries, how far the text shrinks at all, and its length."""
        sizes, parts = [0, 0, 0], blocks(text)
        for b in parts:
            for i, codec in enumerate(self._codecs):
                sizes[i] += len(codec.compress(b))
        n = sum(map(len, parts))
        difference = (sizes[2] - sizes[1]) / max(1, sizes[1] + sizes[2])
        ratio = min(2.0, sizes[0] / max(1, n))
        return [1.0, 10 * difference, 4 * ratio, 4 * ratio * ratio, 0.2 * float(np.log1p(n))]

    def calibrate(self, texts: list[str], labels: list[int], prior: float) -> CompressionModel:
        """Logistic regression by Newton steps; classes are weighted to their true shares."""
        x, y = np.array([self.features(t) for t in texts]).reshape(len(texts), 5), np.array(labels, float)
        weight = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum())) * len(y)
        w, ridge = np.zeros(5), 0.05 * np.eye(5)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
            step = np.linalg.solve(hessian, x.T @ (weight * (p - y)) + ridge @ w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w.tolist()
        return self

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.features(text), self.weights), -30, 30))))


def fit_quality(
    docs: DataFrame, labels: DataFrame, training: Column, sample: int = 2000, id: str = "doc_id", text: str = "text", label: str = "quality"
) -> CompressionModel:
    """Fit on at most ``sample`` labelled texts of each class among the rows where ``training`` holds.

    ``training`` is a condition on the label table, and only rows that meet it are read. The sample is the same on
    every run: the first rows by a digest of the id. Half of it makes the dictionaries, the other
    half calibrates, so that dictionaries never score their own text. NULL labels are left out.
    Without one of the classes there is nothing to tell apart, and every text gets the prior.
    """
    known = labels.filter(training & col(label).isin(0, 1)).select(col(id).alias("k"), col(label).cast("int").alias("y")).distinct()
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = [known.filter(F.col("y") == y).orderBy(F.xxhash64("k", F.lit("fit")), "k").limit(sample) for y in (0, 1)]
    picked = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.select(col(id).alias("k"), content(text).alias("t")).join(picked, "k").dropDuplicates(["k"]).orderBy(F.xxhash64("k", F.lit("half")), "k")
    rows = [(r["t"], r["y"]) for r in rows.collect()]
    half = {y: [t for t, z in rows if z == y][::2] for y in (0, 1)}
    rest = [(t, y) for y in (0, 1) for t in [t for t, z in rows if z == y][1::2]]
    model = CompressionModel(dictionary(half[1]), dictionary(half[0]))
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if not rest or len({y for _, y in rest}) < 2:
        model.weights = [float(np.log(prior / (1 - prior))), 0.0, 0.0, 0.0, 0.0]
        return model
    return model.calibrate([t for t, _ in rest], [y for _, y in rest], prior)


def quality_scores(docs: DataFrame, model: CompressionModel, text: str = "text") -> DataFrame:
    """All rows with ``score`` (0 to 1, higher: good text is likelier), from the whole text and nothing else.

    The model has a fixed size. NULL counts as empty; empty texts get the score of no evidence.
    Columns of the input named like an added one are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score).astype("float64")

    return without(docs, OUT).withColumn("score", score(content(text)))
