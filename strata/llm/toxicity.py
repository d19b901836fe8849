"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, content, without
from strata.session import Workspace

OUT = ("score",)
_words = re.compile(r"[^\W\d_]+").findall
# A word is a feature if so many positive texts have it and its share of them is so many times that of unlabelled ones, to which a
# ridge is added. Neither bound moves with the number of texts.
LEAST_TEXTS, LEAST_RATIO, RIDGE, MOST_WORDS = 3, 4.0, 1e-3, 4000
# How many standard errors the log-odds of a word must be above zero; folds of the training texts choose among them.
EVIDENCE, FOLDS = (0.0, 2.0, 4.0, 6.0), 3
# Candidates among which words are chosen.
MOST_CANDIDATES = 20_000
# Beginnings of longer words are features too, for words that take endings.
STEMS = (4, 5, 6, 7)
# A text without any evidence is scored no higher, whatever the share of toxic labels.
NO_EVIDENCE = 0.2


def tokens(text: str) -> set[str]:
    """The words of a text and their beginnings, the latter marked by a hyphen."""
    found = set(_words(text.lower()))
    stems = {f"{w[:n]}-" for w in found for n in STEMS if len(w) > n}
    return found | stems


@dataclass
class ToxicityModel:
    """A linear classifier over the presence of words; its outputs are probabilities."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str) -> float:
        get = self.weights.get
        z = self.bias + sum(w for t in tokens(text) if (w := get(t)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def least_ratio(prior: float) -> float:
    """``LEAST_RATIO``, or less where many unlabelled texts are positive: no word's ratio can be above one over their share."""
    return min(LEAST_RATIO, (1 + 1 / prior) / 2)


def clear_words(words: Sequence[str], in_p: np.ndarray, in_u: np.ndarray, n: int, m: int, evidence: float, ratio: float = LEAST_RATIO) -> list[int]:
    """Places of the words whose share of ``n`` positive texts is well above that of ``m`` unlabelled ones, the clearest first.

    ``in_p`` and ``in_u`` count the texts that have a word. The log-odds of a word, smoothed by half a text, must be ``evidence`` standard
    errors above zero. Of a word and its stems only the clearest stays, the longest if equal.
    """
    k, u = in_p.astype(float), in_u.astype(float)
    pooled = (k + u) / (n + m)
    z = (k / n - u / m) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n + 1 / m))
    odds = np.log((k + 0.5) / (n - k + 0.5)) - np.log((u + 0.5) / (m - u + 0.5))
    error = np.sqrt(1 / (k + 0.5) + 1 / (n - k + 0.5) + 1 / (u + 0.5) + 1 / (m - u + 0.5))
    good = (k >= LEAST_TEXTS) & (k / n >= ratio * (u / m + RIDGE)) & (odds >= evidence * error)
    scores = {words[i]: (z[i], i) for i in np.flatnonzero(good).tolist()}
    beaten = set()
    for word, (score, _) in scores.items():
        for stem in (f"{word[:k]}-" for k in STEMS if k < len(word.rstrip("-"))):
            if stem in scores:
                beaten.add(word if scores[stem][0] > score else stem)
    return [scores[w][1] for w in sorted(scores.keys() - beaten, key=lambda w: (-scores[w][0], w))[:MOST_WORDS]]


def choose_words(positive: Sequence[str], unlabelled: Sequence[str], evidence: float = 0.0, ratio: float = LEAST_RATIO) -> list[str]:
    """:func:`clear_words` of texts."""
    in_p, in_u = (Counter(w for t in side for w in tokens(t)) for side in (positive, unlabelled))
    words = [w for w, k in in_p.items() if k >= LEAST_TEXTS]
    counts = (np.array([c[w] for w in words], dtype=np.int64) for c in (in_p, in_u))
    return [words[i] for i in clear_words(words, *counts, len(positive), len(unlabelled), evidence, ratio)]


@dataclass
class Presence:
    """Which texts have which words, as pairs of places."""

    texts: int
    row: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, texts: Sequence[Sequence[int]]) -> Presence:
        sizes = [len(t) for t in texts]
        flat = np.concatenate([np.asarray(t, dtype=np.int64) for t in texts]) if texts else np.zeros(0, np.int64)
        return cls(len(texts), np.repeat(np.arange(len(texts)), sizes), flat)

    def counts(self, words: int) -> np.ndarray:
        return np.bincount(self.word, minlength=words)

    def only(self, words: Sequence[int], total: int) -> Presence:
        """The pairs of these words, which are numbered in their order."""
        place = np.full(total, -1)
        place[list(words)] = np.arange(len(words))
        at = place[self.word]
        return Presence(self.texts, self.row[at >= 0], at[at >= 0])

    def part(self, chosen: np.ndarray) -> Presence:
        """Some of the texts, by a mask."""
        place = np.cumsum(chosen) - 1
        inside = chosen[self.row]
        return Presence(int(chosen.sum()), place[self.row[inside]], self.word[inside])

    def logits(self, weights: np.ndarray) -> np.ndarray:
        """The last weight is the bias."""
        return weights[-1] + np.bincount(self.row, weights[self.word], self.texts)


def nnpu_risk(p: Presence, u: Presence, weights: np.ndarray, prior: float, ridge: float) -> tuple[float, float, np.ndarray]:
    """The non-negative risk, the estimate of the negatives' share in it, and the slope of what a step goes down.

    The risk is ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with logistic loss: unlabelled texts hold a share ``prior`` of
    positive ones, and taking ``prior * R_p(-)`` off their risk as negatives leaves the risk of the true negatives. Where that estimate
    falls below zero the classifier overfits, and a step makes it up instead (slope of its negative).
    """
    zp, zu = p.logits(weights), u.logits(weights)
    sp, su = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
    negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    risk = prior * np.logaddexp(0, -zp).mean() + max(0.0, negative) + 0.5 * ridge * float(weights[:-1] @ weights[:-1])
    # Slopes of log(1 + exp(-z)) and log(1 + exp(z)) at the texts.
    up, down_u, down_p = prior * (sp - 1) / p.texts, su / u.texts, -prior * sp / p.texts
    gp, gu = (up + down_p, down_u) if negative >= 0 else (-down_p, -down_u)
    k = len(weights) - 1
    slope = np.empty(k + 1)
    slope[:k] = np.bincount(p.word, gp[p.row], k) + np.bincount(u.word, gu[u.row], k) + ridge * weights[:k]
    slope[k] = gp.sum() + gu.sum()
    return float(risk), float(negative), slope


def nnpu_weights(p: Presence, u: Presence, words: int, prior: float, steps: int = 600, rate: float = 0.05, ridge: float = 1e-4) -> np.ndarray:
    """Weights of the words and the bias, by steps down the risk with moments (Adam) and a falling rate."""
    w, moment, square = np.zeros(words + 1), np.zeros(words + 1), np.zeros(words + 1)
    w[words] = float(np.log(prior / (1 - prior)))
    for step in range(1, steps + 1):
        _, _, g = nnpu_risk(p, u, w, prior, ridge)
        moment = 0.9 * moment + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        w -= rate * (1 - step / (steps + 1)) * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


def ranked_share(positive: np.ndarray, other: np.ndarray) -> float:
    """How often a positive text is scored above another one; ties count half."""
    both = np.sort(other)
    below, up_to = np.searchsorted(both, positive), np.searchsorted(both, positive, side="right")
    return float((below + up_to).mean() / 2 / max(1, len(other)))


def model_of(words: Sequence[str], weights: np.ndarray) -> ToxicityModel:
    bias = min(float(weights[-1]), float(np.log(NO_EVIDENCE / (1 - NO_EVIDENCE))))
    return ToxicityModel(bias, {t: float(w) for t, w in zip(words, weights) if w})


def fit_presence(words: Sequence[str], p: Presence, u: Presence, p_fold: np.ndarray, u_fold: np.ndarray, prior: float) -> ToxicityModel:
    """The model with as much evidence asked of its words as ranks the positive texts of the folds best that it has not seen."""

    def chosen(p: Presence, u: Presence, evidence: float) -> list[int]:
        return clear_words(words, p.counts(len(words)), u.counts(len(words)), p.texts, u.texts, evidence, least_ratio(prior))

    def trial(evidence: float) -> float:
        ranks = []
        for fold in range(FOLDS):
            seen = p.part(p_fold != fold), u.part(u_fold != fold)
            unseen = p.part(p_fold == fold), u.part(u_fold == fold)
            if not all(side.texts for side in (*seen, *unseen)):
                continue
            known = chosen(*seen, evidence)
            seen, unseen = ([side.only(known, len(words)) for side in both] for both in (seen, unseen))
            weights = nnpu_weights(*seen, len(known), prior, steps=150)
            ranks.append(ranked_share(*(side.logits(weights) for side in unseen)))
        return float(np.mean(ranks)) if ranks else 0.0

    # Of equal ones, the most evidence.
    evidence = max(EVIDENCE, key=lambda e: (round(trial(e), 3), e))
    known = chosen(p, u, evidence)
    weights = nnpu_weights(p.only(known, len(words)), u.only(known, len(words)), len(known), prior)
    return model_of([words[i] for i in known], weights)


def fit_nnpu(positive: Sequence[str], unlabelled: Sequence[str], prior: float) -> ToxicityModel:
    """A model from texts; every third text is of the same fold."""
    words = choose_words(positive, unlabelled, ratio=least_ratio(prior)) if positive and unlabelled else []
    if not words:
        return model_of([], np.array([np.log(prior / (1 - prior))]))
    place = {w: i for i, w in enumerate(words)}
    p, u = (Presence.of([[place[w] for w in tokens(t) if w in place] for t in side]) for side in (positive, unlabelled))
    return fit_presence(words, p, u, np.arange(p.texts) % FOLDS, np.arange(u.texts) % FOLDS, prior)


def _token_lists():
    @F.pandas_udf("array<string>")
    def token_lists(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(tokens(t)))

    return token_lists


def _places(words: Mapping[str, int], docs: DataFrame):
    """The places of the words that a list has."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("array<int>")
    def places(lists: pd.Series) -> pd.Series:
        get = shared.value.get
        return lists.map(lambda ws: [i for w in ws if (i := get(w)) is not None])

    return places


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    positives: int = 3000,
    unlabelled: int = 6000,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> ToxicityModel:
    """Fit on at most so many confirmed toxic texts and so many unlabelled ones.

    ``training`` is a condition on an id column of the label table; labels are read from rows that meet it only. The
    class prior is the share of toxic texts among those labels. Unlabelled texts are drawn from
    documents that meet the condition, whatever their label. Samples are the first rows by a digest of the
    id, the same on every run. Without toxic examples every text gets the score of no evidence.

    Texts are split and their words counted by Spark. The driver sees the counts of at most ``MOST_CANDIDATES`` words, and for each
    sampled text which of them it has; no text and no list of all words reaches it.
    """
    known = labels.filter(training & col(label).isin(0, 1)).select(col(id).alias("k"), col(label).cast("int").alias("y")).distinct()
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    prior = min(0.95, (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1))
    # Ids first: only sampled texts travel.
    order = [F.xxhash64("k", F.lit("fit")), F.col("k")]
    toxic = known.filter(F.col("y") == 1).select("k").orderBy(*order).limit(positives).withColumn("p", F.lit(1))
    others = docs.filter(training).select(col(id).alias("k")).distinct().orderBy(*order).limit(unlabelled).withColumn("p", F.lit(0))
    picked = F.broadcast(toxic.unionByName(others))
    rows = docs.select(col(id).alias("k"), content(text).alias("t")).join(picked, "k").dropDuplicates(["k", "p"])
    with Workspace(docs.sparkSession, "toxicity") as work:
        rows = work.stage(rows.select("k", "p", F.pmod(F.xxhash64("k", F.lit("fold")), F.lit(FOLDS)).alias("fold"), _token_lists()("t").alias("words")))
        n = {r["p"]: r["count"] for r in rows.groupBy("p").count().collect()}
        if len(n) < 2:
            return model_of([], np.array([np.log(prior / (1 - prior))]))
        have = rows.select("p", F.explode("words").alias("word")).groupBy("word").agg(
            *[F.count_if(F.col("p") == side).alias(f"n{side}") for side in (0, 1)]
        )
        clear = (F.col("n1") >= LEAST_TEXTS) & (F.col("n1") / n[1] >= least_ratio(prior) * (F.col("n0") / n[0] + RIDGE))
        best = have.filter(clear).orderBy((F.col("n1") / n[1] - F.col("n0") / n[0]).desc(), "word").limit(MOST_CANDIDATES)
        words = sorted(r["word"] for r in best.select("word").collect())
        places = _places({w: i for i, w in enumerate(words)}, docs)
        texts = rows.select("p", "k", "fold", places("words").alias("at")).orderBy("p", "k").collect()
    sides = {side: [r for r in texts if r["p"] == side] for side in (0, 1)}
    p, u = (Presence.of([r["at"] for r in sides[side]]) for side in (1, 0))
    p_fold, u_fold = (np.array([r["fold"] for r in sides[side]]) for side in (1, 0))
    return fit_presence(words, p, u, p_fold, u_fold, prior)


def toxicity_scores(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """All rows with ``score`` (0 to 1, higher: toxic is likelier), from the whole text and nothing else.

    The model has at most ``MOST_WORDS`` words. NULL counts as empty; empty texts get the score of no evidence. Columns
    of the input named like an added one are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score).astype("float64")

    return without(docs, OUT).withColumn("score", score(content(text)))
