"""Toxicity by weak supervision.

Voters are terms of a lexicon (a few seed words, and words and word heads mined
from labelled texts by their odds) and patterns (shouting, runs of marks, short
insulting forms of address).  They vote on labelled and unlabelled texts alike.
A generative label model estimates how often each voter fires on toxic and on
clean texts, by expectation maximisation over the votes alone: no text brings
its label along, which only gives the rates to start from.  A voter that does
not fire abstains; that none fires is a vote of its own.  Where voters fire
together that are correlated within a class, they share their weight.  A linear classifier (logistic, L2) over the voters is then
trained on the posterior labels, so that a score is a sum over the terms of a
text.  `Model.agreement` tells how often the posterior agrees with the labels.

The model is fitted on at most `sample` labelled texts and as many of all texts,
those of the smallest hash of doc_id (a documented bound; scoring covers every
text).  Which labels may be learned from is the caller's choice; lang, source,
doc_id and labels are never inputs of a score.

Defined results: a null or empty text has no terms and gets the score of the
bias; without labelled texts the seed lexicon alone scores; a label of a doc_id
given more than once counts as toxic if any says so; null labels are ignored;
repeated rows each get their own score; an empty table gives an empty result;
other columns are kept and may have any name.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, with_columns

SAMPLE = 12_000
TERMS = 400
#: Lengths of the heads of words that may become terms.
HEADS = range(4, 9)
#: Least texts of the sample with a term, and least z-score of its log-odds, for it to become a voter.
LEAST, Z = 4, 4.0
#: Least share of toxic ones among the labelled texts with a mined term.
PRECISION = 0.85
CUT = 0.3
SEEDS = "idiot moron stupid loser scum trash pathetic disgusting worthless clown dumb fool jerk bastard shut idiota imbécil estúpido basura dumm trottel abschaum widerlich crétin connard ordure".split()
_WORD = re.compile(r"[^\W\d_]+")
PATTERNS = {"!shout": re.compile(r"(?:\b[A-Z]{3,}\b\W+){4}"), "!marks": re.compile(r"[!?]{3,}"), "!address": re.compile(r"(?i)\b(?:you|du|tu|eres) (?:are |bist |es )?(?:a |ein |un )?[^\W\d_]+[!]")}


def terms(text: str) -> set[str]:
    """Words of the text, heads of longer words (^), and patterns (!)."""
    words = set(_WORD.findall(text.lower()))
    out = words | {"^" + w[:k] for k in HEADS for w in words if len(w) > k}
    out.update(name for name, p in PATTERNS.items() if p.search(text))
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class LabelModel:
    """Votes (texts x voters, 0 or 1) to posterior labels, without labels.

    on, off and prior: the rates to start from, which later count as `held` times
    as many texts as vote, so that what else tells texts apart (language, length)
    cannot take their place.  Correlations are those of the first posterior, by
    the rates to start from, as later ones would feed on what they weaken.
    """

    def __init__(self, rounds: int = 12, held: float = 1.0, close: float = 0.3, least: float = 20.0):
        self.rounds, self.held, self.close, self.least = rounds, held, close, least

    def _related(self, votes: np.ndarray, y: np.ndarray, rate: np.ndarray) -> np.ndarray:
        """Correlations of voters among texts that belong to a class by weights y."""
        z = (votes - rate) * np.sqrt(y)[:, None]
        cov = z.T @ z / max(y.sum(), 1)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-6))
        out = cov / sd[:, None] / sd[None, :]
        # Voters that hardly fire in the class tell nothing there.
        out[y @ votes < self.least] = 0
        out[:, y @ votes < self.least] = 0
        np.fill_diagonal(out, 0)
        return out

    def fit(self, votes: np.ndarray, on: np.ndarray, off: np.ndarray, prior: float) -> np.ndarray:
        n, k = votes.shape
        self.on, self.off, self.prior, self.weight = on, off, prior, np.ones((n, k))
        for k in range(self.rounds):
            llr = np.log(self.on / self.off)
            y = _sigmoid(math.log(self.prior / (1 - self.prior)) + (votes * self.weight) @ llr)
            if k == 0:
                self.correlation = self._related(votes, y, on), self._related(votes, 1 - y, off)
                close = np.maximum(*[np.where(c > self.close, c, 0) for c in self.correlation])
                self.weight = 1 / (1 + votes @ close)
            total, held = (y.sum(), (1 - y).sum()), self.held * n
            self.prior = float((total[0] + held * prior) / (n + held))
            self.on = (votes.T @ y + held * prior * on) / (total[0] + held * prior)
            self.off = (votes.T @ (1 - y) + held * (1 - prior) * off) / (total[1] + held * (1 - prior))
        return y


def unlike(terms_: list[str]) -> list[str]:
    """The first term of each chain of nested ones (a word and its heads): later ones would share its votes."""
    kept: set[str] = set()
    below: set[str] = set()
    out = []
    for t in terms_:
        stem = t.lstrip("^")
        if t[0] == "!" or not (stem in below or any(stem[:k] in kept for k in range(1, len(stem) + 1))):
            out.append(t)
            kept.add(stem)
            below.update(stem[:k] for k in range(1, len(stem)))
    return out


def train_linear(votes: np.ndarray, y: np.ndarray, l2: float = 1e-4, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on soft labels, by Newton's method."""
    n, k = votes.shape
    x = np.hstack([votes, np.ones((n, 1), votes.dtype)])
    ridge = np.append(np.full(k, l2), 1e-9)
    w = np.zeros(k + 1)
    w[-1] = math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        g = x.T @ (p - y) / n + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / n + np.diag(ridge), g)
        w = w - step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


class Model:
    """Weights of terms, the bias, and how often the posterior agreed with the labels it did not see (none: nan)."""

    def __init__(self, weights: dict[str, float], bias: float, agreement: float = math.nan):
        self.weights, self.bias, self.agreement = weights, bias, agreement
        self.patterns = {k: p for k, p in PATTERNS.items() if k in weights}
        self.plain = {k: w for k, w in weights.items() if k[0] not in "^!"}
        self.heads = {n: {k[1:]: w for k, w in weights.items() if k[0] == "^" and len(k) == n + 1} for n in HEADS}

    def score(self, text: str) -> float:
        words = set(_WORD.findall(text.lower()))
        s = self.bias + sum(self.plain[w] for w in words & self.plain.keys())
        for n, heads in self.heads.items():
            if heads:
                s += sum(heads[h] for h in {w[:n] for w in words if len(w) > n} & heads.keys())
        s += sum(self.weights[k] for k, p in self.patterns.items() if p.search(text))
        return float(_sigmoid(s))


def seed_model() -> Model:
    return Model({w: 3.0 for w in SEEDS}, -2.5)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic (those that may be learned from)."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    first = lambda df: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    every = docs.where("doc_id is not null").select("doc_id", F.lit(None).cast("double").alias("toxic"))
    # Two top-k of `sample` ids: their size is bounded, so they are broadcast, and texts are not shuffled.
    chosen = stored(first(known).unionByName(first(every)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "chosen")
    packed = docs.join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")
    found = with_columns(packed, lambda col: {"terms": pa.array([sorted(terms(t)) for t in col.to_pylist()], pa.list_(pa.string()))}, "terms array<string>")
    both = stored(found.select("_row.doc_id", "_row.toxic", "terms"), "terms")
    rows = both.where("toxic is not null")
    size, toxic = rows.agg(F.count("*"), F.sum("toxic")).first()
    toxic = toxic or 0.0
    if not size or not toxic or toxic == size:
        return seed_model()
    a, b = F.col("pos") + 0.5, F.col("all") - F.col("pos") + 0.5
    odds = F.log(a / (toxic + 1 - a)) - F.log(b / (size - toxic + 1 - b))
    z = odds / F.sqrt(1 / a + 1 / b)
    counted = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("pos"), F.count("*").alias("all"))
    mined = counted.where((F.col("pos") >= LEAST) | F.col("term").isin(SEEDS)).withColumn("z", z).where((F.col("z") >= Z) & (F.col("pos") >= PRECISION * F.col("all")) | F.col("term").isin(SEEDS) & (F.col("z") > 0))
    # A report of the best terms, longest first among equals: a bounded list.
    best = [r[0] for r in mined.orderBy(F.desc(F.round("z", 6)), F.desc(F.length("term")), "term").limit(10 * TERMS).select("term").collect()]
    lexicon = unlike(best)[:TERMS]
    lexicon += [p for p in PATTERNS if p not in lexicon]
    place = {t: k for k, t in enumerate(lexicon)}
    hits = both.select("doc_id", "toxic", F.array_intersect("terms", F.array(*map(F.lit, lexicon))).alias("hits")).orderBy("doc_id", F.size("hits")).collect()
    votes = np.zeros((len(hits), len(lexicon)), np.float32)
    for i, r in enumerate(hits):
        votes[i, [place[t] for t in r["hits"]]] = 1
    label = np.array([np.nan if r["toxic"] is None else r["toxic"] for r in hits])
    said = np.hstack([votes, ~votes.any(axis=1, keepdims=True)])
    rate = lambda mine: (said[mine].sum(axis=0, dtype=float) + 0.1) / (mine.sum() + 1)
    posterior = LabelModel().fit(said, rate(label == 1), rate(label == 0), float(toxic / size))
    seen = ~np.isnan(label)
    agreement = float(((posterior >= 0.5) == (label >= 0.5))[seen].mean())
    weights, bias = train_linear(votes, posterior)
    return Model({t: round(float(w), 6) for t, w in zip(lexicon, weights) if abs(w) > 1e-6}, round(bias, 6), agreement)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """_row and score of each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return with_columns(docs, lambda col: {"score": pa.array([shared.value.score(t) for t in col.to_pylist()], pa.float64())}, "score double")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitted(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> Model:
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return fit(docs.where(~held_out()).select("doc_id", "text"), table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = score(docs, fitted(spark, sf_dir))
    return rows.select(F.col("_row.doc_id").alias("doc_id"), held_out("_row.doc_id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
