"""Operator 5, toxicity by a linear-chain conditional random field.

Labels are of documents, so tokens are labelled from a distance: word beginnings that are much commoner in toxic
documents of the sample than in others are evidence, and the tokens of toxic documents that carry evidence are
tagged toxic, all other tokens not. A field of two tags (emission weights by kind of evidence, transitions between
neighbours) is fitted to windows of these tokens by gradient ascent on the conditional likelihood. Forward-backward
marginals of a document's tokens give its toxic spans, and, aggregated, its score.

Only the fit uses a bounded sample: at most SAMPLE labelled documents of either label, those of least hash. Scoring
reads every whole text. Between tokens with evidence the field is the power of one matrix, so a document costs
time linear in its words whatever its length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, filter_texts, id_and_text, map_texts

#: Labelled documents of either label that the fit may use, and windows of their tokens.
SAMPLE = 4000
MAX_WINDOWS = 20_000
WINDOW = 32
#: Evidence: word beginnings of these lengths, or whole words, that pass these limits; at most MAX_FEATURES.
LENGTHS = range(4, 10)
MIN_DOCUMENTS, MIN_Z, MIN_RATIO = 3, 4.5, 6.0
MAX_FEATURES = 5000
#: Labels of every FOLDS-th hash are held out.
FOLDS = 5
#: Distance from which on two tokens no longer matter to each other.
FAR = 1024
#: Words whose evidence a worker remembers at once.
MEMO = 300_000
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo FOLDS, is 0; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass
class Model:
    features: dict[str, int]
    emission: np.ndarray  # of the toxic tag over the other one, by evidence; 0 is a token without evidence
    transition: np.ndarray
    start: np.ndarray
    document: np.ndarray  # intercept, weight of the log of expected toxic tokens, weight of the greatest marginal

    def powers(self) -> np.ndarray:
        """Transition matrices over k tokens without evidence and the step out of them, scaled to a sum of one."""
        step = np.exp(self.transition)
        quiet = step * np.exp([0.0, self.emission[0]])
        out, at = [step / step.sum()], step
        for _ in range(FAR):
            at = quiet @ at
            at = at / at.sum()
            out.append(at)
        return np.array(out)


class Evidence(dict):
    """The evidence of white-space separated tokens: 0 for none, else the number of the longest known beginning."""

    def __init__(self, features: dict[str, int]):
        super().__init__()
        self.features, self.longest = features, max(map(len, features), default=0)

    def __missing__(self, token: str) -> int:
        found = 0
        for word in LETTERS.findall(token.lower()):
            if f"{word}$" in self.features:
                found = self.features[f"{word}$"]
            for n in range(min(len(word), self.longest), LENGTHS[0] - 1, -1) if not found else ():
                if word[:n] in self.features:
                    found = self.features[word[:n]]
                    break
            if found:
                break
        if len(self) >= MEMO:
            self.clear()
        self[token] = found
        return found


def chains(texts: list[str], evidence: Evidence) -> tuple[np.ndarray, ...]:
    """Tokens with evidence of all texts, in order: owner, place among its tokens, evidence; and tokens by text."""
    owner, place, kind, sizes = [], [], [], []
    for i, text in enumerate(texts):
        tokens = text.split()
        found = np.fromiter(map(evidence.__getitem__, tokens), np.int64, len(tokens))
        at = np.flatnonzero(found)
        sizes.append(len(tokens))
        owner.append(np.full(len(at), i))
        place.append(at)
        kind.append(found[at])
    cat = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    return cat(owner), cat(place), cat(kind), np.array(sizes, np.int64)


def marginals(model: Model, powers: np.ndarray, owner: np.ndarray, place: np.ndarray, kind: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The probability of the toxic tag at each token with evidence, by forward and backward passes that step
    through the k-th such token of all texts at once."""
    n = len(owner)
    if not n:
        return np.zeros(0)
    counts = np.bincount(owner, minlength=len(sizes))
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    alive = np.searchsorted(-counts[order], -np.arange(1, counts.max() + 1), side="right")
    weight = np.exp(np.stack([np.zeros(n), model.emission[kind]], 1))
    before = np.diff(place, prepend=0) - 1
    before[first[counts > 0]] = place[first[counts > 0]]
    gap = np.minimum(before, FAR)
    ahead, back = np.empty((n, 2)), np.ones((n, 2))
    start = np.exp(model.start)
    quiet = start * np.exp([0.0, model.emission[0]])
    for k, m in enumerate(alive):
        at = first[order[:m]] + k
        if k == 0:
            # tokens without evidence before the first one: the start, then the powers
            g = gap[at]
            later = np.einsum("i,nij->nj", quiet, powers[np.maximum(g - 1, 0)])
            message = np.where(g[:, None] > 0, later, start)
        else:
            message = np.einsum("ni,nij->nj", ahead[at - 1], powers[gap[at]])
        message = message * weight[at]
        ahead[at] = message / message.sum(1, keepdims=True)
    ends = first + counts - 1
    rest = np.minimum(sizes - 1 - place[np.maximum(ends, 0)], FAR)
    tail = np.where((rest > 0)[:, None], (powers @ np.array([1.0, np.exp(model.emission[0])]))[np.maximum(rest - 1, 0)], 1.0)
    have = counts > 0
    back[ends[have]] = tail[have]
    for k in range(len(alive) - 2, -1, -1):
        at = first[order[: alive[k + 1]]] + k
        message = np.einsum("nij,nj->ni", powers[gap[at + 1]], weight[at + 1] * back[at + 1])
        back[at] = message / message.sum(1, keepdims=True)
    both = ahead * back
    return both[:, 1] / both.sum(1)


def document_features(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """By document: one, the log of one more than its expected toxic tokens, its greatest marginal."""
    most = np.zeros(n)
    np.maximum.at(most, owner, p)
    return np.stack([np.ones(n), np.log1p(np.bincount(owner, weights=p, minlength=n)), most], 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_chain(tokens: np.ndarray, toxic: np.ndarray, kinds: int, rounds: int = 60) -> tuple[np.ndarray, ...]:
    """Emission, transition and start weights, by Adam on the conditional likelihood of windows with L2 penalty.
    `tokens` holds evidence by window and place, -1 beyond a window's end; `toxic` marks windows of toxic documents."""
    inside = tokens >= 0
    tags = ((tokens > 0) & toxic[:, None]).astype(np.int64)
    kind = np.maximum(tokens, 0)
    n, width = tokens.shape
    values = [np.zeros(kinds), np.zeros((2, 2)), np.zeros(2)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    both = inside[:, 1:]
    seen = [
        np.bincount(kind[inside], weights=tags[inside], minlength=kinds),
        np.bincount((2 * tags[:, :-1] + tags[:, 1:])[both], minlength=4).reshape(2, 2).astype(float),
        np.bincount(tags[:, 0], minlength=2).astype(float),
    ]
    for r in range(1, rounds + 1):
        emission, transition, start = values
        weight = np.stack([np.ones((n, width)), np.exp(emission)[kind]], 2)
        step = np.exp(transition)
        ahead, back = np.empty((n, width, 2)), np.ones((n, width, 2))
        ahead[:, 0] = np.exp(start) * weight[:, 0]
        ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
        for k in range(1, width):
            message = (ahead[:, k - 1] @ step) * weight[:, k]
            ahead[:, k] = np.where(inside[:, k, None], message / message.sum(1, keepdims=True), ahead[:, k - 1])
        pairs = np.zeros((2, 2))
        for k in range(width - 2, -1, -1):
            after = weight[:, k + 1] * back[:, k + 1]
            message = after @ step.T
            back[:, k] = np.where(inside[:, k + 1, None], message / message.sum(1, keepdims=True), 1.0)
            joint = ahead[:, k, :, None] * step * after[:, None, :]
            pairs += (joint / joint.sum((1, 2), keepdims=True))[inside[:, k + 1]].sum(0)
        p = ahead * back
        p = p[..., 1] / p.sum(2)
        expected = [np.bincount(kind[inside], weights=p[inside], minlength=kinds), pairs, np.array([n - p[:, 0].sum(), p[:, 0].sum()])]
        for i, v in enumerate(values):
            slope = (seen[i] - expected[i]) - 0.5 * v
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            values[i] = v + 0.3 * (first[i] / (1 - 0.9**r)) / (np.sqrt(second[i] / (1 - 0.99**r)) + 1e-8)
    return tuple(values)


def fit_document(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, with a small L2 penalty that keeps separable data finite."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (y - p)) - 0.01 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, size: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of at most `size` labelled documents of either label that are not held out, one text (that of
    the least hash) of each and each text once;
    and how many labelled documents of either label there are. The sample's ids are few, so they are broadcast."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(
        (F.max(label_col) > 0).cast("int").alias("toxic")
    ).where(~held_out(id_col)).select(F.col(id_col).alias("_id"), "toxic")
    totals = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    part = lambda t: one.where(F.col("toxic") == t).orderBy(F.xxhash64("_id"), "_id").limit(size)
    ids = F.broadcast(part(0).unionByName(part(1)))
    texts = id_and_text(docs, id_col, text_col).join(ids, F.col(id_col) == F.col("_id"))
    texts = texts.groupBy("_id").agg(F.min(F.struct(F.xxhash64("text").alias("_hash"), "text", "toxic")).alias("x")).select("x.text", "x.toxic")
    return texts.groupBy(F.xxhash64("text").alias("_key")).agg(F.min(F.struct("text", "toxic")).alias("x")).select("x.text", "x.toxic"), totals


def find_features(sample: DataFrame, sizes: dict[int, int]) -> dict[str, int]:
    """Word beginnings, and whole words (ending in $), that are evidence for label 1: numbered from 1."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    parts = F.flatten(F.transform(words, lambda w: F.filter(
        F.array(F.concat(w, F.lit("$")), *(F.when(F.length(w) >= n, F.substr(w, F.lit(1), F.lit(n))) for n in LENGTHS)),
        lambda x: x.isNotNull(),
    )))
    found = sample.select("toxic", F.explode(F.array_distinct(parts)).alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )
    total1, total0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    rate1, rate0 = F.col("a") / total1, F.col("b") / total0
    pooled = (F.col("a") + F.col("b")) / (total1 + total0)
    z = (rate1 - rate0) / F.sqrt(pooled * (1 - pooled) * (1 / total1 + 1 / total0) + F.lit(1e-12))
    ratio = ((F.col("a") + 0.5) / (total1 + 1)) / ((F.col("b") + 0.5) / (total0 + 1))
    kept = found.where(F.col("a") >= MIN_DOCUMENTS).withColumn("z", z).where((F.col("z") >= MIN_Z) & (ratio >= MIN_RATIO))
    rows = kept.orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).select("feature").collect()
    return {r["feature"]: i + 1 for i, r in enumerate(rows)}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", size: int = SAMPLE) -> Model:
    """Fits the field and the document weights on a bounded sample of labelled documents that are not held out.
    Without labels of both kinds the model has no evidence, and every score is the smoothed share of label 1."""
    sample, totals = labelled_sample(docs, labels, id_col, text_col, label_col, size)
    flat = Model({}, np.zeros(1), np.zeros((2, 2)), np.zeros(2), np.zeros(3))
    positive, negative = totals.get(1, 0), totals.get(0, 0)
    flat.document[0] = np.log((positive + 0.5) / (negative + 0.5)) if positive + negative else 0.0
    sample = cut_lineage(sample.repartition(8))  # a bounded number of texts, read several times
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    features = find_features(sample, sizes) if len(sizes) == 2 else {}
    if not features:
        return flat

    def cut(batches):
        evidence = Evidence(features)
        for batch in batches:
            windows, toxic, keys, places = [], [], [], []
            for text, label, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                kinds = [evidence[x] for x in text.split()]
                for at in range(0, len(kinds), WINDOW):
                    part = kinds[at : at + WINDOW]
                    if at == 0 or any(part):
                        windows.append(part)
                        toxic.append(label)
                        keys.append(key)
                        places.append(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.list_(pa.int32())), pa.array(toxic, pa.int32()), pa.array(keys, pa.int64()), pa.array(places, pa.int32())],
                ["w", "toxic", "key", "place"],
            )

    # drawn by text and place, not by content: of many equal windows a share is drawn, as of all others
    cut_out = sample.select("text", "toxic", F.xxhash64("text").alias("key")).mapInArrow(cut, "w array<int>, toxic int, key long, place int")
    rows = cut_out.orderBy(F.xxhash64("key", "place"), "key", "place").limit(MAX_WINDOWS).collect()
    tokens = np.full((len(rows), WINDOW), -1, np.int64)
    for i, r in enumerate(rows):
        tokens[i, : len(r["w"])] = r["w"]
    keep = tokens[:, 0] >= 0
    toxic = np.array([r["toxic"] for r in rows])
    emission, transition, start = fit_chain(tokens[keep], toxic[keep] == 1, len(features) + 1)
    model = Model(features, emission, transition, start, flat.document)

    def measure(batches):
        evidence, powers = Evidence(features), model.powers()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            owner, place, kind, sizes = chains(texts, evidence)
            x = document_features(marginals(model, powers, owner, place, kind, sizes), owner, len(texts))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 1]), pa.array(x[:, 2]), batch.column(1)], ["x1", "x2", "toxic"])

    rows = sample.mapInArrow(measure, "x1 double, x2 double, toxic int").collect()
    x = np.array([(1.0, r["x1"], r["x2"]) for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    share = {1: positive / max(sizes[1], 1), 0: negative / max(sizes[0], 1)}
    weight = np.where(y == 1, share[1], share[0])
    model.document = fit_document(x, y, weight / weight.mean())
    return model


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every whole text, one row per input row.

    Columns: the id, score (0 to 1), predicted (1 if score >= 0.5) and spans (start:end of each token whose marginal
    is at least one half, in code points, joined by commas). Null and empty texts, and texts without evidence, have
    the model's base score; null and repeated ids stay rows of their own; other columns are not read, so their
    names can't clash.
    """

    def prepare():
        evidence, powers = Evidence(model.features), model.powers()

        def work(texts: list[str]) -> dict:
            owner, place, kind, sizes = chains(texts, evidence)
            p = marginals(model, powers, owner, place, kind, sizes)
            score = sigmoid(document_features(p, owner, len(texts)) @ model.document)
            spans = [""] * len(texts)
            hits: dict[int, list[int]] = {}
            for i in np.flatnonzero(p >= 0.5).tolist():
                hits.setdefault(int(owner[i]), []).append(int(place[i]))
            for i, at in hits.items():
                ends = [f"{m.start()}:{m.end()}" for m in re.finditer(r"\S+", texts[i])] if at else []
                spans[i] = ",".join(ends[k] for k in at if k < len(ends))
            return {"score": score.tolist(), "predicted": (score >= 0.5).astype(int).tolist(), "spans": spans}

        return work

    return map_texts(docs, id_col, text_col, "score double, predicted int, spans string", prepare)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is below one half."""

    def prepare():
        evidence, powers = Evidence(model.features), model.powers()

        def work(texts: list[str]) -> list[bool]:
            owner, place, kind, sizes = chains(texts, evidence)
            x = document_features(marginals(model, powers, owner, place, kind, sizes), owner, len(texts))
            return (sigmoid(x @ model.document) < 0.5).tolist()

        return work

    return filter_texts(docs, text_col, prepare)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Trains on the labelled documents that are not held out and scores all: the id, held_out, score, predicted, spans."""
    scored = score_toxicity(docs, train(docs, labels, id_col, text_col, label_col), id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted", "spans")
