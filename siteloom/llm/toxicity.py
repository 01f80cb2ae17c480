"""Toxic passages as maximum-scoring segments of token log-odds.

A token is a word; its score is the log-odds with an informative Dirichlet prior of its longest significant
feature, the word itself or a beginning of it, and words without one cost a little. A linear-time scan
finds all maximal segments of a document. Their scores are normalised by the extreme-value law that the best
segments of clean documents follow, and a logistic curve over the sum of the normalised scores gives the label's
probability. The curve is fitted on scores from the other half of the training rows (cross-fitting).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that are features beside whole words.
STEMS = (6, 5, 4, 3)
#: Features that so many documents of one class have are candidates. One is significant if chance would give less than
#: FALSE features as clear among all candidates, so what that takes follows from the sample's size.
LEAST_DOCS, FALSE = 2, 1.0
#: Least log-odds of a feature: a passage consists of clear words, and others keep it short.
LEAST_ODDS = 2.0
#: Prior strength as a share of all counts; cost of a word without a feature.
PRIOR, NEUTRAL = 0.1, 1.0
#: Labelled rows used at most, the share taken by a hash of the id.
TRAIN_ROWS = 20_000
#: A passage is significant if as good a one turns up in fewer than this many of as long clean documents.
E_VALUE = 0.05
REMEMBERED = 300_000
#: Counts that a worker gathers before it hands them on.
GATHERED = 400_000


@dataclass
class Model:
    weights: dict[str, float]
    rate: float = 1.0  # of the extreme-value law
    log_k: float = 0.0
    curve: tuple[float, ...] = (-30.0, 0.0, 0.0, 0.0, 0.0)


def stems(word: str) -> list[str]:
    """Features of a word, the most specific first: itself, then its beginnings."""
    return [f"{word}$", *(word[:n] for n in STEMS if len(word) >= n)]


class _Scores(dict):
    """Score of each word under a model; forgets all when it holds REMEMBERED."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = s = next((self.weights[f] for f in stems(word) if f in self.weights), -NEUTRAL)
        return s


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), in order, in linear time."""
    up = scores > 0
    if not up.any():
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    edge = np.diff(np.concatenate([[0], up.view(np.int8), [0]]))
    stack: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, first, end, nearest earlier with less before
    for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        low, high, j = total[s], total[e], len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= high:
                stack.append((low, high, s, e, j))
                break
            low, _, s, _, before = stack[j]
            del stack[j:]
            j = before
    return [(s, e, high - low) for low, high, s, e, _ in stack]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, docs = Counter(), Counter()

    def gathered() -> pa.RecordBatch:
        keys = list(seen)
        out = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()),
             pa.array([seen[k] for k in keys], pa.int64()), pa.array([docs[k] for k in keys], pa.int64())], names=["feature", "fold", "toxic", "n", "docs"])
        seen.clear()
        docs.clear()
        return out

    for batch in batches:
        for text, fold, y in zip(*(batch[c].to_pylist() for c in ("text", "fold", "toxic")), strict=True):
            own = Counter()
            for w, n in Counter(WORD.findall((text or "").lower())).items():
                for f in stems(w):
                    own[f] += n
            for f, n in own.items():
                seen[f, fold, y] += n
                docs[f, fold, y] += 1
            if len(seen) > GATHERED:
                yield gathered()
    yield gathered()


def _best(models: dict[int, dict[str, float]]):
    """Segment scores of training rows, each under the model of the other fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = {k: _Scores(v) for k, v in models.items()}
        for batch in batches:
            sizes, found = [], []
            for text, fold in zip(batch["text"].to_pylist(), batch["fold"].to_pylist(), strict=True):
                words = WORD.findall((text or "").lower())
                sizes.append(len(words))
                found.append([s for _, _, s in segments(np.fromiter(map(by[fold].__getitem__, words), float, len(words)))])
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "size", "found"])
    return run


def _features(model: Model, found: list[float], size: int) -> tuple[float, float, float, float]:
    """What the curve reads: scores in the law's units, their sum, the best beyond what the length explains, the sum a word, and the length."""
    total, length = model.rate * sum(found), float(np.log1p(size))
    best = max(model.rate * max(found) - model.log_k - length, -20.0) if found else -20.0
    return float(np.log1p(total)), best, float(np.log(1e-3 + total / max(size, 1))), length


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Coefficients, the constant first, by Newton's method with halved steps, over standardised columns."""
    mean, sd = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / sd])
    penalty = np.array([1e-6, *[ridge] * x.shape[1]])
    loss = lambda b: float(np.logaddexp(0, z @ b).sum() - y @ (z @ b) + (penalty * b * b).sum() / 2)
    b = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -35, 35)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * b)
        scale = 1.0
        while scale > 1e-6 and loss(b + scale * step) > loss(b):
            scale /= 2
        b += scale * step
        if np.abs(scale * step).max() < 1e-7:
            break
    own = b[1:] / sd
    return (float(b[0] - own @ mean), *own.tolist())


def fit(docs: DataFrame, labels: DataFrame, fold: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from the labelled rows of docs; fold (0 or 1) halves them for the curve.

    Labels other than 0 and 1 are left out; of an id with both the toxic one counts. Without rows of both classes the model gives every text a score near 0.
    Above TRAIN_ROWS labelled rows a share of them is used, chosen by a hash of the id.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("toxic"))
    n = known.count()
    if n > TRAIN_ROWS:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1e6 * TRAIN_ROWS / n))
    known = F.broadcast(known.groupBy("_id").agg(F.max("toxic").alias("toxic")))  # TRAIN_ROWS at most, but for the hash's chance
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), fold.cast("int").alias("fold"))
    rows = rows.join(known, "_id").select("text", "fold", "toxic").where("fold is not null")
    texts = {(r["toxic"], r["fold"]): r["count"] for r in rows.groupBy("toxic", "fold").count().collect()}
    texts |= {(y, 2): sum(n for (z, _), n in texts.items() if z == y) for y in (0, 1)}
    raw = rows.mapInArrow(_counts, "feature string, fold int, toxic int, n long, docs long")
    part = lambda what, y, f: F.sum(F.when((F.col("toxic") == y) & ((F.col("fold") == f) if f < 2 else F.lit(True)), F.col(what)).otherwise(0))
    cells = [(y, f) for y in (0, 1) for f in (0, 1, 2)]
    wide = raw.groupBy("feature").agg(*(part("n", y, f).alias(f"n{y}{f}") for y, f in cells), *(part("docs", y, f).alias(f"d{y}{f}") for y, f in cells))
    wide = cut(wide.where(f"d12 >= {LEAST_DOCS} or (feature like '%$' and d02 >= {LEAST_DOCS})"))
    sums = wide.where("feature like '%$'").agg(*(F.sum(f"n{y}{f}") for y, f in cells)).first()
    total = {c: float(s or 0) for c, s in zip(cells, sums, strict=True)}
    scored = wide
    for f in (0, 1, 2):
        if not total[0, f] or not total[1, f]:
            return Model({})
        a = (F.col(f"n0{f}") + F.col(f"n1{f}")) * PRIOR
        odds = lambda y: (F.col(f"n{y}{f}") + a) / F.greatest(F.lit(total[y, f] + PRIOR * (total[0, f] + total[1, f])) - F.col(f"n{y}{f}") - a, F.lit(1.0))
        # How unlikely it is, by Chernoff's bound, that as many of the documents with a feature are toxic by chance.
        toxic, both, share = F.col(f"d1{f}"), F.col(f"d0{f}") + F.col(f"d1{f}"), texts[1, f] / (texts[0, f] + texts[1, f])
        own = toxic / both
        bits = both * (own * F.log(own / share) + F.when(own < 1, (1 - own) * F.log((1 - own) / (1 - share))).otherwise(0.0))
        scored = scored.withColumns({f"w{f}": F.log(odds(1)) - F.log(odds(0)), f"s{f}": F.when((toxic >= LEAST_DOCS) & (own > share), bits).otherwise(0.0)})
    enough = float(np.log(max(wide.count(), 1) / FALSE))
    clear = lambda f: (F.col(f"s{f}") >= enough) & (F.col(f"w{f}") >= LEAST_ODDS)
    got = scored.where(clear(0) | clear(1) | clear(2)).select("feature", *(F.when(clear(f), F.col(f"w{f}")).alias(f"w{f}") for f in (0, 1, 2))).orderBy("feature").collect()
    by = [{r["feature"]: r[f"w{f}"] for r in got if r[f"w{f}"] is not None} for f in (0, 1, 2)]
    trained = rows.mapInArrow(_best({0: by[1], 1: by[0]}), "toxic int, size long, found array<double>").collect()
    model = Model(by[2])
    clean = [(max(r["found"]), r["size"]) for r in trained if not r["toxic"] and r["found"]]
    if len(clean) > 2 and (sd := float(np.std([m for m, _ in clean]))) > 1e-6:
        model.rate = float(np.pi / np.sqrt(6) / sd)
        model.log_k = float(np.mean([model.rate * m - np.euler_gamma - np.log(s) for m, s in clean]))
    x = np.array([_features(model, r["found"], r["size"]) for r in trained])
    model.curve = _logistic(x, np.array([r["toxic"] for r in trained], float))
    return model


def _score(model: Model, found: list[float], size: int) -> float:
    b = model.curve
    return float(1 / (1 + np.exp(-np.clip(b[0] + np.dot(b[1:], _features(model, found, size)), -30, 30))))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model.weights)
        for batch in batches:
            out, passages = [], []
            for text in batch["_whole_text"].to_pylist():
                low = (text or "").lower()
                words = WORD.findall(low)
                size = len(words)
                found = segments(np.fromiter(map(scores.__getitem__, words), float, size))
                out.append(_score(model, [s for *_, s in found], size))
                least = model.log_k + np.log(max(size, 1)) - np.log(E_VALUE)
                far = [x for x in found if model.rate * x[2] >= least]
                at = [m.span() for m in WORD.finditer(low)] if far else []
                passages.append([{"start": at[s][0], "end": at[e - 1][1], "score": x, "e_value": float(np.exp(model.log_k + np.log(size) - model.rate * x))} for s, e, x in far])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch[c] for c in batch.schema.names if c != "_whole_text"] + [pa.array(out, pa.float64()), pa.array(passages, kind)], names=[c for c in batch.schema.names if c != "_whole_text"] + ["score", "passages"])
    return run


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*keep, score, passages) for each row: whole texts are read, null ones as empty.

    passages lists every significant segment with its place in the lower-cased text. Rows don't depend on each
    other, so repeated rows get equal scores; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("_whole_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_whole_text")
    return rows.mapInArrow(_scored(model), f"{kinds}, score double, passages array<struct<start:bigint,end:bigint,score:double,e_value:double>>")
