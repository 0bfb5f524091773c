"""Toxicity: a linear-chain conditional random field marks toxic spans, documents are scored from them.

Labels are known per document only. Words, their beginnings and endings that keep to toxic documents give
the tokens of the labelled documents a first label; the field learns from these tokens and their
neighbours, so that it also marks unseen words that are built alike. Forward-backward gives every token
its marginal probability; from the marginals of a text a calibrated score and the spans are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from postquarry.session import ship_package

WORD = re.compile(r"\w+")


@dataclass
class Settings:
    max_documents: int = 20_000  # labelled documents that the model is fitted on, chosen by hash
    min_documents: int = 4  # toxic documents that a feature must be in
    first_label: float = 3.0  # log odds from which a token of a toxic document counts as toxic
    rounds: int = 200


def features_of(word: str) -> tuple[str, ...]:
    """The word, its beginnings and its endings, lower-cased."""
    w = word.lower()
    return ("=" + w, *(f"^{w[:k]}" for k in (3, 4, 5, 6) if len(w) > k), *(f"{w[-k:]}$" for k in (4, 5, 6) if len(w) > k))


@dataclass
class Field:
    """Scores of the label T against O: per feature, for any token, and for the steps OT, TO and TT."""

    weights: dict[str, float]
    bias: float
    steps: tuple[float, float, float]
    scale: list[float]  # calibration: constant and one factor per document feature
    known: dict[str, float] = field(default_factory=dict)

    def of_word(self, word: str) -> float:
        """Sum of a word's feature weights; remembered."""
        got = self.known.get(word)
        if got is None:
            weights = self.weights
            got = sum((weights[f] for f in features_of(word) if f in weights), 0.0)
            if len(word) <= 40:
                if len(self.known) > 150_000:
                    self.known.clear()
                self.known[word] = got
        return got


def chain(bias: float, steps: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of the step over a token without features, for steps over many of them."""
    ot, to, tt = steps
    m = np.array([[1.0, np.exp(ot + bias)], [np.exp(to), np.exp(tt + bias)]])
    values, right = np.linalg.eig(m)
    values, right = values.real, right.real
    first = np.argmax(values)
    order = [first, 1 - first]
    right = right[:, order]
    return values[order], right, np.linalg.inv(right)


def over_gaps(gaps: np.ndarray, values: np.ndarray, right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The step matrix to the power of each gap, up to a factor."""
    ratio = (values[1] / values[0]) ** gaps
    return np.einsum("i,k,j->kij", right[:, 0], np.ones(len(gaps)), left[0]) + ratio[:, None, None] * np.outer(right[:, 1], left[1])


def follow(steps: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The state after each step, scaled to a sum of one: state x steps[0] x ... x steps[k], for all k.

    The steps are dealt to blocks of about the root of their number. The blocks go in step twice, once for
    their products and once from the state that the blocks before them lead to.
    """
    n = len(steps)
    size = max(1, int(np.ceil(np.sqrt(n))))
    count = -(-n // size)
    dealt = np.tile(np.eye(2), (count * size, 1, 1))
    dealt[:n] = steps
    dealt = dealt.reshape(count, size, 2, 2)
    whole = dealt[:, 0]
    for t in range(1, size):
        whole = whole @ dealt[:, t]
        whole = whole / whole.sum((1, 2), keepdims=True)
    now = np.empty((count, 1, 2))
    for k in range(count):
        now[k, 0] = state / state.sum()
        state = np.maximum(now[k, 0] @ whole[k], 1e-300)
    out = np.empty((count, size, 2))
    for t in range(size):
        now = np.maximum(now @ dealt[:, t], 1e-300)
        now = now / now.sum(2, keepdims=True)
        out[:, t] = now[:, 0]
    return out.reshape(-1, 2)[:n]


def marginals(scores: list[np.ndarray], gaps: list[np.ndarray], bias: float, steps: tuple[float, float, float]) -> list[np.ndarray]:
    """P(T) of the tokens with features, by forward-backward over the whole text.

    ``gaps`` counts the plain tokens before each of them and after the last. All texts form one chain: the
    step that ends a text leads back to the state before any text. Memory follows the sum of the sizes.
    """
    sizes = np.array([len(s) for s in scores], np.int64)
    out: list[np.ndarray] = [np.zeros(0)] * len(scores)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    ends = np.cumsum(sizes[some] + 1) - 1
    token = np.ones(ends[-1] + 1, bool)
    token[ends] = False
    between = over_gaps(np.concatenate([gaps[k] for k in some]), *chain(bias, steps))
    moves = between @ np.exp(np.array([[0.0, steps[0]], [steps[1], steps[2]]]))
    moves[token, :, 1] *= np.exp(np.clip(np.concatenate([scores[k] for k in some]) + bias, -60, 60))[:, None]
    moves[ends, :, 0] = between[ends].sum(2)
    moves[ends, :, 1] = 0.0
    moves = np.maximum(moves, 0.0)
    moves /= moves.sum((1, 2), keepdims=True)
    forward = follow(moves, np.array([1.0, 0.0]))[token]
    # What comes after a token: the same walk from the end, over the steps turned round.
    back = np.concatenate([follow(moves[:0:-1].transpose(0, 2, 1), np.ones(2))[::-1], np.ones((1, 2))])[token]
    both = forward * back
    inside = both[:, 1] / both.sum(1)
    for k, part in zip(some, np.split(inside, np.cumsum(sizes[some])[:-1])):
        out[k] = part
    return out


def shares(texts: list[str | None], rows: int = 200, characters: int = 2_000_000) -> Iterator[list[str | None]]:
    """The texts in order, in shares of at most so many rows and characters; a longer text is a share of its own."""
    part: list[str | None] = []
    held = 0
    for text in texts:
        size = len(text or "")
        if part and (len(part) == rows or held + size > characters):
            yield part
            part, held = [], 0
        part.append(text)
        held += size
    if part:
        yield part


def read_texts(model: Field, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per text: places of the tokens with features among all tokens, their marginals; number of tokens."""
    places, scores, gaps, sizes = [], [], [], []
    of_word = model.of_word
    for text in texts:
        s = np.fromiter(map(of_word, WORD.findall(text or "")), float)
        at = np.flatnonzero(s)
        places.append(at)
        scores.append(s[at])
        gaps.append(np.diff(np.concatenate([[-1], at, [len(s)]])) - 1)
        sizes.append(len(s))
    return places, marginals(scores, gaps, model.bias, model.steps), scores, np.array(sizes)


def document_features(inside: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Log odds of the likeliest token, and the logs of how many tokens and what share are expected to be toxic."""
    most = np.array([m.max() if len(m) else 0.0 for m in inside])
    many = np.array([m.sum() for m in inside])
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.log(most / (1 - most)), np.log1p(many), np.log(many / np.maximum(sizes, 1) + 1e-5)], 1)


def plain_likelihood(lengths: np.ndarray, bias: float, steps: tuple[float, float, float]) -> np.ndarray:
    """Log probability that all tokens of a whole text of so many plain tokens are O."""
    values, right, left = chain(bias, steps)
    return -lengths * np.log(values[0]) - np.log(right[0, 0] * left[0].sum() + (values[1] / values[0]) ** lengths * right[0, 1] * left[1].sum())


def fit_field(
    sequences: list[list[tuple[tuple[int, ...], int]]], names: list[str], rounds: int, times: list[int] | None = None, plain: dict[int, int] | None = None,
) -> tuple[dict[str, float], float, tuple[float, float, float]]:
    """Weights by gradient ascent on the likelihood of short labelled sequences of (features, label).

    ``times``: how often each sequence occurs (default: once). ``plain``: whole texts without any feature, all
    O, as number of tokens and of texts.
    """
    top, n = max(map(len, sequences), default=1), len(sequences)
    width = max([1, *(len(f) for s in sequences for f, _ in s)])
    often = np.ones(n) if times is None else np.array(times, float)
    lengths, texts = np.array(list(plain or {}), float), np.array(list((plain or {}).values()), float)
    ids = np.full((n, top, width), len(names), np.int64)
    gold, real = np.zeros((n, top), np.int64), np.zeros((n, top), bool)
    for k, s in enumerate(sequences):
        for t, (f, y) in enumerate(s):
            ids[k, t, : len(f)] = f
            gold[k, t], real[k, t] = y, True
    w = np.zeros(len(names) + 1 + 4)  # features, none, bias, OT, TO, TT
    momentum, speed = np.zeros_like(w), np.zeros_like(w)
    for r in range(1, rounds + 1):
        u = np.append(w[: len(names)], 0.0)[ids].sum(2) + w[-4]
        step = np.array([[0.0, w[-3]], [w[-2], w[-1]]])
        enter = np.exp(step)
        local = np.stack([np.ones_like(u), np.exp(np.clip(u, -60, 60))], 2)
        alpha, beta = np.zeros((top, n, 2)), np.ones((top, n, 2))
        alpha[0] = local[:, 0]
        alpha[0] /= alpha[0].sum(1, keepdims=True)
        for t in range(1, top):
            a = (alpha[t - 1] @ enter) * local[:, t]
            alpha[t] = np.where(real[:, t, None], a / a.sum(1, keepdims=True), alpha[t - 1])
        for t in range(top - 2, -1, -1):
            b = (beta[t + 1] * local[:, t + 1]) @ enter.T
            beta[t] = np.where(real[:, t + 1, None], b / b.sum(1, keepdims=True), 1.0)
        both = alpha * beta
        p = (both[:, :, 1] / both.sum(2)).T
        error = np.where(real, gold - p, 0.0) * often[:, None]
        gradient = np.zeros_like(w)
        gradient[: len(names) + 1] = np.bincount(ids.ravel(), np.repeat(error.ravel(), width), len(names) + 1)
        gradient[len(names)] = 0.0
        gradient[-4] = error.sum()
        for t in range(1, top):
            pair = alpha[t - 1][:, :, None] * enter[None] * (beta[t] * local[:, t])[:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            pair = np.where(real[:, t, None, None], pair, 0.0)
            seen = real[:, t] * often
            for place, (i, j) in zip((-3, -2, -1), ((0, 1), (1, 0), (1, 1))):
                gradient[place] += (seen * ((gold[:, t - 1] == i) & (gold[:, t] == j)) - often * pair[:, i, j]).sum()
        for place in range(-4, 0) if len(lengths) else ():
            more, less = w[-4:].copy(), w[-4:].copy()
            more[place] += 1e-5
            less[place] -= 1e-5
            change = plain_likelihood(lengths, more[0], tuple(more[1:])) - plain_likelihood(lengths, less[0], tuple(less[1:]))
            gradient[place] += texts @ change / 2e-5
        gradient -= 0.05 * w
        momentum = 0.9 * momentum + 0.1 * gradient
        speed = 0.99 * speed + 0.01 * gradient**2
        w += 0.1 * (momentum / (1 - 0.9**r)) / (np.sqrt(speed / (1 - 0.99**r)) + 1e-6)
    return dict(zip(names, w[: len(names)].tolist())), float(w[-4]), tuple(w[-3:].tolist())


def fit_scale(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression by Newton's method."""
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, x.T @ (y - p) - 0.1 * w), -3, 3)
    return w.tolist()


def train(labelled: DataFrame, docs: DataFrame, settings: Settings | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Field | None:
    """Fit on ``labelled`` (id, label) and the texts of ``docs``; None without both kinds of label.

    At most ``max_documents`` labelled ids take part, chosen by hash; that bounds what is broadcast and
    what reaches the driver: counts of features and short token sequences. An id with several labels
    counts as toxic if one says so; null labels and ids are left out.
    """
    settings = settings or Settings()
    ship_package(docs.sparkSession)
    chosen = (
        labelled.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("_y"))
        .orderBy(F.xxhash64(doc_id), doc_id).limit(settings.max_documents)
    )
    sample = docs.select(doc_id, text).join(F.broadcast(chosen), doc_id).select(F.col("_y").cast("int").alias("y"), F.coalesce(text, F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f in {f for w in set(WORD.findall(t)) for f in features_of(w)}:
                    seen.setdefault(f, [0, 0])[y > 0] += 1
            yield pa.RecordBatch.from_pydict({
                "f": pa.array(seen), "clean": pa.array([c for c, _ in seen.values()], pa.int64()), "bad": pa.array([b for _, b in seen.values()], pa.int64()),
            })

    totals = {bool(r["y"]): r["n"] for r in sample.groupBy((F.col("y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    clean, bad = totals.get(False, 0), totals.get(True, 0)
    if not clean or not bad:
        return None
    odds = F.log((F.col("bad") + 0.1) / (bad + 0.2)) - F.log((F.col("clean") + 0.1) / (clean + 0.2))
    least = min(settings.min_documents, bad)
    found = (
        sample.mapInArrow(count, "f string, clean long, bad long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
        .where(F.col("bad") >= least).withColumn("odds", odds).where("odds >= 1.5")
        .orderBy(F.desc(F.col("odds") * F.log1p("bad")), "f").collect()
    )
    names = [r["f"] for r in found]
    number, strength = {f: k for k, f in enumerate(names)}, [r["odds"] for r in found]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of at most 16 tokens around tokens with features; of a text without any, the number of tokens."""
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = []
            for y, t in zip(batch.column(0).to_pylist(), texts):
                words = [[number[f] for f in features_of(w) if f in number] for w in WORD.findall(t)]
                near = np.zeros(len(words) + 1, bool)
                for k, w in enumerate(words):
                    if w:
                        near[max(0, k - 2) : k + 3] = True
                if words and not near[: len(words)].any():
                    out.append((None, None, len(words)))
                k = 0
                while k < len(words):
                    if not near[k]:
                        k += 1
                        continue
                    end = k
                    while end < len(words) and near[end] and end - k < 16:
                        end += 1
                    run = words[k:end]
                    out.append((run, [int(y > 0 and any(strength[f] >= settings.first_label for f in w)) for w in run], None))
                    k = end
            yield pa.RecordBatch.from_pydict({
                "runs": pa.array([r for r, _, _ in out], pa.list_(pa.list_(pa.int32()))), "labels": pa.array([l for _, l, _ in out], pa.list_(pa.int32())),
                "plain": pa.array([p for _, _, p in out], pa.int64()),
            })

    # Equal runs are one row with their number; what reaches the driver is bounded by the labelled sample.
    runs = sample.mapInArrow(cut, "runs array<array<int>>, labels array<int>, plain long").groupBy("runs", "labels", "plain").agg(F.count("*").alias("n")).collect()
    held = [r for r in runs if r["plain"] is None]
    sequences = [[(tuple(f), y) for f, y in zip(r["runs"], r["labels"])] for r in held]
    weights, bias, steps = fit_field(sequences, names, settings.rounds, [r["n"] for r in held], {r["plain"]: r["n"] for r in runs if r["plain"] is not None})
    model = Field({f: w for f, w in weights.items() if abs(w) > 1e-3}, bias, steps, [0.0, 1.0, 0.0, 0.0])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("array<double>")
    def describe(texts: pd.Series) -> pd.Series:
        found = []
        for part in shares(texts.tolist()):
            _, inside, _, sizes = read_texts(shared.value, part)
            found += list(document_features(inside, sizes))
        return pd.Series(found)

    points = sample.select("y", describe("text").alias("x")).collect()
    model.scale = fit_scale(np.array([p["x"] for p in points]), np.array([float(p["y"] > 0) for p in points]))
    return model


def _spans(text: str, places: np.ndarray, inside: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Characters of neighbouring tokens whose marginal reaches ``least``."""
    marked = set(places[inside >= least].tolist())
    out: list[tuple[int, int]] = []
    if marked:
        last = -2
        for k, m in enumerate(WORD.finditer(text)):
            if k in marked:
                if last == k - 1:
                    out[-1] = (out[-1][0], m.end())
                else:
                    out.append((m.start(), m.end()))
                last = k
    return out


def score_texts(df: DataFrame, model: Field | None, text: str = "text", name: str = "toxicity", least: float = 0.5) -> DataFrame:
    """Add (score, spans) to every row: 0 to 1, and the code points of toxic spans. One pass, no shuffle.

    Only the whole text decides. Null and empty texts have no tokens, hence no spans and the score of a text
    without any sign; without a model the score is 0. Rows stay one to one.
    """
    kind = "struct<score:double,spans:array<struct<start:int,end:int>>>"
    if model is None:
        return df.withColumn(name, F.struct(F.lit(0.0).alias("score"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")))
    ship_package(df.sparkSession)
    shared: Broadcast = df.sparkSession.sparkContext.broadcast(model)

    @pandas_udf(kind)
    def score(texts: pd.Series) -> pd.DataFrame:
        m, scores, spans = shared.value, [], []
        for part in shares(texts.tolist()):
            places, inside, _, sizes = read_texts(m, part)
            x = document_features(inside, sizes)
            scores.append(1 / (1 + np.exp(-np.clip(m.scale[0] + x @ np.array(m.scale[1:]), -30, 30))))
            spans += [[{"start": a, "end": b} for a, b in _spans(t, p, i, least)] if len(i) else [] for t, p, i in zip(part, places, inside)]
        return pd.DataFrame({"score": np.concatenate(scores) if scores else [], "spans": spans})

    return df.withColumn(name, score(F.col(text)))
