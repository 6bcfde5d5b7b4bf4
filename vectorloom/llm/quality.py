"""Text quality learned from trusted positives and unlabelled web text.

Positive-unlabelled learning with the non-negative risk: with the class prior p, the
risk of a scorer g is p * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - p * E_pos[loss(-g)]).
The second part is the risk on negatives, which can't be below zero; where a batch makes
it so, the step goes against it. The prior is estimated first: a scorer of positives
against unlabelled orders held-back texts, and the prior is the least ratio of the shares
of unlabelled and positive texts above any score (with a margin for small counts).

Only text is an input. Features: shares of the ASCII signs, and figures on words, lines
and repetition. Fitting uses a bounded sample; scoring runs over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import id_and_text, map_rows

STATISTICS = 15
WIDTH = 128 + STATISTICS


@dataclass(frozen=True)
class PuSettings:
    """``most_rows``: at most so many positive and so many unlabelled texts are fitted on."""

    most_rows: int = 20_000
    hidden: int = 32
    epochs: int = 20
    batch: int = 512
    rate: float = 3e-3
    decay: float = 1e-4
    prior_margin: float = 1.0
    seed: int = 7


def features(texts: list[str]) -> np.ndarray:
    rows = np.zeros((len(texts), WIDTH), np.float32)
    for row, text in zip(rows, texts):
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        n = len(data)
        if not n:
            continue
        counts = np.bincount(data, minlength=256)
        row[:128] = np.sqrt(counts[:128] / n)
        words = text.split()
        w = max(1, len(words))
        lines = text.split("\n")
        ends = {}
        for word in words:
            ends[word[-1]] = ends.get(word[-1], 0) + 1
        upper, lower = counts[65:91].sum(), counts[97:123].sum()
        row[128:] = (
            counts[128:].sum() / n,
            np.log1p(n) / 10,
            np.log1p(len(words)) / 10,
            n / w / 10,
            len(set(words)) / w,
            len(set(zip(words, words[1:]))) / w,
            sum(a == b for a, b in zip(words, words[1:])) / w,
            len(set(lines)) / len(lines),
            np.log1p(len(lines)) / 10,
            upper / max(1, upper + lower),
            counts[48:58].sum() / n,
            (counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / n,
            max(ends.values(), default=0) / w,
            sum(len(x) == 1 for x in words) / w,
            counts[:32].sum() / n,
        )
    return rows


class Scorer:
    """One hidden layer on standardised features."""

    def __init__(self, width: int, hidden: int, seed: int):
        random = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(width, np.float32), np.ones(width, np.float32)
        self.parts = [
            random.normal(0, 1 / np.sqrt(width), (width, hidden)),
            np.zeros(hidden),
            random.normal(0, 1 / np.sqrt(hidden), hidden),
            np.zeros(1),
        ]
        self.parts = [p.astype(np.float32) for p in self.parts]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parts]
        self.steps = 0

    def standard(self, rows: np.ndarray) -> None:
        self.mean, self.scale = rows.mean(0), rows.std(0) + np.float32(1e-3)

    def hidden(self, rows: np.ndarray) -> np.ndarray:
        inside = np.clip((rows - self.mean) / self.scale, -8, 8)
        return inside, np.maximum(0, inside @ self.parts[0] + self.parts[1])

    def margin(self, rows: np.ndarray) -> np.ndarray:
        return self.hidden(rows)[1] @ self.parts[2] + self.parts[3][0]

    def step(self, rows: np.ndarray, slope: np.ndarray, rate: float, decay: float) -> None:
        """One step of adaptive gradient descent, given the loss's slope at each row's margin."""
        inside, hidden = self.hidden(rows)
        back = np.outer(slope, self.parts[2]) * (hidden > 0)
        slopes = [inside.T @ back, back.sum(0), hidden.T @ slope, np.array([slope.sum()])]
        slopes = [s.astype(np.float32) for s in slopes]
        self.steps += 1
        for part, slope_, (first, second) in zip(self.parts, slopes, self.moments):
            slope_ = slope_ + decay * part
            first += 0.1 * (slope_ - first)
            second += 0.001 * (slope_**2 - second)
            part -= rate * (first / (1 - 0.9**self.steps)) / (np.sqrt(second / (1 - 0.999**self.steps)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, settings: PuSettings, prior: float | None) -> Scorer:
    """Without a prior: positives against unlabelled; with one: the non-negative risk."""
    random = np.random.default_rng(settings.seed)
    scorer = Scorer(positive.shape[1], settings.hidden, settings.seed)
    scorer.standard(unlabelled)
    steps = max(1, (len(positive) + len(unlabelled)) // settings.batch) * settings.epochs
    half = settings.batch // 2
    for i in range(steps):
        rate = settings.rate * (1 - i / steps)
        p = positive[random.integers(0, len(positive), half)]
        u = unlabelled[random.integers(0, len(unlabelled), half)]
        at_p, at_u = scorer.margin(p), scorer.margin(u)
        pull, push = -sigmoid(-at_p) / half, sigmoid(at_u) / half  # slopes of loss(g) on p, loss(-g) on u
        if prior is None:
            slope_p, slope_u = pull, push
        else:
            back = sigmoid(at_p) / half  # of loss(-g) on p
            negative = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
            if negative >= 0:
                slope_p, slope_u = prior * (pull - back), push
            else:  # only undo what made the part negative
                slope_p, slope_u = prior * back, -push
        scorer.step(np.vstack([p, u]), np.concatenate([slope_p, slope_u]), rate, settings.decay)
    return scorer


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, margin: float) -> float:
    """Least ratio of shares above a score, from scores of held-back positive and unlabelled texts."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.99, 200)))
    n, m = len(positive), len(unlabelled)
    of_p = np.array([(positive >= c).mean() for c in cuts])
    of_u = np.array([(unlabelled >= c).mean() for c in cuts])
    slack = margin * (np.sqrt(np.log(20) / (2 * n)) + np.sqrt(np.log(20) / (2 * m)))
    best = np.argmin((of_u + slack) / of_p)
    return float(np.clip(of_u[best] / of_p[best], 0.01, 0.99))


@dataclass
class QualityModel:
    scorer: Scorer | None
    prior: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of quality; 0.5 for all where nothing could be learned."""
        if self.scorer is None:
            return np.full(len(texts), 0.5)
        return sigmoid(self.scorer.margin(features(texts)))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [r.tobytes() for r in features(batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["row"])


def _gather(texts: DataFrame) -> np.ndarray:
    """Features of a bounded sample of texts, in a fixed order."""
    rows = sorted(r["row"] for r in map_rows(texts, _feature_rows, "row binary").collect())
    rows = [np.frombuffer(r, np.float32) for r in rows]
    return np.array(rows, np.float32).reshape(len(rows), WIDTH)


def sample_ids(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` identifiers, chosen by hash; small enough to broadcast."""
    return ids.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id")).limit(most)


def fit(docs: DataFrame, positives: DataFrame, unlabelled: DataFrame, settings: PuSettings | None = None) -> QualityModel:
    """Fit on texts of ``docs`` with identifiers in ``positives`` and in ``unlabelled`` (columns ``doc_id``).

    Null texts are empty ones; null identifiers in either list are passed over, repeated
    ones count once in the list and as often as ``docs`` has rows of them. The curve is
    fitted on three quarters of each kind and the prior read off the rest: with fewer than
    10 texts of either kind nothing is fitted, and every text scores 0.5.
    """
    settings = settings or PuSettings()
    rows = id_and_text(docs)
    sets = [
        _gather(rows.join(F.broadcast(sample_ids(ids, settings.most_rows)), "doc_id", "left_semi"))
        for ids in (positives, unlabelled)
    ]
    if min(map(len, sets)) < 10:
        return QualityModel(None, 0.5)
    random = np.random.default_rng(settings.seed)
    (p, held_p), (u, held_u) = (np.split(s[random.permutation(len(s))], [len(s) * 3 // 4]) for s in sets)
    ranking = _fit(p, u, settings, None)
    prior = estimate_prior(ranking.margin(held_p), ranking.margin(held_u), settings.prior_margin)
    return QualityModel(_fit(sets[0], sets[1], settings, prior), prior)


def _score(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = model.scores(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])


def score(docs: DataFrame, model: QualityModel, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, score`` of every row: the probability of quality from its whole text.

    Null texts are scored as empty ones. Null identifiers and repeated rows pass through;
    equal texts have equal scores; other columns are not read.
    """
    return map_rows(id_and_text(docs, id_col, text_col), _score, "doc_id bigint, score double", model)


def fold(doc_id, parts: int):
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def score_documents(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, threshold: float = 0.3):
    """Learn from the rows outside of the held-out fold, score all."""
    learn = fold(F.col("doc_id"), parts) != held
    positives = labels.where(learn & (F.col("quality") == 1))
    model = fit(docs, positives, docs.where(learn))
    return score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), parts) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
