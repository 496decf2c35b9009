"""Quality classifier: a weak-label model over heuristic labellers, then a hashed linear scorer.

A document can be bad in two ways that have nothing to do with each other: it is junk, or it is toxic. Each way is a
latent class of its own with its own overlapping labellers.

1. Labellers vote on every document (1 good, -1 bad, 0 no vote); most look at the text, one passes on given labels.
2. Votes are counted by pattern over all documents: a few hundred rows whatever the corpus. Expectation-maximisation
   on these counts estimates how accurate each labeller is.
3. The posterior of each pattern labels a bounded sample, on which a logistic scorer over hashed words is trained.
4. The scorers judge every whole text in a narrow Arrow stage.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, Memo, bounded_sample, forgetting, map_arrow, narrow, word_array

# Common English insults, as whole words.
INSULTS = ("bastard clown creep dimwit disgusting dumb fool idiot imbecile jerk loser lowlife moron pathetic pig scum "
           "scumbag shut stupid trash vermin worthless").split()
# The labellers of each way of being bad; the last passes on the given labels.
LABELLERS = {
    "junk": ("symbols", "shouting", "repetition", "word_length", "variety", "sentences", "given_quality"),
    "toxic": ("insult", "insults", "given_toxic"),
}
GIVEN = ("given_quality", "given_toxic")

BUCKETS = 1 << 17
PREFIX, COPIES = 5, 8


def votes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the vote of every labeller that looks at the text (``doc_id, text``)."""
    words = docs.select("doc_id", "text", word_array(F.col("text")).alias("words"))
    s = words.select(
        "doc_id", F.size("words").alias("n"), F.length(F.array_join("words", "")).alias("chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>!]")).alias("symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).alias("upper"),
        F.regexp_count("text", F.lit(r"(?i)\b(?:" + "|".join(INSULTS) + r")\b")).alias("insults"),
        F.col("text").rlike(r"\p{Ll}[.?]").alias("sentence"),
        F.size(F.array_distinct(F.transform("words", lambda w: F.xxhash64(w)))).alias("kinds"))
    n, chars = F.greatest("n", F.lit(1)), F.greatest("chars", F.lit(1))
    symbols, upper, kinds = F.col("symbols") / chars, F.col("upper") / chars, F.col("kinds") / n
    bad = lambda c: F.when(c, -1).otherwise(0)
    good = lambda c: F.when(c, 1).otherwise(0)
    return s.select(
        "doc_id",
        bad(symbols >= 0.05).alias("symbols"), bad(upper >= 0.3).alias("shouting"),
        bad((F.col("n") >= 20) & (kinds < 0.35)).alias("repetition"),
        bad((F.col("chars") / n > 15) | (F.col("chars") / n < 2)).alias("word_length"),
        bad(F.col("insults") > 0).alias("insult"), bad(F.col("insults") > 1).alias("insults"),
        good((kinds >= 0.5) & (F.col("n") >= 5)).alias("variety"),
        good(F.col("sentence") & (symbols < 0.02)).alias("sentences"))


def given(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The votes of the given labels; rows that repeat a key vote once, a null label does not vote."""
    vote = lambda bad: F.min(F.when(bad, -1).when(~bad, 1).otherwise(0))
    return labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        vote(F.col("quality") == 0).alias("given_quality"), vote(F.col("toxic") == 1).alias("given_toxic"))


@dataclass
class LabelModel:
    """What EM found: ``table[class, labeller, vote + 1]`` with class 0 bad and 1 good, the share of good, the rounds."""

    table: np.ndarray
    prior: float
    rounds: int

    @property
    def accuracy(self) -> np.ndarray:
        """By labeller, the chance that a vote it gives is right."""
        right = self.prior * self.table[1, :, 2] + (1 - self.prior) * self.table[0, :, 0]
        wrong = self.prior * self.table[1, :, 0] + (1 - self.prior) * self.table[0, :, 2]
        return right / np.maximum(right + wrong, 1e-12)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good) of each row of votes. A labeller that does not vote says nothing: it may not know the language."""
        at = patterns.astype(int) + 1
        z = (np.log(self.table[:, np.arange(patterns.shape[1]), at]) * (patterns != 0)).sum(-1)
        return 1 / (1 + np.exp(np.clip(z[0] + math.log(1 - self.prior) - z[1] - math.log(self.prior), -40, 40)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, *, rounds: int = 200, start: float = 0.9,
                    strength: float = 0.05, prior: float = 0.8) -> LabelModel:
    """Expectation-maximisation for labellers that are independent given the class and may abstain.

    Each labeller starts from the belief that a vote of the wrong kind comes ``1 - start`` times as often as one of
    the right kind, held with the weight of ``strength`` of the rows: this fixes which class is the good one. How
    often it votes at all is learned per class. Without rows the model is that belief itself.
    """
    m, total = patterns.shape[1], float(counts.sum())
    seen = np.stack([((patterns == v) * counts[:, None]).sum(0) for v in (-1, 0, 1)]) + 0.5
    share = seen / seen.sum(0)
    belief = np.empty((2, m, 3))
    for c, good_side in ((0, 0), (1, 2)):
        belief[c, :, good_side] = share[good_side] / (prior if c else 1 - prior) * start
        belief[c, :, 2 - good_side] = share[2 - good_side] * (1 - start)
        belief[c] = np.minimum(belief[c], 0.9)
        belief[c, :, 1] = np.maximum(0.05, 1 - belief[c, :, 0] - belief[c, :, 2])
        belief[c] /= belief[c].sum(-1, keepdims=True)
    model, pseudo = LabelModel(belief, prior, 0), max(1.0, strength * total)
    for i in range(rounds if total else 0):
        p = model.posterior(patterns)
        table = np.empty_like(belief)
        for c, weight in ((0, (1 - p) * counts), (1, p * counts)):
            got = np.stack([((patterns == v) * weight[:, None]).sum(0) for v in (-1, 0, 1)], -1)
            table[c] = (got + pseudo * belief[c]) / (weight.sum() + pseudo)
        nxt = LabelModel(table, float(np.clip((p * counts).sum() / total, 0.05, 0.99)), i + 1)
        moved = abs(nxt.table - model.table).max() + abs(nxt.prior - model.prior)
        model = nxt
        if moved < 1e-7:
            break
    return model


_EDGE = b".,;:!?()[]{}\"'*$%&#|<>-_=/"

def _hashed(word: bytes) -> tuple[int, bytes]:
    """Bucket of a word, and its first characters."""
    w = word.strip(_EDGE)
    return zlib.crc32(w) % BUCKETS, w.decode("utf-8", "ignore")[:PREFIX].encode()


_words = Memo(_hashed, 100_000)


def _forget() -> None:
    _words.clear()


def _level(name: str, x: float, cuts: tuple[float, ...]) -> list[int]:
    """Buckets that say how many of the cuts a share reaches; several, as one text has only one such share."""
    level = sum(x >= c for c in cuts)
    return [zlib.crc32(f"#{name}{level}.{i}".encode()) % BUCKETS for i in range(COPIES)]


_SYMBOL, _UPPER = re.compile(r"[#*$%&|<>!]"), re.compile(r"[^\W\d_a-zß-öø-ÿ]")


def features(text: str) -> np.ndarray:
    """Distinct buckets of a whole text.

    Its words; how many different words start alike (1, 2, 4 or 8 at least); levels of a few shares.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    kinds = set(words)
    out, alike = [], Counter()
    for h in map(_words.__getitem__, kinds):
        out.append(h[0])
        alike[h[1]] += 1
    for start, k in alike.items():
        out.append(zlib.crc32(start, 1) % BUCKETS)
        for least in (2, 4, 8):
            if k >= least:
                out.append(zlib.crc32(start, least) % BUCKETS)
    n, chars = max(1, len(words)), max(1, len(text))
    out += _level("symbols", len(_SYMBOL.findall(text)) / chars, (0.005, 0.02, 0.05, 0.15))
    out += _level("upper", len(_UPPER.findall(text)) / chars, (0.05, 0.15, 0.3))
    out += _level("kinds", len(kinds) / n, (0.1, 0.2, 0.35, 0.5))
    out += _level("length", n, (1, 5, 20, 100))
    out += _level("word", sum(map(len, words)) / n, (2, 4, 9, 15))
    return np.unique(np.array(out, np.int32))


@dataclass
class Scorer:
    """``weights`` by bucket, the bias in the last place; a document is bad at ``threshold`` and above."""

    weights: np.ndarray
    threshold: float
    labels: LabelModel | None = None

    def score(self, index: np.ndarray) -> float:
        return float(self.weights[index].sum() + self.weights[-1])


def train(index: list[np.ndarray], bad: np.ndarray, *, epochs: int = 8, rate: float = 0.2, decay: float = 5e-5,
          batch: int = 32, seed: int = 3) -> np.ndarray:
    """Logistic regression on soft labels by AdaGrad over small batches."""
    w, g2 = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(index))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            sizes = [len(index[r]) for r in rows]
            flat = np.concatenate([index[r] for r in rows])
            z = np.add.reduceat(w[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]])) + w[-1]
            d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - bad[rows]
            touched, at = np.unique(flat, return_inverse=True)
            grad = np.bincount(at, np.repeat(d, sizes)) / len(rows) + decay * w[touched]
            g2[touched] += grad * grad
            w[touched] -= rate * grad / np.sqrt(g2[touched])
            g2[-1] += d.mean() ** 2
            w[-1] -= rate * d.mean() / math.sqrt(g2[-1])
    return w


def _threshold(z: np.ndarray, bad: np.ndarray) -> float:
    """The cut where the share of bad caught less five times the share of good lost is largest."""
    order = np.argsort(z)
    z, bad = z[order], bad[order]
    good_below = np.concatenate([[0], np.cumsum(1 - bad)]) / max(1e-9, (1 - bad).sum())
    bad_above = (bad.sum() - np.concatenate([[0], np.cumsum(bad)])) / max(1e-9, bad.sum())
    value = 5 * good_below + bad_above
    # of cuts that differ by no more than one bad document, the one that spares most: small samples cannot tell them apart
    k = int(np.flatnonzero(value >= value.max() - 1 / max(1.0, bad.sum()) - 1e-12)[-1])
    if k == 0:
        return float(z[0]) - 1
    return float(z[k - 1] + z[k]) / 2 if k < len(z) else float(z[-1]) + 1


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", key: str = "doc_id",
        max_train: int = 20_000) -> dict[str, Scorer]:
    """A scorer for each way of being bad: label model on the votes over all documents, training on a bounded sample.

    The sample is about ``max_train`` documents that have a given label, or any documents where labels is empty. Its
    hashed words and votes, no texts, are all that is gathered besides the vote patterns. Empty tables give scorers
    that keep everything.
    """
    texts = narrow(docs, id_col, text_col)
    voices = given(labels, key)

    def voted(rows: DataFrame) -> DataFrame:
        return votes(rows).join(voices, F.col("doc_id") == F.col("_k"), "left").fillna(0, list(GIVEN)).drop("_k")

    every = sorted({x for names in LABELLERS.values() for x in names})
    patterns = voted(texts).groupBy(*every).count().toPandas()  # at most 2^8 x 3^2 rows
    counts = patterns["count"].to_numpy(float)
    models = {k: fit_label_model(patterns[list(names)].to_numpy(float), counts) for k, names in LABELLERS.items()}
    out = {k: Scorer(np.zeros(BUCKETS + 1), math.inf, m) for k, m in models.items()}

    def hashed(batches: Batches) -> Batches:
        for b in batches:
            index = [features(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(index, pa.binary())], names=["doc_id", "index"])

    keys = bounded_sample(voices.select("_k"), "_k", max_train)
    if keys.isEmpty():
        sample = bounded_sample(texts.filter(F.col("doc_id").isNotNull()), "doc_id", max_train)
    else:
        sample = texts.join(F.broadcast(keys), F.col("doc_id") == F.col("_k"), "left_semi")
    # one row per id, so that what is gathered is bounded however often an id repeats
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = map_arrow(sample, forgetting(hashed, _forget), "doc_id long, index binary").join(voted(sample), "doc_id").toPandas()
    if rows.empty:
        return out
    rows = rows.sort_values("doc_id", kind="stable")
    index = [np.frombuffer(b, np.int32) for b in rows["index"]]
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"]])
    if held.all() or not held.any():
        held[::2], held[1::2] = True, False
    for k, scorer in out.items():
        bad = 1 - models[k].posterior(rows[list(LABELLERS[k])].to_numpy(float))
        if held.sum() < len(held):
            scorer.weights = train([x for x, h in zip(index, held) if not h], bad[~held])
        z = np.array([scorer.score(x) for x, h in zip(index, held) if h])
        truth = (bad[held] > 0.5).astype(float)
        if truth.any():
            scorer.threshold = _threshold(z, truth)
    return out


def _shared(docs: DataFrame, scorers: dict[str, Scorer]):
    """The scorers for the tasks: a matrix of ``BUCKETS + 1`` by two and two thresholds, whatever the corpus."""
    w = np.stack([scorers[k].weights for k in LABELLERS], 1)
    return docs.sparkSession.sparkContext.broadcast((w, np.array([scorers[k].threshold for k in LABELLERS])))


def judge(docs: DataFrame, scorers: dict[str, Scorer], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, junk_odds, toxic_odds, score, kept`` for every row: kept unless a scorer finds the text bad.

    ``score`` is the larger of the log-odds after each one's threshold is taken off. A null text is
    an empty one; ids may be null or repeat, rows are judged one by one.
    """
    shared = _shared(docs, scorers)

    def run(batches: Batches) -> Batches:
        weights, cuts = shared.value
        for b in batches:
            z = np.array([weights[features(t)].sum(0) + weights[-1] for t in b.column("text").to_pylist()]).reshape(-1, 2)
            over = (z - cuts).max(1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x) for x in (z[:, 0], z[:, 1], over, over < 0))],
                names=["doc_id", "junk_odds", "toxic_odds", "score", "kept"])

    return map_arrow(narrow(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")), forgetting(run, _forget),
                     "doc_id long, junk_odds double, toxic_odds double, score double, kept boolean")


def keep(docs: DataFrame, scorers: dict[str, Scorer], *, text_col: str = "text") -> DataFrame:
    """The rows whose text is kept, with all their columns; one narrow stage."""
    shared, at = _shared(docs, scorers), docs.columns.index(text_col)

    def run(batches: Batches) -> Batches:
        weights, cuts = shared.value
        for b in batches:
            keep = [bool((weights[features(t or "")].sum(0) + weights[-1] < cuts).all()) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, forgetting(run, _forget), docs.schema)
