"""Toxicity by a support vector machine on a gapped subsequence kernel.

A document is a bag of its words, each between a begin and an end mark, without what is no letter inside,
and with runs of spelled-out single letters joined. Two words are as similar as the subsequences of three letters
they share, each weighted down by the gaps it has in either word, so inserted and missing letters cost
similarity but do not hide a word. Landmark words (Nyström) turn that kernel into features of a linear machine. It is
trained on the words of labelled documents: a toxic document has at least one toxic word, another
has none. A document's score is that of its most toxic word, calibrated on the labelled documents.

As the machine is linear in the landmarks' subsequences, it folds into one weight per subsequence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.session import stage

ORDER = 3
DECAY = 0.6
#: Symbols: two marks, 26 letters, and 36 places for all others.
SYMBOLS = 64
#: Longer words are compared in windows of this size that overlap by half.
WINDOW = 16
LANDMARKS = 100
ROUNDS = 4
_CACHED = 300_000

#: Words that cannot get above this decision value are given a bound instead of the exact value.
FLOOR = -0.9

_LETTERS = re.compile(r"[^\W\d_]+")
_SPELLED = re.compile(r"(?<!\w)[^\W\d_](?:[^\w\n]{1,3}[^\W\d_]){2,}(?!\w)")
_CODE = np.arange(1 << 16) % 36 + 28
_CODE[ord("a") : ord("z") + 1] = np.arange(2, 28)


def words(text: str | None) -> set[str]:
    """Distinct words in lower case, without what is no letter, and spelled-out ones joined."""
    lowered = (text or "").lower()
    found = set(lowered.split())
    found.update(_SPELLED.findall(lowered))
    found = {w if w.isalpha() else "".join(_LETTERS.findall(w)) for w in found}
    found.discard("")
    return found


def windows(of: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words as rows of symbols between the marks, by length; long words in windows. With their places."""
    lengths = np.array([len(w) for w in of], dtype=np.int64)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        for start in range(0, len(places), 4096):
            part = places[start : start + 4096]
            letters = "".join([of[i] for i in part]).encode("utf-32-le", "surrogatepass")
            points = np.frombuffer(letters, dtype=np.uint32).reshape(len(part), length)
            marked = np.zeros((len(part), length + 2), dtype=np.int32)
            marked[:, 1:-1], marked[:, -1] = _CODE[points & 0xFFFF], 1
            for at in range(0, max(1, marked.shape[1] - WINDOW // 2), WINDOW // 2):
                yield part, marked[:, at : at + WINDOW]


@lru_cache(maxsize=WINDOW + 1)
def _places(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences of a word of that length, and their weights by span."""
    places = np.array(list(combinations(range(length), ORDER)), dtype=np.int64).reshape(-1, ORDER)
    return places, DECAY ** (places[:, -1] - places[:, 0] + 1)


def _subsequences(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of the subsequences of words of one length, a row per word."""
    places, weights = _places(of.shape[1])
    codes = np.zeros((len(of), len(places)), dtype=np.int32)
    for k in range(ORDER):
        codes = codes * SYMBOLS + of[:, places[:, k]]
    return codes, weights


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square root of each word's kernel with itself: equal subsequences add up before they are squared."""
    order = np.argsort(codes, axis=1, kind="stable")
    ordered, weighted = np.take_along_axis(codes, order, axis=1), weights[order]
    first = np.ones(codes.shape, dtype=bool)
    first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    sums = np.add.reduceat(weighted.ravel(), np.flatnonzero(first.ravel())) if codes.size else np.zeros(0)
    return np.sqrt(np.bincount(np.nonzero(first)[0], weights=sums**2, minlength=len(codes)))


def kernel(of: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of words with landmarks, by the first window of each."""
    table = np.zeros((SYMBOLS**ORDER, len(landmarks)), dtype=np.float32)
    for part, same in windows([w[: WINDOW - 2] for w in landmarks]):
        codes, weights = _subsequences(same)
        norms = _norms(codes, weights)
        for row, i in enumerate(part):
            np.add.at(table[:, i], codes[row], weights / norms[row])
    out = np.zeros((len(of), len(landmarks)), dtype=np.float32)
    for part, same in windows([w[: WINDOW - 2] for w in of]):
        codes, weights = _subsequences(same)
        norms = _norms(codes, weights)
        for row, i in enumerate(part):
            out[i] = weights @ table[codes[row]] / norms[row]
    return out


@dataclass
class ToxicityModel:
    """``table`` has the weight of every subsequence; ``slope`` and ``shift`` calibrate a bag's best word."""

    table: np.ndarray
    bias: float
    slope: float = 0.0
    shift: float = -40.0

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def decide(self, asked: list[str]) -> np.ndarray:
        """Decision value of each word, the best of its windows.

        A word's norm is smallest if no subsequence repeats; the exact norm is only
        computed where that bound lets the value reach ``FLOOR``.
        """
        best = np.full(len(asked), -np.inf)
        for part, same in windows(asked):
            codes, weights = _subsequences(same)
            sums = self.table[codes] @ weights.astype(np.float32)
            values = sums / np.sqrt((weights**2).sum()) + self.bias
            if len(exact := np.flatnonzero(values > FLOOR)):
                values[exact] = sums[exact] / _norms(codes[exact], weights) + self.bias
            best[part] = np.maximum(best[part], values)
        return best

    def bags(self, of: list[set[str]]) -> list[float]:
        """Decision value of the most toxic word of every bag; -1 for a bag without words."""
        missing = list(set().union(*of).difference(self.known))
        if len(self.known) + len(missing) > _CACHED:
            self.known.clear()
            missing = list(set().union(*of))
        self.known.update(zip(missing, self.decide(missing).tolist(), strict=True))
        return [max(map(self.known.__getitem__, bag), default=-1.0) for bag in of]

    def score(self, value: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -40, 40))))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-6
    def loss(w: np.ndarray) -> float:
        return float(ridge @ w**2 / 2 + cost @ np.maximum(0, 1 - y * (x @ w)) ** 2)

    w = np.zeros(x.shape[1])
    for _ in range(steps):
        short = np.flatnonzero(y * (x @ w) < 1)
        inside, c = x[short], cost[short, None]
        step = np.linalg.solve(np.diag(ridge) + 2 * inside.T @ (inside * c), 2 * inside.T @ (c[:, 0] * y[short])) - w
        size, before = 1.0, loss(w)
        while size > 1e-4 and loss(w + size * step) > before:
            size /= 2
        w = w + size * step
        if before - loss(w) < 1e-6 * before:
            break
    return w


def _train(toxic: dict[str, float], clean: dict[str, float], cost: float = 1000.0) -> ToxicityModel:
    """A machine that tells the words apart. A word weighs by its number of bags; the most frequent are landmarks."""
    words_ = [*toxic, *clean]
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    n = np.array([*toxic.values(), *clean.values()], dtype=float)
    landmarks = [w for words_of in (toxic, clean) for w in sorted(words_of, key=lambda w: (-words_of[w], w))[:LANDMARKS]]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    # Both classes weigh the same in total.
    costs = cost * n / np.where(y > 0, n[y > 0].sum(), n[y < 0].sum())
    w = _svm(kernel(words_, landmarks) @ root, y, costs)
    beta = root @ w[:-1]
    table = np.zeros(SYMBOLS**ORDER)
    for part, same in windows([w[: WINDOW - 2] for w in landmarks]):
        codes, weights = _subsequences(same)
        norms = _norms(codes, weights)
        for row, i in enumerate(part):
            np.add.at(table, codes[row], beta[i] * weights / norms[row])
    return ToxicityModel(table.astype(np.float32), float(w[-1]))


def _calibrate(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from decision values to the chance of the label."""
    x, w = np.stack([values, np.ones(len(values))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (labels - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _portions(bags: list[frozenset[str]]) -> Iterator[list[frozenset[str]]]:
    return (bags[i : i + 256] for i in range(0, len(bags), 256))


def _support(bags: list[frozenset[str]], common: set[str]) -> Counter:
    """In how many kinds of bags each word is.

    Bags with the same smallest hash of a word that is not common are mostly copies of each other: one kind.
    """
    kinds: dict[int, set[str]] = {}
    for bag in bags:
        kinds.setdefault(min(map(xxhash.xxh3_64_intdigest, (bag - common) or bag), default=0), set()).update(bag)
    return Counter(w for words_ in kinds.values() for w in words_)


def _chance(inside: int, outside: int, share: float) -> float:
    """Chance that a word that means nothing is in that many toxic bags of all that it is in.

    Summed in logarithms, as the numbers of choices exceed floating point from about a thousand bags on.
    """
    n = inside + outside
    return sum(
        math.exp(
            math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
            + k * math.log(share) + (n - k) * math.log1p(-share)
        )
        for k in range(inside, n + 1)
    )


def _inserted(word: str) -> list[str]:
    """The word with one letter more, at three places."""
    places = sorted({max(1, len(word) * k // 4) for k in (1, 2, 3)})
    return [word[:i] + "xqz"[k % 3] + word[i:] for k, i in enumerate(places)]


def learn(bags: list[set[str]], labels: list[int], most_words: int = 4000) -> ToxicityModel:
    """Train on bags of words whose label holds for the bag.

    Words that occur in toxic bags more often than chance allows start as toxic. In each round the most toxic
    word of every toxic bag joins them, unless other bags have it as often, and the most toxic words
    of other bags become examples of clean ones. A fourth of the bags is left out and used to
    calibrate. With labels of one kind only, or no telling word, all scores are 0.
    """
    distinct = list({(frozenset(b), bool(y)): None for b, y in zip(bags, labels, strict=True)})
    fourth = [xxhash.xxh3_64_intdigest(" ".join(sorted(b))) % 4 == 0 for b, _ in distinct]
    held, used = distinct, distinct
    if len(distinct) >= 40:
        held, used = ([x for x, out in zip(distinct, fourth, strict=True) if out == part] for part in (True, False))
    toxic_bags, clean_bags = [b for b, y in used if y], [b for b, y in used if not y]
    nothing = ToxicityModel(np.zeros(SYMBOLS**ORDER, dtype=np.float32), -1.0)
    if not toxic_bags or not clean_bags:
        return nothing
    everywhere = Counter(w for b, _ in used for w in b)
    common = {w for w, n in everywhere.items() if n > 0.02 * len(used)}
    inside, outside = _support(toxic_bags, common), _support(clean_bags, common)
    share = len(toxic_bags) / (len(toxic_bags) + len(clean_bags))
    repeated = [w for w, n in inside.items() if n > 1 and n > 4 * share * outside[w]]
    toxic = {w for w in repeated if _chance(inside[w], outside[w], share) * len(inside) < 0.5}
    frequent = sorted(outside, key=lambda w: (-outside[w], w))
    half = most_words // 2
    clean = dict.fromkeys(frequent[:half] + frequent[half :: max(1, len(frequent) // half)], 1)
    model = nothing
    for _ in range(ROUNDS):
        strongest = sorted(toxic, key=lambda w: (-inside[w], w))[: most_words // 4]
        if not strongest:
            return nothing
        # A toxic word with a letter put in between is as toxic.
        marked = {v: 0.25 * inside[w] for w in strongest for v in _inserted(w) if v not in outside}
        model = _train(
            marked | {w: max(1, inside[w]) for w in strongest},
            {w: n + min(5, outside[w]) for w, n in clean.items() if w not in toxic},
        )
        hard, found = (
            Counter(
                word
                for some in _portions(of)
                for bag, value in zip(some, model.bags(some), strict=True)
                if value > limit
                for word in sorted(bag, key=lambda w: (-model.known[w], w))[:most]
            )
            for of, limit, most in ((clean_bags, -0.5, 3), (toxic_bags, 0.3, 1))
        )
        clean.update({w: 10 + min(20, n + outside[w]) for w, n in sorted(hard.items())})
        toxic |= {w for w, n in found.items() if inside[w] > 1 and inside[w] > 8 * share * outside[w]}
    values = np.array([v for some in _portions([b for b, _ in held]) for v in model.bags(some)])
    model.slope, model.shift = _calibrate(values, np.array([y for _, y in held], dtype=float))
    model.known = {}
    return model


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_per_label: int = 2000) -> ToxicityModel:
    """Learn from labelled documents; rows with a NULL key, text or label are left out.

    The sample is bounded by ``sample_per_label`` documents of each label in expectation, chosen by a hash
    of the key, and it is all that reaches the driver: the distinct words of each document.
    """
    has(documents, key=key, text=text)
    has(labels, key=key, label=label)
    known = labels.select(F.col(key).alias("key"), (F.col(label) > 0).alias("label")).dropna().distinct()
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    rate = F.when(F.col("label"), min(1.0, sample_per_label / sizes.get(True, 1))).otherwise(
        min(1.0, sample_per_label / sizes.get(False, 1))
    )
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / F.lit(1 << 20)
    chosen = stage(known.where(place < rate), "toxicity-sample")
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).dropna().join(chosen, "key")

    @F.pandas_udf("array<string>")
    def bag(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(words(t)))

    found = rows.select("key", "label", bag("text").alias("words")).collect()
    found.sort(key=lambda r: (r["key"], r["label"], r["words"]))
    return learn([set(r["words"]) for r in found], [int(r["label"]) for r in found])


def score(spark, model: ToxicityModel, text: Column) -> Column:
    """Score from 0 to 1 of every whole text; NULL, empty and wordless texts have no toxic word."""
    shared = spark.sparkContext.broadcast(model)  # one weight per subsequence of three symbols

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = shared.value
        for batch in batches:
            values: list[float] = []
            for start in range(0, len(batch), 256):
                values += fitted.bags([words(t) for t in batch[start : start + 256]])
            yield pd.Series([fitted.score(v) for v in values], dtype=float)

    return scored(text)
