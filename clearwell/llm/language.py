"""Language identification by the nearest of several centroids per language.

A text becomes its letters in lower case, every run of other characters one blank. Its 1- to 3-grams are
counted in hashed bins over the whole text, weighted with the inverse document frequencies of all
labelled documents, and normalised. The texts of a bounded sample are clustered per language; a text gets the language of the
centroid at the smallest cosine distance, and is rejected if it is far from every centroid.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.session import stage

BINS = 4096
LARGEST_GRAM = 3
#: Characters handled at once, so that a long text costs no more memory than a short one.
BLOCK = 1 << 18
UNDETERMINED = "und"
#: Texts with fewer letters have too little in common with any centroid to be rejected.
FEWEST_LETTERS = 32
#: Places of which a hash gives one to every text.
PLACE_BITS = 20
RESULT = "lang_pred string, score double, rejected boolean"

#: Runs of letters; those that touch a digit belong to codes and numbers.
_LETTERS = re.compile(r"(?<![^\W_])[^\W\d_]+(?![^\W_])")
_ANY_LETTER = re.compile(r"[^\W\d_]")
#: The same for Spark.
_LETTER_IN_SPARK = r"[\p{L}\p{Nl}\p{No}]"


def gram_counts(text: str) -> tuple[np.ndarray, int]:
    """Counts of the hashed 1- to 3-grams of the whole text, and its number of letters."""
    lowered = text.lower()
    words = _LETTERS.findall(lowered) or _ANY_LETTER.findall(lowered)
    counts = np.zeros(BINS, dtype=np.int64)
    letters = sum(map(len, words))
    if not letters:
        return counts, 0
    symbols = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for start in range(0, len(symbols), BLOCK):
        block = symbols[start : start + BLOCK + LARGEST_GRAM - 1]
        gram = np.zeros(len(block), dtype=np.uint32)
        for n in range(1, LARGEST_GRAM + 1):
            if len(block) < n:
                break
            gram = gram[: len(block) - n + 1] * np.uint32(0x01000193) + block[n - 1 :] + np.uint32(n)
            bins = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(20))[:BLOCK]
            counts += np.bincount(bins, minlength=BINS)
    return counts, letters


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def _vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf).astype(np.float32)


def _length_class(letters: int) -> int:
    return min(letters.bit_length(), 31)


@dataclass(frozen=True)
class LanguageModel:
    """``floors[c]`` is the cosine below which a text with that length class is rejected."""

    languages: list[str]
    owners: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine of the nearest centroid, and whether that is too far away.

        NULL and texts without letters are undetermined and rejected, with score 0. With nothing learned
        all texts are undetermined, but those with letters are not rejected. Ties go to the
        language that comes first by code point.
        """
        counts, letters = gram_counts(text or "")
        if not letters or not self.languages:
            return UNDETERMINED, 0.0, not letters
        cosines = self.centroids @ _vector(counts, self.idf)
        best = int(np.argmax(cosines))
        score = float(np.clip(cosines[best], 0, 1))
        return self.languages[self.owners[best]], score, bool(score < self.floors[_length_class(letters)])


def _cluster(vectors: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from vectors that are far from those chosen before."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(clusters, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        owner = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[owner == k].sum(axis=0) for k in range(len(centroids))])
        centroids = _unit(np.where(sums.any(axis=1, keepdims=True), sums, centroids)).astype(np.float32)
    return centroids


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bin occurs, over all rows; summed per task before the shuffle."""

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, rows = np.zeros(BINS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                seen += gram_counts(text)[0] > 0
                rows += 1
        yield pd.DataFrame({"bin": np.arange(-1, BINS), "n": np.append(rows, seen)})

    summed = texts.mapInPandas(per_task, "bin int, n long").where("n > 0").groupBy("bin").agg(F.sum("n").alias("n"))
    frequency = np.zeros(BINS + 1, dtype=np.int64)
    for row in summed.collect():  # at most one row per bin
        frequency[row["bin"]] = row["n"]
    return frequency[:BINS], int(frequency[BINS])


def _places(texts: dict[int, int], wanted: int, least: int) -> float:
    """Below which place texts are sampled, from the number of texts whose place has so many bits."""
    total, passed = sum(texts.values()), 0
    for bits in sorted(texts):
        passed += texts[bits]
        if passed >= min(least, total):
            break
    return max(float(1 << bits), (1 << PLACE_BITS) * min(1.0, wanted / total))


def fit(
    labelled: DataFrame, text: str = "text", label: str = "lang", clusters: int = 6,
    sample_per_language: int = 800, floor: float = 0.6,
) -> LanguageModel:
    """Learn from all labelled rows; rows with a NULL text or label are left out.

    Document frequencies come from every labelled row. Centroids are clustered from a sample of the distinct texts
    that have letters, which a hash of the text selects: ``sample_per_language`` of them in expectation however many
    copies they have, all if there are no more, and never fewer than ``clusters`` as long as there are so many. A text is rejected below ``floor`` times the smallest cosine of the sample's texts
    that have at least its length class (a power of two of letters); texts of fewer than ``FEWEST_LETTERS`` never are. The model has one vector per language and cluster.
    """
    has(labelled, text=text, label=label)
    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("label")).dropna()
    frequency, n = _document_frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + frequency)) + 0.1
    lettered = rows.where(F.col("text").rlike(_LETTER_IN_SPARK)).withColumn("digest", F.xxhash64("text"))
    lettered = lettered.withColumn("place", F.pmod("digest", F.lit(1 << PLACE_BITS)))
    counted = lettered.select("label", "digest", "place").distinct().groupBy("label", F.length(F.bin("place")).alias("bits"))
    bits: dict[str, dict[int, int]] = {}
    for r in counted.count().collect():  # at most PLACE_BITS rows per language
        bits.setdefault(r["label"], {})[r["bits"]] = r["count"]
    if not bits:
        return LanguageModel([], np.zeros(0, int), np.zeros((0, BINS), np.float32), idf, np.zeros(32))
    below = {label: _places(texts, sample_per_language, clusters) for label, texts in bits.items()}
    limit = F.create_map(*[F.lit(x) for pair in below.items() for x in pair])
    sample = lettered.where(F.col("place") < F.element_at(limit, F.col("label"))).dropDuplicates(["label", "digest"])

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        counted = [gram_counts(t) for t in group.sort_values("digest")["text"]]
        counted = [(c, letters) for c, letters in counted if letters]
        if not counted:
            return pd.DataFrame({"label": group["label"].iloc[:1], "centroid": None, "length": 0, "cosine": 0.0})
        vectors = np.stack([_vector(c, idf) for c, _ in counted])
        found = _cluster(vectors, clusters)
        cosines = (vectors @ found.T).max(axis=1)
        k = len(found)
        return pd.DataFrame({
            "label": group["label"].iloc[0],
            "centroid": [c.tobytes() for c in found] + [None] * len(counted),
            "length": [0] * k + [_length_class(letters) for _, letters in counted],
            "cosine": [0.0] * k + [float(c) for c in cosines],
        })

    parts = stage(
        sample.groupBy("label").applyInPandas(centroids, "label string, centroid binary, length int, cosine double"),
        "language-centroids",
    )
    found = parts.where("centroid IS NOT NULL").collect()  # languages times clusters
    found.sort(key=lambda r: (r["label"].encode(), r["centroid"]))
    languages = sorted({r["label"] for r in found}, key=str.encode)
    least = {
        r["length"]: r["m"]
        for r in parts.where("centroid IS NULL").groupBy("length").agg(F.min("cosine").alias("m")).collect()
    }
    # Short texts have little in common with any centroid, so a longer text never has the lower floor.
    floors, last = np.zeros(32), least[max(least)] if least else 0.0
    for c in range(31, _length_class(FEWEST_LETTERS) - 1, -1):
        last = min(last, least.get(c, last))
        floors[c] = floor * last
    return LanguageModel(
        languages, np.array([languages.index(r["label"]) for r in found], int),
        np.stack([np.frombuffer(r["centroid"], dtype=np.float32) for r in found]) if found
        else np.zeros((0, BINS), np.float32), idf, floors,
    )


def predict(spark, model: LanguageModel, text: Column) -> Column:
    """A struct of ``lang_pred``, ``score`` and ``rejected`` for every text (see ``LanguageModel.predict``).

    The model goes to the executors once; its size is languages x clusters x bins.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        for batch in batches:
            yield pd.DataFrame([fitted.predict(t) for t in batch], columns=["lang_pred", "score", "rejected"])

    return identify(text)
