"""Language of texts by rank-order profiles of letter n-grams and their out-of-place distance."""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from souqframe.llm.rows import map_texts, once

PROFILE = 400  # n-grams of a profile, of a language or of a document
MOST_LANGUAGES = 20_000  # profiles are sent to every worker, so their number has to be bounded
UNKNOWN = "und"

_BLANK = 0x20
_BITS = 21  # of a code point; three of them fit into a signed 64-bit number
_HELD = 200_000  # n-gram counts a task holds for a language before it passes them on


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def n_grams(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1-, 2- and 3-grams of the lower-cased words of letters, a blank at both ends.

    The codes of one blank and of two in a row are not there; a text without letters has no n-grams.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(letters[codes], codes, _BLANK)
    codes = np.concatenate(([_BLANK], codes, [_BLANK]))
    codes = codes[np.concatenate(([True], (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)))]
    alphabet, small = np.unique(codes, return_inverse=True)
    if len(alphabet) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size, found, counts = len(alphabet), [], []
    grams = np.zeros(len(small), np.int64)
    for n in (1, 2, 3):
        if len(small) < n:
            break
        grams = grams[: len(small) - n + 1] * size + small[n - 1 :]
        if size**n <= 4 * len(grams):
            number = np.bincount(grams, minlength=size**n)
            kinds = np.flatnonzero(number)
            number = number[kinds]
        else:
            kinds, number = np.unique(grams, return_counts=True)
        wide, rest = np.zeros(len(kinds), np.int64), kinds
        for place in range(n):
            wide |= alphabet[rest % size] << (_BITS * place)
            rest = rest // size
        found.append(wide)
        counts.append(number)
    kinds, number = np.concatenate(found), np.concatenate(counts)
    real = kinds != _BLANK
    return kinds[real], number[real]


def ranking(kinds: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The `size` most frequent n-grams, most frequent first, ties by their code."""
    if len(kinds) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        kept = counts >= least
        kinds, counts = kinds[kept], counts[kept]
    return kinds[np.lexsort((kinds, -counts))][:size]


class Profiles:
    """Rank of each n-gram in each language."""

    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.size, self.languages = size, sorted(ranked)
        self.known = np.unique(np.concatenate([np.empty(0, np.int64), *map(np.array, ranked.values())]))
        self.known = self.known.astype(np.int64)
        self.ranks = np.full((len(self.languages), len(self.known) + 1), -1, np.int32)
        for row, language in enumerate(self.languages):
            at = np.searchsorted(self.known, np.array(ranked[language], np.int64))
            self.ranks[row, at] = np.arange(len(at))

    def distances(self, ranked: np.ndarray) -> np.ndarray:
        """Sum over the document's n-grams of how many places each is away; a missing one is `size` away."""
        at = np.searchsorted(self.known, ranked)
        at = np.where(np.append(self.known, -1)[at] == ranked, at, len(self.known))
        theirs = self.ranks[:, at]
        return np.where(theirs >= 0, np.abs(theirs - np.arange(len(ranked))), self.size).sum(axis=1)

    def predict(self, kinds: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(kinds) or not self.languages:
            return UNKNOWN, 0.0
        ranked = ranking(kinds, counts, self.size)
        distances = self.distances(ranked)
        best = int(np.argmin(distances))
        return self.languages[best], float(1 - distances[best] / (self.size * len(ranked)))


def learn_profiles(
    df: DataFrame, text: str = "text", label: str = "lang", size: int = PROFILE
) -> dict[str, list[int]]:
    """The `size` most frequent n-grams of all texts of each label, most frequent first, ties by code.

    Rows with a null label or text teach nothing. Counts are gathered in each task, passed on before
    they grow beyond _HELD n-grams, and summed by Spark; only the finished profiles reach the driver.
    More than MOST_LANGUAGES labels are refused.
    """
    inner = df.select(
        F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{label}`").cast("string").alias("label")
    ).where("text IS NOT NULL AND label IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = once("letters", _letters)
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        waiting: dict[str, int] = defaultdict(int)

        def summed(language: str) -> tuple[np.ndarray, np.ndarray]:
            kinds = np.concatenate([k for k, _ in held[language]])
            counts = np.concatenate([c for _, c in held[language]])
            kinds, at = np.unique(kinds, return_inverse=True)
            return kinds, np.bincount(at, counts).astype(np.int64)

        def given(language: str) -> pa.RecordBatch:
            kinds, counts = summed(language)
            held.pop(language)
            names = pa.array([language] * len(kinds), pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array(kinds), pa.array(counts)], names=["label", "gram", "n"])

        for batch in batches:
            for value, language in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                part = n_grams(value, letters)
                held[language].append(part)
                waiting[language] += len(part[0])
                if waiting[language] > _HELD:
                    held[language] = [summed(language)]
                    waiting[language] = len(held[language][0][0])
                    if waiting[language] > _HELD // 2 or len(held) > 1000:
                        yield given(language)
                        waiting[language] = 0
        for language in list(held):
            yield given(language)

    counts = inner.mapInArrow(count, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("label").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(place)).where(F.col("place") <= size)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("label", "place").toLocalIterator():
        profiles.setdefault(row["label"], []).append(row["gram"])
        if len(profiles) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return profiles


FIELDS = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]


def identify_languages(
    df: DataFrame,
    profiles: dict[str, list[int]],
    text: str = "text",
    keep: list[str] | None = None,
    size: int = PROFILE,
) -> DataFrame:
    """The nearest profile's language for every whole text: the columns `keep` (default doc_id), lang_pred, score.

    score is 1 less the distance as a share of the largest possible one. Of equally near languages the
    first by name is taken. A null text, one without a letter, or no profiles at all give `und` and 0.
    One row comes out for each row that goes in; columns of `keep` named like a result are left out and
    other columns are not read.
    """

    def make():
        letters = once("letters", _letters)
        known = Profiles(profiles, size)

        def run(value: str | None) -> tuple[str, float]:
            return known.predict(*n_grams(value, letters)) if value else (UNKNOWN, 0.0)

        return run

    return map_texts(df, text, keep or ["doc_id"], make, FIELDS)
