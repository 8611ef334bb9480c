"""Benchmark passages in documents: exact hits of pieces, confirmed by Myers' bit-parallel edit distance.

Texts are compared as sequences of words, lower-cased and without punctuation; in scripts that set no
blanks between words, each letter with its marks is a word. An item of n words may differ in up to e
words (substituted, missing or additional). Cut into e + 1 pieces, at least one piece of an occurrence
is unchanged, so an automaton of all pieces finds the place; the distance of the whole item to the words
around it, with free ends, decides. A short item may not differ at all: it is one piece, whose hit decides.
"""

import re
import unicodedata
from uuid import uuid4

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from souqframe.llm.rows import map_texts, once
from souqframe.sources.workspace import workspace

MOST_CHANGED = 0.2  # share of an item's words that may differ
LEAST_WORDS = 8  # items with fewer words are found only as they stand
BLOCK_BYTES = 8 << 20  # of a test set that is sent to the workers

WORD = re.compile(r"[^\W_]+")

# Scripts without blanks between words, as ranges of code points: Thai, Lao, Tibetan, Burmese, Khmer, Tai,
# Balinese, Chinese characters, kana, bopomofo, Yi, Javanese and halfwidth kana.
_RANGES = [
    (0x0E01, 0x0EFF), (0x0F40, 0x0FBC), (0x1000, 0x109F), (0x1780, 0x17DD), (0x1950, 0x19DF), (0x1A20, 0x1AAD),
    (0x1B00, 0x1B4C), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3035), (0x3038, 0x303C), (0x3041, 0x30FF),
    (0x3105, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF),
    (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
]
_LETTERS = "".join(f"{chr(a)}-{chr(b)}" for a, b in _RANGES)
_MARKS = "".join(chr(c) for a, b in _RANGES if b < 0xFFFF for c in range(a, b + 1) if unicodedata.category(chr(c))[0] == "M")
_NO_BLANKS = re.compile(f"[{_LETTERS}]")
_UNIT = re.compile(rf"[^\W_{_LETTERS}]+|(?=[^\W_])[{_LETTERS}][{_MARKS}]*")


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (WORD if text.isascii() or not _NO_BLANKS.search(text) else _UNIT).findall(text)


def pieces_of(words: list[str], errors: int) -> list[tuple[int, list[str]]]:
    """(first word, words) of errors + 1 pieces, as equal in length as can be."""
    count = errors + 1
    cuts = [len(words) * i // count for i in range(count + 1)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def least_distance(item: list[str], words: list[str], most: int) -> tuple[int, int] | None:
    """(distance, end) of the place in `words` that is nearest to the item, if within `most`.

    Myers' bit vectors over the item's words; the place may start and end anywhere.
    """
    size, full = len(item), (1 << len(item)) - 1
    of_word: dict[str, int] = {}
    for i, word in enumerate(item):
        of_word[word] = of_word.get(word, 0) | 1 << i
    up, down, distance, best = full, 0, size, None
    top = 1 << (size - 1)
    for end, word in enumerate(words, start=1):
        same = of_word.get(word, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        plus = down | ~(horizontal | up) & full
        minus = up & horizontal
        if plus & top:
            distance += 1
        elif minus & top:
            distance -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up = minus | ~(vertical | plus) & full
        down = plus & vertical
        if distance <= most and (best is None or distance < best[0]):
            best = distance, end
    return best


def errors_of(words: list[str], most_changed: float) -> int:
    """How many words of an item may differ."""
    return int(len(words) * most_changed) if len(words) >= LEAST_WORDS else 0


def occurs(item: list[str], errors: int, starts: list[int], words: list[str]) -> bool:
    """Whether the item is within its errors near one of the ascending starts. Starts that are close share a stretch."""
    i = 0
    while i < len(starts):
        j = i
        while j + 1 < len(starts) and starts[j + 1] - starts[j] <= len(item) + 2 * errors:
            j += 1
        stretch = words[max(0, starts[i] - errors) : max(0, starts[j] + len(item) + errors)]
        if least_distance(item, stretch, errors) is not None:
            return True
        i = j + 1
    return False


class Finder:
    """The items that whole texts contain."""

    def __init__(self, items: list[tuple[int, str]], most_changed: float):
        # By their place in the list: an id may come with several texts.
        self.items: dict[int, tuple[int, list[str], int]] = {}
        # Places of the items with the piece, and the numbers of those that it is the whole of.
        pieces: dict[str, tuple[list[tuple[int, int]], set[int]]] = {}
        for place, (number, text) in enumerate(items):
            words = words_of(text)
            if not words:
                continue
            errors = errors_of(words, most_changed)
            self.items[place] = number, words, errors
            for first, piece in pieces_of(words, errors):
                places, whole = pieces.setdefault(f" {' '.join(piece)} ", ([], set()))
                if errors:
                    places.append((place, first))
                else:
                    whole.add(number)
        self.automaton = ahocorasick.Automaton()
        for piece, (places, whole) in pieces.items():
            self.automaton.add_word(piece, (len(piece), places, whole))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[int]:
        """The numbers of the items in the text, in ascending order."""
        if not self.items or not text:
            return []
        words = words_of(text)
        line = f" {' '.join(words)} "
        hits: dict[int, set[int]] = {}
        numbers: set[int] = set()
        seen, at = 0, 0
        for end, (length, places, whole) in self.automaton.iter(line):
            numbers |= whole
            if not places:
                continue
            start = end - length + 1  # of the blank before the piece
            seen += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            for place, first in places:
                hits.setdefault(place, set()).add(seen - first)
        found = (place for place, starts in hits.items() if occurs(*self.items[place][1:], sorted(starts), words))
        return sorted(numbers.union(self.items[place][0] for place in found))


def contaminated(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    most_changed: float = MOST_CHANGED,
    folder: str | None = None,
) -> DataFrame:
    """Every row's columns `keep` (default doc_id) and item_ids: the items its whole text contains, ascending.

    A null or empty text contains none, a long one is searched as a whole. Items that are null, or have no
    id or no word, are found nowhere, and those of fewer than LEAST_WORDS words where all their words stand
    one after the other; an id that comes repeatedly is found by any of its texts. An empty test set is
    found nowhere. One row comes out for each row that goes in, so rows that come again come out as often;
    a kept column named item_ids is left out, others that are not kept are not read.

    The test set's bytes are counted first. Up to BLOCK_BYTES it is sent to the workers, and the texts need
    no shuffle; a larger one is met by a join of piece hashes, with intermediate tables in `folder` (default: one of its own in the shared folder).
    """
    spark = df.sparkSession
    keep = [name for name in keep or ["doc_id"] if name.lower() != "item_ids"]
    rows = items.select(
        F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text")
    ).where("id IS NOT NULL AND text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    if size > BLOCK_BYTES:
        from souqframe.llm.piece_join import contaminated_by_join

        return contaminated_by_join(df, rows, folder or workspace(spark), text, keep, most_changed)
    sent, key = spark.sparkContext.broadcast([tuple(row) for row in rows.collect()]), uuid4().hex

    def make():
        finder = once(("items", key), lambda: Finder(sent.value, most_changed))
        return lambda value: (finder.find(value),)

    return map_texts(df, text, keep, make, [StructField("item_ids", ArrayType(LongType()))])
