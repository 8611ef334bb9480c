"""Licence texts found in documents: matching statistics against a suffix automaton, chained into spans."""

import re
from bisect import bisect_left
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StringType, StructField

from souqframe.llm.licence_texts import TEMPLATES, all_templates  # noqa: F401
from souqframe.llm.rows import map_texts, once

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Phrases that decide alone, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

LEAST_MATCH = 3  # words of a match that can be chained
LEAST_COVER = 0.75  # share of a template's words in a span that gives it its label
WHOLE = 4  # words of a template up to which all of them have to be there
MOST_GAP = 8  # words between two matches of a chain, in text and template


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


class SuffixAutomaton:
    """All substrings of several word sequences; after each word of a text, the longest one that ends there."""

    def __init__(self, sequences: list[list[str]]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        # For each state, the places (sequence, last word) at which its substrings end.
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, words in enumerate(sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].append((number, place))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]].extend(self.ends[state])
        self.ends = [sorted(set(places)) for places in self.ends]

    def _new(self, length: int, transitions: dict[str, int], link: int) -> int:
        self.next.append(transitions)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _clone(self, state: int, word: str) -> int:
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: str) -> int:
        if word in self.next[last]:
            return self._clone(last, word)
        state = self._new(self.length[last] + 1, {}, 0)
        while last != -1 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        self.link[state] = 0 if last == -1 else self._clone(last, word)
        return state

    def statistics(self, words: Iterable[str]) -> Iterable[tuple[int, int]]:
        """(length of the longest match that ends at a word, its state), word by word."""
        state, length = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield length, state


class Scanner:
    """Finds the templates' words in texts."""

    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str]):
        pairs = [(label, words_of(text)) for label, texts in templates.items() for text in texts]
        self.labels = [label for label, _ in pairs]
        self.sizes = [len(words) for _, words in pairs]
        self.automaton = SuffixAutomaton([words for _, words in pairs])
        self.phrases = [(words_of(phrase), label) for phrase, label in phrases.items()]
        self.starts = {words[0] for words, _ in self.phrases}
        self.known = set(self.automaton.next[0])

    def base(self, words: list[str]) -> list[tuple[int, str]]:
        """(first word, label) of each place at which a phrase's words follow one another."""
        starts = [i for i, word in enumerate(words) if word in self.starts]
        return [
            (i, label)
            for i in starts
            for phrase, label in self.phrases
            if words[i : i + len(phrase)] == phrase
        ]

    def matches(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(first word, end, state) of the matches that cannot be made longer to the right.

        Words that no template has lead back to the root, so only the runs between them are read.
        """
        known, found, at = self.known, [], -1
        places = [i for i, word in enumerate(words) if word in known]
        run: list[int] = []
        for at in [*places, -1]:
            if run and at != run[-1] + 1:
                if len(run) >= LEAST_MATCH:
                    found += self._run(words, run[0], run[-1] + 1)
                run = []
            run.append(at)
        return found

    def _run(self, words: list[str], first: int, end: int) -> list[tuple[int, int, int]]:
        found, before = [], (0, 0)
        for place, now in enumerate(self.automaton.statistics(words[first:end])):
            if now[0] <= before[0] and before[0] >= LEAST_MATCH:
                found.append((first + place - before[0], first + place, before[1]))
            before = now
        if before[0] >= LEAST_MATCH:
            found.append((end - before[0], end, before[1]))
        return found

    def spans(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """(first word, end, template, covered words) of the chains, for each template the best at its place.

        A chain takes matches in the order of text and template, with gaps of at most MOST_GAP words.
        """
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for first, end, state in self.matches(words):
            for template, last in self.automaton.ends[state]:
                by_template.setdefault(template, []).append((first, end, last + 1))
        out = []
        for template, blocks in by_template.items():
            blocks.sort()
            # Best chain that ends with each block; only blocks that begin within the gap can be before it.
            score, start, reach = [], [], []
            order = [first for first, _, _ in blocks]
            longest = max(end - first for first, end, _ in blocks)
            for i, (first, end, to) in enumerate(blocks):
                best, begun = end - first, first
                for j in range(bisect_left(order, first - MOST_GAP - longest), i):
                    _, end_j, to_j = blocks[j]
                    skip = max(0, end_j - first, to_j - (to - (end - first)))
                    if end_j < end and to_j < to and skip < end - first and (
                        first - end_j <= MOST_GAP and to - (end - first) - to_j <= MOST_GAP
                    ) and score[j] + end - first - skip > best:
                        best, begun = score[j] + end - first - skip, start[j]
                score.append(best)
                start.append(begun)
                reach.append(end)
            best_from: dict[int, tuple[int, int]] = {}
            for begun, value, end in zip(start, score, reach, strict=True):
                best_from[begun] = max(best_from.get(begun, (0, 0)), (value, -end))
            # The best first; others where they leave room.
            taken: list[tuple[int, int]] = []
            for begun, (value, end) in sorted(best_from.items(), key=lambda chain: (-chain[1][0], chain[0])):
                at = bisect_left(taken, (begun, 0))
                if (at == 0 or taken[at - 1][1] <= begun) and (at == len(taken) or taken[at][0] >= -end):
                    taken.insert(at, (begun, -end))
                    out.append((begun, -end, template, value))
        return sorted(out)

    @staticmethod
    def best(spans: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
        """The spans (by their first word) without those that meet one of another label that is covered better."""
        beaten, open_ = [False] * len(spans), []
        for i, (first, _, label, share) in enumerate(spans):
            open_ = [j for j in open_ if spans[j][1] > first]
            for j in open_:
                if spans[j][2] != label and spans[j][3] != share:
                    beaten[i if spans[j][3] > share else j] = True
            open_.append(i)
        return [span for span, lost in zip(spans, beaten, strict=True) if not lost]

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        base = self.base(words)
        places = [place for place, _ in base]
        found = self.spans(words)
        shares = (round(size / self.sizes[template], 6) for _, _, template, size in found)
        good = self.best(
            [
                (first, end, self.labels[template], size / self.sizes[template])
                for first, end, template, size in found
                if size >= (self.sizes[template] if self.sizes[template] <= WHOLE else LEAST_COVER * self.sizes[template])
            ]
        )
        base_labels = {label for _, label in base}
        labels = base_labels | {label for _, _, label, _ in good}
        return (
            len(words),
            len(base),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            min(1.0, max(shares, default=0.0)),
            ",".join(f"{label}:{first}:{end}" for first, end, label, _ in good),
        )


FIELDS = [
    StructField("n_words", LongType()),
    StructField("n_base", LongType()),
    StructField("first_word", LongType()),
    StructField("last_word", LongType()),
    StructField("base_labels", StringType()),
    StructField("labels", StringType()),
    StructField("score", DoubleType()),
    StructField("spans", StringType()),
]


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    templates: dict[str, list[str]] | None = None,
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """Licences named in every whole text: the columns `keep` (default doc_id) and FIELDS.

    score is the largest share of a template's words that one chain covers; a chain that covers
    LEAST_COVER of them (of a template of WHOLE words or fewer, all) gives its label and its span (label:first
    word:end), unless one of another label that is covered better meets it. Several templates may have the
    same label. A null text has no words: counts 0, first_word and last_word null, labels empty, score
    0. One row comes out for each row that goes in; other columns are not read. The templates are sent
    to the workers, so they should stay a few MB.
    """
    templates = all_templates() if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    key = ("licences", repr(templates), repr(phrases))

    def make():
        return once(key, lambda: Scanner(templates, phrases)).scan

    return map_texts(df, text, keep or ["doc_id"], make, FIELDS)
