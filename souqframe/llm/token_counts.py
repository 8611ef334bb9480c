"""Number of greedy longest-match pieces of each text, without building the pieces.

The vocabulary is a trie. Where no entry goes on, a failure link leads to the node of what remains
open after the longest entries in front have been popped, and the link carries how many were popped.
So each byte is read once and each count is an addition.
"""

from collections import deque
from collections.abc import Iterable
from itertools import islice

import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from souqframe.llm.bpe import read_ranks
from souqframe.llm.rows import Memo, map_texts, once

WORDS = 400_000  # words a worker remembers
LONG_TEXT = 1 << 20


class LongestMatch:
    """The trie with failure links; nodes are numbers, 0 is the root."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.children: list[dict[int, int]] = [{}]
        entry = [False]
        for token in vocabulary:
            node = 0
            for byte in token:
                after = self.children[node].get(byte)
                if after is None:
                    after = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    entry.append(False)
                node = after
            entry[node] = bool(token) or entry[node]
        # The failure node (None: nothing matches) and the number of entries popped on the way there.
        self.fail: list[int | None] = [None] * len(self.children)
        self.popped = [0] * len(self.children)
        todo = deque([0])
        while todo:
            parent = todo.popleft()
            for byte, node in self.children[parent].items():
                if entry[node]:
                    self.fail[node], self.popped[node] = 0, 1
                else:
                    at, count = self.fail[parent], self.popped[parent]
                    while at is not None and byte not in self.children[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    self.fail[node] = None if at is None else self.children[at][byte]
                    self.popped[node] = count
                todo.append(node)

    def count(self, word: bytes) -> int:
        """Pieces of the word; 1 (the unknown piece) if the entries do not cover it, 0 for an empty one."""
        node, pieces = 0, 0
        for byte in word:
            while byte not in self.children[node]:
                pieces += self.popped[node]
                node = self.fail[node]
                if node is None:
                    return 1
            node = self.children[node][byte]
        while node:
            pieces += self.popped[node]
            node = self.fail[node]
            if node is None:
                return 1
        return pieces


def count_tokens(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` (default doc_id), n_words and n_pieces of every whole text.

    Words are the matches of `pattern`; their UTF-8 bytes are cut greedily by the entries of the rank
    file (read on the driver, sent to the workers, a few MB). A null text has no words, as an empty one.
    One row comes out for each row that goes in, repeated ones included; other columns are not read.
    """
    entries = df.sparkSession.sparkContext.broadcast(sorted(read_ranks(ranks_path)))

    def make():
        def counter():
            automaton = LongestMatch(entries.value)
            return Memo(lambda word: automaton.count(word.encode()), WORDS)

        counts = once(("pieces", ranks_path), counter)
        words = regex.compile(pattern)

        def run(value: str | None) -> tuple[int, int]:
            if not value:
                return 0, 0
            if len(value) <= LONG_TEXT:
                found = words.findall(value)
                return len(found), sum([counts[word] for word in found])
            matches, total, pieces = (m.group() for m in words.finditer(value)), 0, 0
            while part := list(islice(matches, 1 << 16)):
                total, pieces = total + len(part), pieces + sum([counts[word] for word in part])
            return total, pieces

        return run

    fields = [StructField("n_words", LongType()), StructField("n_pieces", LongType())]
    return map_texts(df, text, keep or ["doc_id"], make, fields)
