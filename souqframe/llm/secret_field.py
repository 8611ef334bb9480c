"""A linear-chain conditional random field over the tokens of texts, which tells where secrets are.

A token's features are its shape, the words beside it, the marks around it and what its file looks like.
What a token adds to its own, the next and the last one's scores is a row of a table that is filled for
all tokens that come for the first time together, by array operations on their characters. The tokens of
many texts are scored at once; those that are outside on every best path, whatever the labels around
them, are found by their scores alone, and Viterbi decides the few stretches between them: the same labels
as over each whole text.
"""

import re
from zlib import crc32

import numpy as np

LABELS = 3  # outside, begin, inside
OUT, BEGIN, INSIDE = range(LABELS)
TOKEN = re.compile(r"([A-Za-z0-9+/_=.-]+)")
KEYWORD = re.compile(rb"(?i)pass|pwd|secret|token|key|credential|auth|bearer|login")
LONGEST = 64  # characters of a token that its shape is taken from; its length counts in full
NEAR = 3  # tokens within which a keyword counts
REMEMBERED = 150_000  # tokens, and as many gaps, whose rows are kept

# Blocks of features, and how many there are in each.
LENGTHS = np.array([2, 3, 4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 40, 64])
N_LENGTHS, N_CLASSES, N_SHARES, N_ENTROPY, N_CHANGES = len(LENGTHS) + 1, 16, 9, 12, 9
STARTS = WORDS = 1 << 12
BLOCKS = {
    "classes+length": N_CLASSES * N_LENGTHS,
    "entropy+length": N_ENTROPY * N_LENGTHS,
    "changes+classes": N_CHANGES * N_CLASSES,
    "digits+length": N_SHARES * N_LENGTHS,
    "hex+length": 2 * N_LENGTHS,
    "keyword": 2,
    "start": STARTS,
    "last word": WORDS + N_CLASSES,
    "next word": WORDS + N_CLASSES,
    "before": 130,
    "after": 130,
    "near": 4,
    "file": 3,
}
BASES = dict(zip(BLOCKS, np.concatenate([[0], np.cumsum(list(BLOCKS.values()))[:-1]]).tolist(), strict=True))
FEATURES = sum(BLOCKS.values())
OWN = ["classes+length", "entropy+length", "changes+classes", "digits+length", "hex+length", "keyword", "start"]

_CLASS = np.full(256, 4, np.uint8)  # of a character: lower 1, upper 2, digit 3, other 4; 0 is the end
for _class, _letters in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"), 1):
    _CLASS[list(_letters)] = _class
_CLASS[0] = 0
_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdefABCDEF\0")] = True


def token_features(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: its own features, those of the tokens behind and in front of it, and whether it has a keyword.

    All are taken from the characters as one matrix, a row a token.
    """
    coded = [token.encode() for token in tokens]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    chars = np.array([token[:LONGEST] for token in coded], f"S{LONGEST}").view(np.uint8).reshape(len(coded), LONGEST)
    used = chars > 0
    seen = np.maximum(used.sum(axis=1), 1)
    classes = _CLASS[chars]
    kinds = sum(((classes == one).any(axis=1) << place) for place, one in enumerate((1, 2, 3, 4)))
    digits = (classes == 3).sum(axis=1)
    changes = ((classes[:, 1:] != classes[:, :-1]) & used[:, 1:]).sum(axis=1)
    ordered = np.sort(chars, axis=1)
    # Runs of equal characters: each ends where the next one is another.
    ends = np.concatenate([ordered[:, 1:] != ordered[:, :-1], np.ones((len(coded), 1), bool)], axis=1) & (ordered > 0)
    row, place = np.nonzero(ends)
    first = np.concatenate([[True], row[1:] != row[:-1]])
    before = np.where(first, LONGEST - seen[row] - 1, np.concatenate([[0], place[:-1]]))
    share = (place - before) / seen[row]
    entropy = np.bincount(row, -share * np.log2(share), len(coded)) if len(row) else np.zeros(len(coded))
    by_length = np.searchsorted(LENGTHS, lengths, "right")
    has_hex = _IS_HEX[chars].all(axis=1) & (digits > 0) & ((kinds & 3) != 3)
    keyword = np.fromiter((KEYWORD.search(token) is not None for token in coded), bool, len(coded))
    starts = np.fromiter((crc32(token[:4]) % STARTS for token in coded), np.int64, len(coded))
    word = np.fromiter(
        (crc32(token.lower()) % WORDS if alone else -1 for token, alone in zip(coded, kinds < 4, strict=True)),
        np.int64,
        len(coded),
    )
    own = [
        kinds * N_LENGTHS + by_length,
        np.minimum((2 * entropy).astype(np.int64), N_ENTROPY - 1) * N_LENGTHS + by_length,
        8 * changes // seen * N_CLASSES + kinds,
        8 * digits // seen * N_LENGTHS + by_length,
        has_hex * N_LENGTHS + by_length,
        keyword.astype(np.int64),
        starts,
    ]
    beside = np.where(word >= 0, word, WORDS + kinds)
    whole = np.stack([part + BASES[name] for part, name in zip(own, OWN, strict=True)], axis=1)
    return whole, np.stack([beside + BASES["last word"], beside + BASES["next word"]], axis=1), keyword


def _mark(mark: str) -> int:
    return 0 if not mark else min(ord(mark), 128) + 1


def gap_features(gap: str) -> tuple[int, int, bool]:
    """Of what is between two tokens: the feature of the next one, that of the last one, and whether it assigns."""
    bare = gap.strip(" \t")
    return BASES["before"] + _mark(bare[-1:]), BASES["after"] + _mark(bare[:1]), ":" in gap or "=" in gap


class Texts:
    """The tokens of some texts, one text behind the other, what is around them, and where they are in their text."""

    def __init__(self, texts: list[str]):
        self.tokens, self.gaps, counts, files = [], [], [], []
        for text in texts:
            parts = TOKEN.split(text)
            self.tokens += parts[1::2]
            self.gaps += parts[0::2]
            counts.append(len(parts) // 2)
            files.append(text.count("=") * 40 > text.count(" ") + 40)
        self.counts, self.files = np.array(counts, np.int64), np.array(files, np.int64)
        self.firsts = self.counts.cumsum() - self.counts
        self.text = np.repeat(np.arange(len(texts)), self.counts)
        # Gaps of a text are one more than its tokens: the one in front of each token.
        self.front = np.arange(len(self.tokens)) + self.text
        sizes = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        around = np.fromiter(map(len, self.gaps), np.int64, len(self.gaps))
        total = np.concatenate([[0], sizes.cumsum()[:-1]]) + around.cumsum()[self.front] if len(sizes) else sizes
        if len(sizes):
            before = np.where(self.firsts > 0, sizes.cumsum()[self.firsts - 1], 0)
            before = before + np.where(self.firsts + np.arange(len(texts)) > 0, around.cumsum()[self.firsts + np.arange(len(texts)) - 1], 0)
            total = total - before[self.text]
        self.starts, self.ends = total, total + sizes

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """The places of the tokens before and after each one in its text; -1 where there is none."""
        place = np.arange(len(self.tokens))
        last, next_ = place - 1, place + 1
        some = self.counts > 0
        last[self.firsts[some]] = -1
        next_[self.firsts[some] + self.counts[some] - 1] = -1
        return last, next_

    def near(self, keyword: np.ndarray, assigns: np.ndarray) -> np.ndarray:
        """The feature of each token for a keyword among the NEAR tokens before it, and for a mark that assigns."""
        place = np.arange(len(self.tokens))
        last = np.maximum.accumulate(np.where(keyword, place, -1)) if len(place) else place
        before = np.concatenate([[-1], last[:-1]]) if len(place) else place
        close = (before >= self.firsts[self.text]) & (place - before <= NEAR)
        return BASES["near"] + 2 * close + assigns[self.front]


def features_of(texts: Texts) -> np.ndarray:
    """All features of each token, a row each: for training."""
    own, beside, keyword = token_features(texts.tokens) if texts.tokens else (np.empty((0, len(OWN)), int), None, None)
    if not texts.tokens:
        return np.empty((0, len(OWN) + 6), np.int64)
    last, next_ = texts.neighbours()
    gaps = np.array([gap_features(gap) for gap in texts.gaps])
    none = token_features([""])[1][0]
    return np.column_stack(
        [
            own,
            np.where(last < 0, none[0], beside[last, 0]),
            np.where(next_ < 0, none[1], beside[next_, 1]),
            gaps[texts.front, 0],
            gaps[texts.front + 1, 1],
            texts.near(keyword, gaps[:, 2]),
            BASES["file"] + texts.files[texts.text],
        ]
    )


class Rows:
    """Rows of a table by key. Those that are missing are made together; all are forgotten when there are too many."""

    def __init__(self, make, width: int):
        self.make, self.places, self.table = make, {}, np.empty((1 << 12, width))

    def of(self, keys: list[str]) -> np.ndarray:
        """The keys' rows of the table as it is now."""
        if len(self.places) > REMEMBERED:
            self.places = {}
        missing = list(set(keys).difference(self.places))
        if missing:
            size = len(self.places) + len(missing)
            if size > len(self.table):
                self.table = np.concatenate([self.table, np.empty((max(size, len(self.table)), self.table.shape[1]))])
            self.table[len(self.places) : size] = self.make(missing)
            self.places.update(zip(missing, range(len(self.places), size), strict=True))
        return np.fromiter(map(self.places.__getitem__, keys), np.int64, len(keys))


class ChainField:
    """Weights of features and of label pairs; forward-backward to train, Viterbi to decode."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs
        # An inside needs a begin or an inside before it.
        self.allowed = np.zeros((LABELS, LABELS))
        self.allowed[OUT, INSIDE] = -1e9
        self.first = np.array([0.0, 0.0, -1e9])
        self.tokens, self.gaps = Rows(self._of_tokens, 3 * LABELS + 1), Rows(self._of_gaps, 2 * LABELS + 1)

    def _of_tokens(self, tokens: list[str]) -> np.ndarray:
        """What each token adds to itself, to the next one, to the last one; whether it has a keyword."""
        own, beside, keyword = token_features(tokens)
        weights = self.weights
        return np.column_stack([weights[own].sum(axis=1), weights[beside[:, 0]], weights[beside[:, 1]], keyword])

    def _of_gaps(self, gaps: list[str]) -> np.ndarray:
        """What each gap adds to the next token and to the last one; whether it assigns."""
        before, after, assigns = np.array([gap_features(gap) for gap in gaps]).T
        return np.column_stack([self.weights[before], self.weights[after], assigns])

    def scores_of(self, texts: Texts) -> np.ndarray:
        """The scores of every token of the texts."""
        rows = self.tokens.of(["", *texts.tokens])
        of_token, none = self.tokens.table[rows[1:]], self.tokens.table[rows[0]]
        gaps = self.gaps.of(texts.gaps)
        of_gap = self.gaps.table[gaps]
        last, next_ = texts.neighbours()
        near = texts.near(of_token[:, 9] > 0, of_gap[:, 6].astype(np.int64))
        scores = of_token[:, :3] + of_gap[texts.front, :3] + of_gap[texts.front + 1, 3:6] + self.weights[near]
        scores += np.where((last < 0)[:, None], none[3:6], of_token[last, 3:6])
        scores += np.where((next_ < 0)[:, None], none[6:9], of_token[next_, 6:9])
        return scores + self.weights[BASES["file"] + texts.files[texts.text]]

    def _outside(self, scores: np.ndarray) -> np.ndarray:
        """Whether each token is outside on every best path.

        A begin and its insides are on a best path only if they gain something over as many outside
        tokens, whatever the labels around them. The most that any such stretch over a token can gain is
        that of the best start up to it and the best end from it on; stretches across texts only add to it.
        """
        moves = self.pairs + self.allowed
        begin = scores[:, BEGIN] - scores[:, OUT] + max(0, (moves[:, BEGIN] - moves[:, OUT]).max())
        inside = scores[:, INSIDE] - scores[:, OUT] + moves[BEGIN:, INSIDE].max() - moves[OUT, OUT]
        leave = max(0, (moves[BEGIN:, :INSIDE] - moves[OUT, :INSIDE]).max())
        total = inside.cumsum()
        most = np.maximum.accumulate(total[::-1])[::-1] + np.maximum.accumulate(begin - total)
        return most + leave < -1e-6

    def label(self, texts: Texts) -> list[tuple[int, int]]:
        """(token, label) of the tokens that are not outside on the best path over all tokens of their text."""
        if not texts.tokens or not (self.weights.any() or self.pairs.any()):
            return []
        scores, found = self.scores_of(texts), []
        open_ = np.flatnonzero(~self._outside(scores))
        if not len(open_):
            return []
        breaks = np.flatnonzero((np.diff(open_) > 1) | (np.diff(texts.text[open_]) > 0)) + 1
        for first, last in zip(open_[[0, *breaks]].tolist(), open_[[*(breaks - 1), -1]].tolist(), strict=True):
            text = texts.text[first]
            begins = first == texts.firsts[text]
            ends = last + 1 == texts.firsts[text] + texts.counts[text]
            path = self._best(scores[first : last + 1], begins, ends)
            found += [(first + i, label) for i, label in enumerate(path) if label != OUT]
        return found

    def _best(self, scores: np.ndarray, begins: bool, ends: bool) -> list[int]:
        """The best path over a stretch that begins and ends the text, or else has outside tokens around it."""
        moves = self.pairs + self.allowed
        into = moves.T.tolist()
        rows = scores.tolist()
        best, back = [a + b for a, b in zip(rows[0], self.first if begins else moves[OUT], strict=True)], []
        for row in rows[1:]:
            ways = [[a + b for a, b in zip(best, to, strict=True)] for to in into]
            most = [max(way) for way in ways]
            back.append([way.index(top) for way, top in zip(ways, most, strict=True)])
            best = [a + b for a, b in zip(most, row, strict=True)]
        if not ends:
            best = [a + b for a, b in zip(best, into[OUT], strict=True)]
        labels = [best.index(max(best))]
        for pointers in reversed(back):
            labels.append(pointers[labels[-1]])
        return labels[::-1]

    def decode(self, features: np.ndarray) -> list[int]:
        """The labels of the best path over the tokens of one text; of equal ones, that with the smaller labels."""
        return self._best(self.weights[features].sum(axis=1), True, True)


def expected(field: ChainField, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The share of each label of each token, and of each pair of labels summed, by forward and backward sums.

    Sequences stand one behind the other, longest first, and are worked through step by step, all at once.
    """
    moves = np.exp(field.pairs + field.allowed)
    starts = lengths.cumsum() - lengths
    seen = np.exp(scores - scores.max(axis=1, keepdims=True))
    forward, backward, scales = np.empty_like(seen), np.ones_like(seen), np.empty(len(seen))
    for step in range(int(lengths.max(initial=0))):
        here = starts[: int((lengths > step).sum())] + step
        if step == 0:
            state = seen[here] * np.exp(field.first)
        else:
            state = (forward[here - 1] @ moves) * seen[here]
        scales[here] = state.sum(axis=1)
        forward[here] = state / scales[here][:, None]
    pairs = np.zeros((LABELS, LABELS))
    for step in range(int(lengths.max(initial=0)) - 1, 0, -1):
        here = starts[: int((lengths > step).sum())] + step
        onward = seen[here] * backward[here] / scales[here][:, None]
        backward[here - 1] = onward @ moves.T
        pairs += moves * (forward[here - 1].T @ onward)
    return forward * backward, pairs


def train(
    features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, rounds: int = 80, rate: float = 0.15, decay: float = 2e-6
) -> ChainField:
    """The field that makes labelled sequences likely: steps on the whole likelihood, scaled feature by feature.

    Sequences stand one behind the other. Weights are drawn to 0 a little.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = lengths.cumsum() - lengths
    rows = np.concatenate([np.arange(starts[i], starts[i] + lengths[i]) for i in order]) if len(order) else order
    features, labels, lengths = features[rows], labels[rows], lengths[order]
    field = ChainField(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)))
    if not len(labels):
        return field
    truth = np.eye(LABELS)[labels]
    inner = np.ones(len(labels), bool)
    inner[lengths.cumsum() - lengths] = False
    later = np.flatnonzero(inner)
    seen_pairs = np.zeros((LABELS, LABELS))
    np.add.at(seen_pairs, (labels[later - 1], labels[later]), 1)
    flat, width = features.ravel(), features.shape[1]
    held = [np.zeros_like(field.weights), np.zeros_like(field.weights)]
    held_pairs = [np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))]
    for turn in range(1, rounds + 1):
        shares, pairs = expected(field, field.weights[features].sum(axis=1), lengths)
        error = truth - shares
        step = np.stack([np.bincount(flat, np.repeat(error[:, k], width), FEATURES) for k in range(LABELS)], axis=1)
        step = step / len(labels) - decay * field.weights
        for value, slope, (mean, square) in (
            (field.weights, step, held),
            (field.pairs, (seen_pairs - pairs) / len(labels), held_pairs),
        ):
            mean += 0.1 * (slope - mean)
            square += 0.02 * (slope**2 - square)
            value += rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.98**turn)) + 1e-8)
    return field
