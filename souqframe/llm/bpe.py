"""Byte-level BPE as a transducer that is made deterministic state by state, and streaming decoding.

A token sequence is the BPE of its bytes exactly if BPE leaves each two neighbours as they are. So
the BPE of every prefix of a piece is known from that of shorter prefixes: its last token is the one
that fits behind the BPE of what stands before it. A state of the transducer is the longest end of the
bytes read so far that can still become an entry; a byte leads to the next state and tells the entries
that end with it. A transition is made when a text needs it for the first time, and so is the answer
to whether two tokens fit. Continuations can only start a token within the open bytes, which are fewer
than the longest entry has; tokens on which all of them agree are given out.

Decoding feeds the bytes of each id to a UTF-8 machine; its state is the bytes of a character that
is not complete yet. What an id does in a state is worked out once and kept.
"""

import base64
import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from souqframe.llm.rows import Memo, map_texts, once

PIECES = 300_000  # pieces of text a worker remembers
SHORT = 100  # characters of the longest piece that is remembered
STATES = 400_000  # transitions and answers a worker keeps before it starts anew
HELD = 256  # bytes of a piece that are held before tokens are given out
LONG_TEXT = 1 << 20  # longer texts are cut into pieces bit by bit

NO_TOKEN = b""
_BEGINNING, _ENTRY = 1, 2
_BYTES = [bytes((byte,)) for byte in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _State(dict):
    """Bytes that can become an entry. For each next byte the next state, and the entries that end, longest first."""

    __slots__ = ("open", "make")

    def __init__(self, open_: bytes, make: Callable):
        self.open, self.make = open_, make

    def __missing__(self, byte: int) -> tuple["_State", tuple["_Entry", ...]]:
        step = self[byte] = self.make(self.open + _BYTES[byte])
        return step


class _Before(dict):
    """For each token, whether an entry fits behind it. Nothing before it is fine."""

    __slots__ = ("token", "fit")

    def __init__(self, token: bytes, fit: Callable):
        self.token, self.fit = token, fit

    def __missing__(self, before: bytes) -> bool:
        answer = self[before] = not before or self.fit(before, self.token)
        return answer


_Entry = tuple[bytes, int, _Before]  # the token, its length, what it fits behind


class Transducer:
    """Bytes of a piece in, ids out (as little-endian unsigned 32-bit integers)."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks, self.limit = ranks, states
        self.none = max(ranks.values(), default=0) + 1
        self.ids = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.kinds = {token[:n]: _BEGINNING for token in ranks for n in range(1, len(token))}
        for token in ranks:  # an entry to which no merges lead is only ever a whole piece
            if self.merged(token) == [token]:
                self.kinds[token] = self.kinds.get(token, 0) | _ENTRY
        self.edges = Memo(self._edges, 2 * len(ranks))
        self.made = 0
        self.states: dict[bytes, _State] = {}
        self._restart()

    def _restart(self) -> None:
        for state in self.states.values():  # they refer to each other
            state.clear()
        self.made = 0
        self.states = {}
        self.entries: dict[bytes, _Entry] = {}
        self.start = self.states[NO_TOKEN] = _State(NO_TOKEN, self._step)

    def merged(self, text: bytes) -> list[bytes]:
        """The merges one by one, lowest rank first. Only for the few bytes that states are made from."""
        parts, ranks, none = [text[i : i + 1] for i in range(len(text))], self.ranks, self.none
        merges = [ranks.get(text[i : i + 2], none) for i in range(len(text) - 1)]
        while merges and (best := min(merges)) < none:
            at = merges.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del merges[at]
            if at < len(merges):
                merges[at] = ranks.get(parts[at] + parts[at + 1], none)
            if at:
                merges[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        return parts

    def _edges(self, token: bytes) -> tuple[list, list, bool]:
        """What stands at the left and at the right edge of a token while its bytes are merged.

        Each part comes with the rank of the merge that ends it. Last, whether the ranks only rise.
        """
        ranks, parts = self.ranks, [token[i : i + 1] for i in range(len(token))]
        left, right, rising, before = [], [], True, -1
        while len(parts) > 1:
            best, at = min((ranks.get(parts[i] + parts[i + 1], self.none), i) for i in range(len(parts) - 1))
            rising, before = rising and best >= before, best
            if at == 0:
                left.append((parts[0], best))
            if at == len(parts) - 2:
                right.append((parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [*left, (token, self.none)], [*right, (token, self.none)], rising

    def _fit(self, before: bytes, token: bytes) -> bool:
        """Whether BPE leaves two tokens as they are: no merge across comes before the merges at their edges."""
        self.made += 1
        (_, right, rising), (left, _, rises) = self.edges[before], self.edges[token]
        if not (rising and rises):
            return self.merged(before + token) == [before, token]
        i = j = 0
        while True:
            (a, end_a), (b, end_b) = right[i], left[j]
            across = self.ranks.get(a + b, self.none)
            if across < end_a and across <= end_b and across < self.none:
                return False
            if end_a == end_b == self.none:
                return True
            if end_a <= end_b:
                i += 1
            else:
                j += 1

    def _step(self, text: bytes) -> tuple[_State, tuple[_Entry, ...]]:
        """The state behind the open bytes and one more: their longest end that can go on; and the entries that end."""
        self.made += 1
        going, ending = NO_TOKEN, []
        for start in range(len(text)):
            token = text[start:]
            kind = self.kinds.get(token, 0)
            if kind & _ENTRY:
                if token not in self.entries:
                    self.entries[token] = token, len(token), _Before(token, self._fit)
                ending.append(self.entries[token])
            if not going and kind & _BEGINNING:
                going = token
        if going not in self.states:
            self.states[going] = _State(going, self._step)
        return self.states[going], tuple(ending)

    def _given(self, tokens: list[bytes], place: int) -> list[bytes]:
        """The ids up to a place, found from behind."""
        ids, out = self.ids, []
        while place:
            out.append(ids[tokens[place]])
            place -= len(tokens[place])
        return out[::-1]

    @staticmethod
    def _agreed(tokens: list[bytes], open_: int) -> int:
        """The last place that the ways to all of the last `open_` places and to the end go through."""
        places = set(range(len(tokens) - 1 - open_, len(tokens)))
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            places.add(last - len(tokens[last]))
        return places.pop()

    def encode(self, piece: bytes) -> bytes:
        """The ids of a piece. One that is an entry itself is that entry, even if no merges lead there."""
        if (whole := self.ids.get(piece)) is not None:
            return whole
        if self.made > self.limit:
            self._restart()
        # The last token of the BPE up to each place, from the last one given out on.
        state, tokens, out, most = self.start, [NO_TOKEN], [], HELD
        for byte in piece:
            state, entries = state[byte]
            place = len(tokens)
            for token, length, fits in entries:
                if fits[tokens[place - length]]:
                    tokens.append(token)
                    break
            else:
                raise ValueError(f"byte {byte} is not in the vocabulary")
            if place >= most:
                agreed = self._agreed(tokens, len(state.open))
                out += self._given(tokens, agreed)
                del tokens[:agreed]
                most = HELD + 2 * len(tokens)
        out += self._given(tokens, len(tokens) - 1)
        return b"".join(out)


def utf8_step(open_: bytes, byte: int) -> tuple[str, bytes]:
    """The UTF-8 machine: bytes of an incomplete character and the next byte give text and what is open then.

    A byte that cannot go on closes what is open as one U+FFFD, as Python's "replace" does.
    """
    if not open_:
        if byte < 0x80:
            return chr(byte), b""
        if 0xC2 <= byte <= 0xF4:
            return "", bytes((byte,))
        return "�", b""
    first = open_[0]
    low, high = 0x80, 0xBF
    if len(open_) == 1:
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(first, low)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(first, high)
    if not low <= byte <= high:
        text, rest = utf8_step(b"", byte)
        return "�" + text, rest
    seen = open_ + bytes((byte,))
    length = 2 if first < 0xE0 else 3 if first < 0xF0 else 4
    return (seen.decode(), b"") if len(seen) == length else ("", seen)


class Decoder:
    """Ids in, text out as soon as it is certain."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.states: dict[bytes, dict] = {b"": {}}
        # By id: the text of one that leads from no open bytes to no open bytes, and which ids are like that.
        size = max(ranks.values(), default=-1) + 1
        self.texts = np.full(size, None, object)
        self.seen, self.parts = np.zeros(size, bool), np.zeros(size, bool)

    def _learn(self, open_: bytes, number: int) -> tuple[str, bytes]:
        given, state = [], open_
        for byte in self.tokens[number]:
            text, state = utf8_step(state, byte)
            given.append(text)
        self.states.setdefault(state, {})
        self.states[open_][number] = "".join(given), state
        return self.states[open_][number]

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of one id after the other, as far as it is certain."""
        state = b""
        for number in ids:
            text, state = self.states[state].get(number) or self._learn(state, number)
            yield text
        if state:
            yield "�"

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The same for all ids of a text.

        Ids that are complete characters are looked up together; the machine runs where one is not.
        """
        ids = np.asarray(ids, np.uint32)
        if not self.seen[ids].all():
            for number in np.unique(ids[~self.seen[ids]]).tolist():
                text, after = self._learn(b"", number)
                self.texts[number], self.parts[number], self.seen[number] = text, bool(after), True
        texts, state, done = self.texts[ids].tolist(), b"", 0
        for place in np.flatnonzero(self.parts[ids]).tolist():
            if place < done:
                continue
            done = place
            while done == place or (state and done < len(ids)):
                number = int(ids[done])
                texts[done], state = self.states[state].get(number) or self._learn(state, number)
                done += 1
        return "".join(texts) + ("�" if state else "")


class _Pieces(Memo):
    """Remembers the ids of pieces; long ones, which could fill the memory, are worked out each time."""

    def __missing__(self, piece: str) -> bytes:
        return super().__missing__(piece) if len(piece) <= SHORT else self.function(piece)


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer, self.decoder = Transducer(ranks), Decoder(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces = _Pieces(lambda piece: self.transducer.encode(piece.encode()), PIECES)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = self.pieces
        if len(text) <= LONG_TEXT:
            return b"".join([pieces[piece] for piece in self.pattern.findall(text)])
        found = (match.group() for match in self.pattern.finditer(text))
        out = bytearray()
        while part := list(islice(found, 1 << 16)):
            out += b"".join([pieces[piece] for piece in part])
        return bytes(out)

    def decode(self, ids: bytes) -> str:
        return self.decoder.decode(np.frombuffer(ids, "<u4"))


DIGESTS = [
    StructField("n_tokens", LongType()),
    StructField("ids_sha256", StringType()),
    StructField("decoded_sha256", StringType()),
]
IDS = StructField("ids", ArrayType(IntegerType()))


def encode_texts(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    keep: list[str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Every whole text to ids and back: the columns `keep`, n_tokens, ids_sha256, decoded_sha256, and ids if asked.

    `ranks_path` is read on the driver and sent to the workers; a vocabulary is a few MB. A null text
    counts as an empty one: no tokens, digests of no bytes. Repeated rows come back as often. Of `keep`
    (default doc_id), columns named like a result are left out; other columns are not read. One row
    comes out for each row that goes in, so an empty table gives none.
    """
    spark = df.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        # The memory holds very many small objects that stay: looking through them for cycles takes half the time.
        gc.set_threshold(1_000_000, 20, 20)
        codec = once(("bpe", ranks_path, pattern), lambda: Codec(ranks.value, pattern))

        def run(value: str | None) -> tuple:
            ids = codec.encode(value or "")
            decoded = codec.decode(ids).encode()
            digests = len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()
            return (*digests, np.frombuffer(ids, "<u4").astype(np.int32)) if with_ids else digests

        return run

    return map_texts(df, text, keep or ["doc_id"], make, [*DIGESTS, IDS] if with_ids else DIGESTS)
