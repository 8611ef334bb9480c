"""Two tokenizers aligned on the same bytes, and which of their ids belong together in the whole corpus.

Texts are shuffled by their full text, so that each distinct one is tokenised and aligned once and its
pairs of ids count as often as it has copies. At a single blank between two other characters both
tokenizers start a token, whatever stands around it: the pre-tokenizer of the byte-level one does, and no
piece of the other one has a blank behind anything else. So a text is put together from the parts between
such blanks. Parts that are not remembered are aligned many at once: between two neighbouring places where
a token of either tokenizer ends lie bytes of one token of each, so the places are the links.

Texts are written down in chunks that number their parts and pairs of ids. Counts of pairs then move as a row for
each chunk and pair, and so do the answers: how often a pair is linked, and whether it is its id's best.
"""

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from souqframe.llm.chunks import ChunkNumbers, Numbering, answers, compact, gather, numbers_in, one_list, with_totals
from souqframe.llm.rows import once

CHUNK = 1 << 19  # parts of texts in a chunk, about; a text is never split
PARTS = 120_000  # that a worker remembers, to twice as many
SHORT = 64  # characters of the longest part that is remembered
TOGETHER = 4096  # new parts of a chunk that are aligned at once, about
CHARS = 1 << 17  # of texts whose new parts wait for that, about
FEWER = 128  # of those, where a part among them does not go with the others
ROWS = 1 << 15  # rows of results at once

# Characters that all engines of regular expressions put into the same classes.
ODD = re.compile(r"[^\t\n\r\x20-\x7e\u00a1-\u024f\u2010-\u2027\u2030-\u205e]")
BETWEEN = re.compile(r" (?<=\S )(?=\S)")
MEASURES = ["n_a", "n_b", "n_groups", "n_links"]


def byte_letters() -> dict[str, int]:
    """What stands for each byte in the entries of a byte-level vocabulary: itself if it can be seen, else from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in seen]
    return {chr(byte): byte for byte in seen} | {chr(256 + place): byte for place, byte in enumerate(rest)}


class Tokens:
    """What the ids of a vocabulary are: their bytes, how many those are, and their numbers as text."""

    def __init__(self, entries: dict[int, bytes]):
        size = max(entries) + 1
        self.bytes = [entries.get(number, b"") for number in range(size)]
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, size)
        self.inner, self.last = (
            np.array([f"{number}{behind}" for number in range(size)], object) for behind in (",", self.LAST)
        )


class ByteTokens(Tokens):
    """The byte-level tokenizer: ids of texts, a blank put before each.

    Where the ids of its entries are in the order of their merges, they are ranks, and a text of usual
    characters is encoded by those; others go through the tokenizer itself, which is slower.
    """

    LAST = "|"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        special = {number for number, token in self.tokenizer.get_added_tokens_decoder().items() if token.special}
        entries = {
            number: entry.encode() if number in special else bytes(letters[letter] for letter in entry)
            for entry, number in self.tokenizer.get_vocab(with_added_tokens=True).items()
        }
        super().__init__(entries)
        self.by_rank = self._by_rank(path, {entry: n for n, entry in entries.items() if n not in special})

    def _by_rank(self, path: str, ranks: dict[bytes, int]):
        """The same vocabulary by ranks, if that is the same, else None."""
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in held["model"]["merges"]]
        made = [held["model"]["vocab"]["".join(merge)] for merge in merges]
        before = held.get("pre_tokenizer") or {}
        usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if not usual or held.get("normalizer") or made != sorted(made) or len(ranks) != 256 + len(made):
            return None
        return tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> list[int]:
        if self.by_rank is not None and not ODD.search(text):
            return self.by_rank.encode_ordinary(f" {text}")
        return self.tokenizer.encode_batch_fast([f" {text}"], add_special_tokens=False)[0].ids


class PieceTokens(Tokens):
    """The tokenizer of pieces, which puts a blank before a text itself."""

    LAST = ";"

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = {}
        for number in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(number)
            is_byte = self.processor.is_byte(number)
            entries[number] = bytes((int(piece[1:-1], 16),)) if is_byte else piece.replace("▁", " ").encode()
        super().__init__(entries)

    def encode(self, text: str) -> list[int]:
        return self.processor.encode([text], num_threads=1)[0]


# An alignment, in one piece as very many are remembered: four numbers of 32 bits (tokens of a and of b,
# groups, links), 64 bits for each link (first id, second id), and the groups as text.
Part = bytes
HEAD = 16


class Aligner:
    """Aligns parts of texts, many at once. Short ones are remembered until there are too many."""

    def __init__(self, a: ByteTokens, b: PieceTokens):
        self.a, self.b, self.known, self.older = a, b, {}, {}

    def of(self, parts: list[str]) -> list[Part | None]:
        """The alignment of each part, or None where the tokens of either are not its bytes behind a blank."""
        known, older = self.known, self.older
        found, missing = list(map(known.get, parts)), []
        for place, whole in enumerate(found):
            if whole is None:
                part = parts[place]
                if (whole := older.get(part)) is None:
                    missing.append(place)
                else:
                    found[place] = known[part] = whole
        for place, whole in zip(missing, self.align([parts[place] for place in missing]), strict=True):
            found[place] = whole
            if whole and len(parts[place]) <= SHORT:
                known[parts[place]] = whole
        if len(known) > PARTS:
            self.known, self.older = {}, known
        return found

    def align(self, parts: list[str]) -> list[Part | None]:
        """All parts at once, put together to a text again; fewer, and then one by one, where that cannot be.

        Parts with unusual characters go together apart from the others, whose tokenizer is faster.
        """
        if len(parts) < 2:
            return [self._alone(part) for part in parts]
        plain = [part for part in parts if part and part.strip() == part]
        odd = [part for part in plain if ODD.search(part)] if ODD.search(" ".join(plain)) else []
        if not odd and len(plain) == len(parts):
            return self._parted(parts)
        apart = set(odd)
        usual = [part for part in plain if part not in apart]
        together = {}
        for own in (usual, odd):
            together |= zip(own, self._parted(own), strict=True)
        return [together[part] if part in together else self._alone(part) for part in parts]

    def _parted(self, parts: list[str]) -> list[Part | None]:
        if not parts or (found := self._together(parts)) is not None:
            return found if parts else []
        if len(parts) <= FEWER:
            return [self._alone(part) for part in parts]
        return [whole for at in range(0, len(parts), FEWER) for whole in self._parted(parts[at : at + FEWER])]

    def _alone(self, part: str) -> Part | None:
        found = self._together([part])
        return None if found is None else found[0]

    def _together(self, parts: list[str]) -> list[Part] | None:
        """The alignments, or None if tokens are not the parts' bytes or do not end where parts do."""
        text = " ".join(parts)
        tokens = self.a.encode(text), self.b.encode(text)
        whole = f" {text}".encode()
        if any(b"".join([of.bytes[n] for n in ids]) != whole for ids, of in zip(tokens, (self.a, self.b), strict=True)):
            return None
        ids_a, ids_b = (np.array(ids, np.int64) for ids in tokens)
        ends = (np.fromiter((len(part.encode()) for part in parts), np.int64, len(parts)) + 1).cumsum()
        ends_a, ends_b = self.a.lengths[ids_a].cumsum(), self.b.lengths[ids_b].cumsum()
        upto_a, upto_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        if (ends_a[upto_a] != ends).any() or (ends_b[upto_b] != ends).any():
            return None
        return self._aligned(ids_a, ids_b, ends_a, ends_b, np.diff(upto_a, prepend=-1), np.diff(upto_b, prepend=-1))

    def _aligned(self, ids_a, ids_b, ends_a, ends_b, n_a, n_b) -> list[Part]:
        """From the ids of all parts and where they end, and how many tokens each part has."""
        a, b = self.a, self.b
        in_b = np.searchsorted(ends_b, ends_a)  # the token of b that holds the last byte of each of a
        cut_a = ends_b[in_b] == ends_a
        in_a = np.searchsorted(ends_a, ends_b)
        cut_b = ends_a[in_a] == ends_b
        part_a, part_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        # Each end is a link; one that both have counts once.
        links = np.concatenate([ids_a << 32 | ids_b[in_b], ids_a[in_a[~cut_b]] << 32 | ids_b[~cut_b]])
        of_part = np.concatenate([part_a, part_b[~cut_b]])
        links = links[np.argsort(of_part, kind="stable")].tobytes()
        n_links = np.bincount(of_part, minlength=len(n_a))
        groups = np.bincount(part_a[cut_a], minlength=len(n_a))
        heads = np.stack([n_a, n_b, groups, n_links], axis=1).astype("<u4").tobytes()
        groups_a, groups_b = cut_a.cumsum() - cut_a, cut_b.cumsum() - cut_b
        order = np.argsort(np.concatenate([2 * groups_a, 2 * groups_b + 1]), kind="stable")
        names = np.concatenate(
            [np.where(cut_a, a.last[ids_a], a.inner[ids_a]), np.where(cut_b, b.last[ids_b], b.inner[ids_b])]
        )[order].tolist()
        name_ends = (n_a + n_b).cumsum().tolist()
        made, link, name = [], 0, 0
        for place, (link_end, name_end) in enumerate(zip((8 * n_links.cumsum()).tolist(), name_ends, strict=True)):
            text = "".join(names[name:name_end])[:-1].encode()
            made.append(heads[HEAD * place : HEAD * (place + 1)] + links[link:link_end] + text)
            link, name = link_end, name_end
        return made


class _Texts:
    """Distinct texts of a chunk: the numbers of their parts, and what can be said of them at once."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.numbers = aligner, Numbering()
        self.parts: list[Part | None] = []
        self.texts, self.copies, self.digests = [], [], []
        self.waiting = 0

    def add(self, text: str, copies: int) -> int:
        ids = self.numbers.of(BETWEEN.split(text))
        self.texts.append(ids)
        self.copies.append(copies)
        self.waiting += len(text)
        if len(self.numbers) - len(self.parts) >= TOGETHER or self.waiting >= CHARS:
            self._align_new()
        return len(ids) + 1

    def _align_new(self) -> None:
        new = list(islice(reversed(self.numbers), len(self.numbers) - len(self.parts)))
        self.parts += self.aligner.of(new[::-1])
        self.waiting = 0

    def _digest(self) -> None:
        """Texts with a part that has no alignment have no tokens."""
        groups = [part and part[HEAD + 8 * int.from_bytes(part[12:HEAD], "little") :] for part in self.parts]
        for place, ids in enumerate(self.texts):
            own = [groups[number] for number in ids.tolist()]
            if None in own:
                self.texts[place] = ids[:0]
                self.digests.append("")
            else:
                self.digests.append(hashlib.sha256(b";".join(own)).hexdigest())

    def row(self) -> dict:
        self._align_new()
        self._digest()
        lengths, ids = np.fromiter(map(len, self.texts), np.int64, len(self.texts)), np.concatenate(self.texts)
        text = np.repeat(np.arange(len(lengths)), lengths)
        used = np.bincount(ids, np.array(self.copies, float)[text], len(self.parts)).astype(np.int64)
        nothing = bytes(HEAD)
        parts = [part if part and count else nothing for part, count in zip(self.parts, used.tolist(), strict=True)]
        heads = np.frombuffer(b"".join([part[:HEAD] for part in parts]), "<u4").reshape(-1, 4).astype(np.int64)
        measures, sizes = dict(zip(MEASURES, heads.T, strict=True)), heads[:, 3]
        links = [part[HEAD : HEAD + 8 * size] for part, size in zip(parts, sizes.tolist(), strict=True)]
        pairs, place = np.unique(np.frombuffer(b"".join(links), np.int64), return_inverse=True)
        weights = np.zeros(len(pairs), np.int64)
        np.add.at(weights, place, np.repeat(used, sizes))
        return {
            **{name: np.bincount(text, of[ids], len(lengths)).astype(np.int64) for name, of in measures.items()},
            "groups_sha256": self.digests,
            "lengths": lengths.astype(np.int32),
            "ids": compact(ids),
            "sizes": compact(sizes),
            "links": compact(place),
            "a": (pairs >> 32).astype(np.int32),
            "b": (pairs & 0xFFFFFFFF).astype(np.int32),
            "weights": weights,
        }


def _chunked(distinct: DataFrame, path_a: str, path_b: str) -> DataFrame:
    inner = distinct.select(F.sha2("text", 256).alias("digest"), "text", "copies")
    schema = StructType(
        [
            StructField("chunk", LongType()),
            StructField("digests", ArrayType(StringType())),
            StructField("lengths", ArrayType(IntegerType())),
            StructField("ids", BinaryType()),
            StructField("sizes", BinaryType()),
            *[StructField(name, ArrayType(LongType())) for name in MEASURES],
            StructField("groups_sha256", ArrayType(StringType())),
            StructField("links", BinaryType()),
            StructField("a", ArrayType(IntegerType())),
            StructField("b", ArrayType(IntegerType())),
            StructField("weights", ArrayType(LongType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = once(("align", path_a, path_b), lambda: Aligner(ByteTokens(path_a), PieceTokens(path_b)))
        number = ChunkNumbers()
        for collector, digests in gather(batches, CHUNK, lambda: _Texts(aligner)):
            row = {"chunk": number(), **collector.row()}
            columns = [
                one_list(digests, field.type) if field.name == "digests" else pa.array([row[field.name]], field.type)
                for field in arrow
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return inner.mapInArrow(run, schema)


RESULTS = [StructField(name, LongType()) for name in [*MEASURES, "n_best", "count_sum"]]


def _measured(chunks: DataFrame) -> DataFrame:
    """A row for each distinct text, from its chunk and the answers on the chunk's pairs."""
    schema = StructType([StructField("digest", StringType()), *RESULTS, StructField("groups_sha256", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(len(batch)):
                row = {name: batch.column(name)[place] for name in batch.schema.names}
                ids, sizes, links = (numbers_in(row[name]) for name in ("ids", "sizes", "links"))
                lengths = row["lengths"].values.to_numpy()
                text, part = np.repeat(np.arange(len(lengths)), lengths), np.repeat(np.arange(len(sizes)), sizes)
                sums = []
                for name in ("best", "count"):
                    of_pair = np.zeros(int(links.max(initial=0)) + 1, np.int64)
                    if row["places"].is_valid:
                        of_pair[row["places"].values.to_numpy()] = row[name].values.to_numpy(zero_copy_only=False)
                    of_part, of_text = np.zeros(len(sizes), np.int64), np.zeros(len(lengths), np.int64)
                    np.add.at(of_part, part, of_pair[links])
                    np.add.at(of_text, text, of_part[ids])
                    sums.append(of_text)
                measures = [row[name].values for name in MEASURES]
                columns = [row["digests"].values, *measures, *map(pa.array, sums), row["groups_sha256"].values]
                whole = pa.RecordBatch.from_arrays(columns, schema=arrow)
                for at in range(0, len(whole), ROWS):
                    yield whole.slice(at, ROWS)

    return chunks.mapInArrow(run, schema)


def align_tokenizers(
    df: DataFrame, path_a: str, path_b: str, folder: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """How two tokenizers cut every whole text: the columns `keep` (default doc_id) and measures of the alignment.

    `path_a` is a byte-level tokenizer's file, `path_b` a model of pieces with bytes to fall back on, which
    puts a blank before a text; the other one is given that blank. n_a and n_b count tokens, n_groups the
    stretches between places where tokens of both end, n_links the pairs of tokens that share bytes. A pair
    of ids counts as often as it is linked in all rows; n_best has the links whose pair counts most of all
    with its second id (ties are all best), count_sum the sum of the counts of all links. groups_sha256 is
    the digest of the groups' ids.

    A text that is null or empty, or that a tokenizer does not give back byte by byte, has no tokens: zeros,
    and an empty groups_sha256. Rows that come again count and are returned as often. Columns of `keep`
    that are named like a result are left out, others are not read. An empty table gives no rows.
    `folder` is where the chunks are written. Texts are told apart in full; measures find their rows by
    the text's SHA-256.
    """
    spark = df.sparkSession
    new = {field.name.lower() for field in RESULTS} | {"groups_sha256"}
    keep = [name for name in keep or ["doc_id"] if name.lower() not in new]
    rows = df.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("kept"), F.col(f"`{text}`").cast("string").alias("text")
    )
    distinct = rows.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    made = _chunked(distinct, path_a, path_b)
    made.write.parquet(f"{folder}/chunks")
    chunks = spark.read.schema(made.schema).parquet(f"{folder}/chunks")

    entries = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b", "weights")).alias("place", "pair")).select(
        "chunk", "place", "pair.*"
    )
    with_totals(entries, ["a", "b"], "weights").select(
        "chunk", "place", "b", F.col("total").alias("count")
    ).write.parquet(f"{folder}/totals")
    totals = spark.read.parquet(f"{folder}/totals")
    # A row for each id of the second vocabulary, which the workers hold as well.
    most = totals.groupBy("b").agg(F.max("count").alias("most"))
    judged = totals.join(F.broadcast(most), "b").withColumn("best", F.col("count") == F.col("most"))
    told = answers(judged, ["count", "best"])
    measured = _measured(chunks.drop("a", "b", "weights").join(told, "chunk", "left").drop("chunk"))
    # A text with very many copies is a hot key on the side of the rows, which adaptive execution splits.
    joined = rows.select("kept", F.sha2("text", 256).alias("digest")).join(measured, "digest", "left")
    return joined.select(
        "kept.*",
        *[F.coalesce(field.name, F.lit(0)).cast("long").alias(field.name) for field in RESULTS],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
