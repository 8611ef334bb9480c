"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

Tokens are runs of characters that secrets are made of; the field (secret_field.py) labels every token of a
text, in one chain. It is trained here, on a bounded sample: windows of texts chosen by their hash, into
which made-up secrets and harmless things are put (secret_samples.py). What the fixed patterns find in
the windows is taught as well.
"""

import random
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from souqframe.llm import secret_field as field_of
from souqframe.llm.secret_field import BEGIN, FEATURES, INSIDE, LABELS, OUT, ChainField, Texts
from souqframe.llm.secret_samples import planted

# The patterns of the three base kinds, in the order of the kinds.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "crf"]
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

WINDOWS = 1500  # of texts that the field is trained on, about
WIDE = 500  # characters of a window
SEED = 7  # of what is put into them
AT_ONCE = 1 << 20  # characters of texts that are scored at once, about


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, each kind leftmost first and without overlaps."""
    found = []
    if "=" in text or ":" in text:
        small = text.lower()
        if any(word in small for word in KEYWORDS):
            found += [
                (m.start(), m.end(), "assign")
                for m in ASSIGN.finditer(text)
                if len(m.group(2)) >= LEAST_ASSIGN
            ]
    if "AKIA" in text:
        found += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST_ACCESS
        ]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2]), span[1]))


def labels_of(texts: Texts, number: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """What spans say about the tokens of one of the texts; the first token that one touches begins it."""
    tokens = slice(texts.firsts[number], texts.firsts[number] + texts.counts[number])
    starts, ends = texts.starts[tokens], texts.ends[tokens]
    labels = np.full(len(starts), OUT)
    for start, end in spans:
        touched = np.flatnonzero((starts < end) & (ends > start) & (labels == OUT))
        labels[touched] = INSIDE
        labels[touched[:1]] = BEGIN
    return labels


def _windows(df: DataFrame, text: str, windows: int) -> list[str]:
    """Windows of some texts: those whose hash is below a share of all, each at a place that its hash says.

    The texts are counted and hashed where they are; only windows reach the driver, equal ones once.
    """
    texts = df.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.length("text") > 0)
    share = min(1.0, windows / max(1, texts.count()))
    chosen = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    room = F.greatest(F.length("text") - WIDE, F.lit(1))
    start = F.pmod(F.xxhash64("text", F.lit(SEED)), room).cast("int") + 1
    found = chosen.select(F.substring("text", start, F.lit(WIDE)).alias("window")).distinct().collect()
    return sorted(row["window"] for row in found)


def examples(windows: list[str], seed: int = SEED) -> list[tuple[str, list[tuple[int, int]]]]:
    """The windows with made-up secrets in them; where those and the patterns' finds are."""
    rnd, made = random.Random(seed), []
    for window in windows:
        text, spans = planted(window, rnd)
        # Of an assignment the value is the secret, which need not be all of a token.
        base = [
            (m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGN
        ] + [span[:2] for span in base_spans(text) if span[2] != "assign"]
        made.append((text, sorted({*spans, *base})))
    return made


def train_field(df: DataFrame, text: str = "text", windows: int = WINDOWS, seed: int = SEED) -> ChainField:
    """A field trained on about `windows` windows of WIDE characters, whatever the size of the table.

    They are those of the texts with the smallest hashes. With no text at all, everything is outside.
    """
    made = examples(_windows(df, text, windows), seed)
    texts = Texts([text for text, _ in made])
    labels = [labels_of(texts, number, spans) for number, (_, spans) in enumerate(made)]
    if not labels:
        return ChainField(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)))
    some = texts.counts > 0
    return field_of.train(field_of.features_of(texts), np.concatenate(labels), texts.counts[some])


def scan(values: list[str], field: ChainField) -> list[tuple]:
    """The counts and spans of some texts."""
    texts = Texts(values)
    found: list[list[list[int]]] = [[] for _ in values]
    before = -2
    for token, label in field.label(texts):
        of, start, end = found[texts.text[token]], int(texts.starts[token]), int(texts.ends[token])
        if label == INSIDE and before == token - 1 and of:
            of[-1][1] = end
        else:
            of.append([start, end])
        before = token
    return [_merged(base_spans(text), added) for text, added in zip(values, found, strict=True)]


def _merged(base: list[tuple[int, int, str]], added: list[list[int]]) -> tuple:
    # A span of the field is new if no base span touches it; both lists run by their start.
    new, last, reach = [], 0, 0
    for start, end in added:
        while last < len(base) and base[last][0] < end:
            reach = max(reach, base[last][1])
            last += 1
        if reach <= start:
            new.append((start, end, "crf"))
    spans = sorted(base + new, key=lambda span: (span[0], KINDS.index(span[2])))
    counts = [sum(kind == of for *_, of in base) for kind in KINDS[:3]]
    return (*counts, *(",".join(f"{k}:{s}:{e}" for s, e, k in part) for part in (base, spans)))


FIELDS = [
    StructField("n_assign", LongType()),
    StructField("n_access", LongType()),
    StructField("n_hex", LongType()),
    StructField("base", StringType()),
    StructField("spans", StringType()),
]


def scan_secrets(df: DataFrame, field: ChainField, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Secrets of every whole text: the columns `keep` (default doc_id), counts of the base kinds, base and all spans.

    Spans are kind:start:end in code points, the end behind the last one, by start and kind, joined by
    commas. The field's spans (`crf`) are those that no base span touches. A null text has none, as an
    empty one; a long text is one chain like any other. One row comes out for each row that goes in, so
    rows that come again come out as often and an empty table gives none. Columns of `keep` that are named
    like a result are left out; others are not read.
    """
    new = {one.name.lower() for one in FIELDS}
    keep = [name for name in keep or ["doc_id"] if name.lower() not in new]
    inner = df.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("kept"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    schema = StructType([*inner.schema["kept"].dataType.fields, *FIELDS])
    arrow = to_arrow_schema(schema)
    used = np.flatnonzero(field.weights.any(axis=1))
    sent = df.sparkSession.sparkContext.broadcast((used, field.weights[used], field.pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros((FEATURES, LABELS))
        weights[sent.value[0]] = sent.value[1]
        own = ChainField(weights, sent.value[2])
        for batch in batches:
            sizes = np.fromiter((len(text.as_buffer() or b"") for text in batch.column(1)), np.int64, len(batch))
            cuts = np.flatnonzero(np.diff(sizes.cumsum() // AT_ONCE)) + 1
            for first, end in pairwise([0, *cuts.tolist(), len(batch)]):
                part = batch.slice(first, end - first)
                rows = scan(part.column(1).to_pylist(), own)
                columns = list(zip(*rows, strict=True)) if rows else [()] * len(FIELDS)
                new = [pa.array(column, one.type) for column, one in zip(columns, list(arrow)[len(keep) :], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.column(0).flatten(), *new], schema=arrow)

    return inner.mapInArrow(run, schema)
