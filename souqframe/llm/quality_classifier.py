"""Document quality: a classifier's evidence, with what is known of the site and its section as prior.

There are two questions, whether a document is good and whether it is toxic, and the same steps for both.
The classifier is a naive Bayes over hashed words and text shapes, of which only clear ones count; its
sums are turned into log-likelihood ratios on labelled documents it has not seen. Sites (and sections
within them) have Beta posteriors: the share of such documents that the evidence shows there, shrunk
towards the share of all documents (of the site) with a strength that is estimated from how much sites
(sections) differ. A document's answer is its section's posterior, from which the document itself is
taken out, updated by its own evidence: so no evidence counts twice.
"""

import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from souqframe.llm.rows import Memo, map_texts

BITS = 18
CLEAR = 4.0  # standard deviations by which a feature's log-odds must differ from zero
SMOOTH = 0.5
BINS = 64  # of the evidence, from -LIMIT to LIMIT
LIMIT = 24.0
SAMPLE_LABELS = 20_000  # labelled documents, chosen by hash, that the classifier is fitted on at most
KINDS = 4  # of labels: quality, and twice toxic
# The kinds of labels that say no and yes to a question.
QUESTIONS = {"quality": ([0, 2], [1, 3]), "toxic": ([0, 1], [2, 3])}
CALIBRATION = 4  # one labelled document in so many tells what the evidence is worth


def _hashed(name: str) -> int:
    return crc32(name.encode()) >> (32 - BITS)


def features_of(text: str) -> set[str]:
    """Different words in lower case, and shapes of the text (their names cannot be words)."""
    parts = text.split()
    words = set(text.lower().split())
    n, size = len(parts), max(1, len(text))
    lines = [line for line in text.split("\n") if line]
    shapes = {
        "length": min(12, n.bit_length()),
        "different": 10 * len(words) // max(1, n),
        "word": min(15, size // max(1, n)),
        "symbols": min(10, 40 * sum(text.count(c) for c in "#*$%&|<>") // size),
        "shouts": min(10, 10 * text.count("!!") // max(1, n)),
        "capitals": min(10, 10 * sum(part.isupper() for part in parts) // max(1, n)),
        "lines": 10 * len(set(lines)) // max(1, len(lines)),
    }
    return {word.strip(".,;:!?\"'()") for word in words} | {f" {name} {value}" for name, value in shapes.items()}


def count_features(labelled: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Documents with each hashed feature, and documents: for each kind of the column `kind`, of KINDS.

    Every task sums its documents into 2 ** BITS numbers a kind, Spark sums the tasks'.
    """
    inner = labelled.select(F.col(f"`{text}`").cast("string"), F.col("kind")).where(f"`{text}` IS NOT NULL")
    names = [f"k{kind}" for kind in range(KINDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((KINDS, 1 << BITS), np.int64), np.zeros(KINDS, np.int64)
        hashed = Memo(_hashed, 300_000)
        for batch in batches:
            for value, kind in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                found = {hashed[name] for name in features_of(value)}
                counts[kind][list(found)] += 1
                totals[kind] += 1
        at = np.flatnonzero(counts.any(axis=0))
        columns = [np.append(at, -1), *(np.append(own[at], total) for own, total in zip(counts, totals, strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["feature", *names])

    schema = ", ".join(f"{name} long" for name in ["feature", *names])
    summed = inner.mapInArrow(run, schema).groupBy("feature").agg(*[F.sum(name).alias(name) for name in names])
    counts, totals = np.zeros((KINDS, 1 << BITS)), np.zeros(KINDS)
    for feature, *numbers in summed.collect():  # at most 2 ** BITS + 1 rows
        if feature < 0:
            totals[:] = numbers
        else:
            counts[:, feature] = numbers
    return counts, totals


def weights_of(counts: np.ndarray, totals: np.ndarray) -> dict[int, float]:
    """Log-likelihood ratio (of the second kind to the first) of the features that clearly tell them apart."""
    if not totals.all():
        return {}
    share = (counts + SMOOTH) / (totals[:, None] + 2 * SMOOTH)
    ratio = np.log(share[1]) - np.log(share[0])
    deviation = np.sqrt((1 / (counts + SMOOTH)).sum(axis=0))
    clear = np.flatnonzero(np.abs(ratio) > CLEAR * deviation)
    return {int(at): float(ratio[at]) for at in clear}


def add_evidence(df: DataFrame, weights: list[dict[int, float]], text: str, keep: list[str], into: list[str]) -> DataFrame:
    """Sums of the weights of each whole text's features, one for each question; null for a null text."""
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def make():
        def weigh(name: str) -> tuple[float, ...]:
            number = _hashed(name)
            return tuple(known.get(number, 0.0) for known in sent.value)

        weight, none = Memo(weigh, 300_000), (None,) * len(into)

        def run(value: str | None) -> tuple:
            if value is None:
                return none
            return tuple(map(math.fsum, zip(*[weight[f] for f in features_of(value)], strict=True)))

        return run

    return map_texts(df, text, keep, make, [StructField(name, DoubleType()) for name in into])


def _bin(evidence):
    place = F.floor((F.col(evidence) + LIMIT) * (BINS / (2 * LIMIT)))
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), place)).cast("int")


def calibrated(rows: list[tuple[int, int, int]]) -> list[float]:
    """Log-likelihood ratio of each bin from (bin, yes, no), made to rise with the bin by pooling."""
    yes, no = np.zeros(BINS), np.zeros(BINS)
    for place, n_yes, n_no in rows:
        yes[place], no[place] = n_yes, n_no
    if not yes.sum() or not no.sum():
        return [0.0] * BINS
    pools: list[list[float]] = []  # shares of yes and of no, bins
    for g, b in zip(yes / yes.sum(), no / no.sum(), strict=True):
        pools.append([g, b, 1])
        while len(pools) > 1 and pools[-2][0] * (pools[-1][0] + pools[-1][1]) >= pools[-1][0] * (pools[-2][0] + pools[-2][1]):
            g2, b2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + g2, pools[-1][1] + b2, pools[-1][2] + n2]
    few_yes, few_no = 1 / (yes.sum() + 1), 1 / (no.sum() + 1)
    return [math.log((g + few_yes) / (b + few_no)) for g, b, n in pools for _ in range(int(n))]


def _strength(groups: DataFrame, mean: str) -> float:
    """Beta strength of the groups' shares around `mean`, by moments; large if the groups hardly differ."""
    row = groups.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.count("*").alias("groups"),
        F.sum((F.col("good") / F.col("n") - F.col(mean)) ** 2 * F.col("n")).alias("spread"),
        F.avg(F.col(mean) * (1 - F.col(mean))).alias("within"),
    ).first()
    if not row["n"] or row["groups"] < 2 or row["n"] <= row["squares"] / row["n"]:
        return 10.0
    between = (row["spread"] - (row["groups"] - 1) * row["within"]) / (row["n"] - row["squares"] / row["n"])
    if between <= 0:
        return 1e4
    return min(1e4, max(1.0, row["within"] / between - 1))


def _priors(scored: DataFrame, question: str, stored: Callable) -> tuple[DataFrame, float, float, float]:
    """Sums of each section and its host, the share of all rows, and the strengths of hosts and of sections.

    `scored` has host, path, and the share `soft_<question>` that each row adds to both.
    """
    soft = F.col(f"soft_{question}")
    sections = stored(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(soft).alias("good")), f"sections_{question}"
    )
    hosts = sections.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n"), F.sum("good")).first()
    mean = total[1] / total[0] if total[0] else 0.5
    of_hosts = _strength(hosts.withColumn("mean", F.lit(mean)), "mean")
    hosts = hosts.withColumn("host_prior", (F.col("good") + of_hosts * mean) / (F.col("n") + of_hosts))
    h = hosts.select(
        F.col("host").alias("of_host"), "host_prior", F.col("n").alias("host_n"), F.col("good").alias("host_good")
    )
    sections = sections.join(h, F.col("host").eqNullSafe(F.col("of_host")))
    of_sections = _strength(sections, "host_prior")
    sums = sections.select("of_host", F.col("path").alias("of_path"), "n", "good", "host_n", "host_good")
    return sums, mean, of_hosts, of_sections


def classify_quality(
    df: DataFrame,
    labels: DataFrame,
    folder: str,
    text: str = "text",
    id: str = "doc_id",
    host: str = "source",
    path: str = "lang",
) -> DataFrame:
    """doc_id, evidence, host_prior, path_prior, quality (0 to 1), toxic (0 to 1) and kept of every row.

    Kept are documents with a quality of 0.5 or more that are toxic with less than 0.5. evidence and the
    priors are those of quality; the priors leave the row itself out. `labels` has `id`, quality (1: good,
    0: not) and toxic (1: toxic, else not); rows with a null id or quality are unlabelled, and an id
    with several labels is good if any says so, and toxic likewise. Without both kinds of labels of a
    question its evidence is 0 and its share of all documents that of the labels, one half without any. The
    classifier is fitted on at most SAMPLE_LABELS labelled documents; all statistics of sites and sections
    are over all documents. Sites and sections may be null: those form one. The documents have no path:
    `source` stands for the host and `lang` for the path within it. A null text has no evidence of its own,
    an empty one that of its shape, a long one is read as a whole. Repeated rows come back as often, an
    empty table gives none. Other columns are not read. `folder` is shared.
    """
    spark = df.sparkSession

    def stored(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{folder}/{name}")
        return spark.read.schema(table.schema).parquet(f"{folder}/{name}")

    rows = df.select(
        F.col(f"`{id}`").alias("doc_id"),
        F.col(f"`{host}`").cast("string").alias("host"),
        F.col(f"`{path}`").cast("string").alias("path"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    # Kinds: bad, good, bad and toxic, good and toxic.
    kind = F.max(F.col("quality") == 1).cast("int") + 2 * F.max(F.coalesce("toxic", F.lit(0)) == 1).cast("int")
    kinds = (
        labels.where("quality IS NOT NULL")
        .groupBy(F.col(id).alias("labelled_id"))
        .agg(kind.alias("kind"))
        .where("labelled_id IS NOT NULL")
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(SAMPLE_LABELS)
    )
    # At most SAMPLE_LABELS ids and kinds, so the texts stay where they are.
    kinds = F.broadcast(stored(kinds, "labelled"))
    labelled = rows.select("doc_id", "text").join(kinds, F.col("doc_id") == F.col("labelled_id"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0
    counts, totals = count_features(labelled.where(~fold), "text")
    weights, shares = [], []
    for of_no, of_yes in QUESTIONS.values():
        sums = np.array([counts[of_no].sum(axis=0), counts[of_yes].sum(axis=0)])
        both = np.array([totals[of_no].sum(), totals[of_yes].sum()])
        weights.append(weights_of(sums, both))
        shares.append((both[1] + 1) / (both.sum() + 2))
    sums = [f"sum_{question}" for question in QUESTIONS]
    scored = stored(add_evidence(rows, weights, "text", ["doc_id", "host", "path"], sums), "scored")

    held = scored.join(kinds, F.col("doc_id") == F.col("labelled_id")).where(fold & F.col(sums[0]).isNotNull())
    for place, (question, (_, of_yes)) in enumerate(QUESTIONS.items()):
        yes, total = F.col("kind").isin(of_yes), f"sum_{question}"
        bins = held.groupBy(_bin(total).alias("bin")).agg(F.count_if(yes).alias("yes"), F.count_if(~yes).alias("no"))
        ratios = calibrated([tuple(row) for row in bins.collect()])  # at most BINS rows
        evidence = F.when(F.col(total).isNull(), 0.0).otherwise(F.get(F.array(*map(F.lit, ratios)), _bin(total)))
        prior = math.log(shares[place] / (1 - shares[place]))
        scored = scored.withColumn(f"evidence_{question}", evidence).withColumn(
            f"soft_{question}", 1 / (1 + F.exp(-(F.lit(prior) + F.col(f"evidence_{question}"))))
        )
    answered = scored
    for question in QUESTIONS:
        sections, mean, of_hosts, of_sections = _priors(scored, question, stored)
        sections = stored(sections, f"priors_{question}")
        same = F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
        own = F.col(f"soft_{question}")
        answered = (
            answered.join(sections, same)
            .withColumn(
                f"host_{question}", (F.col("host_good") - own + of_hosts * mean) / (F.col("host_n") - 1 + of_hosts)
            )
            .withColumn(
                f"path_{question}",
                (F.col("good") - own + of_sections * F.col(f"host_{question}")) / (F.col("n") - 1 + of_sections),
            )
            .drop("of_host", "of_path", "n", "good", "host_n", "host_good")
        )
        prior = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col(f"path_{question}")))
        answered = answered.withColumn(
            question, 1 / (1 + F.exp(-(F.ln(prior / (1 - prior)) + F.col(f"evidence_{question}"))))
        )
    return answered.select(
        "doc_id",
        F.col("evidence_quality").alias("evidence"),
        F.col("host_quality").alias("host_prior"),
        F.col("path_quality").alias("path_prior"),
        "quality",
        "toxic",
        ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("kept"),
    )
