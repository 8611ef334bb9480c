"""Quality rules whose cutoffs are chosen so that few good documents are rejected, with a guarantee.

Each rule is a ratio; a document above the rule's cutoff is rejected. A stated chain of steps tightens one
rule after the other; each step stands for the set of all cutoffs up to it. On the labelled documents of
a stratum, the good documents that a step's whole set rejects are counted. The set is safe if the exact
binomial probability of so few or fewer, were the true rate the allowed one, is small enough. The chain is
tested from its mildest set on and the test ends at the first failure, so along the chain no correction is
needed (fixed sequence); strata share the error probability equally (Bonferroni). With four strata some 220
labelled good documents without a false rejection are enough for a stratum to have cutoffs.

Everything is DataFrame expressions.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souqframe.llm.rows import unused

ALLOWED_RATE = 0.02  # share of a stratum's good documents that all rules together may reject
ERROR = 0.05  # probability that any stratum's rate is higher than allowed
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
WINDOW = 8

BLANK = r"[\x20\x09-\x0D]"

# Rule: the ratio, from the measures.
RULES: dict[str, Callable[[Column], Column]] = {
    "symbols": lambda m: m["n_symbols"] / m["word_chars"],
    "capitals": lambda m: m["n_capitals"] / m["word_chars"],
    "shouts": lambda m: m["n_shouts"] / m["n_words"],
    "repeats": lambda m: m["n_repeat_words"] / m["n_words"],
    "same_lines": lambda m: m["n_dup_lines"] / m["n_lines"],
}
# Steps in the order in which they are tested: rules that good prose hardly ever comes near stand first.
CHAIN = [
    *[("symbols", cutoff) for cutoff in (0.4, 0.3, 0.2, 0.15, 0.1)],
    *[("shouts", cutoff) for cutoff in (0.5, 0.3, 0.2, 0.1)],
    *[("capitals", cutoff) for cutoff in (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15)],
    *[("same_lines", cutoff) for cutoff in (0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2)],
    *[("repeats", cutoff) for cutoff in (0.25, 0.2, 0.15, 0.1)],
]

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(df: DataFrame, text: str, into: str) -> DataFrame:
    """Adds the struct `into`: BASE (long), n_lines, n_capitals, n_shouts and base_failed of every whole text.

    A null text counts as one without words. n_repeat_words counts the words that lie in a window of 8
    words found twice or more in the text; windows are told apart by a 64-bit hash. Only texts with such
    a window sort theirs; all steps grow with the text's length, or that times its logarithm.
    """
    t = unused(df, "measure_text")
    names = {key: unused(df, f"measure_{key}") for key in ("parts", "words", "windows", "sorted", "places", "lines")}
    c = {key: F.col(name) for key, name in names.items()}
    columns = [F.col(f"`{name}`") for name in df.columns]
    text_column = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))

    one = df.select(*columns, text_column.alias(t)).withColumns(
        {
            names["parts"]: F.split(t, BLANK + "+"),
            names["lines"]: F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    # Only the first and the last part can be empty.
    first = (F.get(c["parts"], F.lit(0)) == "").cast("int")
    last = ((F.size(c["parts"]) > 1) & (F.element_at(c["parts"], -1) == "")).cast("int")
    words = F.slice(c["parts"], first + 1, F.size(c["parts"]) - first - last)
    two = one.withColumn(names["words"], F.transform(words, lambda word: F.xxhash64(word)))
    window = F.when(
        F.size(c["words"]) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(c["words"]) - WINDOW),
            lambda i: F.xxhash64(*[F.get(c["words"], i + step) for step in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    three = two.withColumn(names["windows"], window)
    all_different = F.size(F.array_distinct(c["windows"])) == F.size(c["windows"])
    in_order = F.sort_array(F.transform(c["windows"], lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    four = three.withColumn(
        names["sorted"], F.when(all_different, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(in_order)
    )
    found_twice = F.filter(
        c["sorted"],
        lambda w, i: F.coalesce(F.get(c["sorted"], i + 1)["h"] == w["h"], F.lit(False))
        | F.when(i > 0, F.get(c["sorted"], i - 1)["h"] == w["h"]).otherwise(False),
    )
    five = four.withColumn(names["places"], F.sort_array(F.transform(found_twice, lambda w: w["i"])))
    n_repeat = F.aggregate(
        F.transform(
            c["places"],
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(c["places"], i + 1) - p, F.lit(WINDOW))),
        ),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    n_words = F.size(c["words"]).cast("bigint")
    six = five.withColumn(
        into,
        F.struct(
            n_words.alias("n_words"),
            (F.char_length(t) - F.regexp_count(t, F.lit(BLANK))).cast("bigint").alias("word_chars"),
            F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("bigint").alias("n_dup_lines"),
            n_repeat.alias("n_repeat_words"),
            F.size(c["lines"]).cast("bigint").alias("n_lines"),
            F.regexp_count(t, F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
            F.regexp_count(t, F.lit("!!")).cast("bigint").alias("n_shouts"),
        ),
    )
    m = F.col(into)
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
    return six.select(*columns, m.withField("base_failed", failed).alias(into))


def _log_gamma(x: Column) -> Column:
    """By Stirling's series at x + 7; good to about 1e-10 for x >= 1."""
    y = x + 7
    series = (y - 0.5) * F.ln(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (
        1260 * y * y * y * y * y
    )
    return series - reduce(lambda a, b: a + b, [F.ln(x + step) for step in range(7)])


def binomial_tail(k: Column, n: Column, rate: Column) -> Column:
    """P(X <= k) of a binomial X, for k below n * rate.

    Summed from k downwards; there the terms only get smaller, and after ten standard deviations
    (and 60 more) what is left out is below 1e-20 of the sum.
    """
    k, n = k.cast("double"), n.cast("double")
    log_first = (
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.ln(rate) + (n - k) * F.ln(1 - rate)
    )
    terms = F.least(k, F.ceil(10 * F.sqrt(n * rate)) + 60).cast("int")
    summed = F.aggregate(
        F.sequence(F.lit(0), terms),
        F.struct(F.exp(log_first).alias("term"), F.lit(0.0).alias("sum")),
        lambda held, j: F.struct(
            (held["term"] * (k - j) / (n - k + j + 1) * (1 - rate) / rate).alias("term"),
            (held["sum"] + held["term"]).alias("sum"),
        ),
        lambda held: held["sum"],
    )
    return F.least(summed, F.lit(1.0))


def choose_cutoffs(
    labelled: DataFrame,
    measures: str,
    stratum: str,
    good: str,
    allowed_rate: float = ALLOWED_RATE,
    error: float = ERROR,
) -> DataFrame:
    """One row for each stratum of the labelled rows: the stratum and the safe cutoff of each rule, null if none is.

    `labelled` has the struct `measures`, the column `stratum` (a null is a stratum of its own) and the
    boolean `good`; rows with a null there say nothing. Documents that fail the base rules count neither
    as kept nor as rejected here. Counts are summed where the rows are, so the shuffle has one row for
    each task and stratum.
    """
    m = F.col(measures)
    ratios = {rule: F.coalesce(ratio(m), F.lit(0.0)) for rule, ratio in RULES.items()}
    # The first step that rejects a document: so do all sets from there on.
    first = F.least(*[F.when(ratios[rule] > cutoff, F.lit(i)) for i, (rule, cutoff) in enumerate(CHAIN)])
    counted = labelled.where(F.col(good) & ~m["base_failed"])
    steps = counted.groupBy(F.col(stratum).alias("stratum"), first.alias("first")).agg(F.count("*").alias("c"))
    upto = [F.coalesce(F.sum(F.when(F.col("first") <= i, F.col("c"))), F.lit(0)) for i in range(len(CHAIN))]
    counts = steps.groupBy("stratum").agg(
        F.sum("c").alias("n"), *[count.alias(f"k_{i}") for i, count in enumerate(upto)]
    )
    strata = max(1, counted.select(stratum).distinct().count())
    tested = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(rule).alias("rule"), F.lit(cutoff).alias("cutoff"), F.col(f"k_{i}").alias("k"))
            for i, (rule, cutoff) in enumerate(CHAIN)
        ]
    )
    rows = counts.select("stratum", "n", F.explode(tested).alias("t")).select("stratum", "n", "t.*")
    rate = F.lit(allowed_rate)
    tail = binomial_tail(F.col("k"), F.col("n"), rate)
    safe = F.when(F.col("k") < F.col("n") * rate, tail <= error / strata).otherwise(False)
    so_far = Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("safe", F.min(safe).over(so_far))
        .groupBy("stratum")
        .agg(
            *[
                F.min(F.when(F.col("safe") & (F.col("rule") == rule), F.col("cutoff"))).alias(f"cut_{rule}")
                for rule in RULES
            ]
        )
    )


def judge(df: DataFrame, measures: str, stratum: str, cutoffs: DataFrame, into: str) -> DataFrame:
    """Adds the boolean `into`: whether base rules and the stratum's cutoffs keep the row.

    A stratum without labelled rows has no cutoffs, so there the base rules alone decide. `cutoffs` has
    one row a stratum; written down before, Spark sees its size and decides on how to join.
    """
    columns = [F.col(f"a.`{name}`") for name in df.columns]
    m = F.col(f"a.`{measures}`")
    rejected = [
        F.coalesce(F.coalesce(ratio(m), F.lit(0.0)) > F.col(f"b.cut_{rule}"), F.lit(False))
        for rule, ratio in RULES.items()
    ]
    joined = df.alias("a").join(
        cutoffs.alias("b"), F.col(f"a.`{stratum}`").eqNullSafe(F.col("b.stratum")), "left"
    )
    kept = ~m["base_failed"] & ~reduce(lambda a, b: a | b, rejected)
    return joined.select(*[c for c, name in zip(columns, df.columns, strict=True) if name.lower() != into.lower()], kept.alias(into))


def apply_quality_rules(
    df: DataFrame,
    labels: DataFrame,
    folder: str,
    text: str = "text",
    id: str = "doc_id",
    stratum: str = "lang",
    keep: list[str] | None = None,
) -> tuple[DataFrame, str, str]:
    """Measures and judges every row: the columns `keep` (default all), and the names of the measures and verdict columns.

    `labels` has `id` and quality (1: good, 0: not, null: says nothing); ids that are null or that no
    label has are unlabelled, and an id labelled both ways counts as good. Measures and cutoffs are
    written to `folder`, which all executors share; texts are read once. Rows that come repeatedly are
    judged each, and an empty table gives an empty one.
    """
    spark = df.sparkSession
    keep = df.columns if keep is None else keep
    measures, verdict, group = (unused(df, name) for name in ("measures", "kept_by_rules", "rule_stratum"))
    measured = measure(
        df.select(*[F.col(f"`{n}`") for n in {**dict.fromkeys(keep), id: 0, text: 0}], F.col(f"`{stratum}`").cast("string").alias(group)),
        text,
        measures,
    )
    if text not in keep:
        measured = measured.drop(text)
    measured.write.parquet(f"{folder}/measured")
    measured = spark.read.schema(measured.schema).parquet(f"{folder}/measured")
    good = (
        labels.where("quality IS NOT NULL")
        .groupBy(F.col(id).alias("labelled_id"))
        .agg((F.max("quality") == 1).alias("labelled_good"))
    )
    labelled = measured.select(F.col(f"`{id}`").alias("measured_id"), group, measures).join(
        good, F.col("measured_id") == F.col("labelled_id")
    )
    cutoffs = choose_cutoffs(labelled, measures, group, "labelled_good")
    cutoffs.coalesce(1).write.parquet(f"{folder}/cutoffs")
    cutoffs = spark.read.schema(cutoffs.schema).parquet(f"{folder}/cutoffs")
    judged = judge(measured, measures, group, cutoffs, verdict)
    return judged.select(*[F.col(f"`{n}`") for n in keep], measures, verdict), measures, verdict
