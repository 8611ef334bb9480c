"""Near-duplicates by bottom-k sketches of word shingles, confirmed on the full sets.

1. Each text becomes the set of its shingles' hashes; equal sets are one class, whose smallest document
   stands for it. A class keeps its SKETCH smallest hashes.
2. Two sets with the wanted similarity share at least `least` values of their sketches (see _least). So
   they share one among their SKETCH - least + 1 rarest values: only those go into the inverted lists.
   A document whose other values occur nowhere else drops out here, and a passage that very many
   documents have makes a long list only for documents that mostly consist of such passages.
3. In each list the documents are compared with LEADERS documents, on the full sets. Links to leaders make
   the first components. With the first leader b, x shares i(x) shingles, and x has others besides. Two
   documents x, y of the list that share s of those others share at most m + s in all, where m is the
   smaller one of i(x) and i(y). So a link of a document x outside the leader's component either has
   s = 0 and sizes that m allows, which hardly ever happens; or at least a number s of others are shared,
   that i(x) tells, and then one of x's rarest others is. Inverted lists of those, in which documents of
   one component need no comparison, lead to the pairs.
4. Pairs that only their sizes allow pass the estimate from the union of both sketches; all pairs are
   confirmed on the full sets or what differs between them, and links are joined to components.
"""

from collections.abc import Callable
from hashlib import blake2b

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField
from xxhash import xxh3_64_intdigest

from souqframe.llm.components import connected_components
from souqframe.llm.rows import map_texts

SKETCH = 64
# Values of the sketch that two sets of similarity 0.8 or more share: the number is at least that of
# SKETCH draws of 0.8 each, which is below 30 with a probability under 1e-9.
SHARED = 30
LEADERS = 3
WIDTH = 5
PERCENT = 80


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `width` words; of fewer words, of all together.

    Words are what stands between blanks, with A-Z in lower case.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    mixed = np.full(len(words) - width + 1, 0x9E3779B97F4A7C15 + width, np.uint64)
    for step in range(width):
        mixed = (mixed ^ hashes[step : len(words) - width + 1 + step]) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _sketches(width: int) -> Callable:
    def run(text: str | None) -> tuple[int, bytes, list[int]]:
        hashes = shingle_hashes(text, width)
        digest = blake2b(hashes.tobytes(), digest_size=16).digest()
        return len(hashes), digest, hashes[:SKETCH].view(np.int64)

    return run


def _least(n: Column, percent: int) -> Column:
    """How many values of its sketch a set of n shingles shares with every set it is linked with."""
    # Sets that are whole in their sketch, as are all that are similar to them, share that part exactly.
    whole = F.ceil(n * percent / 100)
    return F.when(n * 100 <= SKETCH * percent, whole).otherwise(F.lit(SHARED)).cast("int")


def _may_link(a: Column, b: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether the sketch of the union, made of both sketches, leaves a link possible."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    whole = (n_a <= SKETCH) & (n_b <= SKETCH)
    return F.when(whole, 100 * F.size(F.array_intersect(a, b)) >= percent * F.size(F.array_union(a, b))).otherwise(
        shared >= SHARED
    ) & _like_sizes(n_a, n_b, percent)


def _like_sizes(n_a: Column, n_b: Column, percent: int) -> Column:
    return (100 * n_a >= percent * n_b) & (100 * n_b >= percent * n_a)


def near_duplicates(
    df: DataFrame, folder: str, text: str = "text", id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept of every row.

    Linked are documents whose shingle sets have 100 * intersection >= `percent` * union (percent of 80
    or more). Null and empty texts have no shingles and are linked with nothing. A row without an id is
    linked with nothing and kept, with a null component_id. Rows that repeat an id with the same set
    come back as often; if their sets differ, the id has the set with the smallest digest and comes back
    once. Extra columns are not read. Intermediate tables go to `folder`, which all executors share.
    """
    if percent < PERCENT:
        raise ValueError(f"the sketches are made for similarities of {PERCENT} per cent or more")
    spark = df.sparkSession

    def stored(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{folder}/{name}")
        return spark.read.schema(table.schema).parquet(f"{folder}/{name}")

    texts = df.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    fields = [
        StructField("n_shingles", LongType()),
        StructField("digest", BinaryType()),
        StructField("sketch", ArrayType(LongType())),
    ]
    rows = stored(map_texts(texts, "text", ["doc_id"], lambda: _sketches(width), fields), "sketches")
    several = (
        rows.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.min("digest") != F.max("digest")).alias("differ"))
        .where("differ")
    )
    if not several.isEmpty():
        first = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("digest", "n_shingles", "sketch")).alias("r"))
        rows = stored(
            first.select("doc_id", "r.n_shingles", "r.digest", "r.sketch").union(rows.where("doc_id IS NULL")), "single"
        )

    filled = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        filled.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
        "classes",
    )
    lists = stored(_inverted_lists(classes, percent), "lists")
    members = stored(lists.select("rep").distinct(), "members")
    sets = stored(_full_sets(texts, classes, members, width), "sets")
    sketches = stored(classes.join(members, "rep", "left_semi").select("rep", "n", "sketch"), "member_sketches")

    compared = stored(_with_leaders(lists, sets, percent), "compared")
    groups = connected_components(compared.where("linked").select("a", "b"), f"{folder}/star")
    placed = stored(_with_components(compared, groups), "placed")
    by_size = _confirmed(_with_sketches(_by_size(placed, percent).distinct(), sketches, percent), sets, percent)
    rest_links = stored(_by_other_shingles(placed, percent).union(by_size), "rest_links")
    components = groups
    if not rest_links.isEmpty():
        links = compared.where("linked").select("a", "b").union(rest_links)
        components = connected_components(links, f"{folder}/all")

    of_class = (
        classes.alias("c")
        .join(components.alias("g"), F.col("c.rep") == F.col("g.node"), "left")
        .select("c.digest", F.coalesce("g.component", "c.rep").alias("component"))
    )
    joined = rows.select("doc_id", "n_shingles", "digest").alias("r").join(
        of_class.alias("k"), (F.col("r.digest") == F.col("k.digest")) & (F.col("r.n_shingles") > 0), "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _inverted_lists(classes: DataFrame, percent: int) -> DataFrame:
    """value, rep and n of the rarest values of each sketch, of those that any other sketch has."""
    values = classes.select("rep", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    hits = values.join(shared, "value")
    of_rep = Window.partitionBy("rep")  # at most SKETCH rows
    least = _least(F.col("n"), percent)
    ranked = hits.withColumn("shared", F.count("*").over(of_rep)).withColumn(
        "place", F.row_number().over(of_rep.orderBy("df", "value"))
    )
    # Values that no other sketch has are the rarest; they fill the first places.
    place = F.col("size") - F.col("shared") + F.col("place")
    lists = ranked.where((F.col("shared") >= least) & (place <= F.col("size") - least + 1)).select("value", "rep", "n")
    again = lists.groupBy("value").agg(F.count("*").alias("df")).where("df > 1").select("value")
    return lists.join(again, "value")


def _full_sets(texts: DataFrame, classes: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """rep and all shingle hashes of the documents that stand in a list."""
    own = classes.join(members, "rep", "left_semi").select("rep", "digest")
    of_members = texts.alias("t").join(own.alias("o"), F.col("t.doc_id") == F.col("o.rep"))
    fields = [StructField("found", BinaryType()), StructField("shingles", ArrayType(LongType()))]

    def make():
        def run(text: str | None) -> tuple[bytes, np.ndarray]:
            hashes = shingle_hashes(text, width)
            return blake2b(hashes.tobytes(), digest_size=16).digest(), hashes.view(np.int64)

        return run

    made = map_texts(of_members.select("o.rep", "o.digest", "t.text"), "text", ["rep", "digest"], make, fields)
    # An id that comes repeatedly with the same set is there once.
    return made.where("found = digest").select("rep", "shingles").dropDuplicates(["rep"])


def _with_sketches(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    a, b = sketches.alias("sa"), sketches.alias("sb")
    joined = (
        pairs.alias("p")
        .join(a, F.col("p.a") == F.col("sa.rep"))
        .join(b, F.col("p.b") == F.col("sb.rep"))
    )
    possible = _may_link(F.col("sa.sketch"), F.col("sb.sketch"), F.col("sa.n"), F.col("sb.n"), percent)
    return joined.where(possible).select("p.a", "p.b")


def _with_leaders(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each document b with each leader a of its lists: their sizes, what they share, and the other shingles of b.

    Leaders are the documents whose own lists are the longest together: those nearest to the original,
    among copies that were each changed in other places.
    """
    lengths = lists.groupBy("value").agg(F.count("*").alias("length"))
    weights = lists.join(lengths, "value").groupBy("rep").agg(F.sum("length").alias("weight"))
    heaviest = Window.partitionBy("value").orderBy(F.desc("weight"), "rep")
    leaders = (
        lists.join(weights, "rep")
        .withColumn("place", F.row_number().over(heaviest))
        .where(F.col("place") <= LEADERS)
        .select("value", F.col("rep").alias("a"), "place")
    )
    pairs = (
        lists.join(leaders, "value")
        .where("rep <> a")
        .groupBy("a", F.col("rep").alias("b"))
        .agg((F.min("place") == 1).alias("first"))
    )
    with_sets = (
        pairs.alias("p")
        .join(sets.alias("sa"), F.col("p.a") == F.col("sa.rep"))
        .join(sets.alias("sb"), F.col("p.b") == F.col("sb.rep"))
        .select(
            "p.a",
            "p.b",
            "p.first",
            F.size("sa.shingles").cast("bigint").alias("n_a"),
            F.size("sb.shingles").cast("bigint").alias("n_b"),
            F.array_except("sb.shingles", "sa.shingles").alias("other"),
            F.array_except("sa.shingles", "sb.shingles").alias("missing"),
        )
    )
    shared = F.col("n_b") - F.size("other")
    return with_sets.withColumn("both", shared).withColumn(
        "linked", 100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))
    )


def _with_components(compared: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents of the first leaders that have documents outside their own component."""
    first = compared.where("first").select("a", "b", "n_a", "n_b", "both", "other", "missing")
    of_a, of_b = groups.alias("ga"), groups.alias("gb")
    placed = (
        first.join(of_a, F.col("a") == F.col("ga.node"), "left")
        .join(of_b, F.col("b") == F.col("gb.node"), "left")
        .select(
            *first.columns,
            F.coalesce("gb.component", "b").alias("component"),
            (F.coalesce("ga.component", "a") != F.coalesce("gb.component", "b")).alias("outside"),
        )
    )
    sizes = placed.groupBy("a").agg(F.min("n_b").alias("least"), F.bool_or("outside").alias("open"))
    return placed.join(sizes.where("open").drop("open"), "a")


def _by_size(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs of a leader's documents that could be linked if they shared all that both share with the leader.

    With m shared, sizes x and y allow a link if percent * (x + y) <= (100 + percent) * m. A document that
    is not linked with the leader only has such partners below a size, mostly below the smallest there is.
    """
    most = F.floor((100 + percent) * F.col("both") / percent) - F.col("n_b")
    narrow = placed.drop("other", "missing")
    x, y = narrow.where(F.col("outside") & (most >= F.col("least"))).alias("x"), narrow.alias("y")
    allowed = percent * (F.col("x.n_b") + F.col("y.n_b")) <= (100 + percent) * F.least("x.both", "y.both")
    pairs = x.join(
        y, (F.col("x.a") == F.col("y.a")) & (F.col("x.component") != F.col("y.component")) & allowed
    )
    return pairs.select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b"))


def _by_other_shingles(placed: DataFrame, percent: int) -> DataFrame:
    """Links of a leader's documents, one of them outside, that share one of its rarest other shingles.

    What two documents share follows from what either has besides the leader's shingles and what it lacks
    of them, so the join itself tells, and no pair comes out that is not linked.
    """
    spread = placed.select("a", "b", "n_b", "both", "least", "component", "outside", F.explode("other").alias("value"))
    # Lists of one component need no comparison.
    several = (
        spread.groupBy("a", "value")
        .agg(F.count("*").alias("df"), F.min("component").alias("one"), F.max("component").alias("other"))
        .where("one <> other")
        .select("a", "value", "df")
    )
    shared = spread.join(several, ["a", "value"])
    # Enough others have to be shared even with the smallest partner; the rarest ones cannot all be missing.
    partner = F.greatest(F.col("least"), F.ceil(F.col("n_b") * percent / 100))
    needed = F.ceil(percent * (F.col("n_b") + partner) / (100 + percent)) - F.col("both")
    of_document = Window.partitionBy("a", "b").orderBy("df", "value")
    rarest = (
        shared.where("outside")
        .withColumn("place", F.row_number().over(of_document))
        .withColumn("of", F.count("*").over(Window.partitionBy("a", "b")))
        .where(F.col("place") <= F.col("of") - F.greatest(needed, F.lit(1)) + 1)
    )
    rarest = rarest.select("a", "b", "component", "value")
    lists = rarest.select("a", "value").distinct()
    others = shared.select("a", "b", "component", "value").join(lists, ["a", "value"], "left_semi")
    differences = placed.select("a", "b", "n_a", "n_b", "other", "missing")
    x, y = (side.join(differences, ["a", "b"]).alias(name) for side, name in ((rarest, "x"), (others, "y")))
    lacking = (
        F.size("x.missing") + F.size("y.missing") - F.size(F.array_intersect("x.missing", "y.missing"))
    )
    both = F.col("x.n_a") - lacking + F.size(F.array_intersect("x.other", "y.other"))
    return x.join(
        y,
        (F.col("x.a") == F.col("y.a"))
        & (F.col("x.value") == F.col("y.value"))
        & (F.col("x.component") != F.col("y.component"))
        & _like_sizes(F.col("x.n_b"), F.col("y.n_b"), percent)
        & (100 * both >= percent * (F.col("x.n_b") + F.col("y.n_b") - both)),
    ).select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a, b = sets.alias("sa"), sets.alias("sb")
    joined = (
        pairs.alias("p")
        .join(a, F.col("p.a") == F.col("sa.rep"))
        .join(b, F.col("p.b") == F.col("sb.rep"))
        .select(
            "p.a",
            "p.b",
            F.size(F.array_intersect("sa.shingles", "sb.shingles")).cast("bigint").alias("both"),
            (F.size("sa.shingles").cast("bigint") + F.size("sb.shingles")).alias("sum"),
        )
    )
    return joined.where(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b")


def drop_near_duplicates(
    df: DataFrame, folder: str, text: str = "text", id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """The rows of `df` that near_duplicates() keeps, all their columns unchanged: one of each component.

    Rows that repeat a kept id are reduced to one. Rows without an id stay.
    """
    result = near_duplicates(df, folder, text, id, width, percent).select(
        F.col("doc_id").alias("judged_id"), "kept"
    )
    again = result.where("judged_id IS NOT NULL").groupBy("judged_id").count().where("count > 1")
    dropped = result.where("NOT kept").select("judged_id").distinct()
    dropped.write.parquet(f"{folder}/dropped")
    dropped = df.sparkSession.read.schema(dropped.schema).parquet(f"{folder}/dropped")
    left = df.join(dropped, F.col(f"`{id}`") == F.col("judged_id"), "left_anti")
    repeated = df.where(F.col(f"`{id}`").isNotNull()).groupBy(F.col(f"`{id}`").alias("judged_id")).count().where("count > 1")
    if again.isEmpty() and repeated.isEmpty():
        return left
    with_id = left.where(F.col(f"`{id}`").isNotNull()).dropDuplicates([id])
    return with_id.unionByName(left.where(F.col(f"`{id}`").isNull()))
