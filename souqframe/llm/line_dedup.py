"""Boilerplate lines of sites: those that too large a share of a site's pages contain.

Everything is DataFrame expressions. A site's boilerplate lines are few whatever its size: with cutoff
r and on average d different lines a page, at most d / r lines can be on more than r of the pages. So
each site's lines are one array, which meets the site's pages by a join on the host; Spark broadcasts
the sites if they are small when written down, and otherwise splits the pages of a large site.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souqframe.llm.rows import unused

MOST_SHARE = 0.1  # of a site's pages that may contain a line
LEAST_PAGES = 5  # that must contain a line before it can be boilerplate

_HAS_WORD = r"[^\x20\x09-\x0D]"


def _line_key(line: Column) -> Column:
    """Lines that are equal but for blanks around them count as one; they are told apart by a 64-bit hash."""
    return F.xxhash64(F.trim(line, F.lit(" \t\x0b\f\r")))


def boilerplate(df: DataFrame, text: str = "text", host: str = "source", most_share: float = MOST_SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, n_pages and boilerplate (hashes of lines) of every site that has such lines.

    Rows without a host form one site. A page counts once for each line, however often it has it; null
    and empty texts are pages without lines. Lines without a word are never boilerplate.
    """
    pages = df.select(F.col(f"`{host}`").cast("string").alias("host"), F.col(f"`{text}`").cast("string").alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("n_pages"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(_HAS_WORD))
    keys = F.array_distinct(F.transform(lines, _line_key))
    found = (
        pages.select("host", F.explode(keys).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("with_line"))
        .where(F.col("with_line") >= least_pages)
    )
    return (
        found.alias("f")
        .join(totals.alias("t"), F.col("f.host").eqNullSafe(F.col("t.host")))
        .where(F.col("with_line") > most_share * F.col("n_pages"))
        .groupBy("t.host", "n_pages")
        .agg(F.sort_array(F.collect_set("line")).alias("boilerplate"))
    )


def drop_boilerplate(
    df: DataFrame,
    folder: str,
    text: str = "text",
    host: str = "source",
    most_share: float = MOST_SHARE,
    least_pages: int = LEAST_PAGES,
    spare_whole: bool = False,
) -> tuple[DataFrame, str, str]:
    """Every row without its site's boilerplate lines, and the names of two columns: lines of the text, lines dropped.

    All columns stay; the text has the other lines in their order, joined by line feeds. A null text
    stays null, with 0 lines. With `spare_whole`, a text all of whose lines with a word would go stays as
    it is. A site's lines are written to `folder`, which all executors share.
    """
    spark = df.sparkSession
    sites = boilerplate(df, text, host, most_share, least_pages)
    sites.write.parquet(f"{folder}/sites")
    sites = spark.read.schema(sites.schema).parquet(f"{folder}/sites")
    n_lines, n_dropped, left = (unused(df, name) for name in ("n_lines", "n_dropped", "lines_left"))
    bad = F.col("s.boilerplate")
    all_lines = F.split(F.col(f"d.`{text}`").cast("string"), "\n")
    kept = F.filter(
        all_lines, lambda line: ~(line.rlike(_HAS_WORD) & F.array_contains(bad, _line_key(line)))
    )
    joined = (
        df.alias("d")
        .join(sites.alias("s"), F.col(f"d.`{host}`").cast("string").eqNullSafe(F.col("s.host")), "left")
        .select(
            "d.*",
            F.when(F.col(f"d.`{text}`").isNull(), 0).otherwise(F.size(all_lines)).cast("bigint").alias(n_lines),
            F.when(bad.isNull(), all_lines).otherwise(kept).alias(left),
        )
    )
    lines, dropped = F.array_join(left, "\n"), F.col(n_lines) - F.size(left)
    if spare_whole:
        spared = (dropped > 0) & ~F.exists(left, lambda line: line.rlike(_HAS_WORD))
        lines = F.when(spared, F.col(f"`{text}`").cast("string")).otherwise(lines)
        dropped = F.when(spared, 0).otherwise(dropped)
    columns = [
        F.when(F.col(f"`{name}`").isNotNull(), lines).alias(name) if name == text else F.col(f"`{name}`")
        for name in df.columns
    ]
    dropped = F.when(F.col(left).isNull(), 0).otherwise(dropped).cast("bigint")
    return joined.select(*columns, n_lines, dropped.alias(n_dropped)), n_lines, n_dropped
