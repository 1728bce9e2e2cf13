"""Which names contain which fragments, through an inverted index of short substrings.

Every distinct substring of up to ``GRAM`` characters of a name is a posting. A fragment is looked up by one
of its own substrings, the one that the fewest names have, and what that finds is verified. So
thousands of fragments meet millions of names in an equality join, not a comparison of each with all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions.text import blank_to_null

GRAM = 3


def grams(text: Column, sizes: Column) -> Column:
    """Distinct substrings of ``text`` of each of the ``sizes``; none for a size over its length."""

    def of_size(n: Column) -> Column:
        last = F.length(text) - n + 1
        places = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring(text, i, n))

    return F.array_distinct(F.flatten(F.transform(sizes, of_size)))


def name_postings(names: DataFrame, name: str, key: str, size: int = GRAM) -> DataFrame:
    """(gram, key, name) for every distinct gram of up to ``size`` characters; names in lower case.

    Write it once, partitioned or sorted by gram, and look fragments up as often as needed. A NULL
    or empty name has no grams.
    """
    low = names.select(F.col(key).alias("key"), F.lower(blank_to_null(name)).alias("name")).where("name IS NOT NULL")
    sizes = F.array(*[F.lit(n) for n in range(1, size + 1)])
    return low.select(F.explode(grams(F.col("name"), sizes)).alias("gram"), "key", "name")


def names_with(postings: DataFrame, fragments: DataFrame, fragment: str, size: int = GRAM) -> DataFrame:
    """(fragment, key, name) of the names that contain each distinct fragment, without regard to case.

    Empty fragments are none. Counts per gram combine before their shuffle; a gram that very many names have
    is used only by fragments that have no rarer one, and Spark splits it in the join.
    """
    asked = fragments.select(blank_to_null(fragment).alias("fragment")).where("fragment IS NOT NULL").distinct()
    low = F.lower("fragment")
    own = asked.select("fragment", F.explode(grams(low, F.array(F.least(F.length(low), F.lit(size))))).alias("gram"))
    counts = postings.groupBy(F.col("gram").alias("_gram")).agg(F.count(F.lit(1)).alias("n"))
    # A gram no name has rules the fragment out, and inner joins drop it: its count of 0 is the least.
    counted = own.join(counts, F.col("gram") == F.col("_gram"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = counted.groupBy("fragment").agg(F.min(F.struct("n", "gram")).alias("_least"))
    rarest = rarest.where("_least.n > 0").select("fragment", F.col("_least.gram").alias("_rare"))
    met = rarest.join(postings, F.col("_rare") == F.col("gram"))
    return met.where(F.contains("name", F.lower("fragment"))).select("fragment", "key", "name")
