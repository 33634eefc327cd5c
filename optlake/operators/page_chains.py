"""Order of a query's pages by their links (list ranking).

Each landed page names the next one.  The links form chains; a page's place in
its chain is found by pointer doubling: every page points to the one before it
and knows how far that is, and each round all pages that have not reached the
head of their chain take over the pointer of the page they point to and add its
distance.  A chain of n pages takes log2(n) rounds of one equi-join; pages that
have reached their head leave the rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optlake.session import delete_path, scratch_path


def page_positions(pages: DataFrame, url: str = "url", link: str = "next_url") -> DataFrame:
    """(url, chain, pos, pages, status): the first page of its chain, its 0-based place, the chain's length and state.

    Status of a chain: 'complete' (its last page names no next one), 'broken' (the page that the last one names has not
    landed), 'forked' (it names a page that another page precedes; of several predecessors the least url counts), or
    'cycle' (the pages lead back to themselves: chain and pos are NULL, pages is 1).  ``url`` is unique per page; rows
    with a NULL url are left out.
    """
    spark = pages.sparkSession
    paths: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        paths.append(scratch_path(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    landed = keep(pages.where(F.col(url).isNotNull()).select(F.col(url).alias("url"), F.col(link).alias("next")), "pages")
    before = landed.where("next is not null").groupBy(F.col("next").alias("url")).agg(F.min("url").alias("ptr"))
    linked = keep(landed.select("url").join(before, "url", "left"), "page-links")
    # a page without a predecessor is the head of its chain
    done = linked.where("ptr is null").select("url", F.col("url").alias("chain"), F.lit(0).cast("long").alias("pos"))
    todo = keep(linked.where("ptr is not null").withColumn("dist", F.lit(1).cast("long")), "page-todo")
    done = keep(done, "page-done")  # a union of what each round has added
    total, reach = landed.count(), 1
    while reach < 2 * total and todo.limit(1).count():
        ends = done.select(F.col("url").alias("p"), "chain", "pos")
        found = keep(todo.join(ends, F.col("ptr") == F.col("p")).select("url", "chain", (F.col("pos") + F.col("dist")).alias("pos")),
                     "page-found")
        far = todo.select(F.col("url").alias("p"), F.col("ptr").alias("ptr2"), F.col("dist").alias("dist2"))
        todo = keep(todo.join(far, F.col("ptr") == F.col("p")).select("url", F.col("ptr2").alias("ptr"), (F.col("dist") + F.col("dist2")).alias("dist")),
                    "page-todo")
        done, reach = done.unionByName(found), 2 * reach
    # what is left after log2(all) rounds has no head
    rest = todo.select("url", F.lit(None).cast("string").alias("chain"), F.lit(None).cast("long").alias("pos"))
    place = done.unionByName(rest)
    after = linked.select(F.col("ptr").alias("url"), F.col("url").alias("follower")).where("url is not null")
    known = landed.select(F.col("url").alias("next"), F.lit(True).alias("there"))
    tails = (landed.join(after, "url", "left_anti").join(done, "url").join(known, "next", "left")
             .select("chain", (F.col("pos") + 1).alias("pages"),
                     F.when(F.col("next").isNull(), "complete").when(F.col("there"), "forked").otherwise("broken").alias("status")))
    one = F.lit(1).cast("long")
    out = keep(place.join(tails, "chain", "left").select(
        "url", "chain", "pos", F.coalesce("pages", one).alias("pages"), F.coalesce("status", F.lit("cycle")).alias("status")), "page-chains")
    for path in paths[:-1]:
        delete_path(spark, path)
    return out
