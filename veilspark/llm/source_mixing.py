r"""Mixing sources to target weights by entropy balancing.

Every source is to give a target number of words. Among all rates that meet the targets, entropy balancing takes those closest to one
copy of each document: ``rate = min(most, exp(tilt * size))``, with one tilt a source, the dual variable of its constraint. The dual is
convex; Newton's iterations find all tilts at once. An iteration is one aggregation over the distinct (source, size) pairs with their
counts, as documents of one size share a rate, so it doesn't read the documents. A step that would leave the interval known to hold a
tilt halves it instead. Terms are summed as whole numbers of 1/1024 word, so the order of tasks can't change a bit of the result.

Rates become copies, longest documents first: each takes the whole number of copies that comes closest to what it and its
predecessors should have given, so a source misses its target by no more than about half of its smallest documents (or, where all its
documents are large, half of one). A source is dealt by hash into parts of about PART_ROWS documents, which are rounded on their own.

Targets: a source's weight as a share of all words, at most ``most`` times its own words; what is cut off goes to the others by weight,
until none is above. Sources without words get nothing. Null and empty texts have no words and keep one copy each. Equal
(doc_id, source, size) rows are counted together and share their copies as evenly as whole copies allow. Null doc_ids and a null source
are values of their own, the null source last. An empty table gives an empty result. Columns besides those named aren't read, so
their names can't clash, and pass through ``mixed``. Nothing grows on the driver: sources stay a table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut
from ..sources.tables import spread

#: Documents that are rounded together; a hot source has many such parts.
PART_ROWS = 2_000
#: Most Newton steps; halving alone would need fewer.
MAX_STEPS = 100
_UNIT = 1024


def n_words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    one_each = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.length(F.regexp_replace(one_each, r"[\x20\x09-\x0D]++", "")), F.lit(0)).cast("long")


def cycled(*weights: int) -> Column:
    """Weights in turn by a source's rank (from 0)."""
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))


def counted(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """(doc_id, source, size, n): equal rows once."""
    size = n_words(F.col("text")) if size is None else size
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))


def ranked(sources: DataFrame) -> DataFrame:
    """With ``rank``: the place of a source by code points, null last. Ranges are numbered on their own, then shifted."""
    by = F.col("source").asc_nulls_last()
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(sources.repartitionByRange(parts, by).withColumn("range", F.spark_partition_id()))
    before = dealt.groupBy("range").agg(F.count("*").alias("k")).select("range", (F.sum("k").over(Window.orderBy("range")) - F.col("k")).alias("before"))
    own = dealt.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy(by)) - 1)
    return own.join(before, "range").withColumn("rank", F.col("place") + F.col("before")).drop("range", "place", "before")


def targets(rows: DataFrame, weight: Column, most: int = 3) -> DataFrame:
    """(source, rank, weight, source_size, docs, unit, target). ``unit`` is the size that its average word's document has."""
    words = F.col("size") * F.col("n")
    sums = rows.groupBy("source").agg(F.sum(words).alias("source_size"), F.count("*").alias("docs"), F.sum((words * F.col("size")).cast("decimal(38,0)")).alias("squares"))
    sources = cut(ranked(sums).withColumn("weight", weight.cast("long")))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    limit, left, among, capped = most * F.col("source_size"), total, None, -1
    while True:
        # Sources above their limit at the level so far (at first: those without words) stop there; the others share what is left.
        above = F.col("weight") * F.lit(float(left)) > limit * F.lit(float(among)) if among else F.col("source_size") == 0
        taken, rest, k = sources.agg(F.coalesce(F.sum(F.when(above, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.count(F.when(above, 1))).first()
        if k == capped:
            break
        left, among, capped = total - taken, rest, k
    share = F.when(above, limit.cast("double")).otherwise((F.col("weight") * F.lit(left)).cast("double") / F.lit(float(among or 1)))
    return sources.select("source", "rank", "weight", "source_size", "docs", F.greatest(F.lit(1.0), F.col("squares") / F.col("source_size").cast("double")).alias("unit"), share.alias("target")) if total else sources.select(
        "source", "rank", "weight", "source_size", "docs", F.lit(1.0).alias("unit"), F.lit(0.0).alias("target"))


def tilts(rows: DataFrame, wanted: DataFrame, most: int = 3) -> DataFrame:
    """``wanted`` with ``tilt``, per ``unit`` words, and ``full``: the source gives all copies it may."""
    full = F.col("target") >= most * F.col("source_size")
    idle = full | (F.col("target") <= 0)
    state = cut(wanted.select("*", full.alias("full"), idle.alias("done"), F.when(~idle, F.log(F.col("target") / F.col("source_size"))).otherwise(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")))
    same = rows["source"].eqNullSafe(wanted["source"])
    cells = cut(rows.join(wanted, same).filter("size > 0").groupBy("rank", rows["size"]).agg(F.sum("n").alias("n")))
    for _ in range(MAX_STEPS):
        open_ = state.filter("not done")
        if open_.isEmpty():
            break
        free = F.col("tilt") * F.col("size") / F.col("unit") < F.log(F.lit(float(most)))
        given = F.col("n") * F.col("size") * F.when(free, F.exp(F.col("tilt") * F.col("size") / F.col("unit"))).otherwise(float(most))
        whole = lambda x: F.sum(F.round(x * _UNIT).cast("decimal(38,0)")).cast("double") / _UNIT
        sums = cells.join(open_.select("rank", "tilt", "unit"), "rank").groupBy("rank").agg(whole(given).alias("words"), F.coalesce(whole(F.when(free, given * F.col("size") / F.col("unit"))), F.lit(0.0)).alias("slope"))
        near = F.abs(F.col("words") - F.col("target")) <= F.greatest(F.lit(0.25), F.col("target") * 1e-10)
        low = F.when(F.col("words") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("words") > F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        # Newton's step on the logarithm of the words, which are a sum of exponentials.
        step = F.col("tilt") - F.log(F.greatest(F.col("words"), F.lit(1e-300)) / F.col("target")) * F.col("words") / F.col("slope")
        inside = (F.col("slope") > 0) & (F.col("low").isNull() | (step > F.col("low"))) & (F.col("high").isNull() | (step < F.col("high")))
        halved = F.when(F.col("low").isNull(), F.col("high") - 1 - F.abs("high")).when(F.col("high").isNull(), F.col("low") + 1 + F.abs("low")).otherwise((F.col("low") + F.col("high")) / 2)
        moved = state.join(sums, "rank", "left").withColumns({"low": F.coalesce(low, "low"), "high": F.coalesce(high, "high"), "done": F.col("done") | near})
        state = cut(moved.withColumn("tilt", F.when(F.col("done"), F.col("tilt")).when(inside, step).otherwise(halved)).select(*state.columns))
    return state.select(*wanted.columns, "full", "tilt")


def rounded(rows: DataFrame, tilted: DataFrame, most: int = 3, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, copies): whole copies of n equal rows, ``most`` of each at most."""
    part = F.pmod(F.xxhash64("doc_id", rows["source"], "size"), F.ceil(F.col("docs") / part_rows).cast("long"))
    own = rows.join(tilted, rows["source"].eqNullSafe(tilted["source"])).select("doc_id", rows["source"], "size", "n", "source_size", "target", "rank", "full", F.col("tilt") / F.col("unit"), part.alias("part"), F.xxhash64("doc_id").alias("tie"))
    own = own.toDF("doc_id", "source", "size", "n", "source_size", "target", "rank", "full", "tilt", "part", "tie")
    kinds = dict(own.dtypes)

    def copies(data: pd.DataFrame) -> pd.DataFrame:
        data = data.sort_values(["size", "tie"], ascending=False, kind="stable")
        size, n = data["size"].to_numpy(np.int64), data["n"].to_numpy(np.int64)
        rate = np.where(data["full"].to_numpy(bool), float(most), np.exp(np.minimum(data["tilt"].to_numpy(float) * size, np.log(most))))
        if not data["target"].iloc[0] > 0:
            rate = np.zeros(len(data))
        out, carry = [], 0.0
        for s, k, r in zip(size.tolist(), n.tolist(), rate.tolist(), strict=True):
            if s == 0:
                out.append(k)
                continue
            want = carry + r * s * k
            c = min(max(int(np.floor(want / s + 0.5)), 0), most * k)
            carry = want - c * s
            out.append(c)
        data["copies"] = out
        return data[["doc_id", "source", "size", "n", "source_size", "target", "copies"]]

    return own.groupBy("rank", "part").applyInPandas(copies, f"doc_id {kinds['doc_id']}, source string, size long, n long, source_size long, target double, copies long")


def copies_of(docs: DataFrame, weight: Column, most: int = 3, part_rows: int = PART_ROWS, size: Column | None = None) -> DataFrame:
    """As ``rounded``, for documents (doc_id, source, text) and weights by source and rank."""
    rows = cut(counted(docs, size))
    return rounded(rows, tilts(rows, cut(targets(rows, weight, most)), most), most, part_rows)


def _share(place: Column) -> Column:
    """Copies of the row at this place (from 0) among n equal ones."""
    return F.floor(F.col("copies") / F.col("n")).cast("long") + F.when(place < F.col("copies") % F.col("n"), 1).otherwise(0)


def mixed(docs: DataFrame, weight: Column, most: int = 3, part_rows: int = PART_ROWS) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken. Rows equal in doc_id, source and size take their turns by the
    hash of their text."""
    done = cut(copies_of(docs, weight, most, part_rows)).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "n", "copies")
    given = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_a"), F.col("source").cast("string").alias("_b"), n_words(F.col("text")).alias("_c"))
    both = given.join(done, F.col("_a").eqNullSafe(F.col("_id")) & F.col("_b").eqNullSafe(F.col("_source")) & (F.col("_c") == F.col("_size")))
    alone = both.filter("n = 1").select("_row", F.col("copies").alias("_k"))
    place = F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy(F.xxhash64("_row.text"))) - 1
    several = both.filter("n > 1").select("_row", _share(place).alias("_k"))
    return alone.unionByName(several).filter("_k > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_k")))).select("_row.*")


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = copies_of(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), cycled(1, 2, 3))
    # Equal rows again one by one, in blocks.
    blocks = done.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(1024))).alias("block"))
    each = blocks.select("*", F.explode(F.sequence(F.col("block"), F.least(F.col("block") + 1023, F.col("n") - 1))).alias("place"))
    return each.select("doc_id", "size", "source_size", "target", (_share(F.col("place")) * F.col("size")).alias("taken"))
