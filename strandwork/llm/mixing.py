"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source is a queue of its documents in a fixed shuffled order (md5 of doc_id and text), sent up to three times. The
virtual finish time of a document's n-th sending is the number of words its source has sent up to its end, divided by the
source's target. All sendings of all sources, sorted by that time, are truncated at the total budget, the sum of the targets:
a document is taken as often as its sendings lie before the cut. The document at the cut is taken if at least half of it fits.

Sums before a row are two-level and never put a source into one task. In a source, documents fall into 4096 ranges of their
shuffle key; over all sendings, into ranges of virtual time. Sources send evenly in virtual time, so ranges of equal width hold
equal numbers of words. Their number is the square root of the number of sendings: the sums of ranges, and the rows
of the one range that the cut falls into, are each as few as that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.llm.common import WORD, written

#: Weights of the sources by code point, repeating (fixed by the contract), and how often one document may be taken.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
#: Ranges of virtual time lie below this time, the last one also holds what is later.
LAST_TIME = 2.0
#: Sources whose cuts are broadcast; each has three keys of 32 letters.
MOST_BROADCAST = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column) -> Column:
    """The place of a document in its source's queue: documents of equal key are equal in doc_id and text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit(""))).cast("binary"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source_size and target of each source, from one row (source, source_size) each.

    The k-th source by code point (null last) has weight ``weights[k mod n]``. Targets share the sum of all sizes by
    weight; none exceeds MOST_TIMES its source's size, and what is above is shared anew by weight. With sources in
    the order of cap/weight, those that reach their cap come first, so one running sum finds the common level of the rest: the highest that its own rows can take.
    The windows run over one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    own = [c for c in sources.columns if c not in ("source", "source_size")]
    rated = sources.withColumn("weight", pick).withColumn("cap", (MOST_TIMES * F.col("source_size")).cast("double"))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    staged = rated.withColumn("level", level)
    final = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(Window.partitionBy())
    return staged.withColumn("final", final).select(
        *own, "source", "source_size", F.when(F.col("weight") * F.col("final") < F.col("cap"), F.col("weight") * F.col("final")).otherwise(F.col("cap")).alias("target")
    )


def _queued(docs: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """One row for each different document (source, doc_id, text): its number of rows n, size, source_size, target and ``end``.

    end: the words that its source has sent in one round when all its rows are through. Texts are read once, here.
    """
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    rows = docs.select(key.alias("queue"), "source", "doc_id", shuffle_key(F.col("doc_id"), F.col("text")).alias("at"), word_count(F.col("text")).alias("size"))
    # Repeated rows combine before the shuffle, so one document with very many rows is one row here.
    rows = rows.groupBy("queue", "at", "doc_id", "size").agg(F.first("source").alias("source"), F.count("*").alias("n"))
    rows = written(rows.withColumn("bucket", F.substring("at", 1, 3)), "queues")
    volume = F.col("size") * F.col("n")
    sums = rows.groupBy("queue", "bucket").agg(F.first("source").alias("source"), F.sum(volume).alias("bucket_size"))
    sources = sums.groupBy("queue").agg(F.first("source").alias("source"), F.sum("bucket_size").alias("source_size"))
    by_bucket = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("queue", "bucket", F.coalesce(F.sum("bucket_size").over(by_bucket), F.lit(0).cast("long")).alias("sent"))
    offsets = offsets.join(targets(sources, weights).drop("source"), "queue")
    within = Window.partitionBy("queue", "bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(offsets, ["queue", "bucket"]).withColumn("end", F.col("sent") + F.sum(volume).over(within)).drop("sent", "bucket")


def _finish(turn: Column | int) -> Column:
    """The virtual finish time of a document's sending in the given turn, from 0 on; null where the target is 0."""
    return F.when(F.col("target") > 0, (turn * F.col("source_size") + F.col("end")) / F.col("target"))


def _sendings(queued: DataFrame) -> DataFrame:
    turns = F.explode(F.sequence(F.lit(0), F.lit(MOST_TIMES - 1)))
    sent = queued.where("size > 0 and target > 0").select("*", turns.alias("turn"))
    return sent.withColumn("finish", _finish(F.col("turn")))


def cut_time(queued: DataFrame) -> float:
    """The virtual time at which all sendings, sorted by their finish, are truncated: the latest one that the budget takes.

    Sendings that finish at the same time are taken together, if at least half of their words fit; -1 if nothing is sent.
    """
    whole = queued.agg(F.count("*"), F.sum(F.col("size") * F.col("n"))).first()
    if not whole[1]:
        return -1.0
    budget = queued.groupBy("queue").agg(F.first("target").alias("target")).agg(F.sum("target")).first()[0]
    n_ranges = max(16, int((whole[0] * MOST_TIMES) ** 0.5))
    sent = _sendings(queued).select("finish", (F.col("size") * F.col("n")).alias("volume"))
    sent = sent.withColumn("range", F.floor(F.least(F.col("finish") / LAST_TIME, F.lit(1.0)) * n_ranges))
    up_to = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = sent.groupBy("range").agg(F.sum("volume").alias("volume")).withColumn("until", F.sum("volume").over(up_to))
    # The cut falls into the first range that ends beyond the budget; where none does, into the last one.
    crossed = ranges.where(F.col("until") >= budget).orderBy("range").first() or ranges.orderBy(F.desc("range")).first()
    before = crossed["until"] - crossed["volume"]
    inside = sent.where(F.col("range") == crossed["range"]).groupBy("finish").agg(F.sum("volume").alias("volume"))
    until = F.sum("volume").over(Window.orderBy("finish").rowsBetween(Window.unboundedPreceding, Window.currentRow)) + before
    fits = inside.withColumn("until", until).where(F.col("until") - F.col("volume") / 2 <= budget)
    found = fits.agg(F.max("finish")).first()[0]
    if found is None:  # nothing of that range fits: the last sending of an earlier one
        found = sent.where(F.col("range") < crossed["range"]).agg(F.max("finish")).first()[0]
    return -1.0 if found is None else found


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """What the mix takes of every document.

    ``docs`` has doc_id, text, source and any more columns. Returns doc_id, source, size (words), source_size, target,
    taken (words, repeats counted: size times 0 to 3) and virtual_finish (of the document's last taken sending, else of
    its first one; null where the target is 0), globally sorted by virtual_finish. Texts that are null or without words
    have size 0 and take 0. A null source is a source. Repeated rows (equal source, doc_id and text) are sent together, so each
    takes the same; an empty table gives an empty one.
    """
    queued = written(_queued(docs, weights), "queued")
    cut = cut_time(queued)
    times = sum((F.coalesce(_finish(k) <= cut, F.lit(False)).cast("int") for k in range(MOST_TIMES)), F.lit(0))
    out = queued.withColumn("times", F.when(F.col("size") > 0, times).otherwise(0)).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    finish = _finish(F.greatest(F.col("times") - 1, F.lit(0)))
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), finish.alias("virtual_finish")).orderBy("virtual_finish", "doc_id")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as the mix takes it (0 to MOST_TIMES).

    Texts are not moved: of each source and turn the last key before the cut decides, and these few rows join the documents.
    """
    queued = written(_queued(docs, weights), "queued")
    cut = cut_time(queued)
    last = _sendings(queued).where(F.col("finish") <= cut).groupBy("queue", "turn").agg(F.max("at").alias("last")).groupBy("queue").agg(F.collect_list("last").alias("lasts"))
    # One row a source, held by the driver; it is broadcast while that is little, as for any mix of sources, and joined beyond.
    held = [(r["queue"], r["lasts"]) for r in last.collect()]
    lasts = docs.sparkSession.createDataFrame(held, "queue_ string, lasts array<string>")
    lasts = F.broadcast(lasts) if len(held) <= MOST_BROADCAST else lasts
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), key.alias("queue_"), F.when(F.col("text").rlike(WORD), shuffle_key(F.col("doc_id"), F.col("text"))).alias("at_"))
    times = F.size(F.filter("lasts", lambda x: F.col("at_") <= x))
    again = keyed.where("at_ is not null").join(lasts, "queue_").withColumn("times", times).where("times > 0")
    return again.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
