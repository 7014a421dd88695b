"""Mix sources to target weights by weighted sampling without replacement.

Each document draws an exponential key divided by its quality weight (Efraimidis and Spirakis);
a source takes its documents in key order until its budget is met. A budget of several times the
source's size takes so many whole epochs first and samples only the rest.

No task ever sorts a source. Documents fall into 4096 buckets by key and the sums of the buckets
show where the budget ends; the one bucket that it ends in is cut into 4096 again, and only what is
left there, one document in 16.8 million, is sorted. All bucket sums are combined before they are
shuffled, so a source with most of the rows costs no more than the others.

Defined results: a null text has size 0; null is a source of its own, last in order. Rows that are
equal in id and text are interchangeable, and other ties go by id and text hash. Sizes of 0 take
nothing. An empty table gives an empty mix. Texts of any length are read whole; other columns of the
table are passed through by ``mixed_documents`` and not read otherwise.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spokeframe.llm.columns import only, text_or_empty, word_count
from spokeframe.session import through_table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKETS = 4096

# The draw uses 52 bits of a digest, which a double holds exactly.
_DRAWS = 2.0**52


def quality_weight(text):
    """1 to 10 by the share of characters that are not ASCII digits or punctuation."""
    marks = F.regexp_count(text, F.lit(r"[!-@\[-`{-~]"))
    clean = F.length(text) - marks
    return F.when(F.length(text) > 0, F.lit(1) + F.floor(F.lit(9) * clean / F.length(text))) \
        .otherwise(F.lit(1)).cast("int")


def with_keys(docs, seed, quality=quality_weight):
    """Columns ``doc_id, source, text`` to the sampling columns, without the text."""
    text = F.col("text")
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                            F.lit("|"), text))
    keyed = docs.select(
        "doc_id", "source", word_count(text).alias("size"), digest.alias("tie"),
        quality(text).alias("quality"),
    )
    draw = (F.conv(F.substring("tie", 1, 13), 16, 10).cast("double") + 1) / (_DRAWS + 1)
    spread = (F.lit(1.0) - F.exp(-F.col("key"))) * BUCKETS
    return (
        keyed.withColumn("key", -F.log(draw) / F.col("quality"))
        .withColumn("bucket", F.floor(spread).cast("int"))
        .withColumn("fine", F.floor((spread - F.floor(spread)) * BUCKETS).cast("int"))
    )


def source_targets(sizes, weights=WEIGHTS, max_epochs=MAX_EPOCHS):
    """``source, source_size`` to each source's target, one row a source.

    Sources by code point, null last, weigh as ``weights`` repeating. A target above
    ``max_epochs`` times its source is cut to that and the excess goes to the others by weight:
    the sources with the least room per weight fill up first, so prefix sums in that order find
    all that are cut. The windows span one row per source.
    """
    nth = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = sizes.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int")))
    room = weighed.withColumn("limit", F.col("source_size") * max_epochs)
    by_room = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    filled = room.withColumns({"left": left, "onward": F.sum("weight").over(onward)}).withColumn(
        "full", F.col("left") * F.col("weight") > F.col("limit") * F.col("onward"))
    shared = filled.withColumns({
        "rest": F.sum("source_size").over(every)
        - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(every), F.lit(0)),
        "sharers": F.sum(F.when(~F.col("full"), F.col("weight"))).over(every),
    })
    fair = F.col("rest").cast("double") * F.col("weight") / F.col("sharers")
    return shared.select("source", "source_size", F.when(
        F.col("full"), F.col("limit").cast("double")).otherwise(fair).alias("target"))


def _budget_end(keyed, plan, bucket, budget):
    """Per source the bucket in which the budget ends, and the words before it."""
    sums = keyed.groupBy("source", bucket).agg(F.sum("size").alias("words"))
    ordered = Window.partitionBy("source").orderBy(bucket)
    placed = sums.withColumn("upto", F.sum("words").over(ordered))
    return (
        placed.join(plan, placed["source"].eqNullSafe(plan["source"])).drop(placed["source"])
        .where(F.col("upto") > F.col(budget))
        .groupBy("source").agg(F.min(F.struct(bucket, (F.col("upto") - F.col("words"))
                                              .alias("before"))).alias("at"))
        .select(F.col("source").alias("cut_source"), F.col(f"at.{bucket}").alias(f"cut_{bucket}"),
                F.col("at.before").alias(f"before_{bucket}"))
    )


def _with_cut(plan, cut):
    return plan.join(cut, plan["source"].eqNullSafe(cut["cut_source"]), "left").drop("cut_source")


def sampling_plan(keyed, weights=WEIGHTS, max_epochs=MAX_EPOCHS):
    """One row per source: target, whole epochs, and the buckets in which the sample ends."""
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = through_table(
        source_targets(sizes, weights, max_epochs)
        .withColumn("epochs", whole.cast("bigint"))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    plan = through_table(_with_cut(plan, _budget_end(keyed, plan, "bucket", "budget")))
    narrowed = plan.where("cut_bucket IS NOT NULL").select(
        F.col("source").alias("in_source"), "cut_bucket")
    inside = keyed.join(narrowed, keyed["source"].eqNullSafe(F.col("in_source"))
                        & (keyed["bucket"] == F.col("cut_bucket"))).drop("in_source", "cut_bucket")
    remaining = plan.withColumn("left", F.col("budget") - F.col("before_bucket"))
    return through_table(_with_cut(plan, _budget_end(inside, remaining, "fine", "left")))


def with_copies(keyed, plan):
    """Add ``source_size``, ``target`` and ``copies``: how often the mix takes the document.

    The document at the end of the budget is taken if at least half of it fits, so a source ends
    within half a document of its target.
    """
    cut = plan.withColumnRenamed("source", "plan_source")
    rows = keyed.join(cut, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    past = F.struct("bucket", "fine")
    end = F.struct(F.col("cut_bucket").alias("bucket"), F.col("cut_fine").alias("fine"))
    decided = rows.withColumn("side", F.when(F.col("cut_bucket").isNull(), -1)
                              .when(F.col("bucket") != F.col("cut_bucket"),
                                    F.when(F.col("bucket") < F.col("cut_bucket"), -1).otherwise(1))
                              .when(F.col("cut_fine").isNull() | (past < end), -1)
                              .when(past > end, 1).otherwise(0))
    ordered = Window.partitionBy("source").orderBy("key", F.asc_nulls_last("doc_id"), "tie") \
        .rowsBetween(Window.unboundedPreceding, -1)
    begun = F.col("before_bucket") + F.col("before_fine") \
        + F.coalesce(F.sum("size").over(ordered), F.lit(0))
    edge = decided.where("side = 0").withColumn(
        "side", F.when(begun + F.col("size") / 2 <= F.col("budget"), -1).otherwise(1))
    return (
        decided.where("side <> 0").unionByName(edge)
        .withColumn("copies", F.col("epochs") + F.when(F.col("side") < 0, 1).otherwise(0))
        .select("doc_id", "source", "tie", "size", "source_size", "target", "copies")
    )


def mix(docs, weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=0, quality=quality_weight,
        doc_id="doc_id", source="source", text="text"):
    """``doc_id, source, tie, size, source_size, target, copies`` of every document.

    ``tie`` is a digest of seed, id and text; with the id it tells rows apart.
    """
    plain = only(docs, doc_id=doc_id, source=source, text=text).withColumn(
        "text", text_or_empty("text"))
    keyed = through_table(with_keys(plain, seed, quality))
    return with_copies(keyed, sampling_plan(keyed, weights, max_epochs))


def mixed_documents(docs, weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=0, quality=quality_weight):
    """The documents themselves, each as often as the mix takes it, with their own columns.

    Documents are matched to their copies by id, source and digest. Rows equal in all three, of which
    the mix may take some, are interchangeable: one of them stands for all that is taken of them.
    """
    chosen = mix(docs, weights, max_epochs, seed, quality).groupBy("doc_id", "source", "tie").agg(
        F.sum("copies").alias("__mix_copies"), F.count("*").alias("__mix_rows")).where(
        "__mix_copies > 0").withColumnsRenamed(
        {"doc_id": "__mix_id", "source": "__mix_source", "tie": "__mix_tie"})
    digest = F.md5(F.concat(
        F.lit(f"{seed}|"), F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit("|"),
        F.coalesce(docs["text"], F.lit(""))))
    found = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["__mix_id"])
                      & docs["source"].eqNullSafe(chosen["__mix_source"])
                      & (digest == chosen["__mix_tie"]))
    once = found.where("__mix_rows = 1")
    equal = found.where("__mix_rows > 1").dropDuplicates(["__mix_id", "__mix_source", "__mix_tie"])
    return once.unionByName(equal).withColumn("__mix_nth", F.explode(F.sequence(
        F.lit(1).cast("bigint"), "__mix_copies"))).select(*docs.columns)
