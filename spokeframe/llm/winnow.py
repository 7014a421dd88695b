"""Document fingerprints by winnowing.

A text's tokens are its words, those over eight characters in pieces of eight. Every run of ``k``
tokens is hashed; of every ``w`` neighbouring hashes the least is selected, the rightmost of equal
ones. Two texts that share ``w + k - 1`` tokens in a row therefore share a selected hash, and the
positions that are kept say where.

A hash and its position are one number: 39 bits of hash above 24 bits that count positions down, so
the least number is the least hash and, among equals, the rightmost. The count starts anew after
16.8 million tokens, which can only change which of two equal hashes is named.

Defined results: a null text is empty; an empty text has the empty fingerprint; fewer than ``k``
tokens are hashed as one run. Two empty fingerprints are alike (1.0), an empty and another are not.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spokeframe.llm.columns import let, only, text_or_empty
from spokeframe.session import through_table

K, W = 5, 12
TOKEN = r"[^\x20\x09-\x0D]{1,8}"

_LOW = (1 << 24) - 1


def tokens(text):
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def selected(text, k=K, w=W):
    """The selected hashes with their positions, packed, in order of position."""
    def grams(words):
        long_enough = F.transform(
            F.sequence(F.lit(0), F.size(words) - k),
            lambda i: F.xxhash64(*(words.getItem(i + j) for j in range(k))))
        short = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))) \
            .otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(words) >= k, long_enough).otherwise(short)

    def pack(hash_, i):
        high = F.shiftleft(F.shiftrightunsigned(hash_, 25), 24)
        return high + (F.lit(_LOW) - i % (_LOW + 1))

    def least(packed):
        windows = F.transform(F.sequence(F.lit(1), F.size(packed) - w + 1),
                              lambda i: F.array_min(F.slice(packed, i, w)))
        short = F.when(F.size(packed) > 0, F.array(F.array_min(packed))).otherwise(packed)
        return F.when(F.size(packed) > w, windows).otherwise(short)

    packed = F.transform(let(tokens(text), grams), pack)
    return F.array_distinct(let(packed, least))


def hashes(chosen):
    return F.array_distinct(F.transform(chosen, lambda p: F.shiftrightunsigned(p, 24)))


def as_text(chosen):
    """``hash:position`` of every selected run, the hash in hexadecimal."""
    return F.array_join(F.transform(chosen, lambda p: F.concat(
        F.hex(F.shiftrightunsigned(p, 24)), F.lit(":"),
        (F.lit(_LOW) - p.bitwiseAND(F.lit(_LOW))).cast("string"))), ",")


def likeness(one, other):
    """Shared share of two fingerprints' distinct hashes."""
    shared, all_ = F.size(F.array_intersect(one, other)), F.size(F.array_union(one, other))
    return F.when(all_ > 0, shared / all_).otherwise(F.lit(1.0))


def fingerprints(docs, k=K, w=W, doc_id="doc_id", text="text"):
    """``doc_id, text, selected`` of every document."""
    plain = only(docs, doc_id=doc_id, text=text).withColumn("text", text_or_empty("text"))
    return plain.withColumn("selected", selected(F.col("text"), k, w))


def with_next(rows, per_bucket=2048, columns=("text", "selected")):
    """Add ``next_<column>`` from the next document by descending ``doc_id``; the last has the first.

    Neighbours meet without a sort of the table in one task: ids are cut into ranges of about
    ``per_bucket`` documents, each sorted by itself, and the first document of a range is sent to
    the end of the range before it as well. Ids are expected to spread over their span; where they
    crowd, ranges are larger. Rows equal in id go by a hash of the text; null ids come last.
    """
    tagged = rows.withColumn("tie", F.xxhash64("text"))
    ends = tagged.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    low, high, n = ends[0] or 0, ends[1] or 0, max(ends[2], 1)
    width = max(1, (high - low + 1) * per_bucket // n)
    bucket = F.coalesce(F.floor((F.col("doc_id") - F.lit(low)) / F.lit(width)), F.lit(-1))
    tagged = tagged.withColumn("bucket", bucket.cast("bigint"))
    heads = tagged.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    falling = Window.orderBy(F.desc("bucket"))
    first = F.first("bucket").over(falling.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.last("bucket").over(falling.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    goes_to = F.when(F.col("bucket") == first, last).otherwise(F.lag("bucket").over(falling))
    guests = through_table(heads.select(
        F.col("head.doc_id").alias("guest_id"), F.col("head.tie").alias("guest_tie"),
        goes_to.alias("goes_to")))
    sent = tagged.join(guests, F.col("doc_id").eqNullSafe(F.col("guest_id"))
                       & (F.col("tie") == F.col("guest_tie")), "left")
    places = F.array_compact(F.array(
        F.struct(F.lit(0).alias("guest"), F.col("bucket").alias("at")),
        F.when(F.col("goes_to").isNotNull(),
               F.struct(F.lit(1).alias("guest"), F.col("goes_to").alias("at")))))
    dealt = sent.select(*rows.columns, "tie", F.inline(places))
    order = Window.partitionBy("at").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("tie"))
    met = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return met.where("guest = 0").drop("guest", "at", "tie")


def edited_text(text, following):
    """The last half of ``text`` replaced by as many characters of the following text, or all."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half),
                    F.substring(following, F.lit(1), half))
