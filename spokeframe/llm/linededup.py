"""Delete later copies of repeated runs of lines: ranks by prefix doubling, grouped instead of sorted.

Of the suffix array only what the deletion needs is made: which places begin alike, and which of them
comes first. The order among unlike places and the lengths of longer common prefixes are not made.

A document is its sequence of line ids. Prefix doubling gives every place a rank for the 1, 2, 4, ...
lines that start there: places have equal ranks at a level if and only if those lines are equal. The
rank of a level is made from two ranks of the level before, a power of two apart, so all places of a
document double together in its own row and nothing is shuffled until the ranks are grouped.

Compared are the least runs with ``min_words`` words: from each place forward and, where that ends
before it, from a line of fewer words backward to the place; by its two overlapping power-of-two
pieces a run has a rank too. Places of equal rank are one interval of the suffix array whose common
prefix is at least that run; its first place in corpus order keeps the lines, the others are later
copies. That deletes the maximal repeated runs whole: take a line in a longer run that stands
earlier, and cut the run down around the line while ``min_words`` words are left. What remains is
least from its first line, or ends in the line and is least backward, and it stands earlier as well.
The number of levels depends on ``min_words`` only.

Intervals are reduced to their first place before and after the one shuffle of places; a line that
stands in a third of all documents is one partial row per task there, and the join back to its places
is one that adaptive execution splits.

Defined results: corpus order is ``doc_id`` (nulls first), then a hash of the text, then the line.
Rows equal in id and text are one document and fare alike. Lines without a word are in no run; they
stay, but for those between two deleted lines. A null text is empty. A document all of whose
lines with words go is deleted, one that had none stays as it is. An empty table gives an empty table,
and the table's other columns are passed through. Lines and runs are told apart by 128 bits.
"""

import functools

from pyspark.sql import functions as F

from spokeframe.llm.columns import WORD, let, only, text_or_empty
from spokeframe.session import through_table

MIN_WORDS = 10


def _rank(*parts):
    """A rank of 128 bits: two hashes that have nothing in common but what is hashed."""
    return F.struct(F.xxhash64(*(p["a"] for p in parts)).alias("a"),
                    F.xxhash64(F.lit("b"), *(p["b"] for p in parts)).alias("b"))


def _doubled(step, ranks):
    """Ranks of twice the length: null where the document ends before."""
    return F.transform(ranks, lambda r, i: F.when(
        i + step < F.size(ranks), _rank(r, F.get(ranks, i + step))))


def _run_length(ahead, min_words):
    """Leading lines of ``ahead`` that reach ``min_words`` words; null where all together do not."""
    summed = F.aggregate(
        ahead, F.struct(F.lit(0).alias("lines"), F.lit(0).alias("words")),
        lambda s, n: F.when(s["words"] >= min_words, s).otherwise(F.struct(
            (s["lines"] + 1).alias("lines"), (s["words"] + n).alias("words"))))
    return let(summed, lambda s: F.when(s["words"] >= min_words, s["lines"]))


def _forward(words, i, min_words):
    """Lines of the least run from ``i``."""
    return _run_length(F.slice(words, i + 1, min_words), min_words)


def _backward(words, i, min_words):
    """Lines of the least run up to ``i``, null where it is also the least from its first line."""
    first = F.greatest(i - (min_words - 1), F.lit(0))
    n = _run_length(F.reverse(F.slice(words, first + 1, i - first + 1)), min_words)
    return let(n, lambda n: F.when((n > 1) & (F.aggregate(
        F.slice(words, i - n + 2, F.greatest(n - 1, F.lit(0))), F.lit(0), lambda s, w: s + w)
        >= min_words), n))


def suffix_ranks(docs, min_words=MIN_WORDS, doc_id="doc_id", text="text"):
    """``rank, doc_id, tie, line, last, next``: the least runs with their first and last line.

    ``next`` is the line with words after the last one.
    """
    plain = only(docs, doc_id=doc_id, text=text).withColumn("text", text_or_empty("text"))
    lines = F.filter(
        F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(
            i.alias("line"), F.struct(
                F.xxhash64(t, F.length(t)).alias("a"),
                F.xxhash64(F.lit("b"), t, F.length(t)).alias("b")).alias("id"),
            F.regexp_count(t, F.lit(WORD)).alias("words"))),
        lambda s: s["words"] > 0)
    levels = (min_words - 1).bit_length() + 1
    rows = plain.select("doc_id", F.xxhash64("text").alias("tie"), lines.alias("lines"))
    rows = rows.withColumns({
        "level0": F.transform("lines", lambda s: s["id"]),
        "words": F.transform("lines", lambda s: s["words"]),
    })
    for h in range(1, levels):
        rows = rows.withColumn(f"level{h}", let(
            F.col(f"level{h - 1}"), functools.partial(_doubled, 1 << (h - 1))))
    every = F.array(*(f"level{h}" for h in range(levels)))

    def run(x, i, n):
        """The run of ``n`` lines from ``i``."""
        ranks, lines = x["r"], x["l"]
        h = F.floor(F.log2(n.cast("double"))).cast("int")
        back = n - F.pow(F.lit(2), h).cast("int")
        last = lines[i + n - 1]["line"]
        return F.when(n.isNotNull(), F.struct(
            _rank(F.struct(n.alias("a"), n.alias("b")), F.get(F.get(ranks, h), i),
                  F.get(F.get(ranks, h), i + back)).alias("rank"),
            lines[i]["line"].alias("line"), last.alias("last"),
            F.coalesce(F.get(lines, i + n)["line"], last).alias("next")))

    def runs(x, s, i):
        short = F.when(s["words"] < min_words, _backward(x["w"], i, min_words))
        return F.array(
            let(_forward(x["w"], i, min_words), lambda n: run(x, i, n)),
            let(short, lambda n: run(x, i - n + 1, n)))

    placed = let(F.struct(F.col("words").alias("w"), every.alias("r"), F.col("lines").alias("l")),
                 lambda x: F.filter(F.flatten(F.transform(
                     x["l"], lambda s, i: runs(x, s, i))), lambda p: p.isNotNull()))
    return rows.select("doc_id", "tie", F.inline(placed))


def repeated_runs(docs, min_words=MIN_WORDS, doc_id="doc_id", text="text"):
    """``doc_id, tie, runs``: per document the maximal runs (first and last line) to delete."""
    # Written, as the ranks are grouped and then joined to the groups again.
    places = through_table(suffix_ranks(docs, min_words, doc_id, text))
    place = F.struct("doc_id", "tie", "line")
    intervals = (
        places.groupBy("rank").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select(F.col("rank").alias("interval"), "first")
    )
    later = places.join(intervals, F.col("rank") == F.col("interval")).where(
        ~place.eqNullSafe(F.col("first")))
    grouped = later.groupBy("doc_id", "tie").agg(
        F.array_sort(F.collect_set(F.struct("line", "last", "next"))).alias("found"))

    def merge(runs, r):
        end = F.element_at(runs, -1)
        joined = F.struct(end["line"].alias("line"),
                          F.greatest(end["last"], r["last"]).alias("last"),
                          F.greatest(end["next"], r["next"]).alias("next"))
        return F.when(
            (F.size(runs) > 0) & (r["line"] <= F.try_element_at(runs, F.lit(-1))["next"]),
            F.concat(F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0))),
                     F.array(joined)),
        ).otherwise(F.concat(runs, F.array(r)))

    none = F.array().cast("array<struct<line:int,last:int,next:int>>")
    return grouped.select("doc_id", "tie", F.aggregate("found", none, merge).alias("runs"))


def dedup_lines(docs, min_words=MIN_WORDS):
    """The documents without later copies of repeated runs, with their own columns.

    ``n_chars`` follows the text if the table has it.
    """
    runs = repeated_runs(docs, min_words).select(
        F.col("doc_id").alias("__run_id"), F.col("tie").alias("__run_tie"),
        F.col("runs").alias("__runs"))
    tie = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    met = docs.join(runs, docs["doc_id"].eqNullSafe(runs["__run_id"]) & (tie == runs["__run_tie"]),
                    "left")
    kept = F.filter(F.split(docs["text"], "\n", -1), lambda t, i: ~F.exists(
        F.col("__runs"), lambda r: i.between(r["line"], r["last"])))
    text = F.when(F.col("__runs").isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    done = met.withColumn("__text", text).where(
        F.col("__runs").isNull() | F.col("__text").rlike(WORD))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("__text").alias(name))
        elif name == "n_chars":
            columns.append(F.when(F.col("__runs").isNull(), docs[name]).otherwise(
                F.length("__text")).cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(docs[name])
    return done.select(*columns)
