"""Column helpers shared by the operators."""

from pyspark.sql import functions as F

# Fixed value: a word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(column):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text):
    """Number of words; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def let(value, body):
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def only(df, **columns):
    """The named columns only, so that no other column of the caller can clash."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


# Matches that are numbered together.
BLOCK = 256

MATCH = "struct<start:int,end:int,said:string,before:string,after:string>"


def no_matches():
    return F.array().cast(f"array<{MATCH}>")


def matches(text, pattern):
    """Leftmost matches, not overlapping: ``start, end, said``, with the gaps around each.

    The pieces between matches and the matches alternate, so their lengths add up to positions. They
    are added up inside blocks, and the blocks' sums over the blocks, so that no long array grows by
    one element at a time.
    """
    def numbered(steps):
        def inside(block):
            def step(state, s):
                start = state["at"] + F.length(s["before"])
                end = start + F.length(s["said"])
                found = F.struct(start.alias("start"), end.alias("end"), s["said"].alias("said"),
                                 s["before"].alias("before"), s["after"].alias("after"))
                return F.struct(end.alias("at"),
                                F.concat(state["found"], F.array(found)).alias("found"))

            return F.aggregate(block, F.struct(F.lit(0).alias("at"), no_matches().alias("found")), step)

        blocks = F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(steps) / BLOCK).cast("int") - 1),
            lambda i: inside(F.slice(steps, i * BLOCK + 1, F.lit(BLOCK))))

        def joined(state, block):
            moved = F.transform(block["found"], lambda s: s.withField(
                "start", s["start"] + state["at"]).withField("end", s["end"] + state["at"]))
            return F.struct((state["at"] + block["at"]).alias("at"),
                            F.concat(state["found"], F.array(moved)).alias("found"))

        begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{MATCH}>>").alias("found"))
        return F.flatten(F.aggregate(blocks, begin, joined)["found"])

    def steps(both):
        return F.transform(both["said"], lambda s, i: F.struct(
            s.alias("said"), F.get(both["gaps"], i).alias("before"),
            F.get(both["gaps"], i + 1).alias("after")))

    both = F.struct(F.split(text, pattern, -1).alias("gaps"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("said"))
    return F.when(text.rlike(pattern), let(let(both, steps), numbered)).otherwise(no_matches())
