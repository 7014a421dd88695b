"""Secrets in texts, told from copied examples by who holds them.

Three fixed patterns give the base spans. A fourth, broad one finds other strings that could be
credentials. The values of all are hashed and counted over the whole table by distinct documents
(repositories) and sources (owners): a value that several owners or many repositories have is a widely
copied example; one that few repositories of a single owner have looks live. Broad strings become
spans only where they look live.

Counts combine before the shuffle, and only values and places are shuffled, never texts.

Defined results: a null text is empty; null is an owner like another; rows equal in id and text are
one document with the same spans. Spans count code points from 0, end exclusive.
"""

from pyspark.sql import functions as F

from spokeframe.llm.columns import matches, only, text_or_empty
from spokeframe.session import through_table

# The three base patterns and the least length of what they must find.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

# Strings of twenty or more with a digit and a letter among them.
BROAD = r"[A-Za-z0-9+/_-]{20,}"

# The most owners, and documents, that a value which looks live has.
MAX_OWNERS, MAX_REPOSITORIES = 1, 4

KINDS = ("assign", "access", "hex", "owned")

_SPAN = "struct<start:int,kind:int,end:int,value:bigint>"


def _no_spans():
    return F.array().cast(f"array<{_SPAN}>")


def find(text, kind, pattern, group=0, least=0):
    """Spans of a pattern: leftmost, not overlapping, in order.

    ``value`` hashes the group, which must have ``least`` characters for the match to count.
    """
    def value(said):
        return F.regexp_extract(said, pattern, group) if group else said

    found = F.filter(matches(text, pattern), lambda m: F.length(value(m["said"])) >= least)
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"),
        F.xxhash64(value(m["said"])).alias("value")))


def extract(docs, doc_id="doc_id", source="source", text="text"):
    """``doc_id, owner, tie, base, broad``: the base spans, and broad ones that touch none."""
    plain = only(docs, doc_id=doc_id, owner=source, text=text).withColumn(
        "text", text_or_empty("text"))
    text = F.col("text")
    mixed = F.filter(
        F.regexp_extract_all(text, F.lit(BROAD), F.lit(0)),
        lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]"))
    found = plain.select(
        "doc_id", "owner", F.xxhash64("text").alias("tie"),
        F.array_sort(F.concat(find(text, 0, ASSIGN, 2, ASSIGN_LEAST), find(text, 1, ACCESS),
                              find(text, 2, HEX))).alias("base"),
        F.when(F.size(mixed) > 0, find(text, 3, BROAD)).otherwise(_no_spans()).alias("broad"),
        F.transform(mixed, lambda v: F.xxhash64(v)).alias("mixed"),
    )
    apart = F.filter("broad", lambda b: F.array_contains("mixed", b["value"]) & ~F.exists(
        "base", lambda s: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return found.select("doc_id", "owner", "tie", "base", apart.alias("broad"))


def ownership(places):
    """``value`` to its numbers of distinct documents and owners."""
    return places.groupBy("value").agg(
        F.countDistinct("doc_id", "tie").alias("repositories"),
        F.countDistinct(F.struct("owner")).alias("owners"))


def scan(docs, max_owners=MAX_OWNERS, max_repositories=MAX_REPOSITORIES, doc_id="doc_id",
         source="source", text="text"):
    """One row per document: its base spans, and all spans with how each value is held.

    ``spans`` holds ``start, kind, end, value, live``: the base spans whether live or not, and of
    the broad ones those that at most ``max_owners`` owners and ``max_repositories`` documents have.
    """
    found = through_table(extract(docs, doc_id, source, text))
    places = found.select("doc_id", "owner", "tie", F.inline(F.concat("base", "broad")))
    held = ownership(places).select(
        "value", ((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories))
        .alias("live"))
    span = F.struct("start", "kind", "end", "value", "live")
    judged = (
        places.join(held, "value").where("kind < 3 OR live")
        .groupBy("doc_id", "tie").agg(F.array_sort(F.collect_set(span)).alias("spans"))
        .withColumnsRenamed({"doc_id": "judged_id", "tie": "judged_tie"})
    )
    return found.join(
        judged, F.col("doc_id").eqNullSafe(F.col("judged_id")) & (F.col("tie") == F.col("judged_tie")),
        "left",
    ).select("doc_id", "owner", "base", F.coalesce(
        "spans", F.array().cast(f"array<{_SPAN[:-1]},live:boolean>>")).alias("spans"))


def as_text(spans):
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")
