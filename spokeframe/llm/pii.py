"""Personal data: fixed patterns, and terms that give away whom they belong to.

Four fixed patterns give the base spans. Their values are the protected entities. Around each mention
of an entity stand terms, words of letters; the corpus tells how strongly a term reveals the entity.
With ``N`` documents, of which ``df(t)`` have the term, ``df(e)`` the entity and ``n`` the term in the
context of the entity,

    PMI(t; e) / IC(e) = 1 - log(df(t) / n) / log(N / df(e))

is 1 where the term occurs in no document without the entity, and 0 where it says nothing about it.
Terms at ``REMOVED`` or above are removed, those at ``GENERALISED`` or above are replaced by a general
word. A term counts from ``SUPPORT`` documents of at least two different texts on, as what stands once
beside an entity, or in copies of one text only, reveals nothing about other texts.

A context is the last ``CONTEXT`` code points before a mention and the first ones after it, up to the
next mention of the same kind, without words that its outer border cuts. So a text gives no more
pairs than a multiple of its mentions, and pairs are counted over all documents, combined before they
are shuffled. Of the texts themselves nothing is shuffled; the counts of words are, once per task and
word. A frequent word or entity is one partial row per task.

Defined results: a null text is empty. Rows equal in id and text are one document and have the same
spans; documents of equal text count one by one in ``N`` and ``df``. Spans count code points from 0,
end exclusive; spans of different kinds may overlap. Where all documents have the entity, ``log(N /
df(e))`` is 0 and nothing reveals it. An empty table gives an empty table; other columns of the table
are not read. Spans of a long text are numbered block by block, in time nearly linear in their number.
"""

from pyspark.sql import functions as F

from spokeframe.llm.columns import let, matches, no_matches, only, text_or_empty
from spokeframe.session import through_table

# The four base patterns. Possessive repeats and the look-behinds change no match; they
# only keep a long run of letters or digits from being tried again from each of its places.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

KINDS = ("email", "ip", "card", "phone", "removed", "generalised")
BASE_KINDS = 4

# An address part of at most 255, leading zeros aside; digits of cards and of phones.
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

# A word of letters, which may be joined by hyphens and apostrophes and stand between punctuation.
_WORD = r"[^\x20\x09-\x0D]+"
_CORE = r"\p{L}[\p{L}\p{M}]{2,}+(?:['’-][\p{L}\p{M}]++)*+"
TERM = rf"(?<![^\x20\x09-\x0D])\p{{P}}*+({_CORE})\p{{P}}*+(?![^\x20\x09-\x0D])"

CONTEXT = 120
SUPPORT = 2
REMOVED, GENERALISED = 0.95, 0.8

_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _digits(said):
    return F.regexp_replace(said, "[^0-9]", "")


def passes_luhn(digits):
    """The checksum of card numbers: from the right, every second digit counts twice, crosswise."""
    def add(total, at):
        digit = F.substring(digits, F.length(digits) - at, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(at % 2 == 1, twice).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _between(n, bounds):
    return (n >= bounds[0]) & (n <= bounds[1])


def _email(text):
    return F.when(F.contains(text, F.lit("@")), matches(text, EMAIL)).otherwise(no_matches())


def _ip(text):
    part = rf"^{_PART}(?:\.{_PART}){{3}}$"
    return F.filter(matches(text, IP), lambda m: m["said"].rlike(part))


def _card(text):
    enough = text.rlike(rf"[0-9](?:[\x20-]?[0-9]){{{CARD_DIGITS[0] - 1}}}")
    found = F.when(enough, matches(text, CARD)).otherwise(no_matches())
    return F.filter(found, lambda m: let(_digits(m["said"]), lambda d: F.when(
        _between(F.length(d), CARD_DIGITS), passes_luhn(d)).otherwise(F.lit(False))))


def _phone(text):
    found = F.when(F.contains(text, F.lit("+")), matches(text, PHONE)).otherwise(no_matches())
    return F.filter(found, lambda m: _between(F.length(_digits(m["said"])), PHONE_DIGITS))


# How a value is written does not matter to whose it is.
_VALUES = (F.lower, lambda said: said, _digits, _digits)


def _terms(match, context):
    """``term, start, end`` of the words of letters on both sides of a match."""
    def words(piece, at, cut):
        found = F.filter(matches(piece, _WORD), lambda w: ~cut(w))
        cores = F.transform(found, lambda w: let(
            F.regexp_extract(w["said"], TERM, 1), lambda core: F.struct(
                F.lower(core).alias("term"),
                (at + w["start"] + F.instr(w["said"], core) - 1).alias("start"),
                F.length(core).alias("chars"))))
        return F.filter(cores, lambda c: c["chars"] > 0)

    def before(gap):
        n = F.length(gap)
        piece = F.substring(gap, F.greatest(n - context, F.lit(0)) + 1, F.lit(context))
        return words(piece, match["start"] - F.least(n, F.lit(context)),
                     lambda w: (n > context) & (w["start"] == 0))

    def after(gap):
        return words(F.substring(gap, F.lit(1), F.lit(context)), match["end"],
                     lambda w: (F.length(gap) > context) & (w["end"] == context))

    return F.concat(let(match["before"], before), let(match["after"], after))


def extract(docs, context=CONTEXT, doc_id="doc_id", text="text"):
    """``doc_id, tie, base, mentions``: the base spans, and per entity mentioned the terms around it.

    ``tie`` is a digest of the text; with the id it tells documents apart.
    """
    plain = only(docs, doc_id=doc_id, text=text).withColumn("text", text_or_empty("text"))
    text = F.col("text")
    found = plain.select("doc_id", F.md5("text").alias("tie"), F.array(
        *(kind(text) for kind in (_email, _ip, _card, _phone))).alias("found"))

    def of_kind(kind, make):
        return F.transform(F.col("found")[kind], lambda m: make(m, F.concat(
            F.lit(f"{KINDS[kind]}:"), _VALUES[kind](m["said"]))))

    def span(kind):
        return lambda m, value: F.struct(m["start"], F.lit(kind).alias("kind"), m["end"],
                                         F.md5(value).alias("value"))

    def mention(m, value):
        return F.struct(F.md5(value).alias("entity"), _terms(m, context).alias("terms"))

    kinds = range(BASE_KINDS)
    return found.select(
        "doc_id", "tie",
        F.array_sort(F.concat(*(of_kind(k, span(k)) for k in kinds))).alias("base"),
        F.concat(*(of_kind(k, mention) for k in kinds)).alias("mentions"))


def term_counts(docs, doc_id="doc_id", text="text"):
    """``term, documents`` of every term of the corpus."""
    words = F.array_distinct(F.regexp_extract_all(
        F.lower(text_or_empty(text)), F.lit(TERM), F.lit(1)))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(
        F.count("*").alias("documents"))


def disclosures(docs, places, support=SUPPORT, least=GENERALISED, text="text"):
    """``term, entity, strength`` of the terms that reveal an entity, over all documents.

    ``places`` has one row per term in the context of an entity: ``doc_id, tie, entity, term``.
    """
    met = places.select("term", "entity", "doc_id", "tie").distinct()
    pairs = met.groupBy("term", "entity").agg(
        F.count("*").alias("together"), (F.min("tie") < F.max("tie")).alias("varied"),
    ).where((F.col("together") >= support) & F.col("varied")).drop("varied")
    entities = places.select("entity", "doc_id", "tie").distinct().groupBy("entity").agg(
        F.count("*").alias("entity_documents"))
    every = docs.select(F.count("*")).scalar()
    ratio = F.log(F.col("documents") / F.col("together")) / F.log(
        F.col("every") / F.col("entity_documents"))
    return (
        pairs.join(entities, "entity").join(term_counts(docs, text=text), "term")
        .withColumn("every", every).where("every > entity_documents")
        .withColumn("strength", F.lit(1.0) - ratio).where(F.col("strength") >= least)
        .select("term", "entity", "strength")
    )


def scan(docs, context=CONTEXT, support=SUPPORT, removed=REMOVED, generalised=GENERALISED,
         doc_id="doc_id", text="text"):
    """One row per document: ``doc_id, tie, base, spans``.

    ``spans`` holds ``start, kind, end, value``: the base spans, and the terms that reveal an entity
    beside which they stand, as removed or generalised, with the term as value.
    """
    found = through_table(extract(docs, context, doc_id, text))
    mentions = found.where(F.size("mentions") > 0).select(
        "doc_id", "tie", F.inline("mentions"))
    places = mentions.select("doc_id", "tie", "entity", F.inline_outer("terms"))
    named = places.where("term IS NOT NULL")
    # A mention without a term around it counts for its entity all the same.
    revealing = disclosures(docs, places, support, generalised, text)
    kind = F.when(F.col("strength") >= removed, BASE_KINDS).otherwise(BASE_KINDS + 1)
    # A term beside several entities fares as the one it reveals most asks for.
    judged = (
        named.join(revealing, ["term", "entity"])
        .groupBy("doc_id", "tie", "start", "chars", "term")
        .agg(F.min(kind).alias("kind"))
        .groupBy("doc_id", "tie").agg(F.collect_list(F.struct(
            "start", "kind", (F.col("start") + F.col("chars")).alias("end"),
            F.col("term").alias("value"))).alias("terms"))
        .withColumnsRenamed({"doc_id": "judged_id", "tie": "judged_tie"})
    )
    met = found.join(judged, F.col("doc_id").eqNullSafe(F.col("judged_id")) & (
        F.col("tie") == F.col("judged_tie")), "left")
    return met.select("doc_id", "tie", "base", F.array_sort(F.concat(
        "base", F.coalesce("terms", F.array().cast(f"array<{_SPAN}>")))).alias("spans"))


def sanitise(docs, **parameters):
    """The documents, each with its text sanitised as ``sanitised`` and its spans as ``found_spans``.

    Base spans become their kind in angle brackets, generalised terms ``<term>``, removed ones go.
    Of overlapping spans the first stands for all, up to the end of the last.
    """
    found = scan(docs, **parameters).dropDuplicates(["doc_id", "tie"]).select(
        F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"),
        F.col("spans").alias("__spans"))
    text = text_or_empty("text")
    met = docs.withColumn("__text", text).join(
        found, docs["doc_id"].eqNullSafe(found["__id"]) & (F.md5("__text") == F.col("__tie")), "left")

    def merge(groups, s):
        end = F.try_element_at(groups, F.lit(-1))
        joined = F.struct(end["start"].alias("start"), end["kind"].alias("kind"),
                          F.greatest(end["end"], s["end"]).alias("end"))
        own = F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        return F.when((F.size(groups) > 0) & (s["start"] < end["end"]), F.concat(
            F.slice(groups, F.lit(1), F.greatest(F.size(groups) - 1, F.lit(0))), F.array(joined),
        )).otherwise(F.concat(groups, F.array(own)))

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    tags = F.array(*(F.lit(tag) for tag in (*(f"<{k}>" for k in KINDS[:BASE_KINDS]), "", "<term>")))

    def written(groups):
        pieces = F.transform(groups, lambda s, i: F.concat(
            let(F.when(i > 0, F.get(groups, i - 1)["end"]).otherwise(0), lambda at: F.substring(
                F.col("__text"), at + 1, s["start"] - at)),
            F.element_at(tags, s["kind"] + 1)))
        last = F.coalesce(F.try_element_at(groups, F.lit(-1))["end"], F.lit(0))
        rest = F.substring(F.col("__text"), last + 1, F.length("__text"))
        return F.concat(F.array_join(pieces, ""), rest)

    sanitised = let(F.aggregate("__spans", none, merge), written)
    return met.select(*(docs[c] for c in docs.columns), sanitised.alias("sanitised"),
                      F.col("__spans").alias("found_spans"))


def as_text(spans):
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")
