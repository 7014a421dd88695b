"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, or an image, audio or document attachment. A visitor goes
through the parts in order and writes text escaped and attachments as numbered placeholders; it
records what each placeholder stands for and how many tokens it will be expanded to. A plain text is
split into parts at its Markdown attachments, ``![name](address)``.

The template is ``<|turn|>role<|text|>content<|end|>``. Inside roles and contents a backslash is
doubled and ``<|`` becomes ``<\\|``, so no text can forge a mark and the texts read back exactly.
The loss mask covers the contents of assistant turns.

Defined results: turns go by number, then role, then text, nulls first; a null role or text is
empty; a null conversation id is a conversation of its own. A part of a kind that is not known is a
document, a part without a kind is text, one without a body has an empty one. Equal rows are turns
one by one. An empty table gives no rows; other columns of the table are not read.
"""

from pyspark.sql import functions as F

from spokeframe.llm.columns import let, only

ATTACHMENT = r"!\[[^\]\n]*\]\([^()\s]+\)"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDER = r"<\|(?:image|audio|document):[0-9]+\|>"

# Tokens that an attachment is expanded to.
EXPANDED = {"image": 576, "audio": 750, "document": 1024}

_ENDINGS = {"image": r"(?i)\.(png|jpe?g|gif|webp|svg)$", "audio": r"(?i)\.(mp3|wav|ogg|flac|m4a)$"}
_PART = "struct<kind:string,body:string>"


def escape(text):
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text):
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def attachment_kind(markup):
    address = F.regexp_extract(markup, r"\(([^()\s]+)\)$", 1)
    return (F.when(address.rlike(_ENDINGS["image"]), "image")
            .when(address.rlike(_ENDINGS["audio"]), "audio").otherwise("document"))


def parts_of_text(text):
    """The text as an array of parts, text and attachments in turn; bodies joined give the text."""
    def split(text):
        pieces = F.transform(F.split(text, ATTACHMENT, -1),
                             lambda t: F.struct(F.lit("text").alias("kind"), t.alias("body")))
        marks = F.transform(F.regexp_extract_all(text, F.lit(ATTACHMENT), F.lit(0)),
                            lambda m: F.struct(attachment_kind(m).alias("kind"), m.alias("body")))
        return F.flatten(F.transform(F.arrays_zip(pieces.alias("t"), marks.alias("m")),
                                     lambda z: F.array_compact(F.array(z["t"], z["m"]))))

    whole = F.array(F.struct(F.lit("text").alias("kind"), text.alias("body")))
    return F.when(F.contains(text, F.lit("![")), split(text)).otherwise(whole).cast(
        f"array<{_PART}>")


def known_parts(parts):
    """Parts as the visitor takes them: a missing kind is text, an unknown one a document."""
    return F.transform(parts, lambda p: F.struct(
        F.when(p["kind"].isNull() | (p["kind"] == "text"), "text")
        .when(p["kind"].isin(*EXPANDED), p["kind"]).otherwise("document").alias("kind"),
        F.coalesce(p["body"], F.lit("")).alias("body")))


def visit(parts, expanded=None):
    """Content text, and the attachments in order, of an array of parts.

    Placeholders are numbered within the turn. An attachment keeps its markup or address (``ref``).
    """
    sizes = expanded or EXPANDED
    attached = F.filter(parts, lambda p: p["kind"] != "text")
    def placed_after(s, kind):
        """The content so far with what text is pending, and a placeholder."""
        return F.concat(s["content"], escape(s["pending"]), F.lit("<|"), kind, F.lit(":"),
                        s["n"].cast("string"), F.lit("|>"))

    # Texts that follow each other are escaped as one, so that no two make a mark together.
    seen = F.aggregate(
        parts, F.struct(F.lit(0).alias("n"), F.lit("").alias("content"), F.lit("").alias("pending")),
        lambda s, p: F.when(p["kind"] == "text", F.struct(
            s["n"].alias("n"), s["content"].alias("content"),
            F.concat(s["pending"], p["body"]).alias("pending"))
        ).otherwise(F.struct(
            (s["n"] + 1).alias("n"), placed_after(s, p["kind"]).alias("content"),
            F.lit("").alias("pending"))),
        lambda s: F.concat(s["content"], escape(s["pending"])))
    tokens = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair))
    attachments = F.transform(attached, lambda p: F.struct(
        p["kind"].alias("kind"), p["body"].alias("ref"), tokens[p["kind"]].alias("tokens")))
    return F.struct(seen.alias("content"), attachments.alias("attachments"))


def format_chats(turns, expanded=None, conv_id="conv_id", turn="turn", role="role", text="text"):
    """One row per conversation: the formatted text, its loss mask, and its attachments.

    ``loss`` holds start and length, in code points, of each assistant content in ``formatted``;
    ``attachments`` has one list per turn. ``text`` may also be a column of parts.
    """
    plain = only(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    if dict(plain.dtypes)["text"].startswith("array"):
        parts = known_parts(F.coalesce("text", F.array().cast(f"array<{_PART}>")))
    else:
        parts = parts_of_text(F.coalesce(F.col("text").cast("string"), F.lit("")))
    row = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                   visit(parts, expanded).alias("seen"))
    grouped = plain.select("conv_id", row.alias("row")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("row")).alias("rows"))

    def add(state, r):
        head = F.concat(F.lit(TURN), escape(r["role"]), F.lit(TEXT))
        body = r["seen"]["content"]
        start = state["length"] + F.length(head)
        span = F.struct(start.alias("start"), F.length(body).alias("length"))
        return F.struct(
            (start + F.length(body) + len(END)).alias("length"),
            F.when(r["role"] == "assistant", F.concat(state["loss"], F.array(span)))
            .otherwise(state["loss"]).alias("loss"))

    begin = F.struct(F.lit(0).alias("length"),
                     F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: F.concat(
            F.lit(TURN), escape(r["role"]), F.lit(TEXT), r["seen"]["content"], F.lit(END))), "")
        .alias("formatted"),
        F.aggregate("rows", begin, add)["loss"].alias("loss"),
        F.transform("rows", lambda r: r["seen"]["attachments"]).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate(
        F.flatten("attachments"), F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]))


def restore(content, attachments):
    """The text that a content and the attachments of its turn came from."""
    gaps = F.transform(F.split(content, PLACEHOLDER, -1), unescape)
    return let(F.arrays_zip(gaps.alias("gap"), attachments.alias("a")), lambda zipped: F.array_join(
        F.transform(zipped, lambda z: F.concat(
            z["gap"], F.coalesce(z["a"]["ref"], F.lit("")))), ""))


def read_back(formatted):
    """``conv_id, turns`` (role and text) and ``loss_text`` read from the formatted text alone.

    The loss text is cut out by the mask; its attachments are those of the assistant turns.
    """
    # What stands before the first mark is empty.
    pieces = let(F.split("formatted", r"<\|turn\|>", -1),
                 lambda p: F.slice(p, F.lit(2), F.size(p) - 1))

    def turn(piece, i):
        fields = F.split(piece, r"<\|text\|>|<\|end\|>", -1)
        return let(fields, lambda f: F.struct(
            unescape(f[0]).alias("role"),
            restore(f[1], F.col("attachments")[i]).alias("text")))

    turns = let(pieces, lambda p: F.transform(p, turn))
    read = formatted.withColumn("turns", turns)
    answered = F.filter(F.arrays_zip(F.col("turns").alias("t"), F.col("attachments").alias("a")),
                        lambda z: z["t"]["role"] == "assistant")
    masked = F.transform(
        F.arrays_zip(F.col("loss").alias("s"), answered.alias("z")),
        lambda x: restore(F.substring(F.col("formatted"), x["s"]["start"] + 1, x["s"]["length"]),
                          x["z"]["a"]))
    return read.withColumn("loss_text", F.array_join(masked, ""))
