r"""Chat formatting by a grammar that is read back.

    conversation := turn*
    turn         := "<|im_start|>" role "\n" text "<|im_end|>\n"

The parser is deterministic: ``<|im_start|>`` begins a turn wherever it stands, the
first ``<|im_end|>`` ends it and must be followed by a line feed and the next turn, and
of what is between the two one backslash is taken out of every ``<\|``, ``<\\|`` and so on.
Escaping puts one in, so that ``<|`` becomes ``<\|``, and is the exact inverse.

A conversation is first rendered with its texts as they are, and parsed. If that does not give
the turns back, each turn whose own rendering does not is escaped, and the whole is parsed
again. If that failed too, all texts would be escaped; anything else than the turns
would then be an error. Roles are always escaped, and a line feed in one is ``<|n|>``.

All of it is column expressions. A conversation is put together by one task, as a
document would be.
"""

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
_LINE_FEED = "<|n|>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(_LINE_FEED))


def _role_in(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(_LINE_FEED), F.lit("\n")))


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), _role_out(role), F.lit("\n"), text, F.lit(END + "\n"))


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; NULL if the grammar is broken."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)
    bodies = F.slice(pieces, F.lit(2), F.size(pieces) - 1)

    def body(piece):
        return F.substring_index(piece, END, 1)

    def whole(piece):
        ends = piece == F.concat(body(piece), F.lit(END + "\n"))
        return ends & (F.instr(body(piece), "\n") > 0)

    def turn(piece):
        role = F.substring_index(body(piece), "\n", 1)
        text = F.substr(body(piece), F.length(role) + 2)
        return F.struct(_role_in(role).alias("role"), unescaped(text).alias("text"))

    fits = (F.element_at(pieces, 1) == "") & F.forall(bodies, whole)
    return F.when(fits, F.transform(bodies, turn))


def format_chats(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans`` of every conversation.

    ``loss_spans`` are the code points [begin, end) of the assistant's texts in
    ``formatted``, without empty ones. Rows are put in order of turn; rows with the same
    turn follow each other by role, then text. A NULL text or role is empty, a NULL turn comes
    first, and a NULL conv_id is a conversation like any other. Other columns are not
    looked at; no rows give no conversations.
    """
    plain = F.struct(
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ordered = F.sort_array(F.collect_list(plain))
    grouped = conversations.groupBy("conv_id").agg(ordered.alias("ordered"))
    turns = grouped.select(
        "conv_id",
        F.transform("ordered", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
        .alias("turns"),
    )

    def rendering(text_of) -> Column:
        return F.array_join(F.transform("turns", lambda t: _rendered(t["role"], text_of(t))), "")

    def conflicting(t):
        alone = parsed(_rendered(t["role"], t["text"]))
        return ~alone.eqNullSafe(F.array(F.struct(t["role"].alias("role"), t["text"].alias("text"))))

    same = parsed(F.col("formatted")).eqNullSafe(F.col("turns"))
    raw = turns.withColumn("formatted", rendering(lambda t: t["text"])).withColumn("same", same)
    # Level by level, what is not read back as it was is escaped further.
    texts = F.transform("turns", lambda t: t["text"])
    some = F.transform("turns", lambda t: F.when(conflicting(t), escaped(t["text"])).otherwise(t["text"]))
    every = F.transform("turns", lambda t: escaped(t["text"]))
    joined = F.array_join(
        F.zip_with("turns", "contents", lambda t, text: _rendered(t["role"], text)), ""
    )
    once = (
        raw.withColumn("contents", F.when(F.col("same"), texts).otherwise(some))
        .withColumn("formatted", joined)
        .withColumn("same", F.col("same") | same)
    )
    twice = (
        once.withColumn("contents", F.when(F.col("same"), F.col("contents")).otherwise(every))
        .withColumn("formatted", F.when(F.col("same"), F.col("formatted")).otherwise(joined))
        .withColumn("same", F.col("same") | same)
    )
    broken = F.raise_error(F.lit("a formatted conversation does not parse to its turns"))
    before = F.transform("turns", lambda t: F.lit(len(START) + 1) + F.length(_role_out(t["role"])))
    laid_out = F.aggregate(
        F.arrays_zip(F.col("turns"), F.col("contents"), before.alias("before")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans")),
        lambda done, t: F.struct(
            (done["at"] + t["before"] + F.length(t["contents"]) + (len(END) + 1)).alias("at"),
            F.when(
                (t["turns"]["role"] == LEARNED_ROLE) & (t["contents"] != ""),
                F.concat(done["spans"], F.array(F.struct(
                    (done["at"] + t["before"]).alias("begin"),
                    (done["at"] + t["before"] + F.length(t["contents"])).alias("end"),
                ))),
            ).otherwise(done["spans"]).alias("spans"),
        ),
    )
    return twice.select(
        "conv_id",
        F.when(F.col("same"), F.col("formatted")).otherwise(broken.cast("string")).alias("formatted"),
        laid_out["spans"].alias("loss_spans"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """``formatted`` with its ``turns`` (role, text) and the ``loss_text`` under the mask."""
    text = F.transform(
        "loss_spans",
        lambda s: unescaped(F.substr(F.col("formatted"), s["begin"] + 1, s["end"] - s["begin"])),
    )
    return formatted.withColumn("turns", parsed(F.col("formatted"))).withColumn(
        "loss_text", F.array_join(text, "")
    )
