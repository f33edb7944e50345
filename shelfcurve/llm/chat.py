"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted, adjacent turns of one role are merged
into a block, and blocks are concatenated:

    <|im_start|>role \\n text [<|im_sep|> text ...] <|im_end|> \\n

Inside texts and roles every ``<|`` becomes ``<||``, so no control string can occur there; a line
break in a role becomes ``<|n|>``. Both are undone on reading. The loss mask lists the [start, end)
code points of each assistant text in the formatted string; marks and separators are outside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# fixed values of the template
START, END, SEPARATOR, LINE = "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|n|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def format_conversations(turns: DataFrame, loss_role: str = ASSISTANT) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): conv_id, formatted,
    loss_mask.

    Null texts and roles count as empty, null turns come first, equal turns are ordered by role and
    text and repeated rows are turns of their own. A null conv_id is a conversation. Other columns
    are not read.
    """
    full = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct("turn", full("role").alias("role"), full("text").alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    last = F.size("turns")
    role = lambda k: F.element_at("turns", k)["role"]
    begins = sorted_turns.withColumn(
        "begins", F.filter(F.sequence(F.lit(1), last), lambda k: (k == 1) | (role(k) != role(F.greatest(k - 1, F.lit(1)))))
    )
    # a block is the slice of turns up to the next begin
    block = lambda k, i: F.slice("turns", k, F.coalesce(F.get("begins", i + 1), last + 1) - k)
    blocks = begins.select("conv_id", F.transform("begins", block).alias("blocks"))
    escaped_role = lambda b: F.replace(escape(b[0]["role"]), F.lit("\n"), F.lit(LINE))
    parts = blocks.select(
        "conv_id",
        F.transform(
            "blocks",
            lambda b: F.struct(
                F.concat(F.lit(START), escaped_role(b), F.lit("\n")).alias("head"),
                F.transform(b, lambda t: escape(t["text"])).alias("texts"),
                (b[0]["role"] == loss_role).alias("learned"),
            ),
        ).alias("blocks"),
    )
    formatted = F.array_join(
        F.transform("blocks", lambda b: F.concat(b["head"], F.array_join(b["texts"], SEPARATOR), F.lit(END + "\n"))), ""
    )
    # length and kind of every text, with what stands before and after it
    runs = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, i: F.struct(
                    F.when(i == 0, F.length(b["head"])).otherwise(F.lit(len(SEPARATOR))).cast("bigint").alias("before"),
                    F.length(t).cast("bigint").alias("size"),
                    F.when(i == F.size(b["texts"]) - 1, len(END) + 1).otherwise(0).cast("bigint").alias("after"),
                    b["learned"].alias("learned"),
                ),
            ),
        )
    )
    # running ends by doubling: each step adds the sum of as many entries before, so n turns take log n passes
    whole = F.transform("runs", lambda r: r["before"] + r["size"] + r["after"])
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size("runs"), F.lit(1)))).cast("int"))
    summed = lambda acc, k: F.transform(acc, lambda x, i: x + F.coalesce(F.get(acc, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)))
    ends = F.aggregate(steps, whole, summed)
    spans = F.zip_with("runs", "ends", lambda r, e: F.when(r["learned"], F.struct((e - r["after"] - r["size"]).alias("start"), (e - r["after"]).alias("end"))))
    laid = parts.select("conv_id", formatted.alias("formatted"), runs.alias("runs")).withColumn("ends", ends)
    return laid.select("conv_id", "formatted", F.filter(spans, lambda s: s.isNotNull()).alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string."""
    quoted = lambda mark: mark.replace("|", "\\|")
    blocks = F.filter(F.split(formatted, quoted(START), -1), lambda b: b != "")

    def turns(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        name = unescape(F.replace(head, F.lit(LINE), F.lit("\n")))
        start = F.length(head) + 2
        body = F.substring(b, start, F.length(b) - start + 1 - len(END) - 1)
        return F.transform(F.split(body, quoted(SEPARATOR), -1), lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(
        loss_mask, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
