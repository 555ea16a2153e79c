"""Chat formatting: every assistant turn becomes an example of its own.

An example holds all turns before the reply as context and the reply as target; only the
reply's text is under the loss mask, given as a range of code points. A conversation that
does not end with an assistant turn has one more example without target, so that the
output holds every turn. Only built-in functions are used.

A turn is written `<|turn|>role<|text|>text<|end|>`. In roles and texts a backslash is
doubled, and a backslash is put behind the first character of this template's marks and
of the control strings `<s>`, `</s>`, `[INST]`, `[/INST]`, so none of them occurs inside a
text; taking away one backslash before every character is the exact inverse.

Defined results: a null role or text is the empty string; turns of a conversation follow
each other by turn (null first), then role and text; repeated rows are turns of their own;
a null conv_id is a conversation like any other; an empty table gives an empty table.
"""

from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings, as places where the escape goes.
_CONTROL = r"(?<=<)(?=\||/?s>)|(?<=\[)(?=/?INST\])"


def escape(column):
    doubled = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"\\")


def unescape(column):
    return F.regexp_replace(column, r"(?s)\\(.)", "$1")


def examples(conversations):
    """(conv_id, example, formatted, loss_start, loss_chars), examples counted from 1."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = whole.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == "assistant").alias("reply"),
        F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))).alias("heads"),
        F.transform("turns", lambda t: escape(t["text"])).alias("texts"),
    )
    numbers = F.sequence(F.lit(1), F.size("reply"))
    ends = F.filter(numbers, lambda i: F.element_at("reply", i) | (i == F.size("reply")))
    each = written.select("*", F.posexplode(ends).alias("example", "last"))
    turns = F.zip_with("heads", "texts", lambda head, text: F.concat(head, text, F.lit(END)))
    is_reply = F.element_at("reply", F.col("last"))
    placed = each.select(
        "conv_id",
        (F.col("example") + 1).alias("example"),
        F.array_join(F.slice(turns, 1, F.col("last") - 1), "").alias("context"),
        F.element_at("heads", F.col("last")).alias("head"),
        F.element_at("texts", F.col("last")).alias("target"),
        is_reply.alias("is_reply"),
    )
    return placed.select(
        "conv_id",
        "example",
        F.concat("context", "head", "target", F.lit(END)).alias("formatted"),
        (F.length("context") + F.length("head")).alias("loss_start"),
        F.when(F.col("is_reply"), F.length("target")).otherwise(0).alias("loss_chars"),
    )


def read_back(formatted):
    """One row for each conversation, from the examples alone: its turns as (role, text)
    structs, the text under the loss mask, and all characters written."""
    loss = F.struct(
        "example", F.expr("substring(formatted, loss_start + 1, loss_chars)").alias("text")
    )
    gathered = formatted.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.sort_array(F.collect_list(loss)).alias("losses"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    pieces = F.split(F.regexp_replace("longest", r"^<\|turn\|>|<\|end\|>$", ""), r"<\|end\|><\|turn\|>")
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(p, TEXT, 1)).alias("role"), unescape(F.substring_index(p, TEXT, -1)).alias("text")
        ),
    )
    return gathered.select(
        "conv_id",
        turns.alias("turns"),
        unescape(F.array_join(F.transform("losses", lambda x: x["text"]), "")).alias("loss"),
        "formatted_chars",
    )
