"""Chat formatting with Spark expressions only: sorted turn structs, merged neighbours, one template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, SEP = "<|im_start|>", "<|im_end|>", "<|im_sep|>"
#: Texts whose lengths are added up in one fold.
RUN = 256


def escape(text: Column) -> Column:
    """A backslash more in each ``<\\...\\|``, so that no control string is left; reversible."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss_spans (start, length in code points) of each conversation in ``turns``.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Turns go by (turn, role, text), nulls
    first, so ties and repeated rows have one order; every row is a turn. Neighbours of one role share a block:
    ``<|im_start|>role`` newline, their texts joined by ``<|im_sep|>``, ``<|im_end|>`` newline. Null roles and
    texts count as empty; rows with a null conv_id are one conversation. loss_spans has the texts of
    ``trained_role``, without marks. Control strings inside texts and roles are escaped reversibly.
    """
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("turns"))
    # Sorted by the texts as they are, then escaped: escapes would order ties otherwise.
    chats = chats.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), escape(t["text"]).alias("text")))).withColumn("n", F.size("turns"))
    # Where blocks of one role begin; a block ends where the next begins.
    starts = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", F.when(i > 0, i - 1).otherwise(0))["role"]))
    chats = chats.withColumn("starts", starts)
    blocks = F.transform(
        F.col("starts"),
        lambda at, k: F.struct(
            F.get("turns", at)["role"].alias("role"),
            F.transform(F.slice("turns", at + 1, F.coalesce(F.get("starts", k + 1), F.col("n")) - at), lambda t: t["text"]).alias("texts"),
        ),
    )
    chats = chats.withColumn("blocks", blocks)
    head = lambda b: F.concat(F.lit(START), _escape_role(b["role"]), F.lit("\n"))
    pieces = F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], SEP), F.lit(END + "\n")))
    # Every text with what stands before it (a block's head, or a separator) and behind it, in code points.
    around = lambda b: F.transform(
        b["texts"],
        lambda t, i: F.struct(
            F.when(i == 0, F.length(head(b))).otherwise(len(SEP)).alias("before"),
            F.length(t).alias("length"),
            F.when(i == F.size(b["texts"]) - 1, len(END) + 1).otherwise(0).alias("after"),
            (b["role"] == trained_role).alias("trained"),
        ),
    )
    chats = chats.select("conv_id", F.array_join(pieces, "").alias("formatted"), F.flatten(F.transform("blocks", around)).alias("texts"))
    chats = chats.withColumn("begins", _sums_before(F.transform("texts", lambda t: t["before"] + t["length"] + t["after"])))
    spans = F.zip_with("texts", "begins", lambda t, at: F.struct((at + t["before"]).alias("start"), t["length"].alias("length"), t["trained"].alias("trained")))
    trained = F.filter(spans, lambda s: s["trained"])
    return chats.select("conv_id", "formatted", F.transform(trained, lambda s: F.struct(s["start"], s["length"])).alias("loss_spans"))


def _sums_before(sizes: Column) -> Column:
    """For each of ``sizes`` the sum of those before it. Runs of RUN are added up apart, so that a fold copies short lists only."""
    last = lambda sums: F.element_at(sums, -1)
    fold = lambda values, size: F.aggregate(values, F.array(F.lit(0)), lambda sums, x: F.array_append(sums, last(sums) + size(x)))
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(sizes) - 1, F.lit(0)), F.lit(RUN)), lambda at: fold(F.slice(sizes, at + 1, RUN), lambda x: x))
    both = F.struct(runs.alias("runs"), fold(runs, last).alias("befores"))
    within = lambda run, before: F.transform(F.slice(run, 1, F.size(run) - 1), lambda x: x + before)
    return F.flatten(F.transform(F.array(both), lambda s: F.flatten(F.transform(s["runs"], lambda run, k: within(run, F.get(s["befores"], k))))))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    parts = F.split(formatted, r"<\|im_start\|>")
    bodies = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.struct(F.substring_index(p, "\n", 1).alias("role"), F.substr(p, F.instr(p, "\n") + 1).alias("body")))
    turns = F.transform(
        bodies,
        lambda b: F.transform(
            F.split(F.substring_index(b["body"], END, 1), r"<\|im_sep\|>"),
            lambda t: F.struct(_unescape_role(b["role"]).alias("role"), unescape(t).alias("text")),
        ),
    )
    return F.flatten(turns)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")
