"""Chat formatting from an event log, with DataFrame functions alone.

A log has one row per event: conversation, sequence number, kind, message, role, text.

* ``message`` (or null): a whole message. With a null message id it stands alone; with an
  id that exists it replaces that message's role and text.
* ``delta``: text to append to the message (which begins with its first event).
* ``edit``: the message's text from now on.
* ``regenerate``: the message's text starts empty again, and the messages begun after it and
  before this event are withdrawn.

Events are grouped by conversation, sorted by sequence, and folded. Conversations are
rendered in pages of turns, so that a conversation of any length is spread over tasks; its
output is its pages in order.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside roles and texts a
backslash is put before each backslash and behind the first character of each control string
(and a role's line feed becomes backslash n), so control strings occur in the output only
where the template puts them; ``unescape`` is exact.

Defined cases: null texts and roles are empty, a null sequence number sorts first, ties
sort by role and text, repeated rows are turns of their own, a null conversation is a
conversation, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that chat templates give a meaning; none survives inside a text. Fixed values.
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Turns per page, and events per page of one message, by sequence number.
PAGE = 64
_CONTROL = "|".join(f"(?<={re.escape(c)})(?=" + "|".join(re.escape(x[1:]) for x in CONTROLS if x[0] == c) + ")"
                    for c in dict.fromkeys(x[0] for x in CONTROLS))


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # Pairs of backslashes are taken from the left; between them a single one escapes.
    part = lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit(""))
    return F.array_join(F.transform(F.split(role, r"\\\\", -1), part), "\\")


def _sort_key(*columns: Column) -> list[Column]:
    return [c for x in columns for c in (x.isNotNull(), x)]


def _fold(parts: Column) -> Column:
    """Text of sorted parts from the last one that sets it (or the first) on."""
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x["sets"], i + 1).otherwise(1)))
    kept = F.slice(parts, last, F.size(parts))
    return F.array_join(F.transform(kept, lambda x: x["text"]), "")


def messages(log: DataFrame, page: int = PAGE) -> DataFrame:
    """conv_id, seq, role, text: the final messages of each conversation."""
    alone = F.col("message").isNull() & (F.coalesce(F.col("kind"), F.lit("message")) == "message")
    log = log.select("conv_id", F.col("seq").cast("long").alias("seq"), "kind", "message",
                     F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), alone.alias("alone"))
    single = log.where("alone").select("conv_id", "seq", "role", "text")
    events = log.where(~F.col("alone")).withColumn("kind", F.coalesce("kind", F.lit("message")))
    sets = F.col("kind").isin("message", "edit", "regenerate")
    # Deltas of one message are folded in pages by sequence, then the pages; the fold is associative.
    part = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_sort_key(F.col("seq"), F.col("kind"), F.col("role"), F.col("text")))],
                    sets.alias("sets"), F.when(F.col("kind") == "regenerate", "").otherwise(F.col("text")).alias("text"))
    paged = events.groupBy("conv_id", "message", F.floor(F.col("seq") / page).alias("page")).agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.min("seq").alias("first"),
        F.min_by("role", F.struct(~F.col("kind").isin("message"), F.col("seq"))).alias("role"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
        F.max(F.when(F.col("kind") == "message", F.struct("seq", "role"))).alias("named"))
    paged = paged.select("conv_id", "message", "page", "first", "role", "again", "named",
                         F.exists("parts", lambda x: x["sets"]).alias("sets"),
                         _fold(F.col("parts")).alias("text"))
    folded = paged.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(F.struct(F.col("page").isNotNull().alias("k"), "page", "sets", "text"))).alias("parts"),
        F.min("first").alias("seq"), F.min_by("role", F.struct(F.col("page").isNotNull(), "page")).alias("role"),
        F.max("again").alias("again"), F.max("named").alias("named"))
    folded = folded.select("conv_id", "seq", F.coalesce("named.role", "role").alias("role"),
                           _fold(F.col("parts")).alias("text"), "again")
    begun = folded.unionByName(single.withColumn("again", F.lit(None).cast("long")))
    # A message is withdrawn if one begun before it is regenerated after it began: among the
    # regenerations behind it, the smallest beginning lies before its own.
    redone = folded.where(F.col("again").isNotNull()).select(
        "conv_id", F.col("again").alias("seq"), F.col("seq").alias("first"), F.lit(1).alias("mark"))
    touched = redone.select(F.col("conv_id").alias("touched")).distinct()
    same = begun["conv_id"].eqNullSafe(touched["touched"])
    behind = Window.partitionBy("conv_id").orderBy(F.desc_nulls_last("seq"), "mark") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    branched = begun.join(touched, same, "left_semi").withColumn("mark", F.lit(0)) \
        .unionByName(redone, allowMissingColumns=True) \
        .withColumn("earliest", F.min("first").over(behind)) \
        .where((F.col("mark") == 0) & ~F.coalesce(F.col("earliest") < F.col("seq"), F.lit(False)))
    columns = ["conv_id", "seq", "role", "text"]
    return begun.join(touched, same, "left_anti").select(*columns).unionByName(branched.select(*columns))


def render(turns: DataFrame, page: int = PAGE) -> DataFrame:
    """conv_id, page, n_turns, formatted, loss_spans: the output of each conversation in pages.

    ``loss_spans`` are (start, length) in code points of the page's text: what the model is
    trained on, the texts of assistant turns.
    """
    shown = turns.select(
        "conv_id", "seq", F.floor(F.col("seq") / page).alias("page"), (F.col("role") == "assistant").alias("learned"),
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"))
    size = F.char_length("head") + F.char_length("body") + len(END) + 1
    so_far = Window.partitionBy("conv_id", "page").orderBy("seq", "head", "body") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = shown.withColumn("end", F.sum(size).over(so_far))
    turn = F.struct("end", "head", "body", "learned")
    pages = placed.groupBy("conv_id", "page").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    span = lambda x: F.struct(
        (x["end"] - len(END) - 1 - F.char_length(x["body"])).alias("start"),
        F.char_length(x["body"]).cast("long").alias("length"))
    return pages.select(
        "conv_id", "page", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(END + "\n"))), "").alias("formatted"),
        F.transform(F.filter("turns", lambda x: x["learned"]), span).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of an output, from its text alone."""
    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        begin = F.char_length(role) + 2
        return F.struct(unescape_role(role).alias("role"), unescape(
            F.substr(x, begin, F.char_length(x) - begin - len(END))).alias("text"))
    return F.transform(F.slice(F.split(formatted, re.escape(START), -1), 2, 1 << 30), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digest(pages: DataFrame) -> DataFrame:
    """One row per conversation, read back from its output."""
    said = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = pages.select(
        "conv_id", "page", F.size(read_turns(F.col("formatted"))).cast("long").alias("n"), said.alias("said"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("learned"),
        F.char_length("formatted").cast("long").alias("chars"))
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sum(F.char_length("learned")).alias("loss_chars"),
        F.sort_array(F.collect_list(F.struct("page", "said", "learned"))).alias("pages"))
    join = lambda name: F.sha2(F.array_join(F.transform("pages", lambda p: p[name]), ""), 256)
    return whole.select("conv_id", "n_turns", join("said").alias("turns_sha256"), "loss_chars",
                        join("learned").alias("loss_sha256"), "formatted_chars")


def format_chats(log: DataFrame, page: int = PAGE) -> DataFrame:
    """The log's conversations, reconstructed and rendered: see ``render``."""
    return render(messages(log, page), page)


#: Sequence numbers that a turn takes in ``as_streamed``.
STEPS = 8


def as_streamed(turns: DataFrame) -> DataFrame:
    """A log (conv_id, seq, kind, message, role, text) from which ``messages`` makes these turns.

    By a hash of conversation and turn a turn is one message; an empty message and the deltas of
    its text; a draft that an edit corrects; or a draft with a wrong delta that is generated again.
    Turns without a number, and those that share one, are whole messages without an id: nothing
    could tell their events apart.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    same = F.count("*").over(Window.partitionBy("conv_id", "turn"))
    whole = F.col("turn").isNull() | (F.col("n") > 1)
    form = F.when(whole, -1).otherwise(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)).cast("int"))
    size = F.char_length("text")
    third = F.floor(size / 3).cast("int")
    first, rest = F.substr("text", F.lit(1), third), F.substr("text", third + 1, size)
    middle, last = F.substr(rest, F.lit(1), third), F.substr(rest, third + 1, size)
    draft = F.concat(first, F.lit("… no, wait"))

    def events(*steps: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("step"), F.lit(kind).alias("kind"), text.alias("text")) for i, (kind, text) in enumerate(steps)])

    made = F.when(form <= 0, events(("message", F.col("text")))) \
        .when(form == 1, events(("message", F.lit("")), ("delta", first), ("delta", middle), ("delta", last))) \
        .when(form == 2, events(("message", draft), ("delta", last), ("edit", first), ("delta", rest))) \
        .otherwise(events(("message", draft), ("delta", middle), ("regenerate", F.lit(None).cast("string")), ("delta", first), ("delta", rest)))
    return rows.withColumn("n", same).select("conv_id", "turn", "role", whole.alias("whole"), F.explode(made).alias("e")).select(
        "conv_id", (F.col("turn") * STEPS + F.col("e.step")).alias("seq"), F.col("e.kind").alias("kind"),
        F.when(~F.col("whole"), F.col("turn")).alias("message"), "role", F.col("e.text").alias("text"))
