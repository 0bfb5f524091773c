"""Chat formatting: render conversations with a small grammar and prove that they read back.

A formatted conversation is a row of turns without anything between them:

    <<SYS>>text<</SYS>>   [INST]text[/INST]   <s>text</s>   [ROLE]name[AS]text[/ROLE]

for system, user, assistant and every other role. No control string may stand in a text. A turn is
rendered as it is, parsed again and compared with its source; only where that differs, every
control string in it gets one backslash more after its first character. Parsing takes one backslash
away, so texts that hold such strings, with any number of backslashes, come back as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER, AS, OTHER_END = "[ROLE]", "[AS]", "[/ROLE]"

#: First character, backslashes, rest of a control string.
CONTROL = r"([<\[])(\\*)(</?SYS>>|/?s>|/?INST\]|/?ROLE\]|AS\])"
ESCAPED = r"([<\[])\\(\\*)(</?SYS>>|/?s>|/?INST\]|/?ROLE\]|AS\])"
TURN = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render(role: Column, text: Column) -> Column:
    """One turn, its role and text put in as they are."""
    out = F.concat(F.lit(OTHER), role, F.lit(AS), text, F.lit(OTHER_END))
    for name, (opening, closing) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(opening), text, F.lit(closing))).otherwise(out)
    return out


def _between(turn: Column, opening: int | Column, closing: int) -> Column:
    first = F.lit(opening) if isinstance(opening, int) else opening
    return turn.substr(first + 1, F.length(turn) - first - closing)


def parse_turn(turn: Column) -> Column:
    """(role, text) of one rendered turn, unescaped."""
    split = F.instr(turn, AS) - 1
    out = F.struct(
        unescape(turn.substr(F.lit(len(OTHER) + 1), split - len(OTHER))).alias("role"),
        unescape(_between(turn, split + len(AS), len(OTHER_END))).alias("text"),
    )
    for name, (opening, closing) in MARKS.items():
        text = unescape(_between(turn, len(opening), len(closing)))
        out = F.when(turn.startswith(opening), F.struct(F.lit(name).alias("role"), text.alias("text"))).otherwise(out)
    return out


def segments(formatted: Column) -> Column:
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def parse_chat(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    return F.transform(segments(formatted), parse_turn)


def format_chats(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: id, n_turns, formatted, loss (spans of assistant texts), n_escaped.

    Rows are ordered by turn, then role and text; null role or text counts as empty, a null turn comes
    first, rows with a null id form one conversation, repeated rows are repeated turns. Other columns
    are ignored. A span is 0-based start and length, in code points of the escaped text, and its 0-based turn. The task
    fails if a conversation does not parse back to its source, which the grammar rules out.
    """
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    plain = render(F.col("role"), F.col("text"))
    control = F.regexp_count(F.col("plain"), F.lit(CONTROL))
    tried = rows.withColumn("plain", plain).withColumn(
        "same",
        (control == F.when(F.col("role").isin(*MARKS), 2).otherwise(3))
        & parse_turn(F.col("plain")).eqNullSafe(F.struct("role", "text")),
    )
    turns = tried.withColumn(
        "shown", F.when(F.col("same"), F.col("plain")).otherwise(render(escape(F.col("role")), escape(F.col("text"))))
    )
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    opening = len(MARKS["assistant"][0])
    around = opening + len(MARKS["assistant"][1])
    placed = turns.withColumn("i", F.row_number().over(order)).withColumn(
        "start", F.sum(F.length("shown")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("shown")
    )
    span = F.when(
        F.col("role") == "assistant",
        F.struct(
            (F.col("start") + opening).alias("start"), (F.length("shown") - around).cast("long").alias("length"),
            (F.col("i") - 1).cast("long").alias("turn"),
        ),
    )
    whole = placed.groupBy("conv").agg(
        F.count("*").alias("n_turns"), F.count_if(~F.col("same")).alias("n_escaped"),
        F.array_sort(F.collect_list(span)).alias("loss"),
        F.array_sort(F.collect_list(F.struct("i", "shown", "role", "text"))).alias("turns"),
    ).withColumn("formatted", F.array_join("turns.shown", ""))
    back = parse_chat(F.col("formatted"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    proven = F.when(
        back.eqNullSafe(source) & (F.length(F.array_join(segments(F.col("formatted")), "")) == F.length("formatted")),
        F.col("formatted"),
    ).otherwise(F.raise_error(F.lit("a conversation did not parse back to its source")))
    return whole.select(F.col("conv").alias(conv), "n_turns", proven.alias("formatted"), "loss", "n_escaped")


def read_turns(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per turn of the formatted conversations: id, turn (from 0), role, text, loss, shown_chars, n_escaped.

    ``loss`` is the turn's text under the mask, null if none is; ``shown_chars`` its length as formatted. A conversation
    is cut into its turns once and every span is taken from its own turn, so the work grows with its length and not
    with the square. All rows of one stay in the task that formatted it.
    """
    none = F.lit(None)
    shown = F.transform(
        segments(F.col("formatted")),
        lambda s, i: F.struct(i.cast("long").alias("turn"), s.alias("shown"), none.cast("long").alias("start"), none.cast("long").alias("length")),
    )
    spans = F.transform(
        "loss",
        lambda s: F.struct(s["turn"].alias("turn"), none.cast("string").alias("shown"), s["start"].alias("start"), s["length"].alias("length")),
    )
    turns = (
        formatted.select(F.col(conv).alias("conv"), "n_escaped", F.explode(F.concat(shown, spans)).alias("p"))
        .groupBy("conv", "p.turn").agg(*[F.max(f"p.{c}").alias(c) for c in ("shown", "start", "length")], F.max("n_escaped").alias("n_escaped"))
    )
    before = Window.partitionBy("conv").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("start") - F.coalesce(F.sum(F.length("shown")).over(before), F.lit(0)) + 1
    masked = unescape(F.col("shown").substr(first.cast("int"), F.col("length").cast("int")))
    return turns.withColumn("masked", masked).withColumn("t", parse_turn(F.col("shown"))).select(
        F.col("conv").alias(conv), "turn", "t.role", "t.text", F.col("masked").alias("loss"),
        F.length("shown").cast("long").alias("shown_chars"), "n_escaped",
    )


def digest_chats(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the formatted strings and loss spans say when read back."""
    heard = read_turns(formatted, conv).groupBy(F.col(conv).alias("conv")).agg(
        F.count("*").alias("n_turns"), F.sum("shown_chars").alias("formatted_chars"), F.max("n_escaped").alias("n_escaped"),
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "loss"))).alias("turns"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join("turns.loss", "")
    return heard.select(
        F.col("conv").alias(conv), "n_turns", F.sha2(said, 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"), "formatted_chars", "n_escaped",
    )
