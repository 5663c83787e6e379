"""Chat formatting in budgeted windows, with column functions only.

A conversation becomes windows of whole turns. Running sums of the turns' tokens choose the spans:
with S tokens left for new turns (budget less history less system turn), a turn of over S/2 tokens
is a span alone and all others are grouped by their start's multiple of S/2, so no span has over S
tokens unless one turn has. A window is the system turn again (where the conversation begins with
one), the last turns before the span that fit into `history` tokens, and the span's own turns. The
loss mask covers the texts of the span's own assistant turns and nothing that is repeated, so each
is a target once.

A turn is written `<s>role[INST]text[/INST]</s>`. Each of these four strings, where it stands in a
role or text, gets a backslash behind its first character, one more than it has; reading back takes
one away. Texts are never cut.

Conversations are dealt by conv_id and part, a part being PART_TURNS turn numbers: windows don't
cross its borders, so a conversation of any length is spread. History reaches back over a border by
as many turn numbers as `history` tokens can hold turns. Texts are shuffled once.

Null roles and texts are empty; null turns come first; rows of one turn go by role and text, and
repeated rows are turns of their own. A null conv_id is a conversation. A table without rows gives
no windows. Columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Tokens of a window, and of the turns repeated at its start.
BUDGET, HISTORY = 2048, 256
#: Tokens that the marks of a turn take.
TURN_TOKENS = 4
#: Turn numbers of a part.
PART_TURNS = 10_000
#: Rows whose texts are targets.
TARGET = "assistant"

BEGIN, TEXT, END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = r"(<)(\\*)(/?s>)|(\[)(\\*)(/?INST\])"
_CUT = r"\[/INST\]</s>|\[INST\]|<s>"


def token_count(text: str) -> Column:
    """Words and other visible characters, one token each."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"))


def escape(text: Column | str) -> Column:
    """One backslash more in every control string: then none is left bare."""
    return F.regexp_replace(text, _CONTROL, r"$1$4\\$2$5$3$6")


def unescape(text: Column | str) -> Column:
    return F.regexp_replace(text, r"(<)\\(\\*)(/?s>)|(\[)\\(\\*)(/?INST\])", "$1$4$2$5$3$6")


def _parts(turns: DataFrame, history: int) -> DataFrame:
    """Rows by conv_id and part: kind 1 the part's own, 0 turns before its border, -1 a mark that earlier parts exist, with the system turn if there is one."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    part = F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-(2**62)))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text")).withColumn("part", part)
    tokens = (token_count("text") + token_count("role") + TURN_TOKENS).cast("long")

    reach = history // TURN_TOKENS + 1
    near = F.col("turn") - F.col("part") * PART_TURNS >= PART_TURNS - reach
    kinds = F.when(near, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(1)))
    own = rows.withColumn("kind", F.explode(kinds)).withColumn("part", F.when(F.col("kind") == 0, F.col("part") + 1).otherwise(F.col("part")))

    conv = Window.partitionBy("conv_id")
    known = rows.groupBy("conv_id", "part").agg(F.min(F.struct("turn", "role")).alias("head"))
    later = known.select("conv_id", "part", F.min("head").over(conv).alias("head"), F.min("part").over(conv).alias("first")).where("part > first")
    later = later.select(F.col("conv_id").alias("c"), "part", F.col("head.turn").alias("t"), F.col("head.role").alias("r"))
    system = rows.where("role = 'system'").select("conv_id", "turn", "text")
    match = F.col("c").eqNullSafe(F.col("conv_id")) & F.col("t").eqNullSafe(F.col("turn")) & (F.col("r") == "system")
    marks = later.join(system, match, "left").groupBy("c", "part").agg(F.min("t").alias("turn"), F.min(F.when(match, F.struct("text"))).alias("found"))
    marks = marks.select(
        F.col("c").alias("conv_id"), "turn", F.when(F.col("found").isNotNull(), "system").alias("role"), F.coalesce("found.text", F.lit("")).alias("text"), "part", F.lit(-1).alias("kind")
    )
    # a part of borrowed turns alone has no windows
    return own.unionByName(marks).repartition("conv_id", "part").withColumn("tokens", tokens)


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, part and span (their order is the conversation's), formatted, n_tokens, n_repeated (turns at the start that are repeated) and loss, an array of (start, end) in code points of formatted, end exclusive."""
    key = ["conv_id", "part"]
    w = Window.partitionBy(*key).orderBy("kind", "turn", "role", "text")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    kind, counted = F.col("kind"), F.when(F.col("kind") >= 0, F.col("tokens")).otherwise(0)
    rows = _parts(turns, history).select(
        "*",
        F.row_number().over(w).alias("pos"),
        (F.sum(counted).over(upto) - counted).alias("at"),
        F.sum(F.when(kind == 0, F.col("tokens")).otherwise(0)).over(upto).alias("borrowed"),
        F.first(F.struct("role", "turn", "tokens")).over(upto).alias("head"),
        F.first("text").over(upto).alias("head_text"),
    )
    has_system = F.coalesce(F.col("head.role") == "system", F.lit(False))
    room = F.lit(budget - history) - F.when(has_system, F.col("head.tokens")).otherwise(0)
    half = F.greatest(F.floor(room / 2), F.lit(1))
    span = 2 * F.floor((F.col("at") - F.col("borrowed")) / half) + F.when(F.col("tokens") > half, 1).otherwise(0)
    rows = rows.withColumns({"system": has_system, "span": F.when(kind == 1, span)})
    opens = (kind == 1) & ~F.col("span").eqNullSafe(F.lag("span").over(w))
    rows = rows.withColumn("again", opens & F.col("system") & (F.col("pos") > 1))
    is_system = F.col("system") & (kind >= 0) & (F.col("role") == "system") & F.col("turn").eqNullSafe(F.col("head.turn")) & ((F.col("pos") == 1) | (kind == 0))
    rows = rows.select(*key, "pos", "role", "text", "tokens", "at", "span", "again", is_system.alias("is_system"), F.when(F.col("again"), F.col("head_text")).alias("system_text"), F.when(F.col("again"), F.col("head.tokens")).alias("system_tokens"), "kind").where("kind >= 0")

    # a turn belongs to the history of every span that begins up to `history` tokens after its own beginning
    onward = Window.partitionBy(*key).orderBy("at").rangeBetween(0, history)
    following = F.filter(F.collect_set("span").over(onward), lambda s: F.col("span").isNull() | (s > F.col("span")))
    rows = rows.withColumn("following", F.when(~F.col("is_system"), following))
    none = F.array().cast("array<struct<span:bigint,repeated:boolean,system:boolean>>")
    use = lambda s, repeated, system: F.struct(s.alias("span"), F.lit(repeated).alias("repeated"), F.lit(system).alias("system"))
    uses = F.concat(
        F.when(F.col("again"), F.array(use(F.col("span"), True, True))).otherwise(none),
        F.when(F.col("kind") == 1, F.array(use(F.col("span"), False, False))).otherwise(none),
        F.coalesce(F.transform("following", lambda s: use(s, True, False)), none),
    )
    used = rows.withColumn("use", F.explode(uses))
    of_system = F.col("use.system")
    turn = F.struct(
        F.when(of_system, 0).otherwise(F.col("pos")).alias("pos"),
        F.col("use.repeated").alias("repeated"),
        F.when(of_system, "system").otherwise(F.col("role")).alias("role"),
        F.when(of_system, F.col("system_text")).otherwise(F.col("text")).alias("text"),
    )
    grouped = used.groupBy(*key, F.col("use.span").alias("span")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"), F.sum(F.when(of_system, F.col("system_tokens")).otherwise(F.col("tokens"))).alias("n_tokens")
    )
    written = F.transform("turns", lambda t: F.struct(t["repeated"].alias("repeated"), t["role"].alias("role"), escape(t["role"]).alias("r"), escape(t["text"]).alias("t")))
    grouped = grouped.withColumn("turns", written)
    begin = lambda t: F.lit(len(BEGIN + TEXT)) + F.char_length(t["r"])
    masked = lambda t: ~t["repeated"] & (t["role"] == TARGET)
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))
    loss = F.aggregate(
        "turns",
        empty,
        lambda s, t: F.struct(
            (s["at"] + begin(t) + F.char_length(t["t"]) + len(END + CLOSE)).alias("at"),
            F.when(masked(t), F.concat(s["loss"], F.array(F.struct((s["at"] + begin(t)).alias("start"), (s["at"] + begin(t) + F.char_length(t["t"])).alias("end"))))).otherwise(s["loss"]).alias("loss"),
        ),
    )["loss"]
    return grouped.select(
        *key, "span", F.array_join(F.transform("turns", lambda t: F.concat(F.lit(BEGIN), t["r"], F.lit(TEXT), t["t"], F.lit(END + CLOSE))), "").alias("formatted"),
        "n_tokens", F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"), loss.alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Windows with what their text says: turns, an array of (role, text) without the repeated ones, and targets, the texts under the loss mask; all unescaped."""
    cut = F.split("formatted", _CUT)
    n = F.floor((F.size("cut") - 1) / 3).cast("int")
    one = lambda k: F.struct(unescape(F.get("cut", 3 * k + 1)).alias("role"), unescape(F.get("cut", 3 * k + 2)).alias("text"))
    fresh = F.when(n > F.col("n_repeated"), F.transform(F.sequence(F.col("n_repeated"), n - 1), one)).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    under = F.transform("loss", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumn("cut", cut).withColumns({"turns": fresh, "targets": under}).drop("cut")
