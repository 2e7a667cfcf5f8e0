"""Chat formatting with budgeted windows, in DataFrame functions only.

A turn is written as `<turn:ROLE>TEXT</turn>`. In roles and texts the characters
that control strings are made of (`&`, `<`, `>`, `[`, `]`) are replaced by
entities, so no text can spell a control string and unescaping restores it.

A conversation becomes one or more windows. Prefix sums of turn tokens choose
spans of whole turns that fit the budget; each window repeats the leading system
turn and as much of the turns before it as the history budget holds; repeated
turns are outside the loss mask, so each target is learned once.

The prefix sums of tokens and of written characters are made by one window function,
so the work grows with the turns and the windows, not with their product: a window
carries only the turns that it shows, and positions are differences of prefix sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters that control strings use, and their entities.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lsqb;"), ("]", "&rsqb;"))
OPEN, MIDDLE, CLOSE = "<turn:", ">", "</turn>"
MARKS = len(OPEN) + len(MIDDLE) + len(CLOSE)
#: Tokens of a window, and of the earlier turns that it repeats.
BUDGET, HISTORY = 2048, 256
TARGET_ROLE = "assistant"
SYSTEM_ROLE = "system"
#: A token as budgets count it: a character of a script without blanks, or a run of up
#: to eight other characters that are not white space. It stands in for a tokenizer.
_UNSPACED = (
    r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
)
TOKEN = rf"[{_UNSPACED}]|[^\t\n\x0B\f\r {_UNSPACED}]{{1,8}}"


def escaped(text: Column) -> Column:
    """Text without any control character; `&` first, so that it is reversible."""
    for plain, entity in ENTITIES:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescaped(text: Column) -> Column:
    for plain, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def turn_tokens(text: Column) -> Column:
    """Tokens of a turn as the budget counts them: those of TOKEN, and one for the marks."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long") + 1


def window_starts(turns: Column, room: Column) -> Column:
    """The index of the first turn of each window, from turns with their prefix sums.

    A turn begins a window if the span from the window's first turn through it holds
    more than `room`; a turn longer than that has a window of its own.
    """
    start = F.struct(F.lit(0).cast("long").alias("before"), F.array(F.lit(0)).alias("starts"))

    def step(acc: Column, t: Column) -> Column:
        full = (t["before"] > acc["before"]) & (t["before"] + t["tokens"] - acc["before"] > room)
        begun = F.struct(t["before"].alias("before"), F.concat(acc["starts"], F.array(t["k"])).alias("starts"))
        return F.when(full, begun).otherwise(acc)

    return F.aggregate(turns, start, step)["starts"]


def format_conversations(
    df: DataFrame,
    *,
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens: Column | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row (conv_id, window, formatted, spans) per window of a conversation.

    `spans` describes the turns of a window in order: turn index in the conversation,
    start and length of its escaped role and text in `formatted` (code points, from
    0), whether it is repeated, and whether its text is under the loss mask.

    `tokens` is a column of `df` with real token counts of the texts (null: none), to
    which one is added for the marks; without it they are reckoned by TOKEN. Turns are
    ordered by turn (nulls first), role, text. Null texts and roles are empty; rows with a null conversation id form one conversation; equal
    rows are turns of their own; other columns are not read; an empty table gives no
    windows. A conversation is one training document, so its turns share a row.
    """
    turns = df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        (F.lit(None) if tokens is None else tokens).cast("long").alias("told"),
    )
    reckoned = turn_tokens(F.col("text")) if tokens is None else F.coalesce(F.col("told"), F.lit(0)) + 1
    counted = turns.select(
        "*",
        F.greatest(reckoned, F.lit(1)).cast("long").alias("tokens"),
        (F.length(escaped(F.col("role"))) + F.length(escaped(F.col("text"))) + MARKS).cast("long").alias("chars"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    through = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counted.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("k"),
        escaped(F.col("role")).alias("role"),
        escaped(F.col("text")).alias("text"),
        (F.col("role") == TARGET_ROLE).alias("target"),
        "tokens",
        "chars",
        (F.sum("tokens").over(through) - F.col("tokens")).alias("before"),
        (F.sum("chars").over(through) - F.col("chars")).alias("at"),
    )
    turn = F.struct("k", "role", "text", "target", "tokens", "chars", "before", "at")
    whole = summed.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    first_turn = F.get("turns", F.lit(0))
    lead = F.when(first_turn["role"] == SYSTEM_ROLE, 1).otherwise(0)
    # the system turn and the history leave this much for new turns
    room = F.greatest(F.lit(1), F.lit(budget - history) - F.when(lead == 1, first_turn["tokens"]).otherwise(0))
    cut = whole.select("conv_id", "turns", lead.alias("lead"), window_starts(F.col("turns"), room).alias("starts"))

    def shown(start: Column, window: Column) -> Column:
        """What a window holds: the system turn apart, history and new turns as one slice."""
        end = F.coalesce(F.get("starts", window + 1), F.size("turns"))
        limit = F.get("turns", start)["before"] - history
        # a turn has one token at least, so the history has no more turns than tokens
        low = F.greatest(F.col("lead"), start - history)
        near = F.when(start > low, F.slice("turns", low + 1, start - low)).otherwise(F.slice("turns", 1, 0))
        head = start - F.size(F.filter(near, lambda t: t["before"] >= limit))
        return F.struct(
            window.alias("window"),
            start.alias("first"),
            F.when((F.col("lead") == 1) & (start > 0), F.slice("turns", 1, 1)).otherwise(F.slice("turns", 1, 0)).alias("led"),
            F.slice("turns", head + 1, end - head).alias("own"),
        )

    windows = cut.select("conv_id", F.explode(F.transform("starts", shown)).alias("w")).select("conv_id", "w.*")
    head = F.coalesce(F.get("led", F.lit(0))["chars"], F.lit(0).cast("long"))
    base = F.get("own", F.lit(0))["at"]

    def span(t: Column, at: Column) -> Column:
        again = t["k"] < F.col("first")
        role, text = F.length(t["role"]).cast("long"), F.length(t["text"]).cast("long")
        return F.struct(
            t["k"].alias("turn"),
            (at + len(OPEN)).alias("role_start"),
            role.alias("role_length"),
            (at + len(OPEN) + role + len(MIDDLE)).alias("text_start"),
            text.alias("text_length"),
            again.alias("repeated"),
            (~again & t["target"]).alias("loss"),
        )

    spans = F.concat(
        F.transform("led", lambda t: span(t, F.lit(0).cast("long"))),
        F.transform("own", lambda t: span(t, t["at"] - base + head)),
    )
    written = F.transform(
        F.concat("led", "own"),
        lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE)),
    )
    return windows.select("conv_id", "window", F.array_join(written, "").alias("formatted"), spans.alias("spans"))


def read_back(windows: DataFrame) -> DataFrame:
    """What the formatted windows of each conversation hold.

    (conv_id, n_turns, turns array<struct<role, text>>, targets array<string>,
    formatted_chars): every turn once, from the window where it is not repeated, cut
    out of `formatted` by its span and unescaped; targets are the texts under the
    loss mask.
    """
    cut = windows.withColumn(
        "own",
        F.transform(
            F.filter("spans", lambda s: ~s["repeated"]),
            lambda s: F.struct(
                s["turn"].alias("turn"),
                unescaped(F.substring(F.col("formatted"), (s["role_start"] + 1).cast("int"), s["role_length"].cast("int"))).alias("role"),
                unescaped(F.substring(F.col("formatted"), (s["text_start"] + 1).cast("int"), s["text_length"].cast("int"))).alias("text"),
                s["loss"].alias("loss"),
            ),
        ),
    )
    gathered = cut.groupBy("conv_id").agg(
        F.array_sort(F.flatten(F.collect_list("own"))).alias("own"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
    )
    return gathered.select(
        "conv_id",
        F.size("own").cast("long").alias("n_turns"),
        F.transform("own", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        F.transform(F.filter("own", lambda t: t["loss"]), lambda t: t["text"]).alias("targets"),
        "formatted_chars",
    )


def _sql_escaped(text: str) -> str:
    for plain, entity in ENTITIES:
        text = f"replace({text}, '{plain}', '{entity}')"
    return text


def chat_sql(budget: int = BUDGET, history: int = HISTORY) -> str:
    """DuckDB SQL for the query over `conversations` and one more that spells control strings."""
    return f"""
WITH RECURSIVE talks AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM talks
), counted AS (
  SELECT *, row_number() OVER w - 1 AS k, 1 + len(regexp_extract_all(text, '{TOKEN}')) AS n,
    length({_sql_escaped('role')}) + length({_sql_escaped('text')}) + {MARKS} AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY k) - n AS before FROM counted
), heads AS (
  SELECT conv_id, role = '{SYSTEM_ROLE}' AS led, chars AS led_chars,
    greatest(1, {budget - history} - CASE WHEN role = '{SYSTEM_ROLE}' THEN n ELSE 0 END) AS room
  FROM summed WHERE k = 0
), windows AS (
  SELECT conv_id, 0::BIGINT AS first FROM heads
  UNION ALL
  SELECT w.conv_id, min(s.k) FROM windows w JOIN heads h USING (conv_id)
  JOIN summed b ON b.conv_id = w.conv_id AND b.k = w.first
  JOIN summed s ON s.conv_id = w.conv_id AND s.k > w.first AND s.before + s.n - b.before > h.room
  GROUP BY w.conv_id, w.first
), repeated AS (
  SELECT w.conv_id, w.first, coalesce(sum(s.chars), 0) + CASE WHEN any_value(h.led) THEN any_value(h.led_chars) ELSE 0 END AS chars
  FROM windows w JOIN heads h USING (conv_id) JOIN summed b ON b.conv_id = w.conv_id AND b.k = w.first
  LEFT JOIN summed s ON s.conv_id = w.conv_id AND s.k >= h.led::INT AND s.k < w.first AND b.before - s.before <= {history}
  WHERE w.first > 0 GROUP BY w.conv_id, w.first
), more AS (SELECT conv_id, sum(chars) AS chars FROM repeated GROUP BY conv_id)
SELECT s.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = '{TARGET_ROLE}'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = '{TARGET_ROLE}'), '')) AS loss_sha256,
  CAST(sum(s.chars) + coalesce(any_value(m.chars), 0) AS BIGINT) AS formatted_chars
FROM summed s LEFT JOIN more m ON m.conv_id IS NOT DISTINCT FROM s.conv_id GROUP BY s.conv_id
"""
