"""Operator 9, chat formatting: conversations as budgeted, turn-aligned windows.

A window holds the system turn, a little repeated history and new turns, within a
token budget. Only new assistant turns carry loss; whatever is repeated is masked.
Only DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import let, llm_query, table

#: The template's marks, and the control strings of other common templates.
START, HEAD, END = "<|start|>", "<|head|>", "<|end|>"
#: A control string is opened by < or [; blanks of escape (backslashes) go between opener and rest.
CONTROL = "([<\\[])(\\\\*)(\\||/?s>|/?INST\\]|/?SYS>|<SYS>)"
ESCAPED = "([<\\[])\\\\(\\\\*)(\\||/?s>|/?INST\\]|/?SYS>|<SYS>)"


@dataclass(frozen=True)
class Budget:
    """Tokens per window, and how many of them are set aside for the system turn and history.

    A system turn over ``system_tokens`` is repeated whole as any other; what it has
    more is taken off the window's budget for new turns.
    ``history_turns`` turns before a window are repeated as long as they fit into
    ``history_tokens``. A single turn longer than what is left is not cut: it is a
    window by itself, marked ``over_budget``.
    """

    window_tokens: int = 1024
    system_tokens: int = 128
    history_tokens: int = 192
    history_turns: int = 2

    @property
    def new_tokens(self) -> int:
        return self.window_tokens - self.system_tokens - self.history_tokens

    def cell_tokens(self, system: Column) -> Column:
        """``new_tokens``, less what a system turn of so many tokens has over ``system_tokens``; 1 at least."""
        over = F.greatest(F.coalesce(system, F.lit(0)) - self.system_tokens, F.lit(0))
        return F.greatest(F.lit(self.new_tokens) - over, F.lit(1)).cast("long")


BUDGET = Budget()


def escape(text: Column) -> Column:
    """Put one backslash into every control string, so that none is left in the text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    """Undo ``escape``: take one backslash out again."""
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def turn_tokens(text: Column) -> Column:
    """An upper estimate without a tokenizer: a token for four bytes, and four for the marks."""
    return (F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4) + 4).cast("long")


def chat_windows(conversations: DataFrame, budget: Budget = BUDGET) -> DataFrame:
    """Format conversations (conv_id, turn, role, text) as training windows.

    One row per window: conv_id, window (0, 1, ...), n_repeated (turns of system
    and history at its start), n_turns, n_tokens, over_budget, formatted, and
    loss_spans: start and end (code points, zero-based, end exclusive) in
    ``formatted`` of each assistant text that is new in this window.

    Rows are ordered by turn, then role and text, so ties and repeated rows have
    one order and all are kept; a null turn comes first, a null role or text is
    empty, rows with a null conv_id are one conversation. The system turn is a
    first turn with role system. Other columns are ignored. No rows give no rows.

    Prefix sums of tokens decide: the tokens before and after a turn fall into
    cells of ``new_tokens``; a turn inside a cell joins the others there, a turn
    across a cell border is a window of its own. The whole system turn opens every
    window, and the cells of a conversation are smaller where it is longer than
    ``system_tokens``. So no window exceeds the budget, unless one new turn does
    with what is repeated before it; such windows are ``over_budget``.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("tokens", turn_tokens(F.concat("role", "text")))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"place": F.row_number().over(order), "after": F.sum("tokens").over(upto)})
    is_system = (F.col("place") == 1) & (F.col("role") == "system")
    system = F.first(F.when(is_system, F.struct("role", "text", "tokens"))).over(upto)
    rows = rows.withColumn("system", system)
    cell = lambda c: F.floor(c / budget.cell_tokens(F.col("system.tokens")))
    # A long system turn has its own part of the budget: it is not counted in the cells and goes with the turn after it.
    rows = rows.withColumn("long", F.when(F.col("system.tokens") > budget.system_tokens, F.col("system.tokens")).otherwise(F.lit(0)))
    upto_here = F.col("after") - F.col("long")
    first, last = cell(upto_here - F.col("tokens")), cell(upto_here - 1)
    rows = rows.withColumn("span", F.when(first == last, 2 * first).otherwise(2 * first + 1))
    rows = rows.withColumn("span", F.when(is_system & (F.col("long") > 0), F.coalesce(F.lead("span").over(order), F.lit(0))).otherwise(F.col("span")))
    rows = rows.withColumns({
        "starts": F.coalesce(F.lag("span").over(order) != F.col("span"), F.lit(True)),
        **{f"span{k}": F.lead("span", k).over(order) for k in range(1, budget.history_turns + 1)},
        **{f"tokens{k}": F.lead("tokens", k).over(order) for k in range(1, budget.history_turns)},
    }).withColumn("system", F.when(F.col("starts") & (F.col("place") > 1), F.col("system")))
    # A row goes out as itself, as history of a window that starts soon after it, and the first of a window brings the system turn.
    copies = [
        F.when(F.col("system").isNotNull(), F.struct(F.lit(-1).alias("place"), F.col("span"), F.lit(1).alias("again"), F.col("system.role").alias("role"),
                                                        F.col("system.text").alias("text"), F.col("system.tokens").alias("tokens"))),
        F.struct("place", "span", F.lit(0).alias("again"), "role", "text", "tokens"),
    ]
    before = F.col("span")
    held = F.col("tokens")
    for k in range(1, budget.history_turns + 1):
        here = F.col(f"span{k}")
        copies.append(F.when(
            here.isNotNull() & (here != before) & (held <= budget.history_tokens) & ~is_system,
            F.struct("place", here.alias("span"), F.lit(1).alias("again"), "role", "text", "tokens"),
        ))
        before = here
        if k < budget.history_turns:
            held = held + F.coalesce(f"tokens{k}", F.lit(0))
    spread = rows.select("conv_id", F.explode(F.filter(F.array(*copies), lambda c: c.isNotNull())).alias("c")).select("conv_id", "c.*")
    opened = F.concat(F.lit(START), _role_out(F.col("role")), F.lit(HEAD))
    spread = spread.withColumns({"head": opened, "body": escape(F.col("text"))}).withColumn(
        "loss", (F.col("role") == "assistant") & (F.col("again") == 0))
    windows = spread.groupBy("conv_id", "span").agg(
        F.sort_array(F.collect_list(F.struct("place", "role", "head", "body", "loss", "again", "tokens"))).alias("turns"))
    return windows.select(
        "conv_id",
        (F.row_number().over(Window.partitionBy("conv_id").orderBy("span")) - 1).alias("window"),
        F.size(F.filter("turns", lambda t: t["again"] == 1)).alias("n_repeated"),
        F.size("turns").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        _spans(F.col("turns")).alias("loss_spans"),
    ).withColumn("over_budget", F.col("n_tokens") > budget.window_tokens)


def _spans(turns: Column) -> Column:
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(a, t):
        start = a["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(t["loss"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda a: a["spans"])


def _role_out(role: Column) -> Column:
    for plain, code in (("%", "%25"), ("<", "%3C"), ("[", "%5B")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _role_back(role: Column) -> Column:
    for plain, code in (("[", "%5B"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _quoted(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from formatted windows: the contract's digest columns."""
    body = F.substring("formatted", F.lit(len(START) + 1), F.length("formatted") - len(START) - len(END))
    marked = F.split(body, _quoted(END + START), -1)
    new = F.slice(marked, F.col("n_repeated") + 1, F.size(marked))
    told = F.transform(new, lambda t: let(F.split(t, _quoted(HEAD), 2), lambda p: F.concat(
        _role_back(p[0]), F.lit("\n"), unescape(p[1]), F.lit("\n"))))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    per_window = windows.select(
        "conv_id", "window", F.size(new).alias("n"), F.array_join(told, "").alias("told"),
        F.array_join(loss, "").alias("loss"), F.length("formatted").alias("chars"))
    whole = per_window.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "told", "loss"))).alias("w"))
    text = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(text("told"), 256).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"), F.sha2(text("loss"), 256).alias("loss_sha256"), "formatted_chars")


_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
a AS (SELECT *, CAST(ceil(octet_length(encode(role || text)) / 4) + 4 AS BIGINT) AS tokens,
    length(text) + length(regexp_extract_all(text, '([<\\[])(\\\\*)(\\||/?s>|/?INST\\]|/?SYS>|<SYS>)'))
    + length(role) + 2 * (length(role) - length(translate(role, '%<[', ''))) + {len(START + HEAD + END)} AS chars FROM c),
b AS (SELECT *, row_number() OVER w AS place, sum(tokens) OVER (w ROWS UNBOUNDED PRECEDING) AS upto FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, place = 1 AND role = 'system' AS is_sys, first_value(CASE WHEN role = 'system' THEN tokens END) OVER w AS held,
    first_value(CASE WHEN role = 'system' THEN chars END) OVER w AS sys FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
l AS (SELECT *, CASE WHEN held > {BUDGET.system_tokens} THEN held ELSE 0 END AS long,
    greatest({BUDGET.new_tokens} - greatest(coalesce(held, 0) - {BUDGET.system_tokens}, 0), 1) AS cell FROM p),
s AS (SELECT *, (upto - long - tokens) // cell AS x, (upto - long - 1) // cell AS y FROM l),
f AS (SELECT *, CASE WHEN x = y THEN 2 * x ELSE 2 * x + 1 END AS own FROM s),
g AS (SELECT *, CASE WHEN is_sys AND long > 0 THEN coalesce(lead(own) OVER w, 0) ELSE own END AS span FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
n AS (SELECT *, coalesce(lag(span) OVER w <> span, TRUE) AS starts, lead(span, 1) OVER w AS s1, lead(span, 2) OVER w AS s2, lead(tokens, 1) OVER w AS t1
    FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY place))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars + CASE WHEN starts AND place > 1 THEN coalesce(sys, 0) ELSE 0 END
        + CASE WHEN s1 <> span AND tokens <= {BUDGET.history_tokens} AND NOT is_sys THEN chars ELSE 0 END
        + CASE WHEN s2 <> s1 AND tokens + t1 <= {BUDGET.history_tokens} AND NOT is_sys THEN chars ELSE 0 END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id"""


@llm_query("op9_chat_formatting", _SQL)
def op9_chat_formatting(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(said).alias("text"))
        for k, role in enumerate(("user", "assistant"))])).alias("c")).select("c.*")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(chat_windows(turns.unionByName(extra)))
