"""Chat formatting: a state machine over roles, a template and loss flags.

The template is data: for each role the control strings before and after a
text and whether the text is trained on. Inside texts the escape character and
the first character of every control string get the escape character in front,
so a control string in a text can never be read as one, and unescaping gives
the text back. Formatting, validation and reading back are Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: role -> (before, after, trained on). Every control string starts with < or [.
TEMPLATE = {
    "system": ("<<SYS>>", "<</SYS>>", False),
    "user": ("[INST]", "[/INST]", False),
    "assistant": ("<s>", "</s>", True),
}
#: Any other role: the role's own name goes into the opening string.
OTHER = ("<role:", ">", "</role>", False)
#: (state, role) -> state; a pair that is missing is an error in turn order.
TURNS = {("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user", ("user", "assistant"): "assistant", ("assistant", "user"): "user"}

ESCAPED = r"([\\<>\[])"
#: An escaped text: no bare control character. Possessive, so no recursion on long texts.
BODY = r"(?:[^\\<>\[]|\\.)*+"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()<>*+-=!?^$|/:" else c for c in s)


def segments_of(turn: Column, template=None) -> Column:
    """The three segments of one turn: before, text, after, each with its loss flag."""
    template = template or TEMPLATE
    role, text = turn["role"], escape(turn["text"])
    part = lambda value, loss: F.struct(value.alias("text"), F.lit(loss).alias("loss"))
    out = F.array(part(F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])), False), part(text, OTHER[3]), part(F.lit(OTHER[2]), False))
    for name, (before, after, loss) in template.items():
        out = F.when(role == name, F.array(part(F.lit(before), False), part(text, loss), part(F.lit(after), False))).otherwise(out)
    return out


def turn_pattern(template=None) -> str:
    """One formatted turn: group 1 all of it, the rest anonymous."""
    kinds = [f"{_quoted(before)}{BODY}{_quoted(after)}" for before, after, _ in (template or TEMPLATE).values()]
    kinds.append(f"{_quoted(OTHER[0])}{BODY}{_quoted(OTHER[1])}{BODY}{_quoted(OTHER[2])}")
    return "(?s)(" + "|".join(kinds) + ")"


def read_back(formatted: Column, template=None) -> Column:
    """Turns (role, text) parsed from the formatted string alone."""
    template = template or TEMPLATE

    def parsed(turn: Column) -> Column:
        role_end = F.regexp_extract(turn, f"(?s)^{_quoted(OTHER[0])}({BODY}){_quoted(OTHER[1])}", 1)
        head = F.length(role_end) + len(OTHER[0]) + len(OTHER[1])
        other = F.struct(unescape(role_end).alias("role"), unescape(F.substring(turn, head + 1, F.length(turn) - head - len(OTHER[2]))).alias("text"))
        for name, (before, after, _) in template.items():
            inner = F.substring(turn, F.lit(len(before) + 1), F.length(turn) - len(before) - len(after))
            other = F.when(F.startswith(turn, F.lit(before)), F.struct(F.lit(name).alias("role"), unescape(inner).alias("text"))).otherwise(other)
        return other

    return F.transform(F.regexp_extract_all(formatted, F.lit(turn_pattern(template)), 1), parsed)


def valid_order(turns: Column) -> Column:
    """True where the state machine reads all roles; an empty list is valid."""

    def step(state: Column, turn: Column) -> Column:
        out = F.lit("error")
        for (before, role), after in TURNS.items():
            out = F.when((state == before) & (turn["role"] == role), F.lit(after)).otherwise(out)
        return out

    return F.aggregate(turns, F.lit("start"), step) != "error"


def format_chats(rows: DataFrame, template=None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, turns, valid, segments, formatted.

    Rows go by turn; equal turns by role, then text; a null turn comes first.
    Null texts and roles count as empty. Conversations in a wrong order are
    formatted too, with valid = false. Repeated rows are turns of their own; rows of a null
    conversation are one conversation; an empty table gives no rows. A conversation is one
    record of the output, so its turns meet in one row, whatever their length. Only the four
    named columns are read, so other columns may have any name.
    """
    template = template or TEMPLATE
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chats = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # collect_list keeps no order; array_sort puts a null field of a struct first
    chats = chats.withColumn("valid", valid_order(F.col("turns")))
    chats = chats.withColumn("segments", F.flatten(F.transform("turns", lambda t: segments_of(t, template))))
    return chats.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def chat_digest(chats: DataFrame, template=None) -> DataFrame:
    """What the formatted output says, read back from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    chats = chats.withColumn("back", read_back(F.col("formatted"), template))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select("conv_id", F.size("back").cast("long").alias("n_turns"), sha(said).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), sha(loss).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid")


CHAT_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, length(text) + length(regexp_replace(text, '[^\\<>\[]', '', 'g')) + case role when 'system' then 15 when 'user' then 13 when 'assistant' then 7 else 14 + length(role) + length(regexp_replace(role, '[^\\<>\[]', '', 'g')) end as n from c)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
 sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
 sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text)) as loss_sha256,
 sum(n)::bigint as formatted_chars,
 regexp_matches(string_agg(case role when 'system' then 's' when 'user' then 'u' when 'assistant' then 'a' else 'x' end, '' order by turn nulls first, role, text), '^(s|s?u(au)*a?)$') as valid
from e group by conv_id
"""
