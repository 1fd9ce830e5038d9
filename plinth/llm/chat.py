"""Chat formatting by a finite-state machine over roles.

A template declares, for each role, what opens and what closes a turn and whether its
text counts for the loss, and which role may follow which state. The machine reads a
conversation's turns in order: from its state and a turn's role it moves to the next
state and emits the turn's segments, each with a loss flag. So rows of turns become one
formatted string a conversation, its segments, and whether the machine ends in a state
that may end a conversation. Turns are read in blocks, so that appending to what has
been emitted costs little however long a conversation is.

Texts are escaped so that no control string of the template can occur in them: a
backslash is doubled and one is put behind the first character of every control
string. ``parse`` reads roles and texts back exactly.

Defined results: null texts and null roles are empty; rows of a null conv_id form one
conversation; turns go by turn (null first), equal turns by role and text, and repeated
rows stay; a role that the machine doesn't know, or that may not follow, leads to a
state of its own that it never leaves: such a conversation is invalid, yet it is
formatted all the same; an empty table gives no rows; other columns of the input are
not read, so their names cannot clash. A conversation is one row, so one that doesn't
fit a row doesn't fit this format; map-side lists keep its turns from being shuffled
singly, and very long texts are kept whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """open and close hold {role}; moves maps (state, role) to the next state."""

    open: str = "### {role}: "
    close: str = "</turn>\n"
    #: Strings that no escaped text holds, beside close without its line end.
    controls: tuple[str, ...] = ("###", "</turn>", "<|endoftext|>")
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed",
            ("start", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    ends: tuple[str, ...] = ("answered",)


CHAT = Template()
INVALID = "invalid"


def _quoted(s: str) -> str:
    return "".join(c if c.isalnum() or c in " _" else "\\" + c for c in s)


def escape(text: Column, template: Template = CHAT) -> Column:
    """text in which no control string occurs, even where several overlap."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in template.controls:
        out = F.regexp_replace(out, f"{_quoted(control[0])}(?={_quoted(control[1:])})", control[0].replace("$", "\\$") + "\\\\")
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role_out(role: Column) -> Column:
    """Roles are put so that they hold no colon and no line end."""
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    for c in (":", "\n", "<", "#"):
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def _role_in(role: Column) -> Column:
    for c in ("#", "<", "\n", ":", "%"):
        role = F.replace(role, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return role


#: Turns that the machine reads at a stretch before what it emitted is appended to the rest.
STRETCH = 512
_MADE = "struct<state:string,segments:array<struct<text:string,loss:boolean>>>"


def emitted(turn: Column, template: Template = CHAT) -> Column:
    """The segments of one turn, a struct(role, text): opening, text and closing."""
    before, after = template.open.split("{role}")
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.array(
        part(F.concat(F.lit(before), _role_out(turn["role"]), F.lit(after)), F.lit(False)),
        part(escape(turn["text"], template), turn["role"].isin(*template.trained)),
        part(F.lit(template.close), F.lit(False)),
    )


def machine(turns: Column, template: Template = CHAT) -> Column:
    """struct(state, segments): where an array of struct(role, text) leads, and all that is emitted on the way."""
    table = F.create_map(*(F.lit(x) for (s, r), to in template.moves.items() for x in (f"{s}\x1f{r}", to)))
    moved = lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit("\x1f"), role)), F.lit(INVALID))
    made = lambda state, segments: F.struct(state.alias("state"), segments.alias("segments")).cast(_MADE)
    read = lambda m, t: made(moved(m["state"], t["role"]), F.concat(m["segments"], emitted(t, template)))
    nothing = F.array().cast("array<struct<text:string,loss:boolean>>")

    def stretch(m: Column, at: Column) -> Column:
        """The machine led over STRETCH turns more."""
        new = F.aggregate(F.slice(turns, at, F.lit(STRETCH)), made(m["state"], nothing), read)
        return F.get(F.transform(F.array(new), lambda x: made(x["state"], F.concat(m["segments"], x["segments"]))), F.lit(0))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(turns), F.lit(1)), F.lit(STRETCH)), made(F.lit(template.start), nothing), stretch)


def format_chats(rows: DataFrame, template: Template = CHAT, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: conv_id, formatted, segments (text, loss), final_state, valid."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    run = grouped.select("conv_id", machine(F.col("turns"), template).alias("made")).select("conv_id", "made.segments", F.col("made.state").alias("final_state"))
    return run.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments", "final_state", F.col("final_state").isin(*template.ends).alias("valid"))


def parse(formatted: Column, template: Template = CHAT) -> Column:
    """The array of struct(role, text) from which formatted was made."""
    before, after = template.open.split("{role}")
    parts = F.split(formatted, _quoted(template.close).replace("\n", "n"))

    def turn(part: Column) -> Column:
        # the role holds no colon, so the first one ends it
        role = F.substring_index(F.substring(part, F.lit(len(before) + 1), F.length(part)), after, 1)
        return F.struct(_role_in(role).alias("role"), unescape(F.substring(part, F.length(role) + len(before) + len(after) + 1, F.length(part))).alias("text"))

    return F.transform(F.filter(parts, lambda p: p != ""), turn)


def loss_text(segs: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segs, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
