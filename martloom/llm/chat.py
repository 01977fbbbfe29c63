r"""Chat formatting by a grammar round trip, in DataFrame functions alone.

The template writes each turn as ``### role: text</turn>`` and a line end. Its control strings are ``### ``, which opens a
turn, ``</turn>``, which ends one, and within a role ``: ``, which ends the role. A deterministic parser reads a formatted
text back by cutting it at the control strings, and takes one backslash out of each run of backslashes that follows the first
character of what would otherwise be a control string (``<\/turn>`` is the text ``</turn>``, ``<\\/turn>`` is ``<\/turn>``).

Each turn is rendered as it is, reparsed and compared with its source. Where they differ, one control string after the
other is escaped until they are identical; texts without conflicts stay as they are. A turn that parses alone to just
itself ends at its first ``</turn>`` and holds no other ``### ``, so a row of such turns parses to just those turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import col

TURN, END, COLON = "### ", "</turn>", ": "
# The role whose texts are learnt.
LEARNT = "assistant"


def _runs(control: str) -> str:
    """Pattern of a control string with any backslashes behind its first character."""
    return rf"{control[0]}(\\*){control[1:]}"


def _escape(text: Column, control: str) -> Column:
    return F.regexp_replace(text, _runs(control), rf"{control[0]}\\$1{control[1:]}")


def _unescape(text: Column, controls: tuple[str, ...]) -> Column:
    for control in controls:
        text = F.regexp_replace(text, rf"{control[0]}\\(\\*){control[1:]}", f"{control[0]}$1{control[1:]}")
    return text


def _parse_turn(piece: Column) -> Column:
    """A turn from what follows its ``### ``: role and text, or null if it isn't one turn with its end."""
    head = F.instr(piece, COLON)
    size = F.char_length(piece)
    body = F.substr(piece, head + len(COLON), size - head - (len(COLON) + len(END)))
    # The first end is the last thing in the piece, and the role ends before it.
    whole = piece.endswith(END + "\n") & (F.instr(piece, END) == size - len(END)) & (head > 0) & (head <= size - (len(END) + 2))
    return F.when(
        whole,
        F.struct(
            _unescape(F.substr(piece, F.lit(1), head - 1), (TURN, END, COLON)).alias("role"),
            _unescape(body, (TURN, END)).alias("text"),
        ),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as an array of role and text; null if it doesn't follow the grammar."""
    pieces = F.split(formatted, TURN)
    turns = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), _parse_turn)
    return F.when((pieces[0] == "") & ~F.exists(turns, F.isnull), turns)


def _render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(TURN), role, F.lit(COLON), body, F.lit(END + "\n"))


def _until_identical(turns: DataFrame, made: str, source: str, controls: tuple[str, ...], alone) -> DataFrame:
    """Escape ``made`` for one control string after the other, as long as it doesn't read back as ``source``."""
    turns = turns.withColumn(made, col(source))
    for control in controls:
        same = F.coalesce(alone(col(made)), F.lit(False))
        turns = turns.withColumn(made, F.when(same, col(made)).otherwise(_escape(col(made), control)))
    return turns


def format_turns(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` with the rendered turn and how much of it stands before, in and behind its text.

    Adds ``rendered``, ``before``, ``body``, ``behind`` (code points). Raises if a turn doesn't read back as its source.
    """
    turns = rows.select("conv_id", "turn", *[F.coalesce(col(c), F.lit("")).alias(c) for c in ("role", "text")])

    def one_turn(role: Column, text: Column, field: str, wanted: Column) -> Column:
        found = parse(_render(role, text))
        return (F.size(found) == 1) & (found[0][field] == wanted)

    turns = _until_identical(
        turns, " head", "role", (END, TURN, COLON), lambda made: one_turn(made, F.lit(""), "role", F.col("role"))
    )
    turns = _until_identical(turns, " body", "text", (END, TURN), lambda made: one_turn(F.lit("x"), made, "text", F.col("text")))
    turns = turns.withColumn(" whole", _render(col(" head"), col(" body")))
    found = parse(col(" whole"))
    identical = (F.size(found) == 1) & (found[0]["role"] == F.col("role")) & (found[0]["text"] == F.col("text"))
    checked = F.when(F.coalesce(identical, F.lit(False)), col(" whole")).otherwise(
        F.raise_error(F.concat(F.lit("a turn does not read back: "), F.col("role")))
    )
    return turns.select(
        "conv_id", "turn", "role", "text", checked.alias("rendered"),
        (F.char_length(col(" head")) + len(TURN) + len(COLON)).alias("before"),
        F.char_length(col(" body")).alias("body"), F.lit(len(END) + 1).alias("behind"),
    )


def format_chats(rows: DataFrame) -> DataFrame:
    r"""One training text per conversation: ``conv_id, formatted, loss_mask``.

    ``rows`` has ``conv_id, turn, role, text``; other columns are left out. Turns stand in the order of ``turn``, null
    first; rows of one turn in that of role and text, repeated rows each time. Null roles and texts count as empty, rows
    without ``conv_id`` are one conversation, an empty table gives none. ``loss_mask`` has an entry for each turn: how many
    code points come before the learnt ones (``skip``), how many are learnt (``take``) and how many follow (``rest``).

    A conversation is one value of the result, so it must fit into one; longest texts are rendered before they are
    gathered, and nothing is gathered across conversations.
    """
    learnt = F.col("role") == LEARNT
    mask = F.struct(
        F.when(learnt, F.col("before")).otherwise(F.col("before") + F.col("body") + F.col("behind")).alias("skip"),
        F.when(learnt, F.col("body")).otherwise(0).alias("take"),
        F.when(learnt, F.col("behind")).otherwise(0).alias("rest"),
    )
    turn = F.struct("turn", "role", "text", "rendered", mask.alias("mask"))
    # The rendered turn follows from role and text, so it needs no place in the order.
    ordered = format_turns(rows).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return ordered.select(
        "conv_id", F.array_join("turns.rendered", "").alias("formatted"), F.col("turns.mask").alias("loss_mask")
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """Turns and learnt texts as the formatted texts have them: ``conv_id, formatted, turns, learnt``.

    ``turns`` comes from the parser, ``learnt`` from the mask. Raises if a text doesn't follow the grammar or its mask
    doesn't cover it.
    """
    pieces = F.split("formatted", TURN)
    covered = F.size(pieces) == F.size("loss_mask") + 1
    # The mask counts from the start of each turn, so its texts are cut out of short pieces.
    under = F.transform(
        F.zip_with(F.slice(pieces, 2, F.size("loss_mask")), "loss_mask", lambda p, m: F.struct(p.alias("p"), m.alias("m"))),
        lambda z: F.when(
            F.char_length(z["p"]) + len(TURN) == z["m"]["skip"] + z["m"]["take"] + z["m"]["rest"],
            F.substr(z["p"], z["m"]["skip"] + (1 - len(TURN)), z["m"]["take"]),
        ),
    )
    found = chats.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), F.when(covered, under).alias(" under"))
    fits = F.col("turns").isNotNull() & col(" under").isNotNull() & ~F.exists(col(" under"), F.isnull)
    refused = F.raise_error(F.concat(F.lit("not a formatted conversation: "), F.col("conv_id").cast("string")))
    return found.select(
        "conv_id", "formatted", F.when(fits, F.col("turns")).otherwise(refused).alias("turns"),
        F.transform(col(" under"), lambda t: _unescape(t, (TURN, END))).alias("learnt"),
    )
