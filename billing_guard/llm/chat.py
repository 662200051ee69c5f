r"""Chat formatting by grammar round trip.

A conversation is rendered as turns with marks (the grammar below), reparsed with a
deterministic parser, and the recovered turns are compared with the source.  Turns whose
text conflicts with the grammar (or reads differently afterwards) are escaped, and the
text is rendered and compared again, until the two are identical.

    conversation = { turn }
    turn         = "[INST] " text " [/INST]"               user
                 | "<<SYS>>" text "<</SYS>>"               system
                 | "[ROLE]" role "[/ROLE]" text "</s>"     any other role
                 | text "</s>"                             assistant

A text holds no control string.  Escaping puts a backslash behind the first character of
every control string, and one more where backslashes stand there already (``</s>`` becomes
``<\/s>``, ``<\/s>`` becomes ``<\\/s>``); the parser takes one away.  So escaping is
reversible for every text, and texts without such strings stay as they are.

Scale: rows are range-partitioned by (conversation, turn), so that a conversation of any
length is spread over many tasks.  A task writes parts: consecutive turns of one
conversation, at most PART_TURNS turns or PART_CHARS characters unless one turn is longer.
A part begins and ends at a turn's edge and parses on its own; its position is (place, part).
Parts, their loss masks and their marks are a written table, the operator's output.
Digests read that table back: conversations of one part where they lie, the others
part after part in order (a SHA-256 of one conversation is sequential by definition; it
streams through the parts and holds one at a time).

Edge cases: a NULL text or role is empty; rows of one turn number follow each other by
role, then in an order that a hash of the text fixes (NULL turns first); a NULL conversation id is a conversation of its own; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import written

# --- fixed values: the template ------------------------------------------------------------
USER, SYSTEM, ASSISTANT = "user", "system", "assistant"
OPEN_USER, CLOSE_USER = "[INST] ", " [/INST]"
OPEN_SYSTEM, CLOSE_SYSTEM = "<<SYS>>", "<</SYS>>"
OPEN_ROLE, CLOSE_ROLE = "[ROLE]", "[/ROLE]"
END = "</s>"
#: control strings: no text may hold one unescaped
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
# ---------------------------------------------------------------------------------------------

PART_TURNS = 1_000
PART_CHARS = 2_000_000

_RESTS = "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == "<"), \
    "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == "[")
#: a control string with any number of backslashes behind its first character
_MARKED = re.compile(rf"(<(?=\\*(?:{_RESTS[0]}))|\[(?=\\*(?:{_RESTS[1]})))(\\*)")
_BARE = re.compile("|".join(map(re.escape, CONTROL)))

PARTS = "place int, part int, whole boolean, n_turns long, text string, loss array<struct<start:long,end:long>>"
PART_NAMES = ["place", "part", "whole", "n_turns", "text", "loss"]
Turn = tuple[str, str]


class GrammarError(ValueError):
    """The text is no sentence of the grammar."""


def escape(text: str) -> str:
    return _MARKED.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _MARKED.sub(lambda m: m[1] + m[2][1:], text)


def _render_turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before, in and after a turn."""
    if role == USER:
        return OPEN_USER, text, CLOSE_USER
    if role == SYSTEM:
        return OPEN_SYSTEM, text, CLOSE_SYSTEM
    if role == ASSISTANT:
        return "", text, END
    return f"{OPEN_ROLE}{escape(role)}{CLOSE_ROLE}", text, END


def _until(text: str, at: int, close: str) -> tuple[str, int]:
    """The raw content from ``at`` up to ``close``, which the next control string must belong
    to, and the place behind it."""
    found = _BARE.search(text, at)
    start = found.end() - len(close) if found else -1
    if start < at or not text.startswith(close, start):
        raise GrammarError(f"expected {close!r} after {at}")
    return text[at:start], found.end()


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of all turns; start and end are the raw text's place.

    One look at the beginning of a turn tells its kind, so the parser never goes back.
    """
    turns, at = [], 0
    while at < len(text):
        role, close = ASSISTANT, END
        if text.startswith(OPEN_USER, at):
            role, close = USER, CLOSE_USER
            at += len(OPEN_USER)
        elif text.startswith(OPEN_SYSTEM, at):
            role, close = SYSTEM, CLOSE_SYSTEM
            at += len(OPEN_SYSTEM)
        elif text.startswith(OPEN_ROLE, at):
            raw, at = _until(text, at + len(OPEN_ROLE), CLOSE_ROLE)
            role = unescape(raw)
        raw, end = _until(text, at, close)
        turns.append((role, unescape(raw), at, at + len(raw)))
        at = end
    return turns


def _recovers(rendered: str, turns: list[Turn]) -> list[tuple[str, str, int, int]] | None:
    """The parsed turns if they are the source's."""
    try:
        parsed = parse(rendered)
    except GrammarError:
        return None
    return parsed if [(role, text) for role, text, _, _ in parsed] == turns else None


def format_turns(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns and its loss mask: the assistant's texts."""
    contents = [text for _, text in turns]
    for _ in range(2):
        rendered = ["".join(_render_turn(role, content)) for (role, _), content in zip(turns, contents)]
        whole = "".join(rendered)
        parsed = _recovers(whole, turns)
        if parsed is not None:
            return whole, [(start, end) for role, _, start, end in parsed if role == ASSISTANT]
        contents = [escape(text) if _recovers(one, [(role, text)]) is None else text
                    for one, (role, text) in zip(rendered, turns)]
    raise GrammarError("escaped turns do not read back")  # excluded: escaped texts hold no control string


# --- Spark -----------------------------------------------------------------------------------
def _frame(conv_id: str, rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows that begin with the conversation's id, which may be None and of any type."""
    out = pd.DataFrame([r[1:] for r in rows], columns=names)
    out.insert(0, conv_id, pd.Series([r[0] for r in rows], dtype=object))
    return out


def _parts(conv_id: str):
    """Streams the sorted turns of one range partition into parts."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, turns, chars, number, place, rows = None, [], 0, 0, -1, []

        def close(last: bool):
            nonlocal turns, chars, number
            text, loss = format_turns(turns)
            # the first and the last conversation of a partition may go on in its neighbours
            rows.append((key, place, number, last and number == 0 and not opening, len(turns), text,
                         [{"start": a, "end": b} for a, b in loss]))
            turns, chars, number = [], 0, number + 1

        def out():
            nonlocal rows
            frame, rows = _frame(conv_id, rows, PART_NAMES), []
            return frame

        opening = True
        for batch in batches:
            for conv, role, text, at in zip(batch[conv_id], batch["role"], batch["text"], batch["place"]):
                conv = None if pd.isna(conv) else conv
                if place < 0:
                    key, place = conv, int(at)
                elif conv != key:
                    close(True)
                    key, number, opening = conv, 0, False
                elif len(turns) >= PART_TURNS or chars >= PART_CHARS:
                    close(False)
                turns.append((role or "", text or ""))
                chars += len(turns[-1][1])
            if rows:
                yield out()
        if turns:
            close(False)
            yield out()
    return cut


def format_conversations(conversations: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """The written table of parts: ``conv_id`` and PARTS, in order by (place, part)."""
    rows = conversations.select(conv_id, "turn", "role", "text")
    order = [F.col(c).asc_nulls_first() for c in (conv_id, "turn", "role", "text")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are the same turn said again: where they lie does not matter, so chance deals them
    ranged = (rows.withColumn("tie", F.xxhash64("role", "text")).withColumn("deal", F.rand(13))
              .repartitionByRange(n, F.col(conv_id).asc_nulls_first(), F.col("turn").asc_nulls_first(),
                                  F.col("role").asc_nulls_first(), "tie", "deal")
              .sortWithinPartitions(*order[:3], "tie", F.col("text").asc_nulls_first())
              .select(conv_id, "role", "text", F.spark_partition_id().alias("place")))
    kind = conversations.schema[conv_id].dataType.simpleString()
    return written(ranged.mapInPandas(_parts(conv_id), f"{conv_id} {kind}, {PARTS}"), "chat_parts")


class _Digest:
    """Running digests of one conversation's parts."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, mask) -> None:
        for role, content, _, _ in parse(text):
            self.turns.update(f"{role}\n{content}\n".encode())
            self.n_turns += 1
        for span in mask:
            said = unescape(text[span["start"]:span["end"]])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.chars += len(text)

    def row(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


DIGEST = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
_DIGEST_NAMES = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _digests(conv_id: str):
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for batch in batches:
            rows = []
            for conv, text, mask, whole in zip(batch[conv_id], batch["text"], batch["loss"], batch["whole"]):
                conv = None if pd.isna(conv) else conv
                if digest is not None and (whole or conv != key):
                    rows.append((key, *digest.row()))
                    digest = None
                if digest is None:
                    key, digest = conv, _Digest()
                digest.add(text, mask)
            yield _frame(conv_id, rows, _DIGEST_NAMES)
        if digest is not None:
            yield _frame(conv_id, [(key, *digest.row())], _DIGEST_NAMES)
    return stream


def read_conversations(parts: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``conv_id`` and DIGEST per conversation, parsed from the written parts."""
    kind = parts.schema[conv_id].dataType.simpleString()
    fields = f"{conv_id} {kind}, {DIGEST}"
    columns = [conv_id, "text", "loss", "whole"]
    alone = parts.where("whole").select(*columns).mapInPandas(_digests(conv_id), fields)
    cut = (parts.where("NOT whole").repartition(conv_id)
           .sortWithinPartitions(conv_id, "place", "part").select(*columns)
           .mapInPandas(_digests(conv_id), fields))
    return alone.unionByName(cut)
