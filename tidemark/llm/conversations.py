"""Cheapest repair of conversations whose rows are blank, repeated, cut short or out of turn.

Two streams over rows that are sorted within their conversation.  The first one
reads narrow rows (no texts) from the last turn to the first and works out, for
every place and every state of the pattern ``(s?(ua)+)?``, the cheapest edits of
the rest; it keeps two bytes per row.  The second one reads the texts in order
and applies the edits.  Neither holds a conversation's texts.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: States of the pattern, by what was said last: nothing, the system, the user, the assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The only user or assistant turn that a state takes, and the state after it.
EXPECTED = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: Costs of the edits, and of a text that is cut short and stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LETTERS, FAR = "DIKR", 1 << 30
#: Bytes of back pointers held in memory; more of them go to a file of the task, which ends with the conversation.
IN_MEMORY = 1 << 20
#: Rows whose edits travel as one string.
BLOCK = 1 << 15
LEGAL = frozenset(("su", "ua", "au"))
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_WORDLESS, _ENDED = r"^[\x20\x09-\x0D]*\z", r"[.!?][\x20\x09-\x0D]*\z"


def kept_state(state: int, initial: str) -> int | None:
    """The state after a turn that stays as it is; None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    role, after = EXPECTED[state]
    return after if initial == role[0] else None


class Steps:
    """Transitions between vectors of costs, each worked out once.

    A vector holds, for every state, the cost of finishing from it less the least
    of these; they differ by a few edits at most, so there are few vectors.  From a
    state each letter leads to one place only, so the least letter among the
    cheapest ones leads to the least string of letters.
    """

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.names: dict[tuple[int, ...], int] = {}
        self.known: dict[tuple[int, str, bool, bool], tuple[int, int, int]] = {}
        self.end = self._relaxed([0, FAR, FAR, 0], ["", "", "", ""])

    def _relaxed(self, costs: list[int], letters: list[str], system: bool = False) -> tuple[int, int, int]:
        """``(vector, cost taken off it, choices)`` once turns may be inserted before going on."""
        for _ in range(4):
            for state in range(4):
                other = INSERT + costs[EXPECTED[state][1]]
                if (other, "I") < (costs[state], letters[state]):
                    costs[state], letters[state] = other, "I"
        least = min(costs)
        vector = tuple(c - least for c in costs)
        if vector not in self.names:
            self.names[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.names[vector], least, sum(LETTERS.index(c or "D") << 2 * s for s, c in enumerate(letters)) | system << 8

    def before(self, vector: int, initial: str, gone: bool, truncated: bool) -> tuple[int, int, int]:
        """The step over one row, from the vector after it to the one before it; a row that must go is ``gone``."""
        key = vector, initial, gone, truncated
        if key not in self.known:
            after, best, more = self.vectors[vector], [], TRUNCATED if truncated else 0
            for state in range(4):
                ways = [(DELETE + after[state], "D")]
                if not gone:
                    kept = kept_state(state, initial)
                    ways += [(more + after[kept], "K")] if kept is not None else []
                    ways.append((REROLE + more + after[EXPECTED[state][1]], "R"))
                best.append(min(ways))
            self.known[key] = self._relaxed([c for c, _ in best], [w for _, w in best], initial == "s")
        return self.known[key]


class _Backwards:
    """One conversation, read from its last row to its first."""

    def __init__(self, steps: Steps) -> None:
        self.steps, self.spill = steps, tempfile.SpooledTemporaryFile(IN_MEMORY)
        self.vector, self.cost, choice = steps.end
        self.spill.write(struct.pack("<H", choice))
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.turn = self.most = self.least = self.following = None
        self.starts: list[int | None] = []               # turn of the first row of each full block, from the end

    def read(self, turn: int | None, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        self.vector, more, choice = self.steps.before(self.vector, initial, blank or duplicate, truncated)
        self.spill.write(struct.pack("<H", choice))
        self.cost += more
        self.rows += 1
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += self.following is not None and initial + self.following not in LEGAL
        self.following, self.turn = initial, turn
        if turn is not None:
            self.turns += turn != self.least
            self.most, self.least = turn if self.most is None else self.most, turn
        if (self.rows + 1) % BLOCK == 0:
            self.starts.append(turn)

    def report(self) -> tuple[int, ...]:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (min(gaps, 2**63 - 1), self.blank, self.duplicate, self.truncated, self.illegal,
                self.cost + self.steps.vectors[self.vector][NOTHING])

    def edits(self) -> Iterator[tuple[int | None, str]]:
        """``(turn of the block's first row, letters)`` from the first row on; insertions after the last row end the last block."""
        state, left, at, turn = NOTHING, self.rows, self.rows + 1, self.turn
        while at:
            low = (at - 1) // BLOCK * BLOCK
            self.spill.seek(2 * low)
            raw, out = self.spill.read(2 * (at - low)), []
            for (choice,) in reversed(list(struct.iter_unpack("<H", raw))):
                while left or state in (SYSTEM, USER):
                    letter = LETTERS[choice >> 2 * state & 3]
                    out.append(letter)
                    if letter == "K" and choice >> 8:
                        state = SYSTEM
                    elif letter != "D":
                        state = EXPECTED[state][1]
                    if letter != "I":
                        left -= 1
                        break
            yield turn, "".join(out)
            at = low
            turn = self.starts[at // BLOCK - 1] if at else None
        self.spill.close()


_PLAN = "key string, timed boolean, turn long, part long, edits string, " + ", ".join(f"{c} long" for c in REPORT)
_NEW = object()


def _plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits of conversations whose narrow rows arrive from the last to the first, in blocks from the first to the last."""
    steps, now, key, out = Steps(), None, _NEW, []
    for batch in batches:
        for name, timed, turn, *features in zip(*(batch[c].tolist() for c in ("key", "timed", "turn", "initial", "blank", "duplicate", "truncated")),
                                                strict=True):
            if key is _NEW or name != key:
                if now is not None:
                    yield from _blocks(key, now, out)
                key, now = name, _Backwards(steps)
            now.read(turn if timed else None, *features)
    if now is not None:
        yield from _blocks(key, now, out)
    if out:
        yield _frame(out)


def _blocks(key: str | None, done: _Backwards, out: list[tuple]) -> Iterator[pd.DataFrame]:
    report = done.report()
    for part, (turn, edits) in enumerate(done.edits()):
        out.append((key, turn is not None, turn or 0, part, edits, *report))
        if len(out) * 100 + len(edits) > 1_000_000:
            yield _frame(out)
            out.clear()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["key", "timed", "turn", "part", "edits", *REPORT])


class _Forwards:
    """One conversation, whose letters and texts arrive in order."""

    def __init__(self, report: tuple[int, ...]) -> None:
        self.report, self.state, self.letters, self.at = report, NOTHING, deque(), 0
        self.audit: list[str] = []
        self.digest, self.said = hashlib.sha256(), 0

    def add(self, letters: str) -> None:
        self.letters.append(letters)
        self.audit.append(letters)

    def _next(self) -> str:
        while self.letters and self.at == len(self.letters[0]):
            self.letters.popleft()
            self.at = 0
        return self.letters[0][self.at] if self.letters else ""

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self._next() == "I":
            self.at += 1
            role, self.state = EXPECTED[self.state]
            yield self._say("I", role, "")

    def take(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self._next()
        if not letter:
            raise ValueError("the plan belongs to other rows")
        self.at += 1
        if letter == "K":
            self.state = kept_state(self.state, role[:1])
            yield self._say("K", role, text)
        elif letter == "R":
            role, self.state = EXPECTED[self.state]
            yield self._say("R", role, text)

    def _say(self, letter: str, role: str, text: str) -> tuple[str, str, str]:
        self.digest.update(("\n" if self.said else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.said += 1
        return letter, role, text


def _turns(batches: Iterator[pd.DataFrame], texts: bool) -> Iterator[pd.DataFrame]:
    """Repaired turns (``texts``) or a summary of each conversation, from blocks of letters and texts in order."""
    names = ["key", "place", "edit", "role", "text"] if texts else ["key", *REPORT, "audit", "turns", "digest"]
    now, key, out, size = None, _NEW, [], 0

    def said(turns: Iterator[tuple[str, str, str]]) -> None:
        nonlocal size
        for letter, role, text in turns:
            if texts:
                out.append((key, now.said - 1, letter, role, text))
                size += len(text) + 50

    def finish() -> None:
        nonlocal size
        if now is not None:
            said(now.inserted())
            if not texts:
                out.append((key, *now.report, "".join(now.audit), now.said, now.digest.hexdigest()))
                size += sum(map(len, now.audit)) + 200

    for batch in batches:
        for name, edits, role, text, *report in zip(*(batch[c].tolist() for c in ("key", "edits", "role", "text", *REPORT)), strict=True):
            if key is _NEW or name != key:
                finish()
                key, now = name, _Forwards(tuple(int(v) for v in report))
            if edits is not None:
                now.add(edits)
            else:
                said(now.take(role, text))
            if size > 4_000_000:
                yield pd.DataFrame(out, columns=names)
                out.clear()
                size = 0
    finish()
    if out:
        yield pd.DataFrame(out, columns=names)


def _keyed(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return rows.select(F.col(id_col).cast("string").alias("key"), F.col(turn_col).isNotNull().alias("timed"),
                       F.coalesce(F.col(turn_col).cast("long"), F.lit(0).cast("long")).alias("turn"),
                       F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def plans(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The cheapest edits in blocks, with the report of their conversation: one shuffle of rows without texts."""
    narrow = _keyed(rows, id_col, turn_col, role_col, text_col).select(
        "key", "timed", "turn", "role", F.substring("role", 1, 1).alias("initial"), _digest(F.col("text")).alias("digest"),
        F.col("text").rlike(_WORDLESS).alias("blank"), (~F.col("text").rlike(_ENDED)).alias("open"))
    seen = F.row_number().over(Window.partitionBy("key", "role", "digest").orderBy("timed", "turn")) > 1
    marked = (narrow.repartition("key")
              .withColumn("duplicate", seen & ~F.col("blank"))
              .withColumn("truncated", F.col("open") & ~F.col("blank") & ~F.col("duplicate"))
              .sortWithinPartitions("key", F.desc("timed"), F.desc("turn"), F.desc("role"), F.desc("digest"), F.desc("duplicate")))
    return marked.select("key", "timed", "turn", "initial", "blank", "duplicate", "truncated").mapInPandas(_plan, _PLAN)


def _applied(rows: DataFrame, planned: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, texts: bool) -> DataFrame:
    said = _keyed(rows, id_col, turn_col, role_col, text_col).select(
        "key", "timed", "turn", F.lit(0).cast("long").alias("part"), "role", "text", F.lit(None).cast("string").alias("edits"),
        *[F.lit(0).cast("long").alias(c) for c in REPORT])
    blocks = planned.select("key", "timed", "turn", "part", F.lit("").alias("role"), F.lit("").alias("text"), "edits", *REPORT)
    in_order = (blocks.unionByName(said).repartition("key")
                .sortWithinPartitions("key", "timed", "turn", F.col("edits").isNull(), "part", "role", _digest(F.col("text"))))
    schema = ("key string, place long, edit string, role string, text string" if texts else
              "key string, " + ", ".join(f"{c} long" for c in REPORT) + ", audit string, turns long, digest string")
    out = in_order.mapInPandas(lambda batches: _turns(batches, texts), schema)
    kind = rows.schema[id_col].dataType
    return out.select(F.col("key").cast(kind).alias("conversation"), *[c for c in out.columns if c != "key"])


def repaired_turns(rows: DataFrame, planned: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``(conversation, place, edit, role, text)``: the turns of each repaired conversation, numbered from 0.

    ``edit`` is ``K`` (as it was), ``R`` (another role) or ``I`` (inserted, empty text).
    """
    return _applied(rows, planned, id_col, turn_col, role_col, text_col, True)


def repairs(rows: DataFrame, planned: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """One row per conversation: its faults, the cost and letters (``audit``) of its repair, number of turns and their digest.

    Rows count in the order of their turns, null turns first; rows of one turn by
    role, then by the digest of their text.  The first of these faults counts:
    blank (nothing but white space), duplicate (role and text of an earlier row),
    truncated (the last character is none of ``.!?``).  ``illegal`` counts
    neighbours whose initials are not su, ua or au; ``gaps`` the missing whole turns between the
    least and the greatest.  Edits: D takes a row out (4; needed for the blank and
    duplicate), I puts an empty user or assistant turn in (3), K keeps a row, R
    makes it the user's or assistant's (3); a truncated row that stays adds 3.  The
    cheapest edits that give the pattern ``(s?(ua)+)?`` of initials win, the least
    string of letters among equals.  The digest is the SHA-256 of ``role:text``,
    joined by line breaks.

    A null role or text counts as one space; a null id is a conversation of its
    own.  Rows may be repeated; other columns are ignored, whatever their names.
    An empty table gives no rows.  One conversation is one stream in one task, which
    holds two bytes per row (beyond a megabyte in a file of the task) and no texts
    but the batch it reads, however long the conversation; its ``audit`` is one string.
    """
    return _applied(rows, planned, id_col, turn_col, role_col, text_col, False)
