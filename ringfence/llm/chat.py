"""Chat formatting by incremental black-box rendering, with a loss mask.

A template is any function from a list of (role, text) turns to a string.  The
spans of the turns are found by rendering successive prefixes of a conversation
and comparing consecutive outputs: where the output of n turns begins with that of
n - 1, the rest is turn n's span.  Where it doesn't, the template rewrites
history: the conversation is marked with the turn that did it and the length of
the common part, and carries no loss spans, as a mask over moved text would be wrong.
Inside a turn's span, the text's own place is found by rendering the same turn
with an empty text and matching what surrounds it.

Rows are sorted by (conversation, turn) and streamed.  The prefixes are the whole
conversation's, so a task holds its turns, and the work grows with the square of their
number.  A template that is declared ``local`` renders a turn by no more than a few
turns before it: for such a one, and where ``context`` is given, a prefix starts at a
turn less than ``context`` (``CONTEXT``) before, and a task holds that many turns,
never a whole conversation.  The output comes in segments of at most ``SEGMENT`` turns.

Cases: null text or role counts as empty; turns are ordered by turn, role, text
(nulls first), repeated rows are turns each; a null conversation id is a conversation;
long texts are never cut; an empty table gives an empty table; columns other than
the four named ones are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT, SEGMENT = 32, 64

#: Fixed values of the default template.
HEAD, CLOSE, LEARNED = "### ", "</turn>\n", "assistant"

_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|n)")


def escape(text: str) -> str:
    r"""A backslash before each backslash and control string; ``unescape`` takes them away again."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def local(template: Callable) -> Callable:
    """Declares that what a template writes for a turn depends on less than ``CONTEXT // 2`` turns before it."""
    template.local = True
    return template


@local
def render(turns: list[tuple[str, str]]) -> str:
    """The default template: a head line with the role, the escaped text, a closing mark."""
    return "".join(f"{HEAD}{escape(role).replace(chr(10), chr(92) + 'n')}\n{escape(text)}{CLOSE}" for role, text in turns)


_TURN = re.compile(r"### ((?:\\.|[^\\\n])*)\n((?:\\(?:\\|###|</turn>)|(?!</turn>)[^\\])*)</turn>\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a string that ``render`` made."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def place(span: str, bare: str, text: str) -> tuple[int, int] | None:
    """Where in ``span`` the text stands, given the same turn rendered with an empty text."""
    size = len(span) - len(bare)
    for at in range(len(os.path.commonprefix([span, bare])), -1, -1):
        if span[:at] + span[at + size:] == bare and span[at:at + size] == text:
            return at, at + size
    return None


class Renderer:
    """Feeds the turns of one conversation one by one."""

    def __init__(self, template: Callable, mask: Callable[[str], str], context: int | None = None):
        self.template, self.mask = template, mask
        self.context = context or (CONTEXT if getattr(template, "local", False) else None)
        self.turns: list[tuple[str, str]] = []
        self.last = template([])
        self.opening = self.last

    def feed(self, role: str, text: str) -> tuple[str, tuple[int, int] | None, int | None]:
        """(new output, place of the text in it, length of the common part where the template rewrote history)."""
        if self.context and len(self.turns) >= self.context:
            self.turns = self.turns[-(self.context // 2):]
            self.last = self.template(self.turns)
        before = self.turns
        self.turns = [*before, (role, text)]
        out = self.template(self.turns)
        if not out.startswith(self.last):
            kept = len(os.path.commonprefix([out, self.last]))
            self.last = out
            return "", None, kept
        span = out[len(self.last):]
        bare = self.template([*before, (role, "")])
        at = place(span, bare[len(self.last):], self.mask(text)) if bare.startswith(self.last) else None
        self.last = out
        return span, at, None


_FORMATTED = "conv_id string, segment long, n_turns long, formatted string, turn_at array<long>, loss array<struct<a:long,b:long>>, rewritten_at long, kept long"


def format_conversations(rows: DataFrame, template: Callable = render, mask: Callable[[str], str] = escape,
                         learned: str = LEARNED, context: int | None = None, segment: int = SEGMENT) -> DataFrame:
    """Segments of formatted conversations: text, start of each turn, loss spans (places in that text).

    ``mask`` is what the template does to a text.  ``context`` bounds the prefixes; without
    it they are whole, unless the template is declared ``local``.  A conversation whose template
    rewrites history comes as one segment per rewritten turn with ``rewritten_at``
    (the turn's place) and ``kept``; its formatted text ends before that turn.
    """
    def run(batches):
        now, state = object(), None

        def row(conv, s, at=None, kept=None):
            return (conv, s["segment"], len(s["turn_at"]), "".join(s["parts"]), s["turn_at"], s["loss"], at, kept)

        def fresh(s):
            s.update(parts=[], size=0, turn_at=[], loss=[], segment=s["segment"] + 1)

        for batch in batches:
            out = []
            for conv, role, text in zip(batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None),
                                        batch["role"].fillna(""), batch["text"].fillna("")):
                if state is None or conv != now:
                    if state and state["turn_at"]:
                        out.append(row(now, state))
                    r = Renderer(template, mask, context)
                    now, state = conv, {"r": r, "parts": [r.opening], "size": len(r.opening), "turn_at": [], "loss": [], "segment": 0, "n": 0, "bad": False}
                span, at, kept = state["r"].feed(role, text)
                if kept is not None and not state["bad"]:
                    state["bad"], state["loss"] = True, []
                    out.append(row(now, state, state["n"], kept))
                    fresh(state)
                state["n"] += 1
                if state["bad"]:
                    continue
                if role == learned and at:
                    state["loss"].append((state["size"] + at[0], state["size"] + at[1]))
                state["turn_at"].append(state["size"])
                state["parts"].append(span)
                state["size"] += len(span)
                if len(state["turn_at"]) >= segment:
                    out.append(row(now, state))
                    fresh(state)
            if out:
                yield pd.DataFrame(out, columns=_COLUMNS)
        if state and state["turn_at"]:
            yield pd.DataFrame([row(now, state)], columns=_COLUMNS)

    # the id as text keeps null apart and exact in pandas
    ordered = (rows.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "role", "text")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return ordered.select("conv_id", "role", "text").mapInPandas(run, _FORMATTED)


_COLUMNS = [x.split()[0] for x in re.sub(r"<[^ ]*>", "", _FORMATTED).split(", ")]

_DIGEST = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the default template's output: turns, learned text and their hashes."""
    def run(batches):
        now, s = object(), None
        for batch in batches:
            out = []
            for conv, text, loss in zip(batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None), batch["formatted"], batch["loss"]):
                if s is None or conv != now:
                    if s:
                        out.append(done(now, s))
                    now, s = conv, {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "chars": 0, "all": 0}
                for role, said in parse(text):
                    s["turns"].update(f"{role}\n{said}\n".encode())
                    s["n"] += 1
                for x in loss:
                    said = unescape(text[x["a"]:x["b"]])
                    s["loss"].update(said.encode())
                    s["chars"] += len(said)
                s["all"] += len(text)
            if out:
                yield pd.DataFrame(out, columns=names)
        if s:
            yield pd.DataFrame([done(now, s)], columns=names)

    names = [x.split()[0] for x in _DIGEST.split(", ")]

    def done(conv, s):
        return conv, s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["all"]

    ordered = formatted.select("conv_id", "segment", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.mapInPandas(run, _DIGEST).withColumn("conv_id", F.col("conv_id").cast("long"))
