"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. The rendered
turn is reparsed at once by a deterministic parser; when the turns it finds
are not the one that was written, or role or text hold a control string
(``<|im_start|>``, ``<|im_end|>`` or ``<|esc|>``), the turn is rendered with
role and text escaped, so that no control string stands in the output but the
template's own (an escaped string holds none). Escaping is
reversible: after ``<|im_start|><|esc|>`` every ``\\`` is ``\\\\``, ``<|`` is
``<\\|``, and in the role a line end is ``\\n``. A turn is closed by its own
end mark, so turns that round-trip alone do so when joined.

Rendering and its check run per row where the rows are read, before any
shuffle, so a conversation that holds a third of all rows is formatted by
many tasks. Only the digests need a conversation's turns in order: rows are
hash-partitioned on conv_id and sorted (Spark's external sort), and a task
streams its run, holding the hash state of one conversation and never its
text. SHA-256 is sequential, so one conversation's digest is made in one task
in bounded memory.

Defined results: null role and text are empty. Turns sort by turn (null
first), then by their formatted text, so ties have a fixed order; repeated
rows are separate turns. Rows without conv_id form one conversation with a null id.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches

START, END, ESC = "<|im_start|>", "<|im_end|>", "<|esc|>"


def escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(s: str) -> str:
    return escape(s).replace("\n", "\\n")


def unescape(s: str) -> str:
    out, i = [], 0
    while (j := s.find("\\", i)) >= 0 and j + 1 < len(s):
        out += [s[i:j], "\n" if s[j + 1] == "n" else s[j + 1]]
        i = j + 2
    return "".join(out) + s[i:]


def render(role: str, text: str) -> str:
    """The first form, plain (without control strings in role and text) then
    escaped, that the parser reads back."""
    held = any(c in s for s in (role, text) for c in (START, END, ESC))
    forms = (f"{START}{role}\n{text}{END}\n", f"{START}{ESC}{escape_role(role)}\n{escape(text)}{END}\n")
    for form in forms[held:]:
        try:
            if parse(form) == [(role, text)]:
                return form
        except ValueError:
            pass
    raise ValueError("turn does not round-trip")


def parse(s: str) -> list[tuple[str, str]]:
    """turn* where turn is START [ESC] role "\\n" text END "\\n"."""
    turns, i = [], 0
    while i < len(s):
        if not s.startswith(START, i):
            raise ValueError(f"no turn at {i}")
        i += len(START)
        escaped = s.startswith(ESC, i)
        i += len(ESC) * escaped
        j = s.find("\n", i)
        k = s.find(END, j)
        if j < 0 or k < 0 or s[k + len(END):k + len(END) + 1] != "\n":
            raise ValueError(f"open turn at {i}")
        role, text = s[i:j], s[j + 1:k]
        turns.append((unescape(role), unescape(text)) if escaped else (role, text))
        i = k + len(END) + 1
    return turns


def _render(batches):
    import pyarrow as pa

    for b in batches:
        made = [render(r or "", t or "") for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), pa.array(made, pa.string())],
                                         names=["conv_id", "turn", "formatted"])


def rendered(conversations: DataFrame) -> DataFrame:
    """conv_id, turn and the formatted text of each row."""
    bounded_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.mapInArrow(_render, "conv_id long, turn long, formatted string")


def _digest(batches):
    """Read back from the formatted turns of a sorted run, conversation by conversation."""
    import pyarrow as pa

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now, open_ = None, False
    out: list[tuple] = []

    def closed():
        return (now, n, turns.hexdigest(), chars, loss.hexdigest(), size)

    def batch(rows):
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for b in batches:
        for conv, text in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist()):
            if not open_ or conv != now:
                if open_:
                    out.append(closed())
                now, open_ = conv, True
                n, chars, size, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            size += len(text)
            for role, said in parse(text):
                n += 1
                turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                if role == "assistant":
                    chars += len(said)
                    loss.update(said.encode("utf-8", "surrogatepass"))
        if len(out) >= 4096:
            yield batch(out)
            out = []
    if open_:
        out.append(closed())
    if out:
        yield batch(out)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: turns, their hash, loss mask length and hash, length."""
    run = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return run.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
