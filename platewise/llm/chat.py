"""Chat formatting: records of any known layout to canonical turns, turns to training text, and back.

``fingerprint`` hashes the sorted field paths of a JSON record (array elements share one path). A ``Layout`` is declared by an
example of its fields and by what each turn takes from where; the hash of its paths selects it. Optional fields give a layout
several fingerprints. A record that no layout fits is not guessed at: it gives no turns and one row with the fingerprint
(``unknown``), so that a mapping can be declared for it.

``format_turns`` writes the turns of a conversation into one text by a template. Control strings are told from text by an escape:
inside texts ``<`` is followed by a backslash, ``[`` too, and a backslash is doubled, so no control string can occur there, and
``unescape`` gives every text back exactly. ``mask`` lists the spans (code points) of the assistant's texts. ``read_back`` parses the
text alone and returns the turns.

Nulls: a null text or role is an empty one, a null turn number comes last. Equal turn numbers are ordered by role and text, repeated
rows stay. An empty table gives an empty one. A conversation is one text, so it is built in one task; conversations as such are
spread by their id.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import short_batches

TURN = "struct<position:bigint,role:string,text:string>"


def paths(value, at: str = "") -> set[str]:
    """Field paths of a parsed JSON value: ``a.b`` for objects, ``a[]`` for arrays; values do not matter."""
    if isinstance(value, dict):
        found = {p for k, v in value.items() for p in paths(v, f"{at}.{k}" if at else k)}
        return found or {f"{at}{{}}"}
    if isinstance(value, list):
        found = {p for v in value for p in paths(v, f"{at}[]")}
        return found or {f"{at}[]"}
    return {at}


def fingerprint(value) -> str:
    return hashlib.sha256("\n".join(sorted(paths(value))).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Turn:
    """One turn of a flat layout: a fixed role, and the fields whose non-empty texts are joined by blank lines."""

    role: str
    fields: tuple[str, ...]


def as_text(value) -> str:
    """A value as text: text itself, nothing as empty, anything else as JSON."""
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def sound(text: str) -> str:
    """Text without halves of surrogate pairs, which JSON may name and no encoding can hold; each becomes U+FFFD."""
    return text if text.isascii() else text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


@dataclass(frozen=True)
class Layout:
    """How records of one shape become turns: fixed turns, or a list of messages, or one row that is one turn."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[Turn, ...] = ()
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    position: str | None = None
    roles: dict = field(default_factory=dict, hash=False)

    def fingerprints(self) -> list[str]:
        """Hashes of the required paths with every choice of the optional ones."""
        found = []
        for bits in range(2 ** len(self.optional)):
            chosen = [p for k, p in enumerate(self.optional) if bits >> k & 1]
            found.append(hashlib.sha256("\n".join(sorted({*self.required, *chosen})).encode()).hexdigest()[:16])
        return found

    def apply(self, record: dict) -> list[tuple[int | None, str, str]]:
        if self.messages is None and self.turns:
            texts = [(t.role, "\n\n".join(as_text(record[f]) for f in t.fields if record.get(f))) for t in self.turns]
            return [(k, role, text) for k, (role, text) in enumerate(texts) if text or role != "system"]
        items = record[self.messages] if self.messages else [record]
        found = []
        for k, item in enumerate(items):
            role, place = as_text(item.get(self.role)), item.get(self.position) if self.position else k
            found.append((place if type(place) is int and abs(place) < 1 << 63 else None, self.roles.get(role, role), as_text(item.get(self.text))))
        return found


SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "prompter": "user", "model": "assistant"}
LAYOUTS = (
    Layout("turn_row", ("turn", "role", "text"), role="role", text="text", position="turn"),
    Layout("messages", ("messages[].role", "messages[].content"), ("id", "source"), messages="messages", roles=SPOKEN),
    Layout("conversations", ("conversations[].from", "conversations[].value"), ("id", "source"), messages="conversations", role="from", text="value", roles=SPOKEN),
    Layout("instruction", ("instruction", "output"), ("input", "system", "id"), turns=(Turn("system", ("system",)), Turn("user", ("instruction", "input")), Turn("assistant", ("output",)))),
    Layout("prompt_response", ("prompt", "response"), ("system", "id"), turns=(Turn("system", ("system",)), Turn("user", ("prompt",)), Turn("assistant", ("response",)))),
    Layout("prompt_completion", ("prompt", "completion"), ("id",), turns=(Turn("user", ("prompt",)), Turn("assistant", ("completion",)))),
    Layout("question_answer", ("question", "answer"), ("context", "id"), turns=(Turn("user", ("context", "question")), Turn("assistant", ("answer",)))),
)


def mappings(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """Fingerprint to layout; two layouts with one fingerprint are an error."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        for key in layout.fingerprints():
            if found.setdefault(key, layout) is not layout:
                raise ValueError(f"{layout.name} and {found[key].name} cannot be told apart")
    return found


def canonical_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS, carry: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """Rows (carry columns, fingerprint, layout, position, role, text), one per turn; null layout and turn for unknown records."""
    short_batches(records.sparkSession)
    known = mappings(layouts)

    @F.pandas_udf(f"struct<fingerprint:string,layout:string,turns:array<{TURN}>>")
    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                try:
                    value = json.loads(text) if text is not None else None
                    key = fingerprint(value) if isinstance(value, dict) else None
                except (ValueError, RecursionError):  # no JSON, or nested too deep to be any layout
                    value = key = None
                layout = known.get(key)
                turns = [{"position": p, "role": sound(r), "text": sound(t)} for p, r, t in layout.apply(value)] if layout else []
                rows.append((key, layout and layout.name, turns))
            yield pd.DataFrame(rows, columns=["fingerprint", "layout", "turns"])

    kept = [F.col(f"`{c}`") for c in carry]
    found = records.select(*kept, parsed(F.col(record)).alias("parsed"))
    return found.select(*kept, "parsed.fingerprint", "parsed.layout", F.explode_outer("parsed.turns").alias("t")).select(*kept, "fingerprint", "layout", "t.*")


@dataclass(frozen=True)
class Template:
    """Control strings around a turn; each must begin with ``<`` or ``[``, which never stand alone in an escaped text."""

    begin: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"

    def __post_init__(self):
        if any(s[:1] not in ("<", "[") or s[1:2] == "\\" for s in (self.begin, self.end)):
            raise ValueError("a control string begins with < or [ and goes on with anything but a backslash")

    def escape(self, text: str) -> str:
        return text.replace("\\", "\\\\").replace("<", "<\\").replace("[", "[\\")

    def unescape(self, text: str) -> str:
        return re.sub(r"([\\<\[])\\", r"\1", text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """A formatted turn, and where in it the text begins and ends."""
        head = self.begin + self.escape(role).replace("\n", "\\n") + self.after_role
        body = self.escape(text)
        return head + body + self.end, len(head), len(head) + len(body)

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a formatted conversation."""
        found, at = [], 0
        while at < len(formatted):
            if not formatted.startswith(self.begin, at):
                raise ValueError(f"no turn begins at {at}")
            head = formatted.index(self.after_role, at + len(self.begin))
            close = formatted.index(self.end, head + len(self.after_role))
            role = re.sub(r"\\(\\|n)|([<\[])\\", lambda m: m[2] or ("\n" if m[1] == "n" else "\\"), formatted[at + len(self.begin):head])
            found.append((role, self.unescape(formatted[head + len(self.after_role):close])))
            at = close + len(self.end)
        return found


FORMATTED = "formatted string, mask array<struct<begin:bigint,end:bigint>>"


def format_turns(turns: DataFrame, template: Template = Template(), conv_id: str = "conv_id", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Rows (conv_id, formatted, mask): each conversation's text and the spans of the texts of the roles in ``learn``.

    Rows without a turn (records of unknown layout) add nothing; a conversation of such rows only has an empty text.
    """
    known = F.col("position").isNotNull() | F.col("role").isNotNull() | F.col("text").isNotNull()
    one = F.struct(F.col("position").isNull().alias("last"), F.col("position"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(F.when(known, one))).alias("turns"))

    @F.pandas_udf("struct<formatted:string,mask:array<struct<begin:bigint,end:bigint>>>")
    def written(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for turns_of_one in batch:
                parts, mask, at = [], [], 0
                for t in turns_of_one:
                    text, begin, end = template.turn(t["role"], t["text"])
                    if t["role"] in learn:
                        mask.append({"begin": at + begin, "end": at + end})
                    parts.append(text)
                    at += len(text)
                rows.append(("".join(parts), mask))
            yield pd.DataFrame(rows, columns=["formatted", "mask"])

    return gathered.select("conv_id", written(F.col("turns")).alias("w")).select("conv_id", "w.formatted", "w.mask")


def read_back(formatted: Column, mask: Column, template: Template = Template()) -> Column:
    """Struct (turns, learned) read from the formatted text alone: the turns, and the unescaped texts under the mask."""
    @F.pandas_udf("struct<turns:array<struct<role:string,text:string>>,learned:array<string>>")
    def parsed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, masks in batches:
            rows = [([{"role": r, "text": t} for r, t in template.parse(x)], [template.unescape(x[m["begin"]:m["end"]]) for m in spans]) for x, spans in zip(texts, masks)]
            yield pd.DataFrame(rows, columns=["turns", "learned"])

    return parsed(formatted, mask)
