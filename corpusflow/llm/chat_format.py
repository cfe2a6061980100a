"""Chat formatting: records of many layouts to canonical turns, one template, a loss mask.

A record's layout is told by a fingerprint: a hash of its nested field paths (array
elements share one path). The fingerprint selects a declared mapping; a record of an
unknown layout is kept and named as such, never guessed at.

Template, a turn: ``### Role: text</turn>`` and a newline. Inside texts and roles the
backslash, ``### `` and ``</turn>`` (and a colon in a role) are escaped, so no text
can open or close a turn, and reading back gives exactly what was put in.
"""

import json
import re
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>"
_ESCAPES = (("\\", "\\\\"), (OPEN, "\\h"), (CLOSE, "\\e"), (":", "\\c"))
_PLAIN = {"\\\\": "\\", "\\h": OPEN, "\\e": CLOSE, "\\c": ":"}
_CODE = re.compile(r"\\[\\hec]")


@dataclass(frozen=True)
class Layout:
    """Either a list of messages (items, role, text) or one field for each turn (fields)."""

    name: str
    items: str | None = None
    role: str | None = None
    text: str | None = None
    roles: dict = field(default_factory=dict)  # names that mean a canonical role
    fields: tuple = ()  # (role, field names joined by a blank line)

    def paths(self) -> list[list[str]]:
        """The sets of field paths that this mapping reads."""
        if self.items:
            return [[f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"], [f"{self.items}[]"]]
        return [[f for _, names in self.fields for f in names]]

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.items:
            found = [(m.get(self.role), m.get(self.text)) for m in record.get(self.items) or []]
            return [(self.roles.get(r, r) or "", t or "") for r, t in found]
        texts = [(role, [record.get(n) or "" for n in names]) for role, names in self.fields]
        return [(role, "\n\n".join([t[0], *filter(None, t[1:])])) for role, t in texts if role != "system" or t[0]]


LAYOUTS = (
    Layout("messages", "messages", "role", "content"),
    Layout("turns", "conversation", "role", "text"),
    Layout("shared", "conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    Layout("completion", fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("response", fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction", fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("question", fields=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout("system_prompt", fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
)


def field_paths(value, at: str = "") -> set[str]:
    """Paths of the leaves; an empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)))


def escape(text: str, role: bool = False) -> str:
    for plain, code in _ESCAPES[: 4 if role else 3]:
        text = text.replace(plain, code)
    return text


def unescape(text: str) -> str:
    return _CODE.sub(lambda m: _PLAIN[m[0]], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the character ranges of the assistant's texts in it."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head = f"{OPEN}{escape(role, True)}: "
        body = escape(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE, "\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, as they were."""
    out = []
    for part in formatted.split(CLOSE + "\n")[:-1]:
        role, _, text = part[len(OPEN) :].partition(": ")
        out.append((unescape(role), unescape(text)))
    return out


def format_records(records: DataFrame, id_col: str, record_col: str, layouts=LAYOUTS) -> DataFrame:
    """Format JSON records: id, layout, formatted, loss_mask (character ranges start, end).

    A null record, one that is no JSON object and one of an unknown layout have the
    layout null and no text. Null texts and roles are empty; a null id and repeated
    rows are kept; a record without turns gives an empty text. No rows: no rows.
    Other columns are ignored. One pass, no shuffle.
    """
    known = {fingerprint(p): layout for layout in layouts for p in layout.paths()}
    # an id of any type is carried through as it is
    kind = records.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            names, texts, masks = [], [], []
            for raw in batch.column("record").to_pylist():
                layout = text = mask = None
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                if isinstance(record, dict):
                    layout = known.get(fingerprint(field_paths(record)))
                if layout is not None:
                    text, mask = format_turns(layout.turns(record))
                names.append(layout.name if layout else None)
                texts.append(text)
                masks.append(None if mask is None else [{"start": a, "end": b} for a, b in mask])
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(masks, spans)],
                ["id", "layout", "formatted", "loss_mask"],
            )

    rows = records.select(F.col(id_col).alias("id"), F.col(record_col).cast("string").alias("record"))
    schema = f"id {kind.simpleString()}, layout string, formatted string, loss_mask array<struct<start:long,end:long>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digests(formatted: DataFrame, id_col: str) -> DataFrame:
    """What is read back from formatted texts: turns and the unescaped text under the loss mask.

    One row per row. A null text, of a record in an unknown layout, has no turns and no
    characters; a null mask covers nothing. No rows: no rows.
    """
    import hashlib

    kind = formatted.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            rows = []
            for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("loss_mask").to_pylist(), strict=True):
                turns = read_turns(text or "")
                whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask or [])
                rows.append((len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text or "")))
            n, whole, chars, loss, size = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.record_batch(
                [
                    batch.column("id"), pa.array(n, pa.int64()), pa.array(whole, pa.string()), pa.array(chars, pa.int64()),
                    pa.array(loss, pa.string()), pa.array(size, pa.int64()),
                ],
                ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    schema = f"id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = formatted.select(F.col(id_col).alias("id"), "formatted", "loss_mask")
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def records_of(turns: DataFrame) -> DataFrame:
    """JSON records of several layouts from rows (conv_id, turn, role, text).

    Turns are in order of turn, equal ones by role and text. A user with an
    assistant becomes a completion; others become messages, or shared conversations
    where the id is odd and all roles have a name there. Null texts and roles are empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    roles = F.transform("ts", lambda t: t["role"])
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    common = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    shared = F.transform(
        "ts",
        lambda t: F.struct(
            F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"),
            t["text"].alias("value"),
        ),
    )
    messages = F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    record = (
        F.when(pair, F.to_json(F.struct(F.col("ts")[0]["text"].alias("prompt"), F.col("ts")[1]["text"].alias("completion"))))
        .when(common & (F.col("conv_id") % 2 != 0), F.to_json(F.struct(shared.alias("conversations"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return convs.select("conv_id", record.alias("record"))
