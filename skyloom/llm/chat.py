"""Chat formatting with schema fingerprints.

A record's fingerprint is the hash of its sorted nested field paths (`messages[].role`); it selects a declarative
mapping, so each layout is looked at once and every further record of it costs a dictionary lookup. Mappings turn
prompt, instruction and message layouts into canonical turns (role, text). The template writes the turns as one string

    <|im_start|>role\\ntext<|im_end|>\\n

in which control strings that occur inside texts are broken by a backslash after their first character and backslashes
are doubled, so the string reads back exactly. `loss_spans` are code-point ranges of the assistant texts.

Null texts and roles are empty; numbers and truth values are written as in JSON. A message's content may be a list of text
parts, which are joined. A record that no mapping knows, or whose values aren't what its mapping reads (turns that aren't a
list of objects, parts that aren't text), gives null turns and its fingerprint, and is kept; so is text that isn't JSON, with a
null fingerprint. Lone surrogates become U+FFFD. Repeated rows give repeated rows, columns other than conv_id and record
don't come along, and an empty table gives none. Turns with one number are ordered by role and text. A conversation is one row of
the result, so it has to fit in memory.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates.
CONTROL = [OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + r"\n", re.DOTALL)
_LONE = re.compile("[\ud800-\udfff]")
TURNS = "array<struct<role:string,text:string>>"

#: The layouts that are known. `each` walks a list; `turns` names fields one by one.
MAPPINGS = [
    {"name": "turn rows", "required": ["turns"], "optional": ["turns[].turn", "turns[].role", "turns[].text"], "each": "turns", "role": "role", "text": "text"},
    {"name": "messages", "required": ["messages"], "optional": ["messages[].role", "messages[].content", "messages[].content[].type", "messages[].content[].text"], "each": "messages", "role": "role", "text": "content"},
    {"name": "conversations", "required": ["conversations"], "optional": ["conversations[].from", "conversations[].value"], "each": "conversations", "role": "from", "text": "value", "roles": {"human": "user", "gpt": "assistant"}},
    {"name": "prompt", "required": ["prompt"], "optional": ["system", "response", "completion"], "turns": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response", "completion"])]},
    {"name": "instruction", "required": ["instruction"], "optional": ["input", "output"], "turns": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
    {"name": "question", "required": ["question", "answer"], "optional": ["context"], "turns": [("user", ["context", "question"]), ("assistant", ["answer"])]},
]


def field_paths(value: object, at: str = "") -> set[str]:
    """All paths to fields below a JSON value; a list adds [] and joins its items' paths."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in {f"{at}.{k}" if at else k} | field_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in field_paths(v, f"{at}[]")}
    return set()


def fingerprint(paths: set[str]) -> str:
    return xxhash.xxh64_hexdigest("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"))


class Layouts:
    """Fingerprint to mapping; a new fingerprint is matched against the mappings once."""

    def __init__(self, mappings: list[dict] = MAPPINGS) -> None:
        self.mappings, self.known = mappings, {}

    def select(self, record: object) -> tuple[str, dict | None]:
        paths = field_paths(record)
        key = fingerprint(paths)
        if key not in self.known:
            fits = (m for m in self.mappings if set(m["required"]) <= paths <= {*m["required"], *m["optional"]})
            self.known[key] = next(fits, None)
        return key, self.known[key]


def said(value: object) -> str | None:
    """The text of a field's value; None where it has none that turns could hold."""
    if value is None:
        return ""
    if isinstance(value, str):
        return _LONE.sub("\ufffd", value)
    if isinstance(value, list):
        parts = [x.get("text") if isinstance(x, dict) and x.get("type", "text") == "text" else x for x in value]
        return "".join(map(said, parts)) if all(isinstance(x, str) for x in parts) else None
    return None if isinstance(value, dict) else json.dumps(value)


def turns_of(record: dict, mapping: dict) -> list[tuple[str, str]] | None:
    """Canonical turns; fields that are missing or null give none, nulls inside a list's item are empty. None: they can't be read."""
    if "each" in mapping:
        names, items = mapping.get("roles", {}), record.get(mapping["each"])
        items = [] if items is None else items
        if not isinstance(items, list) or not all(x is None or isinstance(x, dict) for x in items):
            return None
        pairs = [(said((x or {}).get(mapping["role"])), said((x or {}).get(mapping["text"]))) for x in items]
        return None if any(None in p for p in pairs) else [(names.get(r, r), t) for r, t in pairs]
    out = []
    for role, fields in mapping["turns"]:
        given = [said(record.get(f)) for f in fields]
        if None in given:
            return None
        if any(given):
            out.append((role, "\n".join(filter(None, given))))
    return out


def read_json(text: str | None) -> tuple[object, bool]:
    """The value, and whether the text could be read at all."""
    try:
        return (None, False) if text is None else (json.loads(text), True)
    except (ValueError, RecursionError):
        return None, False


def escaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The string and the spans of the assistant texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escaped(role).replace(chr(10), chr(92) + 'n')}\n", escaped(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{CLOSE}\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), spans


def parsed(text: str) -> list[tuple[str, str]]:
    return [(unescaped(role), unescaped(body)) for role, body in _TURN.findall(text)]


def format_records(records: DataFrame, mappings: list[dict] = MAPPINGS) -> DataFrame:
    """records(conv_id, record: JSON text) -> conv_id, layout, schema_hash, formatted, loss_spans. A null record is like text that isn't JSON."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layouts = Layouts(mappings)
        for frame in frames:
            rows = []
            for record in frame["record"]:
                value, readable = read_json(record)
                key, mapping = layouts.select(value) if readable else (None, None)
                turns = turns_of(value, mapping) if mapping else None
                text, spans = formatted(turns) if turns is not None else (None, [])
                rows.append((mapping["name"] if turns is not None else None, key, text, [{"start": a, "stop": b} for a, b in spans]))
            made = pd.DataFrame(rows, columns=["layout", "schema_hash", "formatted", "loss_spans"], dtype=object)
            made.insert(0, "conv_id", frame["conv_id"].to_numpy())
            yield made

    return records.select("conv_id", "record").mapInPandas(run, "conv_id long, layout string, schema_hash string, formatted string, loss_spans array<struct<start:int,stop:int>>")


def records_of_turns(rows: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> one JSON record per conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.sort_array(F.collect_list(turn))
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.to_json(F.struct(turns.alias("turns"))).alias("record"))


def digests(chats: DataFrame) -> DataFrame:
    """What formatted chats hold, read back from their strings."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, spans in zip(frame["formatted"], frame["loss_spans"], strict=True):
                turns = parsed(text or "")
                loss = "".join(unescaped(text[s["start"] : s["stop"]]) for s in spans)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text or "")))
            made = pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            made.insert(0, "conv_id", frame["conv_id"].to_numpy())
            yield made.astype({"n_turns": "int64", "loss_chars": "int64", "formatted_chars": "int64"})

    return chats.select("conv_id", "formatted", "loss_spans").mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
