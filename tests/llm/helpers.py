"""Brute-force versions, in plain Python."""

from __future__ import annotations

import re

KIND = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use for themselves, to clash with.
CLASHES = ["sid", "band", "removed", "n_lines", "score", "ids", "k", "bucket", "virtual_slot", "row"]


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", lower(text or ""))


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def alike(a: frozenset, b: frozenset, percent: int = 75) -> bool:
    common = len(a & b)
    return bool(common) and 100 * common >= percent * (len(a) + len(b) - common)


def docs_of(spark, rows, clash: bool = False):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], KIND)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
ODD = [(None, None), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three"), (6, "It's é ü 日本 \U0001f600 don't"), (7, "a b c d e f g h"), (7, "a b c d e f g h"), (8, "A b C d e f g h"), (None, "a b c d e f g h"), (9, LONG), (10, "line one is here now\nline one is here now\n\nline one is here too now")]
