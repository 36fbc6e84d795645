from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from skyloom.llm import linededup, minhash
from tests.llm.helpers import ODD, alike, docs_of, shingles, words


def near_copies(seed: int = 5) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 60))] for _ in range(12)]
    rows = []
    for i in range(120):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i * 3 % 120 + 1, " ".join(text)))
    return rows


def components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if sets[i] and ids else doc))
    return out


@pytest.mark.parametrize("rows", [near_copies(), ODD, ODD + near_copies(9)])
def test_near_duplicates_equal_brute_force(spark, rows):
    got = minhash.near_duplicates(docs_of(spark, rows, clash=True))
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2] or 0)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], key=key) == sorted(components(rows), key=key)


def test_empty_table(spark):
    empty = docs_of(spark, [])
    assert minhash.near_duplicates(empty).count() == 0
    assert linededup.deduplicated(empty).count() == 0


def test_bit_count_similarity_is_unbiased(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 2**63, 1000, dtype=np.uint64)])
    packed = [minhash.packed(minhash.minima(x)[None, :]).astype(np.int64)[0].tolist() for x in (a, b)]
    row = spark.createDataFrame([tuple(packed[0] + packed[1])], [f"c{i}" for i in range(2 * minhash.WORDS)])
    cols = [F.col(c) for c in row.columns]
    est = row.select(minhash.similarity(minhash.mismatches(cols[: minhash.WORDS], cols[minhash.WORDS :]))).first()[0]
    assert abs(est - 0.6) < 0.15


def removed(rows):
    """Lines (row number in rows, line) that an earlier line matches; rows equal in doc_id and text are one row."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, text_hash(rows[i][1])))
    lines, first = [], {}
    for i in order:
        if first.setdefault(rows[i], i) == i:
            lines += [(i, k, frozenset(words(x))) for k, x in enumerate((rows[i][1] or "").split("\n"))]
    out = {(i, k) for n, (i, k, s) in enumerate(lines) if s and any(4 * len(s & o) >= 3 * len(s | o) for _, _, o in lines[:n] if o)}
    return {(i, k) for i, r in enumerate(rows) for j, k in out if first[r] == j}


def text_hash(text):
    """Spark's xxhash64: its seed, as a signed number."""
    h = xxhash.xxh64_intdigest(text.encode(), 42) if text is not None else 42
    return h - (1 << 64) if h >> 63 else h


def cut(rows, gone):
    return [(i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone)) for n, (i, t) in enumerate(rows)]


def by_row(rows):
    return sorted((i is None, i or 0, t or "", t is None) for i, t in rows)


def repeated_ids(seed: int) -> list[tuple[int, str]]:
    """Rows that share a doc_id with different texts, and rows that are given twice."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, 1, 2, 3]), t) for _, t in line_rows(seed)]
    return rows + rows[:7] + [(1, "x x\nunlike any other"), (2, "y\nalone here"), (2, "x x\nz"), (50, "y\nalone here")]


def line_rows(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 25))] for _ in range(15)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("rows", [line_rows(1), line_rows(2), ODD + [(11, "x" * 100_000)], repeated_ids(4)])
def test_line_dedup_equals_brute_force(spark, rows):
    want = removed(rows)
    got = linededup.deduplicated(docs_of(spark, rows, clash=True)).collect()
    assert sorted((len(r.removed), r.n_lines) for r in got) == sorted((sum(i == n for i, _ in want), len(t.split("\n")) if t is not None else 0) for n, (_, t) in enumerate(rows))
    assert by_row((r.doc_id, r.text) for r in got) == by_row(cut(rows, want))


def test_lines_with_more_candidates_than_are_passed_on(spark, monkeypatch):
    """Sets that nearly match many others: each is counted out against all of them."""
    rng = random.Random(3)
    core = [f"c{i}" for i in range(9)]
    rows = [(i, " ".join(rng.sample(core, 7) + [f"t{rng.randrange(40)}" for _ in range(rng.choice([0, 1, 2, 3]))])) for i in range(150)]
    monkeypatch.setattr(linededup, "PASSED_ON", 1)
    monkeypatch.setattr(linededup, "MOST_PASSED_ON", 1)
    for blocks in (10, 200_000):
        monkeypatch.setattr(linededup, "BLOCK_ROWS", blocks)
        got = linededup.deduplicated(docs_of(spark, rows)).collect()
        assert {(r.doc_id, k) for r in got for k in r.removed} == removed(rows)


def short_rows(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocabulary = [f"s{i}" for i in range(9)]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9)))
    return [(i, "\n".join(line() for _ in range(rng.randint(1, 6)))) for i in range(80)]


COPIES = [(1, "les.\nAnd ornd.\na b c d\nk l m\n\n \t"), (2, "LES.\nand ornd.\na b c d e\nk l m n\n\n \t"), (3, "a b c x\n文字だけの長い行です。\nk l"), (4, "文字だけの長い行です。\nl k l\nk")]


@pytest.mark.parametrize("rows", [COPIES, short_rows(1), short_rows(2)])
def test_lines_of_few_words_are_judged(spark, rows):
    lines = sorted((i, k, frozenset(words(x))) for i, t in rows for k, x in enumerate(t.split("\n")))
    want = {(i, k) for n, (i, k, s) in enumerate(lines) if any(alike(s, o) for _, _, o in lines[:n])}
    got = linededup.deduplicated(docs_of(spark, rows)).collect()
    assert {(r.doc_id, k) for r in got for k in r.removed} == want
    if rows is COPIES:
        assert want == {(2, 0), (2, 1), (2, 2), (2, 3), (4, 0), (4, 1)}


def test_blocks_of_a_very_common_word_meet_pairwise(spark, monkeypatch):
    rows = line_rows(3)
    monkeypatch.setattr(linededup, "BLOCK_ROWS", 10)
    got = linededup.deduplicated(docs_of(spark, rows)).collect()
    assert {(r.doc_id, k) for r in got for k in r.removed} == removed(rows)


def test_blocks_of_a_large_band(spark, monkeypatch):
    """All links come from the last step, in blocks of a few nodes."""
    monkeypatch.setattr(minhash, "ROUNDS", 0)
    monkeypatch.setattr(minhash, "BLOCK_NODES", 3)
    rows = [(i, t) for i, (_, t) in enumerate(near_copies(11))]
    got = minhash.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(components(rows))


@pytest.mark.parametrize(("sent", "known"), [(200, 1 << 15), (60, 3), (150_000, 0)])
def test_lines_that_stand_everywhere(spark, monkeypatch, sent, known):
    """Repeats are kept back by the sender, within a portion and over portions; rows given twice stay one row."""
    monkeypatch.setattr(linededup, "SENT_AT_ONCE", sent)
    monkeypatch.setattr(linededup, "MOST_KNOWN", known)
    rng = random.Random(6)
    menu = ["home about contact imprint", "About HOME imprint contact", "read more here", "x"]
    rows = [(rng.randrange(400), "\n".join([rng.choice(menu), f"own line number {i} of this text", rng.choice(menu)])) for i in range(300)]
    rows += rows[:30] + [(None, "home about contact imprint\nx")]
    want = removed(rows)
    got = linededup.deduplicated(docs_of(spark, rows).coalesce(2)).collect()
    assert by_row((r.doc_id, r.text) for r in got) == by_row(cut(rows, want))


def test_a_line_in_all_texts_is_sent_once_a_task():
    import numpy as np
    import pyarrow as pa

    from skyloom.llm import packed

    text = "home about contact imprint"
    batches = [pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([i], pa.int64()), pa.array([0], pa.int64()), pa.array([text])], names=["d", "k", "t", "x"]) for i in range(500)]
    linededup_sent = linededup.SENT_AT_ONCE
    linededup.SENT_AT_ONCE = 50
    try:
        out = list(linededup._sets(np.zeros(1 << linededup.COUNT_BITS, np.uint8), np.zeros(1 << 10, np.uint64), 7)(iter(batches)))
    finally:
        linededup.SENT_AT_ONCE = linededup_sent
    held = packed.gathered(iter(out))
    assert len(packed.unpack(held[0], linededup.LINE_TYPES, "u4")[0]) == 1
    late = packed.unpack(held[1], ["i8", "i8", "i4"])
    assert sorted(late[0].tolist()) == list(range(1, 500))


def test_packs_of_any_number_of_groups():
    import numpy as np

    from skyloom.llm import packed

    pid = np.array([70_000, 3, 65_536, 70_000, 3, 1 << 20])
    batch = packed.pack(pid, [np.arange(6)])
    assert batch.column(0).to_pylist() == [3, 65_536, 70_000, 1 << 20]
    assert [packed.unpack([b], ["i8"])[0].tolist() for b in batch.column(2).to_pylist()] == [[1, 4], [2], [0, 3], [5]]


def test_lines_with_very_many_near_misses_are_counted_out(spark, monkeypatch):
    """Enough candidates that are no matches for the last round to run with its own limits."""
    rng = random.Random(13)
    core = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(rng.sample(core, 160) + rng.sample([f"t{k}" for k in range(100)], 40))) for i in range(100)]
    rows += [(100 + i, rows[i * 7][1] + " more") for i in range(5)]
    asked, real = [], linededup._members
    monkeypatch.setattr(linededup, "_members", lambda *a: asked.append(1) or real(*a))
    got = linededup.deduplicated(docs_of(spark, rows)).collect()
    assert {(r.doc_id, k) for r in got for k in r.removed} == removed(rows)
    assert asked
