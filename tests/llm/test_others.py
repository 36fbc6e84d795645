from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from skyloom.llm import chat, decontam, entries, quality, shards, simhash, urlrules
from tests.llm.helpers import ODD, docs_of


# Sharding

def test_shards(spark):
    rng = random.Random(1)
    rows = [(i, "é" * rng.randint(0, 50)) for i in range(900)] + [(None, None), (5000, None), (5000, None)]
    sized = shards.sized(docs_of(spark, rows, clash=True))
    totals = shards.slot_totals(sized)
    plan = shards.planned(totals, 7)
    got = shards.placed(sized, shards.as_map(spark, plan, totals)).collect()
    assert len(got) == len(rows) and sum(r.size for r in got) == sum(len((t or "").encode()) + 16 for _, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by.values())
    loads = [sum(r.size for r in rs) for rs in by.values()]
    assert len(loads) == 7 and max(loads) - min(loads) <= 116
    assert {r.text_crc32 for r in got if r.doc_id == 5000} == {0}


def test_rebalancing_moves_little(spark, tmp_path):
    totals = {s: (100 + s % 7, 1) for s in range(shards.SLOTS)}
    old = shards.planned(totals, 10)
    new = shards.rebalanced(old, totals, 11)
    moved = [s for s in range(shards.SLOTS) if old[s] != new[s]]
    assert all(new[s] == 10 for s in moved) and len(moved) < shards.SLOTS / 9
    fewer = shards.rebalanced(old, totals, 9)
    assert max(fewer) == 8 and all(fewer[s] == old[s] for s in range(shards.SLOTS) if old[s] < 9)
    shards.save_map(shards.as_map(spark, old, totals), str(tmp_path), 1)
    shards.save_map(shards.as_map(spark, new, totals), str(tmp_path), 2)
    assert [r.shard for r in shards.load_map(spark, str(tmp_path), 1).orderBy("slot").collect()] == old


# Chat

def test_layouts_become_turns(spark):
    import json

    records = [
        {"prompt": "hi", "response": "yo", "system": "be"},
        {"instruction": "add", "input": "1 2", "output": "3"},
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "</s>[INST] \\n \\ <|im_end|>"}]},
        {"messages": []},
        {"what": 1},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(9, None)], "conv_id long, record string")
    got = {r.conv_id: r for r in chat.format_records(df).collect()}
    assert chat.parsed(got[0].formatted) == [("system", "be"), ("user", "hi"), ("assistant", "yo")]
    assert chat.parsed(got[1].formatted) == [("user", "add\n1 2"), ("assistant", "3")]
    assert chat.parsed(got[2].formatted) == [("user", "a"), ("assistant", "")]
    assert chat.parsed(got[3].formatted)[1] == ("assistant", "</s>[INST] \\n \\ <|im_end|>")
    assert got[4].formatted == "" and got[5].formatted is None and got[9].formatted is None
    a, b = got[3].loss_spans[0].start, got[3].loss_spans[0].stop
    assert chat.unescaped(got[3].formatted[a:b]) == "</s>[INST] \\n \\ <|im_end|>" and not any(c in got[3].formatted[a:b] for c in chat.CONTROL)


def test_records_that_can_not_be_read_are_kept(spark):
    records = {
        0: '{"messages": 5}',
        1: "no JSON",
        2: '{"messages": "abc"}',
        3: None,
        4: '{"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}',
        5: '{"messages": [{"role": "user", "content": [{"type": "image"}]}]}',
        6: '{"messages": [{"role": "user", "content": "\\ud800x"}, {"role": "assistant", "content": 0}]}',
        7: "5",
        8: "[" * 100_000,
        9: '{"prompt": {}, "response": "x"}',
        10: '{"messages": [1, 2]}',
        11: '{"messages": []}',
    }
    df = spark.createDataFrame([*records.items(), (1, "no JSON")], "conv_id long, record string").withColumn("layout", F.lit("clash"))
    rows = chat.format_records(df).collect()
    assert len(rows) == len(records) + 1
    got = {r.conv_id: r for r in rows}
    unread = {k for k, r in got.items() if r.formatted is None}
    assert unread == {0, 1, 2, 3, 5, 7, 8, 9, 10} and all(got[k].layout is None and got[k].loss_spans == [] for k in unread)
    assert {k for k, r in got.items() if r.schema_hash is None} == {1, 3, 8}
    assert chat.parsed(got[4].formatted) == [("user", "ab")]
    assert chat.parsed(got[6].formatted) == [("user", "\ufffdx"), ("assistant", "0")]
    assert got[11].formatted == "" and got[11].layout == "messages"
    assert {r.conv_id: r.n_turns for r in chat.digests(chat.format_records(df)).collect()}[0] == 0
    assert chat.format_records(df.limit(0)).collect() == []


def test_escape_is_reversible():
    rng = random.Random(2)
    parts = [*chat.CONTROL, "\\", "\n", "n", "<", "|", "s>", "é", "[", "INST]"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert chat.unescaped(chat.escaped(text)) == text
        assert not any(c in chat.escaped(text) for c in chat.CONTROL)


def test_conversation_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "x"), (None, 0, None, "y"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    got = {r.conv_id: r for r in chat.digests(chat.format_records(chat.records_of_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert got[1].n_turns == 2 and got[1].turns_sha256 == hashlib.sha256(b"user\nx\nassistant\n\n").hexdigest() and got[1].loss_chars == 0
    assert got[2].n_turns == 2 and got[None].n_turns == 1


def test_conversation_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect() + [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role, text or ""))
    got = {r.conv_id: r for r in entries.op3_chat_format(spark, sf_dir).collect()}
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


# SimHash

def test_simhash_query_equals_brute_force(spark):
    rows = [r for r in ODD if r[0] not in (None, 7)] + [(20 + i, f"some text {i} with words " * (i % 5 + 1)) for i in range(40)]
    got = {r.doc_id: r for r in simhash.compared(docs_of(spark, rows, clash=True)).collect()}
    order = sorted(rows)
    assert set(got) == {i for i, _ in rows}
    for n, (i, t) in enumerate(order):
        t, after = t or "", order[(n + 1) % len(order)][1] or ""
        cut = len(t) // 4
        e = t[: len(t) - cut] + after[:cut]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        if e == t:
            assert got[i].near_edited == 1.0 and got[i].fingerprint == got[i].edited_fingerprint
        other = int(got[order[(n + 1) % len(order)][0]].fingerprint, 16)
        assert got[i].near_next == 1 - (int(got[i].fingerprint, 16) ^ other).bit_count() / 64
    assert simhash.compared(docs_of(spark, ODD)).count() == len(ODD)
    assert simhash.compared(docs_of(spark, [])).count() == 0
    assert simhash.compared(docs_of(spark, [(1, "a b c d")])).first().near_next == 1.0


def simhash_of(text) -> int:
    """The votes one by one; a term's hash is Spark's, each word seeding the next."""
    import re

    import xxhash

    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if x]
    terms = []
    for i in range(len(w)):
        h = 42
        for word in w[i : i + simhash.SHINGLE]:
            h = xxhash.xxh64_intdigest(word.encode(), h)
        terms.append(h)
    return sum(1 << b for b in range(64) if 2 * sum(t >> b & 1 for t in terms) > len(terms))


def test_simhash_bits_and_neighbours_equal_brute_force(spark):
    rng = random.Random(14)
    base = ["one two three four five six seven eight nine ten " * k + "é Ü" for k in (1, 2, 3)]
    rows = [(i, " ".join(rng.choice(["", "zz", "qq"]) if rng.random() < 0.02 else x for x in rng.choice(base).split())) for i in range(200)]
    rows += [(200, ""), (220, None), (40, "another text"), (None, "one two")]
    got = simhash.compared(docs_of(spark, rows, clash=True)).collect()
    want = {(i, f"{simhash_of(t):016x}") for i, t in rows}
    assert {(r.doc_id, r.fingerprint) for r in got} == want and len(got) == len(rows)
    prints = {int(f, 16) for _, f in want}
    for r in got:
        near = sum(0 < (int(r.fingerprint, 16) ^ p).bit_count() <= simhash.RADIUS for p in prints)
        assert r.n_near == (near if r.doc_id is not None and r.doc_id % 20 == 0 else None)
    assert any(r.n_near for r in got)


def test_rank_among_bounds(spark):
    for n in (0, 1, 2, 9, 10, 50):
        bounds = [3 * k - 20 for k in range(n)]
        got = spark.range(-30, 160).select("id", simhash._rank(bounds, F.col("id")).alias("r")).collect()
        assert all(r.r == sum(b <= r.id for b in bounds) for r in got)


def test_block_tables_find_all_near_prints(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(60)]
    every = {x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for x in base for _ in range(4)}
    signed = [x - (1 << 64) if x >> 63 else x for x in every]
    for radius in (1, 3):
        got = {(r.a, r.b) for r in simhash.near(spark.createDataFrame([(x,) for x in signed], "bits long"), radius).collect()}
        want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
        assert got == want


# URL rules

def test_url_rules(spark):
    urls = ["https://a.example.net/en/x", "http://example.net/de/", "https://notexample.net/en/", "http://EXAMPLE.com/de/1?q", "http://x.org/fr/", "http://x.org/frx", "http://x.org", "no scheme", None, "", "http://shop.org/cart?x", "http://x.org/a.exe", "a://b://c.net/", "http://net/?x", "http://x.net?y"]
    rules = [urlrules.site_rule(*r) for r in entries.SITE_RULES] + urlrules.PATTERNS
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, rules).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[1][2:] == ("net/", "block")
    assert got[2][2:] == ("net/", "block") and got[3] == ("example.com", "/de/1", "example.com/de/", "block")
    assert got[4][2:] == ("org/fr/", "allow") and got[5][2:] == (None, "allow") and got[6][1:3] == ("", None)
    assert got[7] == got[8] == got[9] == ("", "", None, "allow")
    assert got[10][2:] == (None, "block") and got[11][2:] == (None, "block") and got[12][0] == "b:" and got[13][2:] == ("net/", "block") and got[14][2] is None
    assert urlrules.judge(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("at_once", [100_000, 3, 1])
def test_rules_in_parts_and_without_a_literal_token(spark, monkeypatch, at_once):
    monkeypatch.setattr(urlrules, "AT_ONCE", at_once)
    urls = ["http://a.net/x", "http://example.net/en/1", "http://q.org/fr/?sessionid=1", "http://q.org/login", "http://z.com/......", "http://z.com/cart/....", None, "mailto:x", "HTTP://A.NET"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "x")], "page_id long, url string, rule string")
    rules = [urlrules.site_rule(*r) for r in entries.SITE_RULES] + urlrules.PATTERNS + [urlrules.block_pattern("dots", r"\.{4}")]
    got = sorted((r.page_id, r.rule, r.pattern, r.verdict) for r in urlrules.judge(pages, rules).collect())
    want = [(0, "net/", None, "block")] * 2 + [(1, "example.net/en/", None, "allow"), (2, "org/fr/", None, "allow"), (3, None, "login", "block"), (4, None, "dots", "block"), (5, None, "cart", "block")]
    assert got == want + [(6, None, None, "allow"), (7, None, None, "allow"), (8, None, None, "allow")]


def test_url_query_equals_sql(spark, sf_dir):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_dir}/pages.parquet')")
    want = sorted(c.sql(entries.OP6_SQL).fetchall())
    assert sorted(tuple(r) for r in entries.op6_url_rules(spark, sf_dir).collect()) == want


# Decontamination

def edited(rng: random.Random, text: str, n: int) -> str:
    chars = list(text)
    for at in rng.sample(range(len(chars)), n):
        chars[at] = rng.choice(["", "#", chars[at] + "%"])
    return "".join(chars)


def test_passages_are_found(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, prose(30)) for i in range(20)] + [(50, None), (51, ""), (52, "tiny"), (53, "exactly ten")]
    rows, want = [], set()
    for i in range(60):
        text = prose(rng.randint(0, 120))
        if i % 3 == 0:
            item, passage = bench[i // 3]
            passage = edited(rng, passage, i % 4 * 2)
            passage = passage.upper() if i % 2 else passage.replace(" ", "\n  ")
            text = f"{text} {passage} {prose(rng.randint(0, 40))}"
            want.add((i, item))
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, "the " * 20_000), (None, bench[3][1]), (103, "say Exactly  TEN now")]
    want |= {(None, 3), (103, 53)}
    got = decontam.leaks(docs_of(spark, rows + rows[:1], clash=True), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert decontam.leaks(docs_of(spark, []), spark.createDataFrame(bench, "item_id long, text string")).count() == 0
    assert decontam.leaks(docs_of(spark, rows), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_blocks_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 10)
    bench = spark.createDataFrame([(i, f"passage number {i} of the benchmark that somebody copied") for i in range(3)], "item_id long, text string")
    got = decontam.leaks(docs_of(spark, [(1, "x passage number 1 of the benchmark that somebody copied y")]), bench).collect()
    assert (1, 1) in {(r.doc_id, r.item_id) for r in got}


def test_one_index_at_a_time(spark, monkeypatch):
    import weakref

    made, alive, real = [], [], decontam.Index

    def counted(items):
        alive.append(sum(x() is not None for x in made))
        index = real(items)
        made.append(weakref.ref(index))
        return index

    monkeypatch.setattr(decontam, "BLOCK_CHARS", 10)
    monkeypatch.setattr(decontam, "Index", counted)
    bench = spark.createDataFrame([(i, f"passage number {i} of the benchmark that somebody copied") for i in range(4)], "item_id long, text string")
    decontam.leaks(docs_of(spark, [(1, "x")]), bench)
    assert len(alive) > 3 and max(alive) <= 1


def test_excerpts_from_the_middle_are_found(spark):
    rng = random.Random(12)
    least = 55
    items = [(i, "".join(rng.choice("abcdefghijklmnop ") for _ in range(n)).replace("  ", "qx").strip() + "z") for i, n in enumerate((60, 90, 130, 200, 333))]
    rows, want = [], set()
    for i, text in items:
        for at in range(0, len(text) - least + 1, 5):
            want.add((len(rows), i))
            rows.append((len(rows), "0" * rng.randint(0, 30) + text[at : at + least] + "1" * 40))
    got = decontam.leaks(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_segments_within_the_budget_are_always_found():
    import numpy as np

    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghij ") for _ in range(96))
    index = decontam.Index([(1, text)])
    e = int(index.budget[0])
    for _ in range(60):
        passage = edited(rng, text, e)
        raw = np.frombuffer(("z" * rng.randint(0, 30) + passage + "z" * 40).encode(), np.uint8)
        point, rows = decontam.normal(raw, np.array([0, len(raw)]))
        segment, row, begin, end, edits = decontam.found(index, point, rows)
        assert len(segment) and edits.min() <= e


def nearest(item: str, text: str) -> int:
    """The fewest edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_decontamination_equals_edit_distance_over_all_pairs(spark):
    """Items of one segment each: found exactly where the edit distance to some part of the text is within the budget."""
    rng = random.Random(21)
    letters = "abcdefgh "
    items = [(i, "x" + "".join(rng.choice(letters) for _ in range(n - 2)).replace("  ", " q") + "y") for i, n in enumerate((40, 48, 24, 30, 44))]
    items = [(i, " ".join(t.split())) for i, t in items]
    rows = []
    for k in range(60):
        i, t = items[k % 5]
        part = edited(rng, t, min(len(t), rng.randint(0, 7)))
        rows.append((k, " ".join(("".join(rng.choice(letters) for _ in range(30)) + part + "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))).split())))
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    index = decontam.Index(items)
    budget = {int(i): int(b) for i, b in zip(index.item, index.budget, strict=True)}
    assert got == {(k, i) for k, text in rows for i, t in items if nearest(t, text) <= budget[i]}


def segment_oracle(items, text, width=96, short=48):
    """Items of which some segment is within its budget of some part of the text, by edit distance."""
    out = set()
    for i, t in items:
        n = len(t)
        for w, step in {(min(n, width), width // 2), (min(n, short), 8)}:
            e = min(int(w * 0.1), (w - 8) // 8)
            if any(nearest(t[a : a + w], text) <= e for a in (*range(0, n - w + 1, step), n - w)):
                out.add(i)
    return out


@pytest.mark.parametrize(("portion", "at_once"), [(1 << 19, 512), (1, 3)])
def test_long_items_equal_edit_distance_over_all_segments(spark, monkeypatch, portion, at_once):
    """Items of several segments, excerpts with edits, in portions of any size."""
    monkeypatch.setattr(decontam, "PORTION", portion)
    monkeypatch.setattr(decontam, "AT_ONCE", at_once)
    rng = random.Random(31)
    letters = "abcdefgh "
    made = lambda n: " ".join(("x" + "".join(rng.choice(letters) for _ in range(n - 2)).replace("  ", " q") + "y").split())
    items = [(i, made(n)) for i, n in enumerate((60, 75, 100, 130))]
    items += [(10, items[3][1]), (11, items[3][1][:70])]  # an equal item, and one whose segments are mostly another's
    rows = []
    for k in range(40):
        _, t = items[k % 4]
        at = rng.randrange(len(t) - 50)
        part = edited(rng, t[at : at + rng.randint(45, 110)], rng.randint(0, 12))
        rows.append((k, " ".join((made(20)[1:] + part + made(rng.randint(3, 30))).split())))
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(k, i) for k, text in rows for i in segment_oracle(items, text)}
    assert got == want and 0 < len(want) < 6 * len(rows)


def test_portions_give_the_same(monkeypatch):
    """Hits worked through one position at a time, and regions three at a time."""
    import numpy as np

    rng = random.Random(41)
    letters = "abcdef "
    items = [(i, "".join(rng.choice(letters) for _ in range(n))) for i, n in enumerate((40, 60, 130, 300))]
    texts = ["".join(rng.choice(letters) for _ in range(30)) + edited(rng, t[10:200], 6) + "-" * 500 + t[:70] for _, t in items for _ in range(4)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    point, rows = decontam.normal(raw, np.append(0, np.cumsum([len(t) for t in texts])))
    index = decontam.Index(items)
    want = {tuple(x) for x in np.stack(decontam.found(index, point, rows)).T.tolist()}
    monkeypatch.setattr(decontam, "PORTION", 1)
    got = {tuple(x) for x in np.stack(decontam.found(index, point, rows)).T.tolist()}
    assert got == want and len(want) > 50
    monkeypatch.setattr(decontam, "AT_ONCE", 3)
    some = {x[:2] for x in (tuple(x) for x in np.stack(decontam.found(index, point, rows)).T.tolist())}
    assert some <= {x[:2] for x in want} and {(r, int(index.item[s])) for s, r in some} == {(r, int(index.item[s])) for s, r, *_ in want}


def test_items_shorter_than_a_q_gram(spark):
    bench = spark.createDataFrame([(1, "abc def"), (2, "X"), (3, " yes\n"), (4, "yes"), (5, "   "), (None, "no")], "item_id long, text string")
    docs = docs_of(spark, [(1, "abc def"), (2, "zabc def"), (3, "say YES now"), (4, "yesterday x"), (5, ""), (6, "abc  DEF\n"), (7, "no"), (8, None)])
    got = {(r.doc_id, r.item_id, r.start, r.stop) for r in decontam.leaks(docs, bench).collect()}
    assert got == {(1, 1, 0, 7), (6, 1, 0, 7), (3, 3, 4, 7), (3, 4, 4, 7), (4, 2, 10, 11), (7, None, 0, 2)}


def test_repeated_characters_stay_small():
    """Ruled lines in the benchmark and in documents: neither memory nor places grow with their product."""
    import time
    import tracemalloc

    import numpy as np

    index = decontam.Index([(1, "-" * 600), (2, "=-" * 300), (3, "a" + "_" * 700)])
    assert len(index.start) < 400 and len(index.place) < 3000
    texts = ["-" * 1_000_000, "x" * 500 + "-" * 40_000 + "y" * 300 + "=-" * 20_000, "_" * 50_000]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    point, rows = decontam.normal(raw, np.append(0, np.cumsum([len(t) for t in texts])))
    tracemalloc.start()
    began = time.time()
    segment, row, begin, end, edits = decontam.found(index, point, rows)
    assert tracemalloc.get_traced_memory()[1] < 600e6 and time.time() - began < 120
    tracemalloc.stop()
    dashes = (index.item[segment] == 1) & (row == 0)
    assert begin[dashes].min() == 0 and end[dashes].max() == 1_000_000 and edits[dashes].min() == 0
    middle = (index.item[segment] == 1) & (row == 1)
    # a segment's first start and last stop, each with some edits
    assert 490 <= begin[middle].min() - rows[1] <= 500 and 40_500 <= end[middle].max() - rows[1] <= 40_510 and edits[middle].min() == 0
    assert {3} <= set(index.item[segment[row == 2]].tolist()) and 2 in index.item[segment[row == 1]]


def test_a_long_item_comes_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 300)
    rng = random.Random(8)
    item = " ".join(f"word{rng.randrange(10**6)}" for _ in range(150))
    docs = docs_of(spark, [(at, "head " + item[at : at + 56] + " tail") for at in range(0, len(item) - 56, 37)])
    got = decontam.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got.count() == docs.count()


def test_rows_of_one_doc_id_are_told_apart(spark):
    text = "a passage of the benchmark that somebody copied into a document"
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    rows = [(5, "some clean text"), (5, "before " + text), (None, text), (None, "clean")]
    got = decontam.passages(docs_of(spark, rows), bench).join(docs_of(spark, rows).select("text", F.xxhash64("text").alias("tag")), "tag").select("text").distinct().collect()
    assert {r.text for r in got} == {"before " + text, text}


# Quality

def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.doc_id: r for r in entries.op10_quality(spark, sf).collect()}
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i in labels if got[i].held_out]
    right = sum(got[i].predicted == labels[i] for i in held)
    assert right / len(held) > 0.93
    good, bad = [got[i].score for i in held if labels[i]], [got[i].score for i in held if not labels[i]]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95


def test_scores_of_odd_texts(spark):
    train = docs_of(spark, [(i, "good words here" if i % 2 else "### *** !!") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, None), (999, 1), (None, 1)], "doc_id long, label int")
    w = quality.train(train, labels)
    got = quality.scores(docs_of(spark, ODD, clash=True), w).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    both = quality.scored(docs_of(spark, ODD, clash=True), w)
    assert sorted(round(r.score, 9) for r in both.collect()) == sorted(round(r.score, 9) for r in got)
    assert quality.scores(docs_of(spark, []), w).count() == 0
    assert quality.train(train, labels.limit(0)).shape == w.shape


@pytest.mark.parametrize("seed", [1])
def test_features_don_t_cross_rows(seed):
    import numpy as np
    import pyarrow as pa

    alone = [quality.features(pa.array([t]))[0] for t in ("a b", "", "c!! d")]
    at, rows = quality.features(pa.array(["a b", "", "c!! d"]))
    assert all((np.sort(at[rows[i] : rows[i + 1]]) == np.sort(alone[i])).all() for i in range(3))
