from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

import corpus_pipeline
from skyloom.llm import entries
from tests.llm.helpers import docs_of
from tests.llm.test_dedup import components, removed


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality classifier"](spark, docs, sf_dir)
    scores = {r.doc_id: r.predicted for r in entries.op10_quality(spark, sf_dir).collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, p in scores.items() if p}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = removed(rows)
    cut = {r.doc_id: r for r in stages["line dedup"](spark, docs, sf_dir).collect()}
    for i, t in rows:
        lines = t.split("\n")
        left = [x for k, x in enumerate(lines) if (i, k) not in want]
        assert (i in cut) == bool(left)
        if left:
            assert cut[i].text == "\n".join(left)
    near = {r.doc_id for r in stages["MinHash near-dedup"](spark, docs, sf_dir).select("doc_id").collect()}
    assert near == {d for d, _, c in components(rows) if d == c}
    leaked = {r.doc_id for r in entries.op1_decontaminate(spark, sf_dir).collect()}
    clean = {r.doc_id for r in stages["benchmark decontamination"](spark, docs, sf_dir).select("doc_id").collect()}
    assert clean == {i for i, _ in rows} - leaked
    coded = stages["byte-level BPE"](spark, docs, sf_dir).join(docs.select("doc_id", F.sha2("text", 256).alias("want")), "doc_id")
    assert coded.where("want <> text_sha256").isEmpty()


def test_run_and_columns(spark, sf_dir):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs_of(spark, [(1, "a b c d e f"), (2, None), (3, "")], clash=True), sf_dir)
        assert out.columns == corpus_pipeline.COLUMNS
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


X = "one text of quite a few words that others copy word by word as it is"
Y = "something else entirely which nobody has ever repeated anywhere in this table"
LEAK = "a passage of the benchmark that somebody has copied into a document of theirs"


def by_row(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.text or "", r.text is None) for r in df.select("doc_id", "text").collect()))


def rows_of(rows):
    return sorted((i is None, i or 0, t or "", t is None) for i, t in rows)


def test_dedup_keeps_other_texts_of_a_doc_id(spark, sf_dir):
    stage = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    assert by_row(stage(spark, docs_of(spark, [(2, X), (5, X), (5, Y)]), sf_dir)) == rows_of([(2, X), (5, Y)])
    rows = [(2, X), (2, X), (5, X + " now"), (5, Y), (None, X), (None, Y + " or so"), (None, None), (None, None), (7, ""), (7, ""), (8, LEAK), (8, LEAK), (None, LEAK), (3, None)]
    got = stage(spark, docs_of(spark, rows, clash=True), sf_dir)
    assert by_row(got) == rows_of([(2, X), (5, Y), (None, None), (None, None), (7, ""), (7, ""), (8, LEAK), (3, None)])
    assert got.columns == corpus_pipeline.COLUMNS


def test_one_row_of_each_group_stays_against_brute_force(spark, sf_dir):
    """Repeated and shared ids: rows are grouped by brute force, and of each group the least row stays, once."""
    import random

    from tests.llm.helpers import alike, shingles
    from tests.llm.test_dedup import near_copies, text_hash

    rng = random.Random(17)
    rows = [(rng.choice([None, *range(9)]), t) for _, t in near_copies(21)]
    rows += rows[:20]
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    rank = lambda r: (r[0] is None, r[0] or 0, text_hash(r[1]))
    want = [min((r for r, g in zip(rows, group) if g == k), key=rank) for k in {*group}]
    got = dict(corpus_pipeline.STAGES)["MinHash near-dedup"](spark, docs_of(spark, rows), sf_dir)
    assert by_row(got) == rows_of(want)


def test_decontamination_keeps_other_texts_of_a_doc_id(spark, tmp_path):
    spark.createDataFrame([(1, LEAK)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, X), (1, LEAK), (2, "so " + LEAK), (2, "so " + LEAK), (None, LEAK), (None, Y), (None, None), (3, "")]
    got = dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs_of(spark, rows, clash=True), str(tmp_path))
    assert by_row(got) == rows_of([(1, X), (None, Y), (None, None), (3, "")])


def test_whole_pipeline_on_repeated_ids_and_empty_tables(spark, sf_dir, tmp_path, monkeypatch):
    """All stages one after the other; the classifier lets everything through here."""
    from skyloom.llm import entries

    monkeypatch.setattr(entries, "ACCEPT", 0.0)
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(f"{tmp_path}/some/{t}.parquet")
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    leak = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rows = [(2, X), (5, X + "\nand a line of its own"), (5, Y), (5, Y), (None, Y + "\nunlike the rest of them"), (None, None), (6, ""), (7, "see: " + leak)]
    docs_of(spark, rows, clash=True).write.parquet(f"{tmp_path}/some/documents.parquet")
    docs_of(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    # the line Y stays in the row without an id, which comes first; the one in (5, Y) and the line X in (5, X) go
    want = [(2, X), (5, "and a line of its own"), (None, Y + "\nunlike the rest of them"), (None, None), (6, "")]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text_sha256) for r in got) == sorted((i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in want)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
