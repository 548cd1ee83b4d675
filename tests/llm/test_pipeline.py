"""The pipeline's stages on planted cases: each one's decisions take effect, clean documents stay."""

import random

import corpus_pipeline


def test_pipeline_on_planted_cases(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ka", "to", "mi", "re", "su", "lan", "der"]) for _ in range(rng.randint(1, 3)))
    text = lambda n: " ".join(word() for _ in range(n))
    docs = [(i, text(80)) for i in range(120)]
    junk = [(i, " ".join(w + "%%%" for w in text(80).split())) for i in range(200, 240)]
    passage = text(14)
    docs[7] = (7, docs[7][1] + " " + passage.upper())
    docs[8] = (8, docs[8][1] + ' token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"')
    copies = [(300, docs[3][1]), (301, docs[4][1].replace(docs[4][1].split()[0], "neu", 1))]
    rows = docs + junk + copies
    d = f"file://{tmp_path}"
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i, _ in docs + junk if i % 2], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    state = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, d)
        assert state.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = {r.doc_id: r for r in state.collect()}
    kept = set(range(120))
    assert set(seen["quality_classifier"]) == kept | {300, 301}
    assert set(seen["minhash_near_dedup"]) == kept
    assert set(seen["benchmark_decontamination"]) == kept - {7}
    clean = seen["secret_scan"]
    assert "f33e" not in clean[8].text and clean[8].n_chars == len(clean[8].text)
    assert all(clean[i].text == t for i, t in docs if i not in (7, 8))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, d).collect()}
    assert set(out) == kept - {7} and all(r.n_tokens > 0 for r in out.values())


def stage_of(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_odd_rows_in_every_stage(spark, tmp_path):
    """Null ids and texts, empty and repeated rows, ties, further columns with names used inside; empty tables."""
    d = f"file://{tmp_path}"
    passage = " ".join(f"bench{i}" for i in range(12))
    plain = "quiet water ran over the stones while somebody counted boats and drank cold tea"
    rows = [
        (1, plain), (1, plain), (None, plain), (2, None), (None, None), (3, ""), (3, passage + " x"), (4, "alpha beta gamma delta epsilon zeta"),
        (4, "other words under the same number stand here"), (None, passage), (5, "key = " + "x1Y2z3W4v5U6t7S8r9Q0p1O2"), (6, "long " * 60_000),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, c0 int, `a.b` int, `row_key` int, `ROW_KEY_` int, `it``s \"q\"` int"
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "i", "r", 7, 1, 2, 3, 4) for i, t in rows], schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage), (None, "x"), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    read = spark.read.parquet(f"{d}/documents.parquet")
    loose = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "i", "r", 7, 1, 2, 3, 4) for i, t in rows], schema)
    texts = lambda df: sorted((str(r.doc_id), r.text) if r.text is not None else (str(r.doc_id), "-") for r in df.collect())
    for docs in (read, loose):
        assert texts(stage_of("quality_classifier")(spark, docs, d)) == texts(docs)
        once = stage_of("minhash_near_dedup")(spark, docs, d)
        # one of (1, 1, null) with one text, one of three without words, one of two with the passage; the rest
        assert [i for i, t in texts(once) if t == plain] == ["1"] and once.count() == len(rows) - 5 and once.columns == docs.columns
        assert "2" in [i for i, _ in texts(once)] and "3" in [i for i, _ in texts(once)]
        clean = stage_of("benchmark_decontamination")(spark, docs, d)
        assert clean.count() == len(rows) - 2 and not any("bench" in t for _, t in texts(clean)) and [i for i, _ in texts(clean)].count("3") == 1
        safe = stage_of("secret_scan")(spark, docs, d)
        assert safe.count() == len(rows) and sum("SECRET" in t for _, t in texts(safe)) == 1 and safe.where("c0 = 7 and id = 'i' and row = 'r'").count() == len(rows)
        assert all(x.columns == docs.columns and x.where("`a.b` = 1 and row_key = 2 and row_key_ = 3").count() == x.count() for x in (once, clean, safe, stage_of("quality_classifier")(spark, docs, d)))
        assert stage_of("byte_bpe")(spark, docs, d).count() == len(rows)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, read.limit(0), d).count() == 0, name
