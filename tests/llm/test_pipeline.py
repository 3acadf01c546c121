from collections import Counter

import numpy as np

import corpus_pipeline
from riskweave.llm.mixing import plan_mix


def test_stages_keep_what_they_should(spark, tmp_path):
    rng = np.random.default_rng(2)
    words = [a + b for a in ("the", "on", "re", "ti", "sha", "ou") for b in ("nd", "ing", "ble", "er", "st", "ha")]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(60)]
    toxic = [int(i % 4 == 0) for i in range(60)]
    texts = [f"idiot {t} moron scum" if y else t for t, y in zip(texts, toxic)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(100, texts[1], "en", "s0", 0), (101, texts[1].replace(" ", "  "), "en", "s1", 0), (102, None, None, None, None), (103, "", "de", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, folder = spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)
    stages = dict(corpus_pipeline.STAGES)

    clean = stages["toxicity"](spark, docs, folder)
    assert clean.columns == docs.columns
    kept = {r.doc_id for r in clean.collect()}
    truth = {i for i, y in enumerate(toxic) if not y} | {100, 101, 102, 103}
    assert len(kept & truth) >= 0.9 * len(truth) and len(kept - truth) <= 0.2 * sum(toxic)

    exact = stages["exact_dedup"](spark, docs, folder)
    assert exact.columns == docs.columns
    assert Counter(" ".join((r.text or "").split()) for r in exact.collect()).most_common(1)[0][1] == 1
    assert {r.doc_id for r in exact.collect()} == set(range(60)) | {102}

    near = stages["near_dedup"](spark, docs, folder)
    assert near.columns == docs.columns
    shingles = {r[0]: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for r in rows for w in [(r[1] or "").split()]}
    first = [i for i, s in shingles.items() if not any(j < i and len(s & t) >= 0.8 * len(s | t) for j, t in shingles.items())]
    assert sorted(r.doc_id for r in near.collect()) == sorted(first)

    mixed = stages["mix_sources"](spark, docs, folder)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in plan_mix(docs).collect() if r.copies})

    pieces = stages["pack"](spark, docs, folder).collect()
    held = Counter()
    for p in pieces:
        held[p.doc_id] += p.length
    assert held == Counter({p.doc_id: p.doc_tokens for p in pieces}) and set(held) == {r[0] for r in rows}
