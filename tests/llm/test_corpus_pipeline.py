"""Every stage of the pipeline on what the stage before it kept, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from test_corpus_operators import _contaminated, _ids, _joined, _passages_cut, _sentence

import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    good = [_sentence(rng, 90) for _ in range(60)]
    junk = [" ".join(w.upper() + "!!" for w in _sentence(rng, 90).split()) for _ in range(30)]
    passage = _sentence(rng, 120)
    rows = list(enumerate(good)) + [(100 + k, t) for k, t in enumerate(junk)]
    rows += [(200, good[3]), (201, good[3] + " and"), (202, f"{_sentence(rng, 20)} {passage} {_sentence(rng, 50)}")]
    rows += [(203, f"{_sentence(rng, 40)} {passage}"), (204, f"{_sentence(rng, 30)} {' '.join(good[5].split()[10:30])}"), (205, None), (206, "")]
    rows += [(200, good[3]), (None, _sentence(rng, 70))]
    root = str(tmp_path_factory.mktemp("corpus"))
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or ""), "x") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string")
    frame.repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(k, 1) for k in range(60)] + [(100 + k, 0) for k in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
    items = [(1, " ".join(good[5].split()[8:32])), (2, _sentence(rng, 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows, items


def test_stages(spark, folder):
    root, rows, items = folder
    docs, names = spark.read.parquet(f"{root}/documents.parquet"), dict(corpus_pipeline.STAGES)

    def step(name, frame):
        out = names[name](spark, frame, root)
        assert out.columns == docs.columns
        return out.cache(), [(r["doc_id"], r["text"]) for r in out.collect()]

    kept, found = step("quality", docs)
    assert not {d for d, _ in found} & set(range(100, 130)) and {d for d, _ in found} >= set(range(60))
    kept, after = step("ngram_join", kept)
    assert Counter(after) == Counter({(d, t) for (d, t), (_, _, c) in zip(found, _joined(found), strict=True) if d == c})
    kept, cut = step("suffix_dedup", kept)
    assert Counter(cut) == Counter(_passages_cut(after, 51)) and Counter(cut) != Counter(after)
    kept, clean = step("decontamination", kept)
    hit = _contaminated(cut, items)
    assert Counter(clean) == Counter(row for row, (_, _, n, _) in zip(cut, hit, strict=True) if not n) and len(clean) < len(cut)
    packed = names["packing"](spark, kept, root).collect()
    tokens = Counter()
    for r in packed:
        tokens[r["doc_id"]] += r["length"]
    assert tokens == Counter({d: len(_ids(t)) for d, t in clean})
    whole = corpus_pipeline.run(spark, root).collect()
    shown = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in whole]
    assert Counter(shown) == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)


def test_nothing_to_do(spark, folder, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
