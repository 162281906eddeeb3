import random
import re

import corpus_pipeline
from corpus import LABELS, awkward, documents, empty, sentence
from test_jaccard_join import sets
from test_toxicity import TERMS


def planted(spark, folder):
    rng = random.Random(8)
    clean = [sentence(rng, 80, "clean") for _ in range(60)]
    shared = sentence(rng, 60, "shared")
    item = sentence(rng, 14, "bench")
    texts = {i: t for i, t in enumerate(clean)}
    for i in range(100, 130):
        texts[i] = " ".join([*sentence(rng, 40).split(), *rng.sample(TERMS, 3), *sentence(rng, 20).split()])
    texts |= {200 + i: clean[0] for i in range(3)}
    texts |= {210 + i: clean[1] + f" e{i}" for i in range(3)}
    texts |= {220 + i: sentence(rng, 70) + "\n" + shared for i in range(6)}
    texts |= {230 + i: sentence(rng, 30) + " " + item + " " + sentence(rng, 30) for i in range(3)}
    docs = documents(spark, list(texts.items()))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(100 <= i < 130)) for i in texts]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts, shared, item


def test_stages_catch_what_is_planted_and_keep_the_rest(spark, tmp_path):
    folder = str(tmp_path)
    texts, shared, item = planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
        seen.append((name, {r.doc_id: r.text for r in docs.collect()}))
        if name != "mixing":
            assert docs.columns == columns
    after = dict(seen)
    clean = set(range(60))
    assert set(after["toxicity"]) == set(texts) - set(range(100, 130))
    lines = after["line_dedup"]
    assert set(lines) == set(after["toxicity"])
    assert [i for i, t in lines.items() if shared in t] == [225]
    near = after["near_duplicates"]
    assert set(lines) - set(near) == {*range(200, 203), *range(210, 213)}
    assert all(100 * len(sets(near[a], 5) & sets(near[b], 5)) < 80 * len(sets(near[a], 5) | sets(near[b], 5))
               for a in near for b in near if a < b)
    assert set(near) - set(after["decontamination"]) == {230, 231, 232}
    assert clean <= set(after["decontamination"])
    assert set(after["mixing"]) <= set(after["decontamination"]) and after["mixing"]
    ran = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in ran.collect()} == set(after["mixing"])
    assert not any(re.search("bench", t) for t in after["decontamination"].values())


def test_awkward_and_empty_tables_pass_every_stage(spark, tmp_path):
    folder = str(tmp_path)
    planted(spark, folder)
    for table in (awkward(spark), empty(spark)):
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, table, folder)
            assert set(table.columns) <= set(out.columns)
            assert 0 <= out.count() <= table.count()
