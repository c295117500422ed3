"""Each stage of the pipeline on planted rows, and the stages one after another."""

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, 3000, n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows, labels = np.random.default_rng(21), [], []
    item = "the heron stands all morning in the shallow water and waits for one small silver fish to pass"
    for i in range(150):
        toxic = i % 5 == 0
        rows.append((i, prose(rng, 70) + (" vile filth scum" if toxic else "") + "\nfollow us on every site for more\nend of it", "en", f"s{i % 14}", 0))
        labels.append((i, 1, int(toxic)))
    copy = rows[7][1].split("\n")[0]
    rows += [(200, f"{copy} tail", "en", "s1", 0), (201, f"{prose(rng, 30)} {item} {prose(rng, 30)}", "en", "s2", 0), (202, prose(rng, 60), "en", "s3", 0), (203, None, "en", None, None), (204, "", "en", "s1", 0)]
    at = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages(spark, folder):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        out = stage(spark, docs, folder)
        if i < 4:
            assert out.columns == columns, name
            out.write.parquet(f"{folder}/stage_{i}.parquet")
            docs = spark.read.parquet(f"{folder}/stage_{i}.parquet")
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        else:
            packed = out.collect()
    clean = {i for i in range(150) if i % 5} | {200, 201, 202, 203, 204}
    assert set(kept["toxicity"]) == clean
    lines = kept["line dedup"]
    assert set(lines) == clean and "follow us" not in lines[1] and "end of it" not in lines[1] and lines[203] is None and lines[204] == ""
    once = kept["n-gram Jaccard join"]
    assert set(once) == clean - {200}
    assert set(kept["benchmark decontamination"]) == clean - {200, 201}
    assert {r["doc_id"] for r in packed} == clean - {200, 201}
    ends = {}
    for r in packed:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in ends.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))] and sum(n for _, n in x) <= 2048


def test_stages_of_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
