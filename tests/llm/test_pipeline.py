"""Every stage on its own input against brute force, and the registered queries on the smallest tables."""

import os

import pytest

import test_decontaminate
import test_line_dedup
import test_near_dup
import test_packing
import test_toxicity

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages(spark, tmp_path):
    import corpus_pipeline
    docs, _, labels = test_toxicity.labelled_corpus(spark, 400)
    shared = "a line that is repeated in several of the documents of this table"
    item = "benchmark question with a dozen words that no other document here will hold"
    rows = [(i, f"{t}\n{shared}" if i % 9 == 0 else t) for i, t in docs]
    rows += [(1000 + i, rows[i][1] + " tail") for i in (7, 8, 10)] + [(2000, f"before {item.upper()}! after"), (2001, None), (2002, "")]
    sf_dir = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf_dir}/documents.parquet")
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, before = df.columns, {i: t for i, t in rows}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dup", "decontaminate", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, sf_dir)
        out.write.parquet(f"{sf_dir}/out-{k}")
        after_df = spark.read.parquet(f"{sf_dir}/out-{k}")
        if name == "packing":
            test_packing.check(after_df.collect(), list(before.items()))
            break
        assert after_df.columns == names
        after = {r.doc_id: r.text for r in after_df.collect()}
        assert after_df.count() == len(after)
        if name == "toxicity":
            gone = set(before) - set(after)
            toxic = {i for i in before if i < 400 and i % 6 == 0}
            assert len(gone & toxic) > 0.9 * len(toxic) and len(gone - toxic) <= 3
            assert all(after[i] == before[i] for i in after)
        elif name == "line_dedup":
            gone = test_line_dedup.brute_force(list(before.items()))
            want = {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, [])) for i, t in before.items()}
            assert after == {i: t for i, t in want.items() if i not in gone or t.split()}
            assert sum(shared in (t or "") for t in after.values()) == 1
        elif name == "near_dup":
            parts, _ = test_near_dup.brute_force(list(before.items()), 5, 80)
            assert after == {i: t for i, t in before.items() if parts[i] == i}
        else:
            assert after == {i: t for i, t in before.items() if not test_decontaminate.brute_force(t, [(1, item)])[4]} and 2000 not in after
        df, before = after_df, after


@given
def test_registered_queries(spark):
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    per_document = {"op2", "op3", "op5", "op6", "op7", "op8"}
    for n in names:
        got = entry.queries()[n](spark, SF)
        assert got.count() == docs if n.split("_")[0] in per_document else got.count() > 0, n
        assert len(set(got.columns)) == len(got.columns)
    assert entry.queries()["pipeline"](spark, SF).columns[:3] == ["doc_id", "start", "length"]
