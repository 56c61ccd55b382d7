import corpus_pipeline
from parcelflow.llm import registry
from parcelflow.llm.common import stored

from test_decontamination import _plain, _shingles
from test_near_dup import brute as brute_groups
from test_quality_rules import brute as brute_counts


def _write(spark, scratch, docs, labels, items):
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")


def test_each_stage_takes_effect(spark, frame, words, scratch):
    item = words(40, 900)
    rows = [(i, " ".join(words(60, i))) for i in range(20)]
    rows += [(100, rows[4][1] + " end"), (101, rows[4][1]), (102, "too short"), (103, None), (104, " ".join([*words(30, 70), *item, *words(30, 71)])),
             (105, " ".join([*words(40, 72), "mail me@example.com or", *words(10, 73)])), (106, "a b c d e " * 9)]
    _write(spark, scratch, frame(rows), [], [(1, " ".join(item))])
    docs, kept = spark.read.parquet(f"{scratch}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stored(stage(spark, docs, scratch), name)
        kept[name] = {r.doc_id: r.asDict().get("text") for r in docs.collect()}
        assert name == "best_fit_packing" or docs.columns == columns
    good = {i: t for i, t in rows if not ((c := brute_counts(t))[0] < 10 or 100 * c[4] > 20 * c[0])}
    assert set(kept["quality_rules"]) == set(good)
    unique = {i for i, v in brute_groups(list(good.items())).items() if v[2]}
    assert set(kept["minhash_near_dedup"]) == unique and 4 in unique and not {100, 101} & unique
    own = _shingles(item)
    clean = {i for i in unique if not any(sum((own & _shingles(_plain(good[i])[s : s + 40])).values()) >= 0.75 * sum(own.values()) for s in range(200))}
    assert set(kept["benchmark_decontamination"]) == clean == unique - {104}
    assert "me@example.com" not in kept["pii"][105] and "<EMAIL>" in kept["pii"][105]
    assert {i: t for i, t in kept["pii"].items() if i != 105} == {i: good[i] for i in clean if i != 105}
    assert set(kept["best_fit_packing"]) == clean
    assert {r.doc_id for r in corpus_pipeline.run(spark, scratch).collect()} == clean


def test_empty_tables(spark, frame, scratch):
    _write(spark, scratch, frame([]), [], [])
    assert corpus_pipeline.run(spark, scratch).count() == 0


def test_registry():
    assert [n.split("_")[0] for n in registry.queries()] == [f"op{i}" for i in range(1, 14)]
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]
