import os

import pytest
from pyspark.sql import functions as F

from tabweave.llm import fm, mixing

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, now, DATA).cache()
        assert out.columns == docs.columns, name
        assert 0 < out.count(), name
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in now.select("doc_id").collect()}
        if "mixing" not in name:
            assert len(ids) == out.count()
        now = out
    last = corpus_pipeline.STAGES[4][1](spark, now, DATA)
    assert last.count() == now.count() and last.columns == [*docs.columns, "shard", "slot"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_stages_against_brute_force(spark):
    """Each stage on its own input, with columns of clashing names: what goes, what stays, and nothing else."""
    from test_operators import brute_classes, brute_contamination
    extra = {"__score": F.lit("a"), "__good": F.lit(7), "__id": F.lit(8), "__doc": F.lit(9), "__spans": F.lit("s")}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumns(extra).cache()
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    texts = {r.doc_id: r.text for r in docs.collect()}

    model = fm.trained(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    rows = {r.doc_id: model.scores([fm.features(r.text, r.n_chars, {})])[0] for r in docs.collect()}
    good = stages["quality classifier"](spark, docs, DATA)
    assert good.columns == docs.columns and ids(good) == sorted(d for d, s in rows.items() if s >= 0.3) and {(r["__score"], r["__good"]) for r in good.collect()} == {("a", 7)}

    unique = stages["n-gram Jaccard join"](spark, docs, DATA)
    assert unique.columns == docs.columns and ids(unique) == sorted(d for d, (_, c) in brute_classes(list(texts.items()), 5, 80).items() if c == d)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    hit = {d: brute_contamination(t, items) for d, t in texts.items()}
    clean = stages["benchmark decontamination"](spark, docs, DATA)
    assert clean.columns == docs.columns and ids(clean) == sorted(d for d, (n, k, _) in hit.items() if not k or 20 * k < n)

    mixed = stages["mixing sources to target weights"](spark, docs, DATA)
    assert mixed.columns == docs.columns and all((texts[r.doc_id] or "").startswith(r.text) for r in mixed.collect())
    size = lambda t: len((t or "").encode().split())
    source, own, taken = {r.doc_id: r.source for r in docs.collect()}, {}, {}
    for d, t in texts.items():
        own[source[d]] = own.get(source[d], 0) + size(t)
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
    want = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(own.items()), "source string, source_size long")).collect()}
    assert all(abs(taken.get(s, 0) - t) <= 1 for s, t in want.items())

    out = stages["sharding"](spark, mixed, DATA)
    assert sorted(map(str, out.select(*docs.columns).collect())) == sorted(map(str, mixed.collect()))
    slots = {}
    for r in out.select("shard", "slot").collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
