"""The pipeline: what each stage keeps, on its own input and in run()."""

import collections

import corpus_pipeline
from ordermart.llm.common import corpus_session

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    corpus_session(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen, last = docs.columns, [docs.count()], docs
    by_stage = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        last = spark.createDataFrame(stage(spark, last, SF).collect(), docs.schema)
        assert last.columns == columns, name
        by_stage.append(last)
        seen.append(last.count())
    start, good, unique, clean, mixed = (sorted(tuple(r) for r in x.collect()) for x in by_stage)
    assert set(good) < set(start) and set(unique) < set(good) and set(clean) <= set(unique) and set(mixed) <= set(clean)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    lost = [labels[r[0]] for r in set(start) - set(good) if r[0] in labels]
    assert lost.count(1) <= 1 and lost.count(0) > 0
    flat = lambda t: " ".join((t or "").lower().split())
    items = [flat(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r for r in unique if any(x in flat(r[columns.index("text")]) for x in items)}
    assert leaks and not leaks & set(clean) and len(clean) >= len(unique) - len(leaks) - 1
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*columns, "shard", "slot"]
    rows = out.collect()
    assert collections.Counter(tuple(r)[:len(columns)] for r in rows) == collections.Counter(mixed)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
