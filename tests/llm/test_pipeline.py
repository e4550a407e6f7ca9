import corpus_pipeline
from tidyleads.llm import common, op01_quality, op03_mixing, op08_decontaminate, op09_sharding
from tidyleads.llm.components import components
from test_near_dedup import _sets, brute


def test_stages_against_plain_versions(spark, sf_small, docs):
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    good = {r.doc_id for r in op01_quality.grade_documents(docs, op01_quality.graded(labels)).where("kept").collect()}
    one = stages["quality"](spark, docs, sf_small)
    assert one.columns == names and {r.doc_id for r in one.collect()} == good and len(good) >= 0.7 * docs.count()
    rows = [(r.doc_id, r.text) for r in one.collect()]
    two = stages["near_dedup"](spark, one, sf_small)
    kept = [c for (d, n, c) in brute(rows, 5, 80)[0]]
    assert two.columns == names and {r.doc_id for r in two.collect()} == {d for (d, _), c, s in zip(rows, kept, _sets(rows, 5)) if d == c or not s}
    three = stages["decontaminate"](spark, two, sf_small)
    items = [op08_decontaminate.normalise(r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    texts = {r.doc_id: op08_decontaminate.normalise(r.text) for r in two.collect()}
    left = {r.doc_id for r in three.collect()}
    assert three.columns == names and not any(i in texts[d] for d in left for i in items)
    assert all(any(op08_decontaminate.myers(i, texts[d])[0] <= len(i) // 20 for i in items) for d in texts if d not in left)
    four = stages["mix"](spark, three, sf_small)
    taken = {r.doc_id: r for r in op03_mixing.mix_documents(three).collect()}
    times = {}
    for r in four.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert four.columns == names
    for d, r in taken.items():
        assert times.get(d, 0) * r.size >= r.taken and (times.get(d, 0) > 0) == (r.taken > 0) and times.get(d, 0) <= 2
    five = stages["shard"](spark, four, sf_small)
    assert five.count() == four.count() and {r.shard for r in five.collect()} <= set(range(16))
    assert op09_sharding.shard_documents(four).exceptAll(five).count() == 0


def test_run_is_the_stages_in_order(spark, sf_small):
    rows = corpus_pipeline.run(spark, sf_small)
    assert rows.count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_stages_of_edge_rows(spark, clashing, empty, sf_small):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, sf_small)
        assert out.columns == clashing.columns
        out.count()
        assert stage(spark, empty, sf_small).count() == 0


def test_jobs_of_the_stages_give_the_drivers_heap_back(spark):
    """Rounds of components plan many jobs: the heap is collected after each, not when it is full."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    collected = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = collected()
    edges = spark.createDataFrame([(i + 1, i) for i in range(20)], "u long, v long")
    assert {r.root for r in components(edges).collect()} == {0}
    assert collected() - before >= 2
    assert corpus_pipeline.materialize is common.settled
