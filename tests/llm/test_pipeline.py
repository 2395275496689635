import os
import shutil
import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline
from logtide.llm import packing, pu_quality, quality_rules
from logtide.llm.common import fold, table
from tests.llm.helpers import jaccard_components

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_match_brute_force(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = {r.doc_id: r for r in docs.collect()}
    rules = quality_rules.train(docs, labels)
    classifier = pu_quality.train(docs, labels, fold("doc_id", 4) != 2)
    kept = {i for i, r in rows.items() if quality_rules.judge([r.text or ""], rules)["kept"][0]}
    kept = {i for i in kept if pu_quality.score([rows[i].text or ""], classifier)[0] >= pu_quality.PREDICT_AT}
    _, root = jaccard_components([(i, rows[i].text) for i in kept])
    kept = {i for i in kept if root[i] == i}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns, name
    assert {tuple(r) for r in now.collect()} == {tuple(rows[i]) for i in kept}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == kept
    want = {tuple(r) for r in packing.pack(now, corpus_pipeline.tokenizer_path("byte_bpe_50k.json"))
            .select("doc_id", "piece", "start", "length", "ids_crc32").collect()}
    assert {tuple(r)[:5] for r in packed} == want
    good = {r.doc_id for r in labels.where("quality = 1").collect()} & set(rows)
    lost = {i for i in good if root.get(i) is None}
    assert len(lost) <= 0.05 * len(good) + sum(len((rows[i].text or "").split()) < 20 for i in good)


def test_stages_on_odd_rows(spark):
    """Null, empty, repeated and id-less rows, extra columns with clashing names, and an empty table."""
    docs = table(spark, SF, "documents").limit(40)
    odd = spark.createDataFrame([(90001, None, "en", "s", None), (90002, "", None, None, 0), (None, "too short", "en", "s", 9),
                                 (None, None, None, None, None)], docs.schema)
    long = docs.where("length(text) > 400").limit(1)
    rows = docs.unionByName(odd).unionByName(long).unionByName(long).unionByName(long.withColumn("doc_id", F.lit(None).cast("long")))
    names = ["_id", "_text", "n", "kept", "digest", "key", "tile", "length", "score", "rank"]
    rows = rows.withColumns({c: F.lit(c) for c in names})
    now = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == rows.columns, name
        assert stage(spark, rows.limit(0), SF).count() == 0, name
    kept = now.collect()
    assert kept and all(r.text and len(r.text.split()) >= 20 for r in kept)
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids))                     # the repeated row is one
    packed = corpus_pipeline.packing_stage(spark, rows, SF).collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    assert sum(r.piece == 0 for r in packed) == rows.count()
    assert corpus_pipeline.packing_stage(spark, rows.limit(0), SF).count() == 0


def test_entry_without_the_operators(tmp_path):
    """The rest imports and registers when this subpackage and the pipeline are absent."""
    for name in ("logtide", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); "
                          "print(len(q), any(k.startswith('op') and k[2].isdigit() for k in q), 'pipeline' in q)"],
                         cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split()[1:] == ["False", "False"] and int(out.stdout.split()[0]) > 50


def test_texts_are_looked_at_in_small_arrays(spark, monkeypatch):
    """What a Python worker holds beside its batch does not grow with the batch: several MB of texts, few MB of arrays."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from logtide.llm import common, pu_quality, quality_rules

    monkeypatch.setattr(common, "map_arrow", lambda df, fn, schema: fn)
    text = " ".join(f"word{k * k % 997} of a line" for k in range(150))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": [f"{k} {text}" for k in range(3000)]})
    docs = spark.createDataFrame([], "doc_id long, text string")
    rng = np.random.default_rng(1)
    net = pu_quality.Net(np.zeros(pu_quality.FEATURES), np.ones(pu_quality.FEATURES),
                         rng.normal(0, 1, (pu_quality.FEATURES, 4)), np.zeros(4), np.ones(4), 0.0)
    runs = [quality_rules.keep_quality(docs, quality_rules.Model(np.zeros(1 << 18, np.float32), 1.0, 1.0, 0.0)),
            pu_quality.keep_predicted(docs, pu_quality.Model(net, 0.5))]
    assert batch.nbytes > 6 << 20
    for run in runs:
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40 << 20


def test_tables_of_the_driver_need_no_python_workers(spark):
    """A list of rows would be read by Python workers of another kind, which stay beside those of the operators."""
    import pyarrow as pa

    from logtide.llm import packing

    pieces = spark.createDataFrame(pa.table({"_row": [1, 2], "piece": pa.array([0, 0], pa.int32()), "length": [5, 7]}))
    ranks = packing.ranked(pieces, {5: 1, 7: 1})
    assert "ExistingRDD" not in ranks._jdf.queryExecution().toString()
    assert sorted((r["length"], r["rank"]) for r in ranks.collect()) == [(5, 0), (7, 0)]
