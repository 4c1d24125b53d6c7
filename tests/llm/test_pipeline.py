import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from llm_helpers import documents
from test_dedup import edited, near_brute
from test_models_llm import labelled
from test_search import contaminated_brute

import corpus_pipeline
from marketgrain.llm import byte_bpe, catalog, quality


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    rows, labels = labelled(spark)
    rows = [*rows, *[(i + 5000, t) for i, t in rows[:20]], *edited(3)[:80], (9000, "x the passage of a test y"), (9001, None)]
    folder = str(tmp_path)
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    items = [(1, "the passage of a test")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    found = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, folder).collect())

    good = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    left, seen = [], set()
    for i, t in sorted((r for r in rows if r[0] in good), key=lambda r: r[0]):
        key = " ".join((t or "").split()) if (t or "").strip() == t else t or ""
        if key not in seen:
            seen.add(key)
            left.append((i, t))
    heads = {i: head for i, _, head in near_brute(left, 5, 80)}
    left = [(i, t) for i, t in left if heads[i] == i]
    hit = {r[0] for r in contaminated_brute(left, items) if r[-1]}
    left = [(i, t) for i, t in left if str(i) not in hit]
    with open(P.path(byte_bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [(i, np.array(tik.encode_ordinary(t or ""), "<u4")) for i, t in left]
    assert 100 < len(left) < len(rows) - 40
    assert found == sorted((i, len(x), hashlib.sha256(x.tobytes()).hexdigest()) for i, x in ids)


def test_stages_keep_the_columns_and_all_queries_are_registered(spark, tmp_path):
    docs = documents(spark, [(1, None), (2, "a b"), (2, "a b"), (None, None)])
    spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "q")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, str(tmp_path))
            assert out.columns == docs.columns
            out.collect()
    assert sorted(catalog.QUERIES) == sorted(
        ["pipeline", "op1_token_counts", "op2_toxicity", "op3_exact_dedup", "op4_byte_bpe", "op5_decontamination",
         "op6_near_dedup", "op7_url_filters", "op8_quality", "op9_license_scan", "op10_sharding", "op11_secret_scan",
         "op12_merkle_manifest", "op13_prefix_trie"])


def test_python_workers_get_small_batches(spark, tmp_path, monkeypatch):
    documents(spark, [(i, "a b") for i in range(2500)]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", lambda spark, docs, folder: docs.mapInArrow(sizes, "n long"))])
    found = [r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(found) == 2500 and max(found) <= corpus_pipeline.BATCH_ROWS
    assert spark.conf.get(setting) == before
