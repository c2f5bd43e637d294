import corpus_pipeline as C
from pricelake.llm import decontam, exact_dedup, near_dedup, packing, quality, queries

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"] is C.run
    assert set(entry.oracle_sql()) <= set(names)
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_each_stage_drops_what_its_operator_finds_and_run_applies_all(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    for k, (name, keep) in enumerate(C.STAGES[:-1]):
        out = str(tmp_path / str(k))
        keep(spark, docs, SF).write.parquet(out)
        kept = spark.read.parquet(out)
        assert kept.dtypes == docs.dtypes
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "quality":
            w = quality.train(docs, labels)
            lost = {r.row.doc_id for r in quality.score(docs, w, keep=["doc_id"]).collect() if r.score < quality.ACCEPT}
        elif name == "exact_dedup":
            lost = {r.doc_id for r in exact_dedup.exact_groups(docs).collect() if not r.kept}
        elif name == "near_dedup":
            lost = {r.doc_id for r in near_dedup.near_groups(docs, num=80).collect() if not r.kept}
        else:
            lost = {r.doc_id for r in decontam.contaminated(docs, bench).collect()}
        assert {r.doc_id for r in kept.select("doc_id").collect()} == ids - lost
        docs = kept
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    by_doc = {}
    for r in queries.packed_pieces(packing.pack(docs)).collect():
        by_doc.setdefault(r.doc_id, []).append(key(r))
    tokens = {d: sum(p[2] for p in ps) for d, ps in by_doc.items()}
    run = {}
    for r in C.run(spark, SF).collect():
        run[r.doc_id] = run.get(r.doc_id, 0) + r.length
    assert run == tokens
