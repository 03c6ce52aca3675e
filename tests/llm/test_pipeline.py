import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import mixing, secret_scan
from tessera.sources.tables import table
from tests.llm.test_minhash import brute

DATA = "/root/testdata/sf0.01"


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_each_stage_on_what_the_one_before_kept(spark, tmp_path):
    docs = table(spark, DATA, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], DATA).write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    start, known, single, masked, mixed, tokens = frames
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert known.count() == start.where("length(text) > 0").count()  # clean documents all stay
    rows = [(r.doc_id, r.text) for r in known.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, _, _, kept in brute(rows) if kept)
    before, after = ({r.doc_id: r.text for r in f.collect()} for f in (single, masked))
    scanned = {r.doc_id: r.n_live for r in secret_scan.scan(single).collect()}
    assert all((before[i] != after[i]) == (scanned[i] > 0) for i in before) and any(scanned.values())
    taken = {r.doc_id: r.repeats for r in mixing.mix(masked).select("row.doc_id", "repeats").collect()}
    got = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {i: n for i, n in taken.items() if n}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in mixed.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(r.text)))
    assert sorted(map(tuple, tokens.collect())) == sorted(want)
    assert sorted(map(tuple, entry.queries()["pipeline"](spark, DATA).collect())) == sorted(want)


def test_run_rereads_each_stage_from_parquet(spark, monkeypatch):
    read = []

    def keep(spark, docs, sf_dir):
        read.append(docs.inputFiles())
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", keep), ("two", keep), ("three", keep)])
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    read.append(out.inputFiles())
    for name, files in zip(["one", "two", "three"], read[1:]):
        assert files and all(f"/{name}/" in f for f in files)
    assert out.count() == table(spark, "/root/testdata/sf0.001", "documents").count()
