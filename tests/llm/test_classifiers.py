"""Held-out accuracy of the trained operators."""

import random
import zlib

import pytest

from tessera.llm import language, quality, quality_rules, queries, toxicity
from tessera.llm.labelled import remainder
from tessera.sources.tables import table

DATA = "/root/testdata/sf0.1"


def area(scores, labels):
    ranks = scores.rank()
    n1 = int(labels.sum())
    n0 = len(labels) - n1
    return (ranks[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


# in this table about one toxic row in sixteen has none of the words that mark the others
@pytest.mark.parametrize("query, label, folds, out, least", [("op5_toxicity", "toxic", 4, 2, 0.94), ("op8_quality", "quality", 3, 1, 0.97)])
def test_held_out_rows(spark, query, label, folds, out, least):
    scores = queries.QUERIES[query](spark, DATA).toPandas()
    assert len(scores) == table(spark, DATA, "documents").count() and scores.score.between(0, 1).all()
    assert (scores.held_out == [zlib.crc32(str(i).encode()) % folds == out for i in scores.doc_id]).all()
    judged = scores[scores.held_out].merge(table(spark, DATA, "labels").toPandas(), on="doc_id")
    assert area(judged.score, judged[label]) > least
    assert (judged.predicted == judged[label]).mean() > 0.94


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_odd_rows(make, spark, operator):
    docs = make([(1, "fine words here"), (1, "fine words here"), (None, "x"), (2, None), (3, ""), (4, "so " * 30_000)])
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, None, None, "x"), (None, 1, 1, "x"), (99, 0, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    got = operator.score(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert operator.score(make([]), labels.limit(0)).count() == 0


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    flipped = labels.selectExpr("doc_id", "quality", "toxic").withColumn("held", remainder(labels.doc_id, 4) == 2)
    flipped = flipped.selectExpr("doc_id", "quality", "if(held, 1 - toxic, toxic) as toxic")
    a, b = (sorted(map(tuple, toxicity.score(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_language_of_documents_and_pages(spark):
    got = queries.QUERIES["op7_language"](spark, "/root/testdata/sf0.01").toPandas()
    docs = got[got.doc_id.notna()].merge(table(spark, "/root/testdata/sf0.01", "documents").toPandas(), on="doc_id")
    assert (docs.lang_x == docs.lang_y).mean() > 0.99 and docs.keep.mean() > 0.99
    assert (docs.text_lang == docs.lang_y).mean() > 0.98  # the text alone
    pages = got[got.page_id.notna()]
    assert len(pages) and (pages.lang == pages.declared).mean() > 0.97


def test_language_evidence_is_fused(make):
    clear = [(i, "the and of with this that from have") for i in range(30)] + \
            [(100 + i, "der und nicht mit eine auch sich werden") for i in range(30)]
    langs = [("en", "h1")] * 30 + [("de", "h2")] * 30
    odd = [(200, "in"), (201, "in"), (202, None), (203, ""), (204, "漢字"), (None, "the and of with")]
    docs = make(clear + odd, langs + [("en", "h1"), ("de", "h2"), ("en", "h1"), ("en", None), (None, None), (None, "h1")])
    got = {r.doc_id: r for r in language.identify(language.from_documents(docs), language.train_on(docs)).collect()}
    assert got[200].lang == "en" and got[201].lang == "de"  # the same text, told apart by host and markup
    assert not got[202].keep and not got[203].keep and not got[204].keep and got[None].lang == "en"
    assert {r.doc_id for r in language.keep_identified(docs).collect()} == set(got) - {202, 203, 204}
    assert language.identify(language.from_documents(make([])), language.train(["a b"], ["en"])).count() == 0
    assert language.keep_identified(make([])).count() == 0


def test_unseen_scripts_and_noise_are_rejected(make, spark):
    model, rng = language.train_on(table(spark, DATA, "documents")), random.Random(3)
    low = "abcdefghijklmnopqrstuvwxyz"
    kinds = {"cjk": ("".join(map(chr, range(0x4E00, 0x9FA0))), 4), "cyrillic": ("".join(map(chr, range(0x430, 0x450))), 7),
             "greek": ("".join(map(chr, range(0x3B1, 0x3CA))), 7), "letters": (low, 9), "base 36": (low + "0123456789", 24),
             "hex": ("abcdef0123456789", 32)}
    texts = [" ".join("".join(rng.choices(signs, k=size)) for _ in range(n)) for signs, size in kinds.values() for n in (40, 400)]
    noise = [(k, t) for k, t in enumerate(texts)]
    got = language.identify(language.from_documents(make(noise)), model).collect()
    assert len(got) == len(noise) and not any(r.keep for r in got) and {r.lang for r in got} == {"und"}
    assert all(r.known < 0.05 for r in got if r.doc_id < 6)  # other scripts share next to nothing
    plain = language.identify(language.from_documents(table(spark, DATA, "documents").where("length(text) > 0")), model)
    assert plain.where("not keep").count() == 0


@pytest.mark.parametrize("operator", [toxicity, quality, quality_rules])
def test_absent_and_repeated_ids_do_not_change_scores(spark, operator):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    score = operator.judge if operator is quality_rules else operator.score
    unknown = labels.selectExpr("doc_id + 10000000 as doc_id", "1 - quality as quality", "1 - toxic as toxic")
    more = labels.unionByName(labels).unionByName(unknown).repartition(5)
    twice = docs.unionByName(docs.selectExpr("doc_id", "concat(text, ' zz') as text", "lang", "source", "n_chars").where("doc_id % 50 = 0"))
    found = [{(r.doc_id, r.score) for r in score(d.repartition(n), lab).collect()} for d, lab, n in
             ((docs, labels, 2), (docs, more, 3), (twice, labels, 4), (twice, more, 7))]
    assert found[0] == found[1] and found[2] == found[3]


def test_language_of_held_out_rows_by_text_alone(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    held = remainder(docs.doc_id, 5) == 2
    model = language.train_on(docs.where(~held))
    got = language.identify(language.from_documents(docs.where(held)), model).toPandas()
    judged = got.merge(docs.toPandas(), on="doc_id")
    assert len(judged) > 150 and (judged.text_lang == judged.lang_y).mean() > 0.97
    assert (judged.lang_x == judged.lang_y).mean() > 0.98
