"""The pipeline and its stages on tables with odd rows, odd column names, and on empty ones."""

from collections import Counter

import pytest

import corpus_pipeline
from tessera.llm import language, minhash, mixing, secret_scan

EXTRA = ("values", "a.b", "n", "label", "row", "f", "found", "doc_key", "text_key", "h", "k", "tie", "a`b", "size", "id", "key", "s")
LONE = "there is more of it and that is with them for this have been on it"
KEY = "token = 'Zk93hdJ2kq0Pz8Wm1xYt7Lq4'"


def frame(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c.replace('`', '``')}` string" for c in EXTRA)
    return spark.createDataFrame([(i, t, lang, src, len(t or ""), *(f"{c}{k}" for c in EXTRA))
                                  for k, (i, t, lang, src) in enumerate(rows)], schema).repartition(3)


def odd_rows():
    plain = [(k, f"the and of with this that from have word{k} and more of it is there {'so ' * (k % 4)}", "en", f"s{k % 3}") for k in range(40)]
    plain += [(100 + k, f"der und nicht mit eine auch sich werden wort{k} und noch mehr davon", "de", "s1") for k in range(40)]
    twin = (3, plain[3][1], "en", "s0")
    return plain + [twin, twin, (3, plain[4][1], "en", None), (None, LONE, "en", "s2"), (None, LONE, "en", "s2"),
                    (200, None, "en", "s0"), (201, "", "de", None), (202, " \n\t", None, None),
                    (203, "the and of with this that from have " + KEY, "en", "s9"), (204, "the and of " * 20_000, "en", "s1")]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows())


def ids(df):
    return Counter(r.doc_id for r in df.collect())


def test_stages_keep_columns_of_any_name(spark, odd):
    rows = odd_rows()
    known = language.keep_identified(odd)
    assert known.columns == odd.columns and ids(known) == Counter(r[0] for r in rows if (r[1] or "").strip())
    single = minhash.keep_one(odd)
    assert single.columns == odd.columns
    got = ids(single)
    assert got[200] == got[201] == got[202] == got[None] == 1
    assert got[3] == 2 and got[4] == 0  # id 3 also holds the text of id 4
    masked = secret_scan.redact(odd)
    assert masked.columns == odd.columns and ids(masked) == Counter(r[0] for r in rows)
    assert [r.text for r in masked.where("doc_id = 203").collect()] == [rows[-2][1].replace("Zk93hdJ2kq0Pz8Wm1xYt7Lq4", "[secret]")]
    mixed = mixing.sample(odd)
    assert mixed.columns == odd.columns and max(ids(mixed).values()) <= 8
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.sample(frame(spark, rows).repartition(7)).collect()))


@pytest.mark.parametrize("n", [0, None])
def test_pipeline_on_odd_and_empty_tables(spark, odd, tmp_path, n):
    docs = odd if n is None else odd.limit(n)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if n == 0:
        assert out == []
        return
    assert all(r.n_tokens > 0 and len(r.ids_sha256) == 64 for r in out)
    assert {r.doc_id for r in out} <= {r[0] for r in odd_rows()} - {200, 201, 202}
