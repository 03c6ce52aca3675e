import pytest

from tessera.session import get_spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_spark("local[4]", app_name="tessera-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return s


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, in several partitions, with columns of clashing names."""
    def frame(rows, extra=()):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " \
                 "size long, row string, ref long, node string, text_key string, spots string, kind string"
        full = [(i, t, *(x or ("en", "s0")), len(t or ""), 7, "r", 1, "n", "k", "s", "x")
                for (i, t), x in zip(rows, list(extra) + [None] * len(rows))]
        return spark.createDataFrame(full, schema).repartition(3) if full else spark.createDataFrame([], schema)
    return frame
