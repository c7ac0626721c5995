"""What a worker keeps between tasks."""

from traveltiers.llm import bpe_transducer, common, jaccard_join


def test_another_operators_tasks_drop_what_was_remembered():
    jaccard_join.shingles("a b c d e f g")
    bpe_transducer._codecs[1] = object()
    common.tidy(jaccard_join.OWNER)
    assert jaccard_join._hashes and not bpe_transducer._codecs
    common.tidy("traveltiers.llm.period_runs")
    assert not jaccard_join._hashes


def test_carried_columns_stay_as_they_came(spark):
    docs = spark.createDataFrame([(i, None if i == 3 else f"t{i}", [i] * (i % 3)) for i in range(1100)], "k long, t string, a array<long>")
    sizes = []

    def run(cols):
        sizes.append(len(cols["k"]))
        assert len(cols["k"]) <= common.BATCH_ROWS
        return cols | {"n": [2 * k for k in cols["k"]]}

    out = common.map_batches(docs, run, "k long, t string, a array<long>, n long").collect()
    assert sorted((r["k"], r["t"], r["a"], r["n"]) for r in out if r["k"] != 3) == [(i, f"t{i}", [i] * (i % 3), 2 * i) for i in range(1100) if i != 3]
    assert [r["t"] for r in out if r["k"] == 3] == [None]
