import numpy as np
import pyarrow as pa

from starling.llm.common import stored, tree_sum

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def handed_over(texts):
    """The size of each batch that Python gets, as a number and as a vector of one."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.nbytes], pa.int64()), pa.array([np.int64(batch.nbytes).tobytes()], pa.binary())],
                names=["size", "vector"])

    return texts.mapInArrow(sizes, "size long, vector binary")


def test_long_texts_come_to_python_a_few_at_a_time(spark):
    texts = spark.range(0, 20, 1, 1).selectExpr("repeat('x', 1500000) AS text")
    handed = handed_over(texts)
    found = [r.size for r in stored(handed, "sizes").collect()]
    assert sum(found) >= 20 * 1_500_000 and max(found) < 8_000_000
    assert NAME not in spark.conf.getAll
    assert tree_sum(handed, "vector", "i8", 1)[0] >= 20 * 1_500_000


def test_a_session_that_says_how_large_batches_are_is_heeded(spark):
    spark.conf.set(NAME, "1000000")
    try:
        handed = handed_over(spark.range(0, 20, 1, 1).selectExpr("repeat('x', 400000) AS text"))
        assert max(r.size for r in stored(handed, "sizes").collect()) < 2_000_000
        assert spark.conf.get(NAME) == "1000000"
    finally:
        spark.conf.unset(NAME)


def test_vectors_are_summed_from_nothing(spark):
    """Nothing as large as a vector goes out with the tasks, and tasks without rows add nothing."""
    vectors = spark.range(0, 3, 1, 3).where("id > 0").selectExpr("unhex(repeat('0100000000000000', 1000)) AS vector")
    assert (tree_sum(vectors, "vector", "<i8", 1000) == np.full(1000, 2)).all()
    none = tree_sum(vectors.where("1 = 0"), "vector", "<i8", 1000)
    assert none.dtype == np.dtype("<i8") and (none == np.zeros(1000)).all()
