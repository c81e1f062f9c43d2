import numpy as np
import pytest

from aerostar.llm import vector_codes as V

KIND = "vec_id long, embedding array<float>, label int, code string, error string, ints int"


def brute(rows, parts=8, entries=16, rounds=6):
    """rows: (id, integer vector), in the order of the first codebook."""
    x = np.array([v for _, v in rows], dtype=np.int64)
    x = x.reshape(len(x), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for r in range(rounds + 1):
        apart = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)  # row, part, entry
        best = apart.argmin(axis=2)
        if r < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    mine = x[best[:, p] == e, p]
                    if len(mine):
                        books[p, e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    return ["".join(f"{b:02x}" for b in row) for row in best], apart.min(axis=2).sum(axis=1).tolist(), books


def frame(spark, vectors, ids=None):
    ids = ids or range(len(vectors))
    return spark.createDataFrame([(k, v if v is None else [None if x is None else float(x) for x in v], 1, "c", "e", 2)
                                  for k, v in zip(ids, vectors)], KIND).repartition(3)


def test_against_brute_force_with_ties_and_gaps(spark):
    rng = np.random.default_rng(2)
    vectors = [list(v) for v in np.round(rng.normal(size=(300, 24)), 1)]  # coarse values: many ties
    vectors += [vectors[3], vectors[3], [0.0] * 24, [1e30] * 24, [-3e38] * 24]
    bad = [None, [], [float("nan")] + [0.0] * 23, [None] + [0.0] * 23, [float("inf")] * 24, [1.0] * 23]
    coded, books = V.compress(spark, frame(spark, vectors + bad), keep=("label",))
    bound = V.limit(24)
    exact = [[int(np.clip(np.floor(float(np.float32(x)) * 4096), -bound, bound)) for x in v] for v in vectors]
    codes, errors, want = brute(list(enumerate(exact)))
    assert (books == want).all()
    assert sorted(map(tuple, coded.select("vec_id", "code", "error").collect())) == list(zip(range(len(vectors)), codes, errors))
    assert coded.columns == ["vec_id", "label", "code", "error"]


def test_search_is_exact_from_any_radius():
    rng = np.random.default_rng(5)
    for entries, width in ((1, 1), (16, 8), (200, 3)):
        book = rng.integers(-50, 50, (entries, width))
        x = rng.integers(-80, 80, (500, width))
        apart = ((x[:, None, :] - book) ** 2).sum(axis=2)
        for radius in (0, 3, 40, 10_000):
            best, error = V.Slices(book).nearest(x, radius)
            assert (best == apart.argmin(axis=1)).all() and (error == apart.min(axis=1)).all()


def test_padding_few_rows_and_repeated_ids(spark):
    vectors = [[1.0, 2.0, 3.0], [0.0, 0.0, 0.0], [1.0, 2.0, 4.0], [1.0, 2.0, 3.0]]
    coded, books = V.compress(spark, frame(spark, vectors, [5, None, 5, 9]), parts=2)
    assert books.shape == (2, 4, 2)  # the first codebook goes by id, then components
    rows = sorted(map(tuple, coded.select("vec_id", "code", "error").collect()), key=repr)
    assert [r[0] for r in rows] == [5, 5, 9, None] and all(r[2] == 0 for r in rows)
    approx = {r.vec_id: r.approx for r in V.decode(coded, books).collect()}
    assert approx[9] == [1.0, 2.0, 3.0, 0.0]


def test_empty_and_unusable_tables(spark):
    for vectors in ([], [None, [float("nan")] * 8]):
        coded, books = V.compress(spark, frame(spark, vectors))
        assert coded.count() == 0 and coded.columns == ["vec_id", "code", "error"] and not books.size
    with pytest.raises(ValueError):
        V.compress(spark, frame(spark, []), entries=257)


def test_a_round_is_one_job_whatever_the_partitions(spark):
    """Sums of a round come to the driver together: its jobs do not grow with
    the number of shuffle partitions."""
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in rng.normal(size=16)]) for k in range(60)]
    ints = V.integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    books = V.first_books(ints, "vec_id")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    jobs = []
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (2, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.sparkContext.setJobGroup(f"rounds-{n}", "")
            V.train(ints, books, 2)
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{n}")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    assert jobs[0] == jobs[1] > 0
