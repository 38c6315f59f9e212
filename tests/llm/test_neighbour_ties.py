from helixframe.llm import neighbours


def test_different_vectors_with_equal_scores(spark):
    rows = [(0, [1.0] + [0.0] * 12)] + [(i, [1.0] + [float(i >> b & 1) for b in range(12)]) for i in range(1, 400)]
    frame = spark.createDataFrame(rows[::-1], "vec_id long, embedding array<double>")
    got = neighbours.search(frame, lambda c: c == 0, parts=1).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == list(range(1, 21))


def test_ids_with_several_vectors(spark):
    rows = [(20, [1.0, 0.0]), (40, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    got = {}
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got[40]) == [(1, 1, 1.0), (2, 20, 1.0), (3, 2, 0.1), (4, 20, 0.0)]
    assert sorted(got[20]) == sorted([(1, 1, 1.0), (2, 40, 1.0), (3, 2, 0.1), (1, 2, 1.0), (2, 1, 0.1), (3, 40, 0.0)])


def test_many_vectors_of_one_id_leave_room_for_others(spark):
    rows = [(0, [1.0, i / 1000]) for i in range(100)] + [(i, [0.5, -i / 1000]) for i in range(1, 41)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda c: c == 0).collect()
    assert len(got) == 100 * 20 and all(r.vec_id for r in got)
