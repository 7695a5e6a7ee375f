from pyspark.sql import functions as F

from leadmill.llm.fixity import audit, leaves, merkle_tree

SCHEMA = "page_id long, url string, html string, HTML string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def found(original, replica):
    return {r.page_id: (r.state, r.file, r.n_bytes > 0, r.replica_bytes > 0) for r in audit(original, replica).collect()}


def test_every_kind_of_damage_is_located(spark):
    rows = [(i, f"u{i}", f"text {i}") for i in range(0, 9000, 3)]
    original = pages(spark, rows)
    assert found(original, original.orderBy(F.rand())) == {}
    damaged = dict((r[0], r) for r in rows)
    damaged[300] = (300, "u300", "text 30O")
    damaged[303] = (303, None, "text 303")
    damaged[8997] = (8997, "u8997", None)
    del damaged[6000]
    replica = pages(spark, [*damaged.values(), (1, "u1", "new"), damaged[600]])
    assert found(original, replica) == {
        300: ("changed", 0, True, True), 303: ("changed", 0, True, True), 8997: ("changed", 2, True, True),
        6000: ("missing", 1, True, False), 1: ("extra", 0, False, True), 600: ("changed", 0, True, True)}


def test_offsets_and_roots(spark):
    original = pages(spark, [(0, "a", "x"), (1, "b", "yy"), (2, "c", "z"), (2, "c", "z")])
    replica = pages(spark, [(0, "a", "x"), (2, "c", "z"), (2, "c", "z")])
    row, = audit(original, replica).collect()
    sizes = {r.node: r.n_bytes for r in leaves(original).collect()}
    assert (row.page_id, row.state, row.first_byte, row.n_bytes) == (1, "missing", sizes[0], sizes[1])
    root, = merkle_tree(leaves(original), 3).levels[-1].collect()
    assert (root.n_records, root.n_bytes) == (4, sum(sizes.values()))


def test_null_ids_huge_texts_and_empty_tables(spark):
    original = pages(spark, [(None, None, None), (5, "u", "x" * 300_000)])
    assert found(original, original.limit(0)) == {None: ("missing", -1, True, False), 5: ("missing", 0, True, False)}
    assert found(original.limit(0), original.filter("page_id = 5")) == {5: ("extra", 0, False, True)}
    assert found(original, pages(spark, [(None, None, ""), (5, "u", "x" * 300_000)])) == {}
    assert found(original.limit(0), original.limit(0)) == {}


def test_only_native_expressions(spark):
    original = pages(spark, [(0, "a", "x")])
    plan = audit(original, original)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
