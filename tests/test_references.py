from datetime import datetime as T

from voxmeter.operators.references import Entity, ForeignKey, ReferenceGraph

D = lambda m, d=1: T(2025, m, d)
STAMP = "timestamp_ntz"


def graph(spark, asr, sources, speakers):
    return ReferenceGraph.of(
        [
            Entity("asr", spark.createDataFrame(asr, f"id long, utt string, at {STAMP}, reason int"), "id", "at"),
            Entity("sources", spark.createDataFrame(sources, f"id long, utt string, who string, at {STAMP}, gone {STAMP}"), "id", "at", "utt", "at", "gone"),
            Entity("speakers", spark.createDataFrame(speakers, f"who string, since {STAMP}, until {STAMP}"), key="who", begin="since", end="until"),
        ],
        [ForeignKey("asr", "utt", "sources"), ForeignKey("sources", "who", "speakers")],
    )


def rows(df):
    return sorted((r["src_table"], r["row_id"], r["period"], r["reason"], r["kind"]) for r in df.collect())


def test_reasons_and_inheritance(spark):
    speakers = [("p", D(1), None), ("late", D(6), None), ("gone", D(1), D(3)), (None, D(1), None)]
    sources = [
        (1, "u1", "p", D(2), None),
        (2, "u2", "late", D(2), None),
        (3, "u3", "gone", D(3), None),  # ended at that very time
        (4, "u4", "", D(2), D(4)),  # the empty key is a reference
        (5, "u5", None, D(2), None),
        (6, "u2", "late", D(7), None),  # another delivery of u2, by then the speaker is there
        (7, "u7", "who?", D(2), None),
    ]
    asr = [
        (1, "u1", D(5), 0), (1, "u1", D(5), 0), (2, "u9", D(5), 0), (3, "u1", D(1), 0), (4, "u4", D(4), 0), (5, None, D(5), 0),
        (6, "u7", D(5), 0), (7, "u2", D(8), 0), (8, "u4", D(3), 0), (9, "u1", None, 0),
    ]
    got = rows(graph(spark, asr, sources, speakers).orphans())
    assert got == sorted([
        ("sources", 2, "2025-02", "later", "direct"),
        ("sources", 3, "2025-03", "deleted", "direct"),
        ("sources", 4, "2025-02", "missing", "direct"),
        ("sources", 7, "2025-02", "missing", "direct"),
        ("asr", 2, "2025-05", "missing", "direct"),
        ("asr", 3, "2025-01", "later", "direct"),
        ("asr", 4, "2025-04", "deleted", "direct"),
        ("asr", 6, "2025-05", "inherited", "inherited"),
        ("asr", 8, "2025-03", "inherited", "inherited"),
    ])


def test_empty_tables(spark):
    g = graph(spark, [], [], [])
    assert rows(g.orphans()) == [] and g.report().count() == 0


def test_cycle_reaches_a_fixpoint(spark):
    """A chain within one table: the last one's parent is missing, so all before it inherit."""
    nodes = spark.createDataFrame([(i, f"n{i}", f"n{i + 1}", D(1)) for i in range(1, 5)] + [(9, "x", "x", D(1))], f"id long, name string, next string, at {STAMP}")
    e = Entity("nodes", nodes, "id", "at", "name")
    got = rows(ReferenceGraph.of([e], [ForeignKey("nodes", "next", "nodes")]).orphans())
    assert got == [("nodes", 1, "2025-01", "inherited", "inherited"), ("nodes", 2, "2025-01", "inherited", "inherited"), ("nodes", 3, "2025-01", "inherited", "inherited"), ("nodes", 4, "2025-01", "missing", "direct")]


def test_plans_grow_with_the_tables_not_beyond(spark, monkeypatch):
    """Each table of a chain of references is joined once with the lifetimes of the one above it and their orphans."""
    import voxmeter.operators.references as r

    plans = []
    monkeypatch.setattr(r, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df.checkpoint())
    for n in (3, 5):
        plans.clear()
        tables = [spark.createDataFrame([(1, f"k{i}", f"k{i + 1}" if i < n - 1 else "nowhere", D(1))], f"id long, k string, up string, at {STAMP}") for i in range(n)]
        es = [Entity(f"t{i}", tables[i], "id", "at", "k") for i in range(n)] + [Entity("root", tables[0].where("id < 0"), "id", "at", "k")]
        g = ReferenceGraph.of(es, [ForeignKey(f"t{i}", "up", f"t{i + 1}" if i < n - 1 else "root") for i in range(n)])
        got = rows(g.orphans())
        assert [x[3] for x in got] == ["inherited"] * (n - 1) + ["missing"]
        assert sum(p.count("Join ") for p in plans) <= 2 * n and max(p.count("Join ") for p in plans) == 1


def test_hot_reference_is_split(spark, monkeypatch):
    """Adaptive execution splits the partition of a key that most rows refer to."""
    import voxmeter.operators.references as r

    monkeypatch.setattr(r, "BROADCAST_ROWS", -1)
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        asr = spark.range(40_000).repartition(8).selectExpr("id", "if(id % 5 < 3, 'hot', concat('u', id % 997)) AS utt", "timestamp_ntz'2025-05-01 00:00:00' AS at")
        sources = spark.range(997).selectExpr("id", "concat('u', id) AS utt", "timestamp_ntz'2025-01-01 00:00:00' AS at")
        g = ReferenceGraph.of([Entity("asr", asr, "id", "at"), Entity("sources", sources, "id", "at", "utt", "at")], [ForeignKey("asr", "utt", "sources")])
        df = g.orphans()
        assert df.count() == 24_000
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_without_id_and_with_disagreeing_ones(spark):
    speakers = [("p", D(1), D(3))]
    sources = [(None, "a", "x", D(2), None), (None, "b", "y", D(2), None), (None, "b", "y", D(2), None), (7, "c", "p", D(4), None), (7, "c", "z", D(5), None)]
    got = sorted((r["row_id"] or 0, r["period"], r["reason"]) for r in graph(spark, [], sources, speakers).orphans().collect())
    assert got == [(0, "2025-02", "missing"), (0, "2025-02", "missing"), (7, "2025-05", "missing")]
