"""Pair, reach and ranking operators against brute force on a random graph."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortgraph.bindings import star
from cohortgraph.operators import edges
from cohortgraph.operators.model import Graph
from cohortgraph.plans import graph as G
from cohortgraph.plans import journeys as J
from cohortgraph.plans import profiling as P
from cohortgraph.plans import tools as T
from cohortgraph.session import work_table


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    people = [f"l{i:02d}" for i in range(30)]
    skills, programs, firms = [f"s{i}" for i in range(8)], [f"p{i}" for i in range(3)], [f"c{i}" for i in range(4)]
    has = sorted({(p, rng.choice(skills)) for p in people for _ in range(4)})
    enrol = sorted({(p, rng.choice(programs)) for p in people for _ in range(2)})
    works = sorted({(p, rng.choice(firms)) for p in people if rng.random() < 0.7 for _ in range(2)})
    none = F.lit(None)
    g = Graph(
        learner=spark.createDataFrame([(p, p.upper()) for p in people], "hashed_email string, full_name string"),
        country=spark.createDataFrame([("AA", "Aland")], "code string, name string"),
        city=spark.createDataFrame([("AA-X", "X", "AA")], "id string, name string, country_code string"),
        skill=spark.createDataFrame([(s, s.upper(), "Other") for s in skills], "id string, name string, category string"),
        program=spark.createDataFrame([(p, "Program " + p) for p in programs], "id string, name string"),
        company=spark.createDataFrame([(c, "n/a" if c == "c0" else "Firm " + c, None, None) for c in firms], "id string, name string, industry string, country_code string"),
        has_skill=spark.createDataFrame(has, "learner string, skill_id string"),
        enrolled_in=spark.createDataFrame(enrol, "learner string, program_id string").withColumns(
            {"is_completed": F.lit(True), "enrollment_status": F.lit("Graduated"), "completion_rate": F.lit(1.0), "lms_overall_score": none.cast("double")}),
        works_for=spark.createDataFrame(works, "learner string, company_id string").withColumn("start_date", none.cast("date")),
    )
    return g, has, enrol, works


def test_peer_pairs_equal_the_self_join(world):
    g, _, enrol, works = world
    want = Counter()
    for (a, pa), (b, pb) in itertools.product(enrol, enrol):
        if a < b and pa == pb:
            for c in {c for x, c in works if x == a} & {c for x, c in works if x == b}:
                want[(pa, "n/a" if c == "c0" else "Firm " + c)] += 1
    got = {(r.cohort, r.company): r.peer_pairs for r in G.g26_peer_pairs(g, 1, 1000).collect()}
    assert got == dict(want)


def test_cooccurrence_equals_the_self_join(world):
    g, has, _, _ = world
    want = Counter((a.upper(), b.upper()) for (x, a), (y, b) in itertools.product(has, has) if x == y and a < b)
    got = {(r.skill1, r.skill2): r.co_occurrence for r in G.g28_cooccurrence_all(g, 1000).collect()}
    assert got == dict(want)


@pytest.mark.parametrize("heavy, tile", [(0, 3), (4, 2), (4, 1000), (63, 64)])
def test_skill_pairs_by_masks_and_tiles(spark, heavy, tile):
    """One learner holds every skill, some share a set; masks and tiles of any size give the self join."""
    rng = random.Random(heavy + tile)
    skills = [f"s{i:02d}" for i in range(40)]
    sets = {"all": set(skills), "none": set(), "one": {"s01"}}
    sets |= {f"l{i}": set(rng.sample(skills[:12], 5)) if i % 3 else {"s00", "s01", "s39"} for i in range(60)}
    has = [(x, s) for x, ss in sets.items() for s in ss]
    df = spark.createDataFrame(has + has[:20], "learner string, skill string").repartition(3)
    want = Counter(p for ss in sets.values() for p in itertools.combinations(sorted(ss), 2))
    got = {(r.skill1, r.skill2): r.co_occurrence for r in G.skill_pairs(df, "skill", heavy=heavy or 1, tile=tile).collect()}
    assert got == dict(want)
    first = sorted(want.items(), key=lambda x: (-x[1], x[0]))[:10]
    best = G.skill_pairs(df, "skill", top=10, heavy=heavy or 1, tile=tile).collect()
    assert sorted((((r.skill1, r.skill2), r.co_occurrence) for r in best), key=lambda x: (-x[1], x[0]))[:10] == first
    assert G.skill_pairs(df.limit(0), "skill").count() == 0


def test_reachable_and_shortest_path(world, spark):
    g, has, enrol, works = world
    near = {}
    for a, b in [("learner:" + x, f"{k}:{y}") for k, es in (("skill", has), ("program", enrol), ("company", works)) for x, y in es]:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    depth, layer = {"learner:l00": 0}, {"learner:l00"}
    for d in (1, 2, 3):
        layer = {n for m in layer for n in near[m]} - set(depth)
        depth |= {n: d for n in layer}
    start = spark.createDataFrame([("learner:l00",)], "node string")
    assert {r.node: r.depth for r in G.reachable(G.node_edges(g), start, 3).collect()} == depth
    goal = max(depth, key=lambda n: (depth[n], n))
    path = G.g43_shortest_path(G.node_edges(g), start, goal, 3).first()
    assert path.length == depth[goal] and path.path[0] == "learner:l00" and path.path[-1] == goal
    assert all(b in near[a] for a, b in zip(path.path, path.path[1:]))


def test_first_of_the_shortest_paths_by_brute_force(spark):
    rng = random.Random(12)
    names = [f"n{i:02d}" for i in range(40)]
    pairs = sorted({tuple(rng.sample(names, 2)) for _ in range(55)} | {("hub", n) for n in names[30:]})
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def brute(starts, goal):
        paths, reached = sorted([s] for s in starts), set(starts)
        while paths:
            found = [p for p in paths if p[-1] == goal]
            if found:
                return min(found)
            best = {}
            for p in paths:
                for n in near.get(p[-1], set()) - reached:
                    best[n] = min(best.get(n, [*p, n]), [*p, n])
            reached |= set(best)
            paths = list(best.values())

    df = spark.createDataFrame(pairs, "src string, dst string").repartition(3)
    for starts, goal in ((["n00"], "n35"), (["n01", "n02", "n07"], "n11"), (["hub"], "n03"), (["n05"], "n05"), (["n06"], "nowhere")):
        got = [tuple(r) for r in G.g43_shortest_path(df, spark.createDataFrame([(x,) for x in starts], "node string"), goal).collect()]
        want = brute(starts, goal)
        assert got == ([(want, len(want) - 1)] if want else [])


def test_similar_learners(world):
    g, has, _, _ = world
    sets = {}
    for x, s in has:
        sets.setdefault(x, set()).add(s)
    target = min((x for x in sets if len(sets[x]) == max(map(len, sets.values()))))
    want = sorted(((-len(sets[x] & sets[target]), x) for x in sets if x != target and len(sets[x] & sets[target]) >= 2))[:10]
    got = [(-r.shared_skills, r.learner) for r in J.j08_similar_learners(g, 2).collect()]
    assert got == want


def test_tool_limits_and_placeholders(world):
    g, _, enrol, works = world
    assert T.t4_top_skills(g, limit=10_000).count() == 8
    employed = {x for x, c in works if c != "c0"}
    got = {r.program: (r.total_learners, r.employed_learners) for r in T.t3_employment_rate(g, min_n=0).collect()}
    want = {f"Program {p}": (len({x for x, q in enrol if q == p}), len({x for x, q in enrol if q == p and x in employed})) for p in ("p0", "p1", "p2")}
    assert got == want


def test_concurrent_enrolments(spark):
    rng = random.Random(9)
    rows = [(f"n{rng.randint(0, 40)}", d := rng.randint(0, 400), d + rng.randint(-3, 40)) for _ in range(120)]
    want = set()
    for (i, a), (j, b) in itertools.product(enumerate(rows), enumerate(rows)):
        if i != j and a[0] == b[0] and a[1] <= b[1] < a[2]:
            want.add(a[0])
    df = spark.createDataFrame(rows, "person string, s int, e int").select(
        "person", F.date_add(F.lit("2000-01-01").cast("date"), F.col("s")).alias("start_date"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("e")).alias("end_date")
    )
    out = P.p12_concurrent(df).first()
    assert (out.people, out.concurrent) == (len({r[0] for r in rows}), len(want))


def test_walks_reach_six_hops_and_say_when_they_stop(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(6)] + [("x", "y")], "src string, dst string")
    start = spark.createDataFrame([("n0",)], "node string")
    assert {r.node: r.depth for r in G.reachable(edges, start).collect()} == {f"n{i}": i for i in range(7)}
    assert G.reachable(edges, start, 2).count() == 3
    assert [tuple(r) for r in G.g43_shortest_path(edges, start, "n6").collect()] == [([f"n{i}" for i in range(7)], 6)]
    assert [tuple(r) for r in G.g43_shortest_path(edges, start, "n6", 3).collect()] == [(None, 3)]
    assert G.g43_shortest_path(edges, start, "y").count() == 0


def test_job_edges_by_numbers_equal_those_by_names(spark):
    sf = "/root/testdata/sf0.001"
    got, want = star.works_for_edges(spark, sf), edges.works_for(star.jobs(spark, sf))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) != []
    plan = next(x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(learner" in x)
    assert "company#" in plan  # shuffled by the numbers, not by ids of 64 characters


def test_skills_by_program_shuffle_numbers(spark):
    """The graph of numbers answers as the stored one, and its plan makes no learner key."""
    sf = "/root/testdata/sf0.001"
    got, want = (G.g10_skills_by_program(g(spark, sf), term="AI", limit=1000) for g in (star.numbered_graph, star.graph))
    assert got.collect() == want.collect()
    assert "sha2" not in entry.queries()["g10_skills_by_program"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    edges_of = star.has_skill_edges(spark, sf)
    assert edges_of.count() == edges_of.distinct().count() == star.numbered_skill_edges(spark, sf).count()


def test_reachable_stores_edges_once_by_numbers(spark, tmp_path, monkeypatch):
    """The registered walk on numbers finds the nodes that the walk on stored texts finds, at the same depths; one-sided edges from either end."""
    sf, stored = "/root/testdata/sf0.001", []

    def keep(df, name):
        stored.append((name, df))
        return work_table(df, name)

    monkeypatch.setattr(G, "work_table", keep)
    got = entry.queries()["g34_reachable"](spark, sf)
    [(_, kept)] = stored
    assert [t for _, t in kept.dtypes] == ["bigint", "bigint"] and kept.filter("src % 4 <> 0 or dst % 4 = 0").count() == 0
    g = star.graph(spark, sf)
    start = g.learner.agg(F.concat(F.lit("learner:"), F.min("hashed_email")).alias("node"))
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, G.reachable(G.node_edges(g), start, 3).collect())) and {d for _, d in rows} == {0, 1, 2, 3}
    few = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", "y"), ("c", None), (None, "x"), ("d", "z")], "src string, dst string")
    for sides in (False, True):
        for node, want in (("a", {"a": 0, "x": 1, "b": 2, "y": 3, "c": 4}), ("y", {"y": 0, "b": 1, "c": 1, "x": 2, "a": 3})):
            assert {r.node: r.depth for r in G.reachable(few, spark.createDataFrame([(node,)], "node string"), sides=sides).collect()} == want
