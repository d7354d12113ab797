from __future__ import annotations

import random

import pytest

from tickloom.llm import components as module
from tickloom.llm.components import components


def roots(links):
    group = {v: v for link in links for v in link}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v

    for a, b in links:
        x, y = find(a), find(b)
        group[max(x, y)] = min(x, y)
    return {v: find(v) for v in group}


def stars_of_one_group(rng, nodes, keys):
    """Links as the buckets of many keys give them: each key has the group in a few stars of its own."""
    links = []
    for _ in range(keys):
        order = rng.sample(range(nodes), nodes)
        links += [(v, min(order[k : k + nodes // 4])) for k in range(0, nodes, nodes // 4) for v in order[k : k + nodes // 4]]
    return [(a, b) for a, b in links if a != b]


@pytest.fixture
def taken(monkeypatch):
    """(links, whether a join is still to be made for them) that each half of a round takes."""
    seen, stars = [], module._stars

    def counted(links, large):
        seen.append((links.count(), "Join" in links._jdf.queryExecution().optimizedPlan().toString()))
        return stars(links, large)

    monkeypatch.setattr(module, "_stars", counted)
    return seen


@pytest.mark.parametrize("nodes", [200, 800])
def test_the_rounds_follow_the_nodes_of_a_group(spark, taken, nodes):
    """They took as many links as the group had keys, each time, and made the first half's join twice."""
    links = stars_of_one_group(random.Random(3), nodes, 30)
    got = components(spark.createDataFrame(links, "a long, b long").repartition(7))
    assert {r.node: r.root for r in got.collect()} == dict.fromkeys(range(nodes), 0)
    assert max(n for n, _ in taken) < nodes
    assert not any(join for _, join in taken)


@pytest.mark.parametrize("task_links", [1, 3, 40, 500, 500_000])
def test_links_left_out_by_tasks_change_no_component(spark, task_links):
    rng = random.Random(task_links)
    links = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)]
    links += [(k, k + 1) for k in range(1_000, 1_080)] + [(2_000, k) for k in range(2_001, 2_300)] * 2
    got = components(spark.createDataFrame(links, "a long, b long").repartition(5), task_links=task_links)
    want = roots([(a, b) for a, b in links if a != b])
    assert sorted((r.node, r.root) for r in got.collect()) == sorted(want.items())


@pytest.mark.parametrize("kind, shown", [("int", int), ("string", lambda v: f"n{v:03d}"), ("double", float)])
def test_links_of_other_values(spark, kind, shown):
    links = [(shown(a), shown(b)) for a, b in [(5, 6), (6, 9), (9, 2), (20, 21), (7, 7)]] + [(None, shown(3))]
    got = components(spark.createDataFrame(links, f"x {kind}, y {kind}"), "x", "y")
    assert got.dtypes == [("node", kind), ("root", kind)]
    want = {2: 2, 5: 2, 6: 2, 9: 2, 20: 20, 21: 20}
    assert {r.node: r.root for r in got.collect()} == {shown(v): shown(r) for v, r in want.items()}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
