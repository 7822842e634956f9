"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import random

import pytest
from helpers import SF, same_rows

from docmill.jobs import registry
from docmill.jobs.pages import site
from docmill.operators import crawl


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, name):
    same_rows(registry.QUERIES[name](spark, SF), registry.SQL[name])


def test_every_query_has_sql_but_the_crawl_with_faults():
    assert set(registry.QUERIES) - set(registry.SQL) == {"crawl_site"}


def loop(pages, links, roots, max_depth, max_pages):
    """The crawl as one plain loop over a queue."""
    visited, finals, pending, done, queue = set(roots), set(), set(), {}, list(roots)
    for depth in range(max_depth + 1):
        if not queue or len(done) >= max_pages:
            break
        room = max_pages - len(done)
        pending |= set(queue[room:])
        following = []
        for node in queue[:room]:
            final, failed = pages.get(node, (node, True))
            if failed:
                done[node] = (depth, "failed")
                continue
            if final in finals:
                continue
            finals.add(final)
            visited.add(final)
            done[final] = (depth, "fetched")
            for dst in links.get(final, []):
                if dst in visited:
                    continue
                if len(done) + len(following) < max_pages:
                    visited.add(dst)
                    following.append(dst)
                else:
                    pending.add(dst)
        queue = following
    return {(n, *x) for n, x in done.items()} | {(n, None, "pending") for n in pending | set(queue) if n not in done}


def lists(pages, links, roots):
    known = {r.node: (r.final, r.failed) for r in pages.collect()}
    out = {}
    for r in sorted(links.collect(), key=lambda r: (r.node, r.ord, r.dst)):
        out.setdefault(r.node, []).append(r.dst)
    return known, out, [r.node for r in sorted(roots.collect(), key=lambda r: r.ord)]


def test_crawl_with_faults_equals_a_loop(spark):
    got = {tuple(r) for r in registry.QUERIES["crawl_site"](spark, SF).collect()}
    assert got == loop(*lists(*site(spark, SF)), 6, 200)


@pytest.mark.parametrize(("seed", "one_task"), [(0, 100_000), (1, 100_000), (2, 100_000), (3, 100_000), (1, 2)])
def test_crawls_of_random_sites_equal_a_loop(spark, monkeypatch, seed, one_task):
    """Also with places that are numbered in ranges, as those of large levels are."""
    monkeypatch.setattr(crawl, "ONE_TASK", one_task)
    rng = random.Random(seed)
    n = 40
    pages = [(k, rng.choice([k, k, k, rng.randrange(n)]), rng.random() < 0.15) for k in range(n - 5)]
    links = [(k, o, rng.randrange(n)) for k in range(n) for o in range(rng.randrange(6))]
    made = spark.createDataFrame(pages, "node long, final long, failed boolean"), spark.createDataFrame(links, "node long, ord int, dst long"), spark.createDataFrame([(0, 0), (7, 1)], "node long, ord int")
    depth, budget = rng.randint(1, 5), rng.choice([3, 9, 17, 100])
    assert {tuple(r) for r in crawl.crawl(*made, depth, budget).collect()} == loop(*lists(*made), depth, budget)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
