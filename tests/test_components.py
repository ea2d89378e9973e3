"""Components and contracted edges against a search over points."""

import random

from voxframe.operators import components as co
from voxframe.operators import neighbours as nb


def searched(points, offsets):
    """The least point that each point reaches."""
    held, found = set(points), {}
    for p in sorted(held):
        waiting = [] if p in found else [p]
        found.setdefault(p, p)
        while waiting:
            q = waiting.pop()
            for o in offsets:
                for s in (1, -1):
                    r = tuple(a + s * b for a, b in zip(q, o, strict=True))
                    if r in held and r not in found:
                        found[r] = p
                        waiting.append(r)
    return found


def test_components_equal_a_search(spark):
    rng = random.Random(1)
    rows = [(k, "m", z, y, x) for k in range(6) for z in range(7) for y in range(9) for x in range(9) if rng.random() < 0.38]
    mask = spark.createDataFrame(rows, "k int, m string, z int, y int, x int")
    for offsets in (nb.FACES, nb.IN_SLICE, nb.ball(2), [(1, 1, -1), (0, 0, 1), (2, 0, 0)]):
        got = {(r.k, r.z, r.y, r.x): r.component for r in nb.components(mask, ["k", "m"], offsets).collect()}
        want = {(k, *p): (q[0] << 42) + (q[1] << 21) + q[2] for k in range(6) for p, q in searched([r[2:] for r in rows if r[0] == k], offsets).items()}
        assert got == want


def test_large_groups_of_edges_are_contracted_in_portions(spark):
    edges = [(1, i, i + 1) for i in range(50)] + [(2, i * 7, i * 7 + 7) for i in range(30)] + [(3, 5, 9)]
    frame = spark.createDataFrame(edges, "k int, a long, b long")
    want = {**{(1, i): 0 for i in range(1, 51)}, **{(2, i * 7): 0 for i in range(1, 31)}, (3, 9): 5}
    for most in (4, 1000):
        assert {(r.k, r.node): r.root for r in co.contracted(frame, ["k"], most).collect()} == want
