"""Call routing against a small step-by-step simulation, on random scope scripts."""

import random

import pytest
from test_scopes import build

from pyspark.sql import functions as F

from linewise.operators.scopes import assign_calls


class Node:
    def __init__(self, name, parent):
        self.name, self.parent = name, parent
        self.asks = self.open = self.ended = False
        self.held, self.host, self.waiting = [], None, []
        above = nearest(self)
        self.host = above if above is not None and above.open else None


def nearest(node):
    up = node.parent
    while up is not None and not up.asks:
        up = up.parent
    return up


def place(node, root):
    """The scope whose list takes a call now; None when nothing is left to take it."""
    if node is root:
        return node
    if node.ended or (not node.asks and node.host is not None and node.host.ended):
        return place(node.host, root) if node.host is not None else None
    if node.host is not None and not node.asks and node not in node.host.waiting:
        node.host.waiting.append(node)
    return node


def gather(node):
    for helper in list(node.waiting):
        node.waiting.remove(helper)
        if helper.asks:
            continue
        owner = nearest(helper)
        if owner is not None and owner is not node:
            helper.host = owner
            owner.waiting.append(helper)
        else:
            node.held += helper.held
            helper.held = []


def simulate(script):
    root = Node("root", None)
    nodes, fate = {"root": root}, {}
    for seq, (kind, name, extra) in enumerate(script, start=1):
        if kind == "open":
            nodes[name] = Node(name, nodes[extra])
            continue
        node = nodes[name]
        if kind == "call":
            target = place(node, root)
            if target is None:
                fate[extra] = ("lost", None)
            else:
                target.held.append(extra)
        elif kind in ("request", "response"):
            if node is not root:
                node.asks = True
                node.open = kind == "request"
            if kind == "response":
                gather(node)
                fate.update({c: ("shipped", (name, seq)) for c in node.held})
                node.held = []
        elif kind == "end":
            node.ended = True
            gather(node)
            target = place(node, root)
            if target is None:
                fate.update({c: ("lost", None) for c in node.held})
            else:
                target.held += node.held
            node.held = []
    for node in nodes.values():
        fate.update({c: ("pending", None) for c in node.held})
    return fate


def random_script(rng):
    """Nested runs that end in order, children that never end, calls anywhere."""
    script, alive, stack, n = [], ["root"], ["root"], 0
    for step in range(60):
        roll = rng.random()
        if roll < 0.2:
            n += 1
            run = rng.random() < 0.6
            parent = stack[-1] if run else rng.choice(alive)
            script.append(("open", f"s{n}", parent))
            alive.append(f"s{n}")
            if run:
                stack.append(f"s{n}")
        elif roll < 0.3 and len(stack) > 1:
            script.append(("end", stack.pop(), None))
        elif roll < 0.6:
            script.append(("call", rng.choice(alive), f"call{step}"))
        elif roll < 0.8:
            script.append(("request", rng.choice(stack), None))
        else:
            script.append(("response", rng.choice(stack), None))
    return script + [("call", "root", "last"), ("response", "root", None)]


@pytest.mark.parametrize("seed", range(4))
def test_routing_equals_the_simulation(spark, seed):
    script = random_script(random.Random(seed))
    want = simulate(script)
    rows = assign_calls(*[build(spark, script)[i] for i in (2, 0, 1)], F.floor(F.col("seq") / 7)).collect()
    got = {r["name"]: (r.fate, (r.ship_scope, r.ship_seq) if r.fate == "shipped" else None) for r in rows}
    assert got == want
