"""Slow helpers of several tests."""


def union_find(nodes, linked):
    """Each node's group, by comparing all pairs."""
    nodes = list(nodes)
    parent = {v: v for v in nodes}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                parent[top(a)] = top(b)
    return {v: top(v) for v in nodes}
