def components(nodes, links):
    """Smallest reachable node of every node."""
    parent = {i: i for i in nodes}

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in parent}
