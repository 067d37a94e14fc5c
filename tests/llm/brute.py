"""Plain Python that several tests of this folder share."""


def components_of(ids, links):
    """The smallest id reachable over links, of each id."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
