"""Plain Python counterparts for small graphs."""

from collections import Counter

# Hand-checked: duplicate A-B, self-loop F, sink E, D without in-edge.
TINY = ["AB", "AC", "BC", "CA", "DC", "AB", "CE", "FF"]


def ranks(edges, iterations, damping):
    degree = Counter(src for src, _ in edges)
    scores = {src: 1.0 for src in degree}
    for _ in range(iterations):
        received = {}
        for src, dst in edges:
            if src in scores:
                received[dst] = received.get(dst, 0.0) + scores[src] / degree[src]
        scores = {node: 1 - damping + damping * got for node, got in received.items()}
    return scores


def hops(edges, starts, count, back=False):
    met, frontier = {node: 0 for node in starts}, set(starts)
    for hop in range(1, count + 1):
        ends = {(a if back else b) for a, b in edges if (b if back else a) in frontier}
        frontier = {node for node in ends if node not in met}
        met.update({node: hop for node in frontier})
    return met


def random_edges(nodes, count, seed, hub_share=3):
    """Edges with a hub: one source and one target carry about a third of them each."""
    import random

    rng = random.Random(seed)

    def pick():
        return "n0" if rng.randrange(hub_share) == 0 else f"n{rng.randrange(nodes)}"

    return [(pick(), pick()) for _ in range(count)]
