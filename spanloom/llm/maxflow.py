"""Minimum cuts of small graphs with two terminals."""

from __future__ import annotations

from collections import deque


def min_cut(gain: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels minimising the cost of the labels and of the links between unlike labels.

    ``gain[i]`` is what label True saves over False at node i (its terminal capacity, to the source if
    positive, to the sink if negative). ``links`` are (i, j, capacity >= 0). Nodes whose gain
    outweighs all their links are settled first, which no minimum cut contradicts; the maximum flow through the others
    tells the rest. Nodes the flow leaves undecided are False.
    """
    n = len(gain)
    around: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in links:
        if i != j and c > 0:
            around[i][j] = around[i].get(j, 0.0) + c
            around[j][i] = around[j].get(i, 0.0) + c
    left = list(gain)
    weight = [sum(x.values()) for x in around]
    label: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:
        i = waiting.popleft()
        if label[i] is not None or abs(left[i]) <= weight[i] and weight[i] > 0:
            continue
        label[i] = left[i] > 0
        for j, c in around[i].items():
            if label[j] is None:
                left[j] += c if label[i] else -c
                weight[j] -= c
                waiting.append(j)
    open_nodes = [i for i in range(n) if label[i] is None]
    if open_nodes:
        reached = _source_side(open_nodes, left, around, label)
        for i in open_nodes:
            label[i] = i in reached
    return [bool(x) for x in label]


def _source_side(nodes: list[int], gain: list[float], around: list[dict[int, float]], label: list[bool | None]) -> set[int]:
    """Nodes the source still reaches after a maximum flow (shortest augmenting paths, level by level)."""
    source, sink = -1, -2
    free: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in nodes:
        free[i] = {j: c for j, c in around[i].items() if label[j] is None}
        if gain[i] > 0:
            free[source][i], free[i][source] = gain[i], 0.0
        elif gain[i] < 0:
            free[i][sink], free[sink][i] = -gain[i], 0.0
    tiny = 1e-12
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, c in free[u].items():
                if c > tiny and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return set(level) - {source}
        todo = {u: list(x) for u, x in free.items()}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(free[a][b] for a, b in zip(path, path[1:]))
                cut = 0
                for k, (a, b) in enumerate(zip(path, path[1:])):
                    free[a][b] -= flow
                    free[b][a] = free[b].get(a, 0.0) + flow
                    if free[a][b] <= tiny and not cut:
                        cut = k + 1
                path = path[: cut or 1]
                continue
            while todo[u]:
                v = todo[u][-1]
                if free[u][v] > tiny and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
                todo[u].pop()
            else:
                path.pop()
                if path:
                    todo[path[-1]].pop()
