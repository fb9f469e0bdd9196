"""A hierarchical navigable small-world graph over unit vectors, in numpy arrays."""

from __future__ import annotations

import io

import numpy as np

#: Neighbours of a node on the upper layers and on the lowest, beam while building.
NEIGHBOURS, LOWEST, BUILD_BEAM = 12, 24, 48
#: Share of a node's places on the lowest layer that keep their first, far neighbours.
FAR = 4
#: Nodes at least that lead to any node of the lowest layer.
LED_TO = 4


class Graph:
    """Nodes are rows of ``vectors``; ``layers[0]`` holds all of them, each upper layer a share of the one below."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int):
        self.vectors, self.layers, self.entry = vectors, layers, entry
        self.seen = np.zeros(len(vectors), np.int64)
        self.turn = 0

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 7) -> Graph:
        n = len(vectors)
        drawn = np.random.default_rng(seed)
        heights = np.floor(-np.log(1 - drawn.random(n)) / np.log(NEIGHBOURS)).astype(int)
        top = int(heights.max()) if n else 0
        graph = cls(vectors, [np.full((n, LOWEST if k == 0 else NEIGHBOURS), -1, np.int32) for k in range(top + 1)], 0)
        near = [np.full(layer.shape, -2.0) for layer in graph.layers]
        reached = -1
        for node in range(n):
            graph._insert(node, int(heights[node]), reached, near)
            if heights[node] > reached:
                reached, graph.entry = int(heights[node]), node
        graph._lead_back()
        return graph

    def _lead_back(self) -> None:
        """Gives nodes that few others lead to a place with their own neighbours, beside those that are taken.

        In a large group of near copies the nearest crowd each other out, and a node may lose all that led to it.
        """
        base = self.layers[0]
        led = np.bincount(base[base >= 0], minlength=len(base))
        more: dict[int, list[int]] = {}
        for node in np.flatnonzero(led < LED_TO).tolist():
            own = base[node][base[node] >= 0].tolist()
            for other in sorted(own, key=lambda k: len(more.get(k, ())))[: LED_TO - int(led[node])]:
                more.setdefault(other, []).append(node)
        wider = np.full((len(base), max(map(len, more.values()), default=0)), -1, np.int32)
        for other, nodes in more.items():
            wider[other, : len(nodes)] = nodes
        self.layers[0] = np.concatenate([base, wider], axis=1)

    def _insert(self, node: int, height: int, reached: int, near: list[np.ndarray]) -> None:
        if reached < 0:
            return
        query = self.vectors[node]
        beam = np.array([self.entry])
        for layer in range(reached, -1, -1):
            ids, likes = self._beam(query, beam, layer, 1 if layer > height else BUILD_BEAM)
            beam = ids
            if layer > height:
                continue
            places = self.layers[layer].shape[1]
            chosen = self._spread(ids, likes, places // 2)
            self.layers[layer][node, : len(chosen)] = ids[chosen]
            near[layer][node, : len(chosen)] = likes[chosen]
            kept = places // FAR
            for other, like in zip(ids[chosen].tolist(), likes[chosen].tolist()):
                row = near[layer][other]
                free = int(np.argmin(row))
                if row[free] > -2:
                    free = kept + int(np.argmin(row[kept:]))
                    if row[free] >= like:
                        continue
                row[free] = like
                self.layers[layer][other, free] = node

    def _spread(self, ids: np.ndarray, likes: np.ndarray, most: int) -> list[int]:
        """The nearest that are no nearer to one already taken than to the query, then the nearest of the rest."""
        order = np.argsort(-likes).tolist()
        if len(order) <= most:
            return order
        among = self.vectors[ids] @ self.vectors[ids].T
        worst = np.full(len(ids), -2.0)
        taken: list[int] = []
        for k in order:
            if worst[k] < likes[k]:
                taken.append(k)
                if len(taken) == most:
                    return taken
                np.maximum(worst, among[k], out=worst)
        chosen = set(taken)
        return taken + [k for k in order if k not in chosen][: most - len(taken)]

    def _beam(
        self, query: np.ndarray, entries: np.ndarray, layer: int, width: int, least: float = 2.0
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes found from the entries, and all found that are as near as ``least``.

        Every node of the beam is expanded, all that are open at a time.
        """
        links, seen = self.layers[layer], self.seen
        self.turn += 1
        turn = self.turn
        ids = entries
        seen[ids] = turn
        likes = self.vectors[ids] @ query
        opened = np.zeros(len(ids), bool)
        while True:
            frontier = ids[~opened]
            if not len(frontier):
                return ids, likes
            opened[:] = True
            around = links[frontier].ravel()
            around = around[around >= 0]
            around = around[seen[around] != turn]
            if not len(around):
                continue
            around = np.unique(around)
            seen[around] = turn
            ids = np.concatenate([ids, around])
            likes = np.concatenate([likes, self.vectors[around] @ query])
            opened = np.concatenate([opened, np.zeros(len(around), bool)])
            if len(ids) > width:
                bound = np.partition(likes, len(likes) - width)[len(likes) - width]
                kept = likes >= min(bound, least)
                ids, likes, opened = ids[kept], likes[kept], opened[kept]

    def search(self, query: np.ndarray, width: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Nodes found with a beam of ``width``, with whatever is as near as ``least`` reached from them."""
        if width >= len(self.vectors):
            return np.arange(len(self.vectors)), self.vectors @ query
        beam = np.array([self.entry])
        for layer in range(len(self.layers) - 1, 0, -1):
            beam, _ = self._beam(query, beam, layer, 1)
        return self._beam(query, beam, 0, width, least)

    def audited_beam(self, least: float, width: int = 32, queries: int = 64, recall: float = 0.99, near: int = 8) -> int:
        """The narrowest beam, doubled from ``width``, that finds nearly all of what brute force finds.

        Evenly spaced nodes ask for their links and their ``near`` nearest others; a beam as wide as the graph
        is brute force.
        """
        n = len(self.vectors)
        asked = np.unique(np.linspace(0, n - 1, min(n, queries)).astype(int))
        truth = self.vectors[asked] @ self.vectors.T
        while width < n:
            found = wanted = close = 0
            for row, node in enumerate(asked.tolist()):
                ids, _ = self.search(self.vectors[node], width, least)
                links = np.flatnonzero(truth[row] >= least)
                nearest = np.argpartition(-truth[row], min(near, n - 1))[: near + 1]
                wanted += len(links)
                found += len(np.intersect1d(links, ids, assume_unique=True))
                close += len(np.intersect1d(nearest, ids, assume_unique=True)) / len(nearest)
            if found >= recall * wanted and close >= 0.9 * len(asked):
                break
            width *= 2
        return width

    def dump(self) -> bytes:
        """Without the vectors."""
        out = io.BytesIO()
        np.savez(out, entry=self.entry, **{f"layer{k}": layer for k, layer in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def load(cls, vectors: np.ndarray, data: bytes) -> Graph:
        held = np.load(io.BytesIO(data))
        layers = [held[f"layer{k}"] for k in range(len(held.files) - 1)]
        return cls(vectors, layers, int(held["entry"]))
