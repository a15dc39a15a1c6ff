"""A hierarchical navigable small-world graph over the vectors of one shard.

Many queries walk the graph together, so the work is array operations. Nodes
are ordered by level, highest first; each layer is the graph of a prefix. Nodes
of a shard find their neighbours by products with all nodes before them, which
takes a tenth of the time of walks.
"""

from __future__ import annotations

import numpy as np

# Queries that walk together.
WAVE = 512
# One query in so many is compared with the whole shard.
AUDITED = 16
# Queries audited together; the first that fail end the audit.
AT_ONCE = 64
# A beam of more than one in so many of a shard's nodes, or one that meets more than that, costs more than a look at all
# of them: a node met is one gathered, all of them are a product.
SCANNED = 16
# Nodes before a wave that it looks at all of when it is built in; beyond, it walks.
LOOKED = 1 << 14
# Pairs whose cosine is taken in double precision at once.
AT_A_TIME = 1 << 15
# Nodes nearest to a query that an audit looks for, links or not.
NEAREST = 8


def _selected(vectors: np.ndarray, found: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours of each row from candidates, nearest first, -1 where there are fewer.

    A candidate nearer to a chosen neighbour than to the node is put back, so
    that links lead out of dense groups; places left go to the nearest put back.
    """
    rows, width = found.shape
    near = vectors[found]
    between = near @ near.transpose(0, 2, 1)
    chosen = np.zeros((rows, width), bool)
    closest = np.full((rows, width), -np.inf, np.float32)
    for i in range(width):
        room = chosen.sum(axis=1) < most
        take = (found[:, i] >= 0) & room & (sims[:, i] >= closest[:, i])
        chosen[:, i] = take
        closest = np.where(take[:, None], np.maximum(closest, between[:, i]), closest)
    order = np.lexsort((np.arange(width)[None, :].repeat(rows, 0), ~chosen, found < 0), axis=1)
    return np.take_along_axis(found, order, axis=1)[:, :most]


class Graph:
    """``vectors`` are unit rows in graph order, ``layers[l]`` the neighbours of the first nodes."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]):
        self.exact = vectors
        self.vectors = vectors.astype(np.float32)
        self.layers = layers
        # nodes that a query of the last walk met in the lowest layer, on average
        self.met = 0.0
        # a product in single precision is off by less than this
        self.off = 1e-6 + vectors.shape[1] * 1.2e-7

    @classmethod
    def build(cls, vectors: np.ndarray, levels: np.ndarray, links: int, beam: int) -> Graph:
        """``levels`` descend; a node is in all layers up to its level."""
        graph = cls(vectors, [])
        top = int(levels[0])
        for level in range(top, -1, -1):
            size = int((levels >= level).sum())
            most = links if level else 2 * links
            layer = np.full((size, most), -1, np.int32)
            done = 0
            if graph.layers:  # the nodes of the layer above are linked already
                above = graph.layers[0]
                done = len(above)
                layer[:done, : above.shape[1]] = above
            graph.layers.insert(0, layer)
            while done < size:
                ahead = min(size, done + max(1, min(done, WAVE)))
                graph._insert(done, ahead, most, beam)
                done = ahead
        return graph

    def _insert(self, done: int, ahead: int, most: int, beam: int) -> None:
        fresh = np.arange(done, ahead)
        together = self.vectors[fresh] @ self.vectors[fresh].T
        np.fill_diagonal(together, -np.inf)
        width = min(most, len(fresh))
        own = np.argpartition(-together, width - 1, axis=1)[:, :width]
        found = (own + done).astype(np.int32)
        sims = np.take_along_axis(together, own, axis=1)
        found[~np.isfinite(sims)] = -1
        if done:
            nearest = self._nearest if done <= LOOKED else self._walked
            met, met_sims = nearest(self.vectors[fresh], beam, done)
            found, sims = np.hstack([found, met]), np.hstack([sims, met_sims])
        sims = np.where(found >= 0, sims, -np.inf)
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * most]
        found, sims = np.take_along_axis(found, order, 1), np.take_along_axis(sims, order, 1)
        layer = self.layers[0]
        chosen = _selected(self.vectors, found, sims, most)
        layer[fresh, : chosen.shape[1]] = chosen
        self._link_back(fresh, most)

    def _walked(self, queries: np.ndarray, beam: int, size: int):
        return self._walk(queries, beam, 0, size)

    def _nearest(self, queries: np.ndarray, beam: int, size: int):
        """The ``beam`` nearest of the first nodes."""
        sims = queries @ self.vectors[:size].T
        width = min(beam, size)
        found = np.argpartition(-sims, width - 1, axis=1)[:, :width].astype(np.int32)
        return found, np.take_along_axis(sims, found, axis=1)

    def _link_back(self, fresh: np.ndarray, most: int) -> None:
        """Gives the neighbours of new nodes a link to them, choosing anew where there are too many."""
        layer = self.layers[0]
        there = layer[fresh]
        at, to = fresh.repeat(there.shape[1])[there.ravel() >= 0], there.ravel()[there.ravel() >= 0]
        if not len(to):
            return
        touched = np.unique(to)
        old = layer[touched]
        node = np.concatenate([to, touched.repeat(old.shape[1])[old.ravel() >= 0]])
        other = np.concatenate([at, old.ravel()[old.ravel() >= 0]])
        pairs = np.unique(node.astype(np.int64) * len(self.vectors) + other)
        node, other = pairs // len(self.vectors), pairs % len(self.vectors)
        sims = np.einsum("id,id->i", self.vectors[node], self.vectors[other])
        order = np.lexsort((-sims, node))
        node, other, sims = node[order], other[order], sims[order]
        first = np.searchsorted(node, touched)
        nth = np.arange(len(node)) - first[np.searchsorted(touched, node)]
        kept = nth < 3 * most
        row, nth = np.searchsorted(touched, node[kept]), nth[kept]
        width = int(nth.max()) + 1
        found = np.full((len(touched), width), -1, np.int32)
        near = np.full((len(touched), width), -np.inf, np.float32)
        found[row, nth], near[row, nth] = other[kept], sims[kept]
        layer[touched] = -1
        fit = min(width, most)
        layer[touched, :fit] = found[:, :fit]
        crowded = np.flatnonzero((found >= 0).sum(axis=1) > most)
        for a in range(0, len(crowded), WAVE):
            part = crowded[a : a + WAVE]
            chosen = _selected(self.vectors, found[part], near[part], most)
            layer[touched[part], : chosen.shape[1]] = chosen

    def _walk(self, queries: np.ndarray, beam: int, bottom: int, size: int | None = None):
        """The ``beam`` nearest nodes met in layer ``bottom``, by way of the layers above."""
        entry = np.zeros(len(queries), np.int64)
        for level in range(len(self.layers) - 1, bottom, -1):
            entry = self._beam(queries, self.layers[level], entry, 1)[0][:, 0]
        layer = self.layers[bottom]
        return self._beam(queries, layer if size is None else layer[:size], entry, beam)

    def _beam(self, queries: np.ndarray, layer: np.ndarray, entry: np.ndarray, beam: int):
        n, rows = len(layer), len(queries)
        seen = np.zeros((rows, n), bool)
        line = np.arange(rows)
        seen[line, entry] = True
        found = np.full((rows, beam), -1, np.int32)
        sims = np.full((rows, beam), -np.inf, np.float32)
        spent = np.zeros((rows, beam), bool)
        found[:, 0] = entry
        sims[:, 0] = np.einsum("id,id->i", queries, self.vectors[entry])
        step = max(1, min(4, beam), beam // 32)
        active = line
        while len(active):
            # the nearest of the beam that were not yet looked around from
            left = np.where(spent[active] | (found[active] < 0), -np.inf, sims[active])
            pick = np.argsort(-left, axis=1, kind="stable")[:, :step]
            open_ = np.isfinite(np.take_along_axis(left, pick, 1))
            alive = open_.any(axis=1)
            active, pick, open_ = active[alive], pick[alive], open_[alive]
            if not len(active):
                break
            at = np.broadcast_to(active[:, None], pick.shape)[open_]
            spent[at, pick[open_]] = True
            around = layer[found[at, pick[open_]]]
            row = np.broadcast_to(at[:, None], around.shape)[around >= 0]
            node = around[around >= 0]
            new = ~seen[row, node]
            pairs = np.unique(row[new].astype(np.int64) * n + node[new])
            row, node = pairs // n, pairs % n
            seen[row, node] = True
            if not len(row):
                continue
            near = np.einsum("id,id->i", queries[row], self.vectors[node])
            place = np.searchsorted(active, row)
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            width = int(nth.max()) + 1
            more = np.full((len(active), width), -1, np.int32)
            more_sims = np.full((len(active), width), -np.inf, np.float32)
            more[place, nth], more_sims[place, nth] = node, near
            all_found = np.hstack([found[active], more])
            all_sims = np.hstack([sims[active], more_sims])
            all_spent = np.hstack([spent[active], np.zeros(more.shape, bool)])
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            found[active] = np.take_along_axis(all_found, best, 1)
            sims[active] = np.take_along_axis(all_sims, best, 1)
            spent[active] = np.take_along_axis(all_spent, best, 1)
        self.met = seen.sum() / rows
        return found, sims

    def _hits(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of cosine ``least`` or more; a beam as wide as the shard looks at all of it."""
        rows, nodes = [], []
        whole = beam >= len(self.exact)
        wave = WAVE if whole else max(1, min(WAVE, 16 * WAVE // beam))
        for a in range(0, len(queries), wave):
            part = queries[a : a + wave]
            if whole:
                row, node = np.nonzero(part.astype(np.float32) @ self.vectors.T >= least - self.off)
            else:
                found, _ = self._walk(part.astype(np.float32), beam, 0)
                row, col = np.nonzero(found >= 0)
                node = found[row, col]
            close = np.concatenate(
                [
                    np.einsum("id,id->i", part[row[b : b + AT_A_TIME]], self.exact[node[b : b + AT_A_TIME]]) >= least
                    for b in range(0, len(row), AT_A_TIME)
                ]
                or [np.empty(0, bool)]
            )
            row, node = row[close], node[close]
            rows.append(row + a)
            nodes.append(node)
        return np.concatenate(rows), np.concatenate(nodes).astype(np.int64)

    def _widened(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) hits; the beam of a query is widened while half of it are hits."""
        todo, width = np.arange(len(queries)), beam
        rows, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(todo):
            row, node = self._hits(queries[todo], least, width)
            full = (np.bincount(row, minlength=len(todo)) * 2 >= width) & (width < len(self.exact))
            fine = ~full[row]
            rows.append(todo[row[fine]])
            nodes.append(node[fine])
            todo, width = todo[full], 4 * width
        return np.concatenate(rows), np.concatenate(nodes)

    def _audited(self, queries: np.ndarray, own: np.ndarray, least: float, beam: int, recall: float) -> tuple[bool, float]:
        """Whether each query finds ``recall`` of its hits and of its nearest nodes, itself (``own``) left out.

        And how many nodes a query met on its walk.
        """
        met = 0.0
        for a in range(0, len(queries), AT_ONCE):
            part, self_ = queries[a : a + AT_ONCE], own[a : a + AT_ONCE, None]
            line = np.arange(len(part))
            sims = part @ self.exact.T
            mine = np.flatnonzero(self_[:, 0] >= 0)
            sims[mine, self_[mine, 0]] = -np.inf
            k = min(NEAREST, sims.shape[1] - int(len(mine) > 0))
            if k > 0:
                furthest = np.partition(sims, -k, axis=1)[:, -k]
                found, _ = self._walk(part.astype(np.float32), beam, 0)
                met = max(met, self.met)
                # equally near nodes stand for each other, to the precision of the walk
                near = (found >= 0) & (sims[line[:, None], found] >= furthest[:, None] - 1e-6)
                if (near.sum(axis=1) < recall * k).any():
                    return False, met
            row, node = self._widened(part, least, beam)
            other = node != self_[row, 0]
            want = (sims >= least).sum(axis=1)
            if (np.bincount(row[other], minlength=len(part)) < recall * want).any():
                return False, met
        return True, met

    def links(
        self,
        queries: np.ndarray,
        least: float,
        beam: int,
        audit: int,
        recall: float,
        own: np.ndarray | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of cosine ``least`` or more, in double precision.

        A query's beam is widened while half of it are hits. Before, one query
        in ``AUDITED``, ``audit`` at least, evenly spread, is compared with all
        of the shard, and the beam all queries start with is doubled until each
        of them finds the ``recall`` asked for, of its hits and of its nearest
        nodes, or the beam is so wide, or meets so many nodes, that a look at
        all of the shard costs less. ``own`` is the node that each query is itself, -1 for none.
        """
        own = np.full(len(queries), -1) if own is None else own
        many = min(len(queries), max(audit, -(-len(queries) // AUDITED)))
        sample = np.unique(np.linspace(0, len(queries) - 1, many).astype(int))
        while beam < len(self.exact):
            fine, met = self._audited(queries[sample], own[sample], least, beam, recall)
            if met * SCANNED > len(self.exact):
                beam = len(self.exact)
            elif fine:
                break
            else:
                beam = 2 * beam if 2 * beam * SCANNED <= len(self.exact) else len(self.exact)
        return self._widened(queries, least, beam)
