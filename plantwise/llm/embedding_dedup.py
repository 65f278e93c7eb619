"""Embedding near-dedup (operator 12) by an inverted multi-index.

* **Codebooks.**  The halves of the vectors get a codebook each, fitted on a
  bounded sample; the pairs of their entries form a product grid.  Equal vectors
  of a label are one node with a weight; every node lives in its nearest cell.
* **Traversal.**  With both halves' distances sorted, the cells that a
  multi-sequence traversal reaches before the sum passes a given reach form a
  staircase.  The reach is calibrated: vectors of the sample get partners at
  exactly the threshold in random directions, the hardest pairs there are, and
  the reach is the least at which ``RECALL`` of them meet.  A node visits only
  cells numbered above its own, so a pair meets in one place: the higher of its
  two cells.
* **Layout.**  The nodes are sorted by label, cell and number into files of
  ``BLOCK_BYTES`` of vectors at most, in the folder that executors share.  All
  that a node may meet lies in its own file or in later ones of its label.
* **Meeting.**  A task has a file, and reads those later files that hold cells which
  its nodes visit, one at a time.  Nothing is copied or shuffled by visits, so
  what a run keeps on disk doesn't depend on their number.
* **Verification.**  The members of a cell are compared with each other and with
  its visitors: a bound from the leading directions and the length of the rest leaves
  out pairs that can't link, the others are verified in double precision.  A task
  gives the number of links of each node and a spanning forest, never the pairs.

Cells are sized by the corpus (``CELL_ROWS`` on average).  The members of a cell
that holds many more, as near copies make it, are put around a few leaders and
cut into parts by angle: two parts that are close enough link wholly, and are
only counted; two that are too far apart don't link at all; the others are
compared.
"""

from __future__ import annotations

import math
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages, shared_fs
from plantwise.llm.components import connected_components

THRESHOLD = 0.93
#: Nodes of the bounded sample that codebooks and reach are fitted on.
SAMPLE_ROWS = 20_000
#: Share of pairs exactly at the threshold that the traversal must bring together.
RECALL = 0.999
#: Nodes a cell holds on average, in the largest label.
CELL_ROWS = 2048
#: Entries of a codebook at most.
MAX_ENTRIES = 4096
#: Members of a cell over which they are put around leaders.
TILE_ROWS = 16_384
#: Leaders of such a cell, and the members that they are fitted on.
LEADERS, LEADER_ROWS = 16, 1024
#: Members of a smaller cell that tell whether many link, and it is treated alike.
PROBE = 256
#: Members in a part of such a cell.
CHUNK = 4096
#: Bytes of vectors in a file of sorted nodes, about.
BLOCK_BYTES = 32 << 20
#: Rows of such a file that are worth a task of their own.
TASK_ROWS = 4096
#: Visits that a task holds at a time.
VISITS = 1 << 22
#: Similarities computed in one array step.
STEP = 1 << 20
#: Share of the sample's unlinked pairs that the bound may let through.
PASS = 1e-4

_FOUND = "a long, b long, n long"


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one (components scaled first, so squares stay finite)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1)[None, :], 0)


class MultiIndex:
    """Two codebooks over the halves of unit vectors, and the reach."""

    def __init__(self, sample: np.ndarray, entries: int, threshold: float, recall: float = RECALL, rounds: int = 10):
        self.dim = sample.shape[1]
        self.half = (self.dim + 1) // 2
        self.books = [self._fit(part, entries, rounds) for part in self._halves(sample)]
        self.reach = self._calibrated(sample, threshold, recall)
        self.lead = self._leading(sample[:2000], threshold)

    def _halves(self, x):
        return x[:, :self.half], x[:, self.half:]

    @staticmethod
    def _fit(x: np.ndarray, entries: int, rounds: int) -> np.ndarray:
        book = np.unique(x, axis=0)
        book = book[np.random.default_rng(1).permutation(len(book))[:entries]]
        for _ in range(rounds):
            of = np.concatenate([_squares(p, book).argmin(1) for p in np.array_split(x, max(1, len(x) * len(book) // STEP))])
            n = np.bincount(of, minlength=len(book))
            sums = np.zeros_like(book)
            np.add.at(sums, of, x)
            book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
        return book

    def fold(self, x: np.ndarray) -> np.ndarray:
        """Vectors of any length in the index's dimensions: cut or padded, which
        never moves two further apart."""
        if x.shape[1] >= self.dim:
            return x[:, :self.dim]
        return np.pad(x, [(0, 0), (0, self.dim - x.shape[1])])

    def excess(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each entry of the two books is further away than the nearest."""
        out = [_squares(p, book) for p, book in zip(self._halves(self.fold(x)), self.books)]
        return tuple(d - d.min(axis=1, keepdims=True) for d in out)

    def home(self, e1: np.ndarray, e2: np.ndarray) -> np.ndarray:
        return e1.argmin(1).astype(np.int64) * len(self.books[1]) + e2.argmin(1)

    def _calibrated(self, sample: np.ndarray, threshold: float, recall: float) -> float:
        a = sample[:4096]
        side = np.random.default_rng(2).standard_normal(a.shape)
        side -= (side * a).sum(1, keepdims=True) * a
        norm = np.sqrt((side * side).sum(1, keepdims=True))
        b = threshold * a + math.sqrt(1 - threshold * threshold) * np.divide(side, norm, out=np.zeros_like(side), where=norm > 0)
        ea, eb = self.excess(a), self.excess(b)
        ha, hb = self.home(*ea), self.home(*eb)
        k, at = len(self.books[1]), np.arange(len(a))
        # The one with the lower cell is the visitor.
        far = np.where(ha <= hb, ea[0][at, hb // k] + ea[1][at, hb % k], eb[0][at, ha // k] + eb[1][at, ha % k])
        far = np.sort(far)
        return float(far[min(len(far) - 1, math.ceil(recall * len(far)))]) * (1 + 1e-9) if len(far) else 0.0

    @staticmethod
    def _leading(sample: np.ndarray, threshold: float) -> np.ndarray:
        """Directions in which the sample is longest, so many that few of its
        unlinked pairs pass ``bounded``."""
        axes = np.linalg.svd(sample, full_matrices=False)[2]
        apart, n = sample @ sample.T < threshold, 4
        while n <= sample.shape[1] // 2 and n < len(axes):
            low = MultiIndex._low(sample, axes[:n])
            if (apart & (low @ low.T >= threshold)).mean() <= PASS:
                return axes[:n]
            n += max(4, n // 4)
        return np.eye(sample.shape[1])

    @staticmethod
    def _low(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
        lead = x @ axes.T
        return np.c_[lead, np.sqrt(np.maximum(0, 1 - (lead * lead).sum(1)))]

    def bounded(self, x: np.ndarray) -> np.ndarray:
        """Short forms of unit vectors whose products are no less than the
        vectors' own, but for rounding."""
        return self._low(x, self.lead).astype(np.float32) if x.shape[1] == self.dim else x.astype(np.float32)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, is home) of every cell that the rows reach, own ones
        first; of the others those numbered above the row's own."""
        e1, e2 = self.excess(x)
        own = self.home(e1, e2)
        o1, o2 = e1.argsort(1), e2.argsort(1)
        s1, s2 = np.take_along_axis(e1, o1, 1), np.take_along_axis(e2, o2, 1)
        rows, cells = [np.arange(len(x))], [own]
        for p in range(s1.shape[1]):  # a step of the staircase: how far the other sequence may go
            live = np.flatnonzero(s1[:, p] <= self.reach)
            if not len(live):
                break
            r, q = np.nonzero(s2[live] <= self.reach - s1[live, p][:, None])
            r = live[r]
            cell = o1[r, p].astype(np.int64) * len(self.books[1]) + o2[r, q]
            up = cell > own[r]
            rows.append(r[up])
            cells.append(cell[up])
        row = np.concatenate(rows)
        return row, np.concatenate(cells), np.arange(len(row)) < len(x)


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the rows of pairs: ``label`` has the least place of each row's component."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


class _Side:
    """Vectors as they came, with their short forms and weights."""

    def __init__(self, raw: np.ndarray, node: np.ndarray, w: np.ndarray, index: MultiIndex):
        self.raw, self.node, self.w = raw, node, w
        self.low = np.concatenate([index.bounded(_unit(raw[a:a + CHUNK].astype(np.float64))) for a in range(0, len(raw), CHUNK)] or [np.zeros((0, 1), np.float32)])

    def unit(self, at) -> np.ndarray:
        return _unit(self.raw[at].astype(np.float64, copy=False))


def _exact(x: _Side, i: np.ndarray, y: _Side, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs are similar; the few within rounding of the threshold are
    summed anew without rounding."""
    out = []
    for a in range(0, len(i), 1 << 14):
        p, q = x.unit(i[a:a + (1 << 14)]), y.unit(j[a:a + (1 << 14)])
        s = np.einsum("ij,ij->i", p, q)
        hit = s >= threshold
        for k in np.flatnonzero(np.abs(s - threshold) < 1e-13).tolist():
            hit[k] = math.fsum(p[k] * q[k]) >= threshold
        out.append(hit)
    return np.concatenate(out) if out else np.zeros(0, bool)


def _true(found: np.ndarray, size: int) -> np.ndarray:
    """Places of the few true ones among the first ``size``, by eights."""
    found[size:-(-size // 8) * 8] = False
    eights = np.flatnonzero(found[:-(-size // 8) * 8].view(np.int64))
    k, j = np.nonzero(found[:-(-size // 8) * 8].reshape(-1, 8)[eights])
    return eights[k] * 8 + j


def near_pairs(x: _Side, xi: np.ndarray, y: _Side, yi: np.ndarray, threshold: float):
    """Blocks of places ``i, j`` in ``xi`` and ``yi`` whose vectors are similar;
    of one set with itself (``xi is yi``) those with ``i < j``."""
    margin = (x.raw.shape[1] + 16) * 2.4e-7  # of single precision
    step = max(1, STEP // max(1, len(yi)))
    lx, ly = x.low[xi], y.low[yi].T
    room = np.empty(min(step, len(xi)) * len(yi), np.float32)
    found = np.empty(len(room) + 7, bool)
    for a in range(0, len(xi), step):
        some, start = xi[a:a + step], a if xi is yi else 0
        size = len(some) * (len(yi) - start)
        s = np.matmul(lx[a:a + step], ly[:, start:], out=room[:size].reshape(len(some), -1))
        hit = np.greater_equal(s, threshold - margin, out=found[:size].reshape(s.shape))
        if xi is yi:
            hit[:, :len(some)] = np.triu(hit[:, :len(some)], 1)
        at = _true(found, size)
        if not len(at):
            continue
        if len(at) > hit.size >> 5:
            s = x.unit(some).astype(np.float32) @ y.unit(yi[start:]).astype(np.float32).T
            hit &= s >= threshold - margin
            unsure = np.flatnonzero(hit & (s < threshold + margin))
            i, j = np.divmod(unsure, hit.shape[1])
            hit.ravel()[unsure] = _exact(x, some[i], y, yi[start + j], threshold)
            i, j = np.divmod(np.flatnonzero(hit), hit.shape[1])
        else:
            i, j = np.divmod(at, hit.shape[1])
            ok = _exact(x, some[i], y, yi[start + j], threshold)
            i, j = i[ok], j[ok]
        if len(i):
            yield i + a, j + start


def _linked(x: _Side, xi, y: _Side, yi, threshold: float, tx: np.ndarray, ty: np.ndarray):
    """Adds the weights that rows link with to ``tx`` and ``ty`` and gives a
    forest of the links, as pairs of nodes."""
    same, label = xi is yi, None
    shift = 0 if same else len(xi)
    for i, j in near_pairs(x, xi, y, yi, threshold):
        label = np.arange(shift + len(yi)) if label is None else label
        # Weights are summed as whole numbers: a float would round large ones.
        np.add.at(tx, xi[i], y.w[yi[j]])
        np.add.at(ty, yi[j], x.w[xi[i]])
        _union(label, i, j + shift)
    if label is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    node = x.node[xi] if same else np.r_[x.node[xi], y.node[yi]]
    up = np.flatnonzero(label != np.arange(len(label)))
    return node[up], node[label[up]]


def _result(node: np.ndarray, total: np.ndarray, links: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows ``a, b, n``: a node's weight of links (``b`` null), or a link (``n`` null)."""
    some = np.flatnonzero(total)
    a, b = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in links)]) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(np.r_[node[some], a]), pa.array(np.r_[np.zeros(len(some), np.int64), b], mask=np.r_[np.ones(len(some), bool), np.zeros(len(b), bool)]),
                                       pa.array(np.r_[total[some], np.zeros(len(b), np.int64)], mask=np.r_[np.zeros(len(some), bool), np.ones(len(b), bool)])], names=["a", "b", "n"])


def _leaders(sample: np.ndarray, count: int) -> np.ndarray:
    """Directions near the sample's: farthest first, then means of their nearest."""
    at = [0]
    best = sample @ sample[0]
    while len(at) < min(count, len(sample)) and best.min() < 1 - 1e-9:
        at.append(int(best.argmin()))
        best = np.maximum(best, sample @ sample[at[-1]])
    lead = sample[at]
    for _ in range(5):
        of = (sample @ lead.T).argmax(1)
        sums = np.zeros_like(lead)
        np.add.at(sums, of, sample)
        norm = np.sqrt((sums * sums).sum(1, keepdims=True))
        lead = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), lead)
    return lead


class _Parts:
    """The many members of a cell, around leaders and cut by angle."""

    def __init__(self, side: _Side, rows: np.ndarray, threshold: float, chunk: int):
        self.side, self.threshold, self.angle = side, threshold, math.acos(threshold)
        some = np.random.default_rng(3).permutation(len(rows))[:LEADER_ROWS]
        self.lead = _leaders(side.unit(rows[np.sort(some)]), LEADERS)
        self.between = np.arccos(np.clip(self.lead @ self.lead.T, -1, 1))
        no, angle = self._placed(side, rows)
        order = np.lexsort((angle, no))
        rows, no, angle = rows[order], no[order], angle[order]
        edges = np.searchsorted(no, np.arange(len(self.lead) + 1))
        cuts = [(k, a, min(a + chunk, int(edges[k + 1]))) for k in range(len(self.lead)) for a in range(int(edges[k]), int(edges[k + 1]), chunk)]
        self.rows = [rows[a:b] for _, a, b in cuts]
        self.no = np.array([k for k, _, _ in cuts])
        self.low, self.high = (np.array([angle[x] for x in at]) for at in ([a for _, a, _ in cuts], [b - 1 for _, _, b in cuts]))
        self.tight = 2 * self.high <= self.angle - 1e-6
        self.w = np.array([side.w[r].sum() for r in self.rows])
        self.first = np.array([r[0] for r in self.rows])
        #: Weight that all of a part link with, and whether something links with all of it.
        self.extra, self.whole = np.zeros(len(cuts), np.int64), np.zeros(len(cuts), bool)
        self.joined = np.arange(len(cuts))

    def _placed(self, side: _Side, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        no, angle = np.zeros(len(rows), np.int64), np.zeros(len(rows))
        for a in range(0, len(rows), CHUNK):
            s = side.unit(rows[a:a + CHUNK]) @ self.lead.T
            no[a:a + CHUNK], angle[a:a + CHUNK] = s.argmax(1), np.arccos(np.clip(s.max(1), -1, 1))
        return no, angle

    def _fate(self, no, low, high) -> tuple[np.ndarray, np.ndarray]:
        """Which parts (columns) link wholly with what lies at an angle of
        ``low`` to ``high`` from leader ``no``, and which may link with it."""
        apart, eps = self.between[no][:, self.no], 1e-6
        sure = apart + high[:, None] + self.high <= self.angle - eps
        may = (apart - high[:, None] - self.high <= self.angle + eps) & (np.maximum(low[:, None] - self.high, self.low - high[:, None]) - apart <= self.angle + eps)
        return sure, may & ~sure

    def within(self, total: np.ndarray) -> list:
        sure, may = self._fate(self.no, self.low, self.high)
        links = []
        for i, rows in enumerate(self.rows):
            self.extra[i] += self.w[sure[i]].sum()
            if sure[i].any():
                self.whole[i] |= True  # what links with all of it holds it together
                _union(self.joined, np.full(int(sure[i].sum()), i), np.flatnonzero(sure[i]))
            if sure[i, i]:
                total[rows] -= self.side.w[rows]
            for j in np.flatnonzero(may[i]).tolist():
                if j >= i:
                    links.append(_linked(self.side, rows, self.side, self.rows[j], self.threshold, total, total))
        return links

    def visited(self, v: _Side, rows: np.ndarray, tv: np.ndarray, total: np.ndarray) -> list:
        no, angle = self._placed(v, rows)
        sure, may = self._fate(no, angle, angle)
        tv[rows] += np.where(sure, self.w, 0).sum(1)
        self.extra += np.where(sure, v.w[rows][:, None], 0).sum(0)
        self.whole |= sure.any(0)
        some, j = np.nonzero(sure)
        head = sure.argmax(1)
        _union(self.joined, *np.divmod(np.unique(head[some] * len(self.rows) + j), len(self.rows)))
        held = np.flatnonzero(sure.any(1))
        links = [(v.node[rows[held]], self.side.node[self.first[head[held]]])]
        for j in np.flatnonzero(may.any(0)).tolist():
            links.append(_linked(v, rows[may[:, j]], self.side, self.rows[j], self.threshold, tv, total))
        return links

    def end(self, total: np.ndarray, own: bool) -> list:
        links, node = [], self.side.node
        for i, rows in enumerate(self.rows):
            total[rows] += self.extra[i]
            if self.whole[i] and (own or not self.tight[i]):
                links.append((node[rows[1:]], np.repeat(node[rows[0]], len(rows) - 1)))
        up = np.flatnonzero(self.joined != np.arange(len(self.joined)))
        return [*links, (node[self.first[up]], node[self.first[self.joined[up]]])]


class _Members:
    """The members of cells: vectors sorted by cell."""

    def __init__(self, side: _Side, cell: np.ndarray, threshold: float, tile_rows: int, chunk: int):
        self.side, self.threshold, self.tile_rows, self.chunk = side, threshold, tile_rows, chunk
        self.total = np.zeros(len(cell), np.int64)
        cuts = np.flatnonzero(np.diff(cell)) + 1
        self.at = {int(cell[a]): np.arange(a, b) for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(cell)])}
        self.cells: dict[int, np.ndarray | _Parts] = {}

    def _cell(self, c: int):
        """Rows of a cell, or its parts if it holds very many that may link."""
        if c not in self.cells:
            rows = self.at[c]
            self.cells[c] = _Parts(self.side, rows, self.threshold, self.chunk) if len(rows) > self.tile_rows or self._crowded(rows) else rows
        return self.cells[c]

    def _crowded(self, rows: np.ndarray) -> bool:
        """Whether many members of a cell link with each other."""
        if len(rows) < PROBE:
            return False
        x = self.side.unit(np.sort(np.random.default_rng(4).permutation(rows)[:PROBE]))
        return bool((x @ x.T >= self.threshold).mean() > 1 / 32)

    def within(self) -> list:
        """Links of members of the same cell."""
        links = []
        for c in self.at:
            here = self._cell(c)
            if isinstance(here, _Parts):
                links += here.within(self.total)
            else:
                links.append(_linked(self.side, here, self.side, here, self.threshold, self.total, self.total))
        return links

    def visited(self, v: _Side, rows: np.ndarray, cells: np.ndarray, tv: np.ndarray) -> list:
        """Links of the members with visitors, sorted by the cells they visit."""
        links = []
        cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)] if len(cells) else []
        for a, b in zip(cuts, cuts[1:]):
            if int(cells[a]) not in self.at:
                continue
            here = self._cell(int(cells[a]))
            if isinstance(here, _Parts):
                for c in range(a, b, CHUNK):
                    links += here.visited(v, rows[c:min(b, c + CHUNK)], tv, self.total)
            else:
                links.append(_linked(v, rows[a:b], self.side, here, self.threshold, tv, self.total))
        return links

    def end(self, own: bool) -> list:
        """Links within parts that something links with wholly.  ``own``: in the
        task of their file, which also gives those of parts that hold together."""
        return [x for here in self.cells.values() if isinstance(here, _Parts) for x in here.end(self.total, own)]


def _visits(index: MultiIndex, side: _Side, first: int):
    """Blocks of (row, cell) that rows from ``first`` on visit, own cells too,
    sorted by cell, and the row after the last."""
    held, n, a = [], 0, first
    while a < len(side.raw) and n < VISITS:
        row, cell, _ = index.visits(side.unit(slice(a, a + 2048)))
        held.append(((row + a).astype(np.int32), cell.astype(np.int32)))
        n, a = n + len(row), a + 2048
    row, cell = (np.concatenate([h[k] for h in held]) for k in (0, 1))
    order = np.argsort(cell.astype(np.uint16) if cell.max() < 1 << 16 else cell, kind="stable")
    return row[order], cell[order], a


def _meetings(stages: Stages, files: list, index: MultiIndex, threshold: float, tile_rows: int, chunk: int) -> DataFrame:
    """Links found in the sorted files, each a (path, first key, last key)."""
    spark = stages.spark

    def batches_of(path: str, columns: list[str]):
        fs, inside = shared_fs(path)
        with fs.open_input_file(inside) as f:
            yield from pq.ParquetFile(f, buffer_size=1 << 20).iter_batches(4096, columns=columns, use_threads=False)

    def read(path: str, label: int, dim: int, low: int, high: int):
        """Cell and vectors of a label's nodes in a file, from cell ``low`` to ``high``."""
        held = []
        for batch in batches_of(path, ["label", "dim", "cell", "node", "w", "vec"]):
            label_of, dim_of, cell = (batch.column(k).to_numpy() for k in ("label", "dim", "cell"))
            at = np.flatnonzero((label_of == label) & (dim_of == dim) & (cell >= low) & (cell <= high))
            if len(at):  # sorted rows: one stretch
                t = batch.slice(int(at[0]), len(at))
                held.append((cell[at], t.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).copy(), *(t.column(k).to_numpy().copy() for k in ("node", "w"))))
        if not held:
            return None
        cell, raw, node, w = map(np.concatenate, zip(*held))
        del held
        pa.default_memory_pool().release_unused()
        return cell.astype(np.int32), _Side(raw, node, w, index)

    def groups(path: str):
        """(label, dim, cell, vectors) of the labels in a file, which is read once."""
        held = []
        for batch in batches_of(path, ["label", "dim", "cell", "node", "w", "vec"]):
            held.append((batch.column("vec").flatten().to_numpy(zero_copy_only=False).copy(), *(batch.column(k).to_numpy().copy() for k in ("label", "dim", "cell", "node", "w"))))
        flat, label, dim, cell, node, w = map(np.concatenate, zip(*held))
        held.clear()
        pa.default_memory_pool().release_unused()
        ends = np.cumsum(dim, dtype=np.int64)
        cuts = [0, *(np.flatnonzero((label[1:] != label[:-1]) | (dim[1:] != dim[:-1])) + 1).tolist(), len(label)]
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1 or b == len(label):  # others have none to meet
                d = int(dim[a])
                yield int(label[a]), d, cell[a:b].astype(np.int32), _Side(flat[ends[a] - d:ends[b - 1]].reshape(-1, d), node[a:b], w[a:b], index)

    def run(batches):
        for p in (int(x) for batch in batches for x in batch.column(0).to_pylist()):
            for label, dim, cell, side in groups(files[p][0]):
                own, total = _Members(side, cell, threshold, tile_rows, chunk), np.zeros(len(cell), np.int64)
                links, a = own.within(), 0
                while a < len(cell):
                    rows, cells, b = _visits(index, side, a)
                    up = cells != cell[rows]  # the own cell's members have met
                    links += own.visited(side, rows[up], cells[up], total)
                    yield _result(side.node, np.zeros(len(cell), np.int64), links)
                    links = []
                    for path, first, last in files[p + 1:]:
                        if first[:2] != (label, dim):
                            break
                        high = last[2] if last[:2] == (label, dim) else 1 << 30
                        lo, hi = np.searchsorted(cells, first[2]), np.searchsorted(cells, high, "right")
                        met = read(path, label, dim, int(cells[lo]), int(cells[hi - 1])) if lo < hi else None
                        if met:
                            there = _Members(met[1], met[0], threshold, tile_rows, chunk)
                            found = there.visited(side, rows[lo:hi], cells[lo:hi], total)
                            found += there.end(False)
                            yield _result(met[1].node, there.total, found)
                    a = b
                links = own.end(True)
                yield _result(side.node, own.total + total, links)

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(run, _FOUND)


def _sorted_files(nodes: DataFrame, index: MultiIndex, blocks: int, stages: Stages) -> list:
    """Writes the nodes by label, cell and number; (path, first key, last key) of the files."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                dims, cell = part.column(1).to_numpy(), np.zeros(min(2048, batch.num_rows - a), np.int64)
                for d in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == d)
                    cell[at] = index.home(*index.excess(_unit(_matrix(part.column(4).take(pa.array(at)), d))))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cell), *(part.column(k) for k in (2, 3, 4))], names=["label", "dim", "cell", "node", "w", "vec"])

    key = ["label", "dim", "cell", "node"]
    homes = nodes.select("label", "dim", "node", "w", "vec").mapInArrow(run, f"label long, dim int, cell long, node long, w long, vec {nodes.schema['vec'].dataType.simpleString()}")
    homes = stages.write(homes.repartitionByRange(blocks, *key).sortWithinPartitions(*key), "cells")
    ends = homes.groupBy(F.input_file_name().alias("path")).agg(*(f(F.struct(*key)).alias(n) for f, n in ((F.min, "first"), (F.max, "last")))).collect()
    return [(unquote(r.path), tuple(r["first"])[:3], tuple(r["last"])[:3]) for r in sorted(ends, key=lambda r: tuple(r["first"]))]


def _marked(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    kind = vectors.select(F.col(vec_col)).schema[0].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    src = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("wide"), F.col(vec_col).cast("array<float>" if narrow else "array<double>").alias("vec"))
    # Spark takes NaN for the greatest number; an empty array has no least one.
    low, high = F.array_min("wide"), F.array_max("wide")
    fine = (high < float("inf")) & (low > float("-inf")) & ((low != 0) | (high != 0)) & ~F.exists("wide", F.isnull)
    good = F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))
    return src.select("vec_id", "label", "vec", good.alias("good"), F.xxhash64("wide").alias("h1"), F.xxhash64(F.lit(2), "wide").alias("h2"))


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, tile_rows: int = TILE_ROWS, chunk: int = CHUNK,
                    block_bytes: int = BLOCK_BYTES, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row: how many other
    vectors of its label have a cosine of ``threshold`` or more that the index
    brought together, and the least id reachable over such links.

    Codebooks and reach come from at most ``SAMPLE_ROWS`` distinct vectors; all
    rows are indexed.  Rows whose label or vector is null, or whose vector is
    empty, zero or holds null or non-finite components, link with nothing;
    vectors of different lengths don't link.  Repeated rows and equal vectors
    are separate vectors that link with each other.  Null ids don't name a
    component unless all its ids are null; ``kept`` compares them as equal.  An
    empty table gives no rows; other columns are ignored.
    """
    stages = Stages(vectors.sparkSession, "embedding-dedup")
    rows = _marked(vectors, id_col, vec_col, label_col)
    same = rows.filter("good").groupBy("label", "h1", "h2").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("least"))
    nodes = stages.write(same.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")), "nodes")
    names = stages.write(nodes.select("label", "h1", "h2", "node", "w", "least"), "names")
    sizes = names.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("largest"), F.sum("n").alias("all")).first()
    if sizes["all"]:
        share = min(1.0, 1.2 * SAMPLE_ROWS / sizes["all"])
        picked = nodes.filter(F.pmod("h1", F.lit(1 << 30)) < math.ceil(share * (1 << 30))).orderBy("h1", "h2", "label").limit(SAMPLE_ROWS).select("vec").collect()
        lengths = np.array([len(r.vec) for r in picked])
        dim = int(np.bincount(lengths).argmax()) if len(lengths) else 1
        sample = _unit(np.array([r.vec for r in picked if len(r.vec) == dim] or [[1.0] * dim], np.float64))
        entries = min(MAX_ENTRIES, max(1, math.ceil(math.sqrt(sizes["largest"] / cell_rows))))
        index = MultiIndex(sample, entries, threshold)
        size = sizes["all"] * (lengths.mean() if len(lengths) else 1) * (4 if nodes.schema["vec"].dataType.elementType == T.FloatType() else 8)
        tasks = min(4 * vectors.sparkSession.sparkContext.defaultParallelism, math.ceil(sizes["all"] / TASK_ROWS))
        files = _sorted_files(nodes, index, max(tasks, math.ceil(size / block_bytes)), stages)
        stages.drop("nodes")
        found = stages.write(_meetings(stages, files, index, threshold, tile_rows, chunk), "found")
        stages.drop("cells")
    else:
        found = stages.write(vectors.sparkSession.createDataFrame([], _FOUND), "found")
    roots = connected_components(found.filter("b IS NOT NULL").select("a", "b"), stages)
    counted = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    rooted = names.select("label", "h1", "h2", "node", "w", "least").join(roots, "node", "left").join(counted, "node", "left")
    rooted = stages.write(rooted.select("label", "h1", "h2", "w", "least", F.coalesce("root", "node").alias("root"), F.coalesce("n", F.lit(0)).alias("n")), "rooted")
    least = stages.write(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = rooted.join(least, "root").select(F.col("label").alias("_l"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), (F.col("n") + F.col("w") - 1).alias("n"), "component_id")
    named = stages.write(named, "named")
    stages.drop("found", "roots", "rooted", "least", "names", "nodes")
    whole = rows.select("vec_id", "label", "good", "h1", "h2")
    out = whole.join(named, F.col("good") & (F.col("label") == F.col("_l")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    root = F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), F.col("vec_id").eqNullSafe(root).alias("kept"))


#: The same rows by DuckDB, all pairs of a label.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x,
  coalesce(label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS good FROM embeddings),
link AS (SELECT a.r AS a, b.r AS b FROM (SELECT * FROM v WHERE good) a JOIN (SELECT * FROM v WHERE good) b ON a.label = b.label AND len(a.x) = len(b.x) AND a.r <> b.r
  WHERE list_cosine_similarity(a.x, b.x) >= {THRESHOLD}),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
cnt AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN root USING (r) LEFT JOIN cnt USING (r)
"""
