"""Numpy kernels that run inside tile tasks (see operators/tiles.py).

A tile holds two groups of blocks as one Arrow table; the ``left`` column tells the
groups apart and ``diag`` marks a group paired with itself. ``by_blocks`` hands a kernel
two blocks at a time in the same form. Everything here is bounded by the block size.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Ship these functions with the job, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 4096
# A feature that fewer than one of so many pairs share is taken pair by pair.
RARE = 256


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


ARROW_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}


# Rows of summaries that a task collects before it combines them.
KEPT_ROWS = 1 << 18


# Blocks from this size on store sketches slot by slot.
WIDE_ROWS = 500


def pack_rows(keys: tuple[str, ...]):
    """The rows of a block as one row, ``pack``: a compressed Arrow stream in which the strings of a
    list are numbers of a dictionary and sketches lie slot by slot, as slots repeat few values."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.drop_columns(list(keys)).combine_chunks()
        for at, field in enumerate(rows.schema):
            if not pa.types.is_list(field.type):
                continue
            arr, kind = rows.column(field.name).combine_chunks(), field.type.value_type
            if pa.types.is_string(kind):
                lengths = np.nan_to_num(arr.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int32)
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                codes = pa.ListArray.from_arrays(offsets, arr.flatten().dictionary_encode(), mask=arr.is_null())
                rows = rows.set_column(at, field.name, codes)
        for name in [f.name for f in rows.schema if f.type == pa.list_(pa.int32())]:
            arr = rows.column(name).combine_chunks()
            if len(arr) < WIDE_ROWS or len(arr) >= 1 << 15 or arr.null_count or len(set(arr.value_lengths().to_pylist())) > 1:
                continue
            wide = arr.flatten().to_numpy().reshape(len(arr), -1)
            rows = rows.drop_columns([name])
            for slot in range(wide.shape[1]):
                value, code = np.unique(wide[:, slot], return_inverse=True)
                rows = rows.append_column(f"{name}.{slot}", pa.DictionaryArray.from_arrays(pa.array(code, pa.int16()), pa.array(value)))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        return pa.table({k: table.column(k).slice(0, 1) for k in keys} | {"pack": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return run


def unpack(pack: pa.Scalar) -> pa.Table:
    """The rows of ``pack_rows``."""
    rows = pa.ipc.open_stream(pack.as_buffer()).read_all().combine_chunks()
    out, slots = {}, {}
    for field in rows.schema:
        arr = rows.column(field.name).combine_chunks()
        arr = arr.chunk(0) if isinstance(arr, pa.ChunkedArray) else arr
        if pa.types.is_dictionary(field.type):
            slots.setdefault(field.name.split(".")[0], []).append(arr.dictionary.to_numpy()[arr.indices.to_numpy()])
        elif pa.types.is_list(field.type):
            values = arr.values.dictionary_decode() if pa.types.is_dictionary(field.type.value_type) else arr.values
            out[field.name] = pa.ListArray.from_arrays(arr.offsets, values, mask=arr.is_null())
        else:
            out[field.name] = arr
    for name, columns in slots.items():
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(columns))
        out[name] = pa.ListArray.from_arrays(offsets, pa.array(np.stack(columns, axis=1).ravel()))
    # all blocks of a table have one schema, however they were stored
    return pa.table({name: out[name] for name in sorted(out)})


def by_blocks(kernel, schema: str, combine=None):
    """Run ``kernel`` on each pair of blocks (column ``block``) of a tile, each block with itself
    where a group meets itself. Pairs with an empty block are skipped. Packed blocks are opened
    two at a time."""
    fields = [f.split() for f in schema.split(",")]
    empty = pa.schema([(name, ARROW_TYPES[kind]) for name, kind in fields]).empty_table()

    def run(table: pa.Table) -> pa.Table:
        is_left, diag = column(table, "left").astype(bool), bool(column(table, "diag")[0])
        if not diag and (is_left.all() or not is_left.any()):
            return empty
        block = column(table, "block")
        order = np.lexsort((block, ~is_left))
        table = table.drop_columns(["left", "diag", "block"]).take(order).combine_chunks()
        block, is_left = block[order], is_left[order]
        starts = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (is_left[1:] != is_left[:-1])]))
        parts = [table.slice(lo, hi - lo) for lo, hi in zip(starts, np.append(starts[1:], len(block)))]
        is_packed = "pack" in table.column_names
        first, opened = None, None
        n_left = int(is_left[starts].sum())
        if diag:
            pairs = [(i, j) for i in range(len(parts)) for j in range(i, len(parts))]
        else:
            pairs = [(i, j) for i in range(n_left) for j in range(n_left, len(parts))]
        found: list[pa.Table] = []
        done = rows = 0
        for i, j in pairs:
            if i != first:
                first, opened = i, unpack(parts[i].column("pack")[0]) if is_packed else parts[i]
            other = unpack(parts[j].column("pack")[0]) if is_packed and i != j else parts[j]
            both = opened if i == j else pa.concat_tables([opened, other]).combine_chunks()
            sides = np.arange(both.num_rows) < opened.num_rows
            both = both.append_column("left", pa.array(sides)).append_column("diag", pa.array(np.full(both.num_rows, i == j)))
            found.append(kernel(both).select(empty.column_names).cast(empty.schema))
            rows += found[-1].num_rows
            if combine and rows > KEPT_ROWS + 2 * done:
                found = [combine(pa.concat_tables(found))]
                done = rows = found[0].num_rows
        out = pa.concat_tables(found)
        return combine(out) if combine and len(found) > 1 else out

    return run


def merged(keys: list[str], **how: str):
    """Rows of equal ``keys`` as one, each other column by the way named for it."""

    def run(table: pa.Table) -> pa.Table:
        got = table.group_by(keys, use_threads=False).aggregate(list(how.items()))
        return pa.table({n: got[n] if n in keys else got[f"{n}_{how[n]}"] for n in table.column_names}).cast(table.schema)

    return run


def split_sides(table: pa.Table):
    """Row positions of both sides and whether the tile is a block with itself."""
    is_left = column(table, "left").astype(bool)
    left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    if column(table, "diag")[0]:
        return left, left, True
    return left, right, False


def dense_matrix(table: pa.Table, name: str) -> np.ndarray:
    arr = table.column(name).combine_chunks()
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(arr), -1) if len(arr) else flat.reshape(0, 0)


def list_parts(table: pa.Table, name: str):
    """Flat values of a list column and the row each value belongs to."""
    arr = table.column(name).combine_chunks()
    lengths = arr.value_lengths().to_numpy(zero_copy_only=False)
    lengths = np.nan_to_num(lengths).astype(np.int64)
    return arr.flatten(), np.repeat(np.arange(len(arr)), lengths), lengths


def sparse_gram(table, left, right, vals: bool, width: int = CHUNK, by_pairs: bool = True) -> np.ndarray:
    """Dot products of sparse rows, over the features both sides have: pairs of cells of rare
    ones (unless not ``by_pairs``), chunks of a dense matrix of the others.

    A row has each feature once. Without ``vals`` the rows are sets and the products
    are counts, which single precision holds exactly.
    """
    names, row_of, _ = list_parts(table, "idx")
    gram = np.zeros((len(left), len(right)))
    if len(names) == 0:
        return gram
    encoded = names.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if vals:
        v = table.column("val").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    else:
        v = np.ones(len(codes), np.float32)
    n_rows, n_codes = table.num_rows, len(encoded.dictionary)
    at_left, at_right = np.full(n_rows, -1), np.full(n_rows, -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    pl, pr = at_left[row_of], at_right[row_of]
    shared = np.zeros(n_codes, bool)
    shared[codes[pl >= 0]] = True
    in_right = np.zeros(n_codes, bool)
    in_right[codes[pr >= 0]] = True
    shared &= in_right
    in_left, in_right = (np.bincount(codes[p >= 0], minlength=n_codes) for p in (pl, pr))
    rare = shared & (in_left * in_right * RARE < len(left) * len(right)) & by_pairs
    add_rare(gram, (codes, pl, v), (codes, pr, v), rare)
    shared &= ~rare
    recode = np.where(shared, np.cumsum(shared) - 1, -1)[codes]
    n_shared = int(shared.sum())
    for lo in range(0, n_shared, width):
        here = (recode >= lo) & (recode < lo + width)
        wide = min(width, n_shared - lo)
        a, b = np.zeros((len(left), wide), v.dtype), np.zeros((len(right), wide), v.dtype)
        m = here & (pl >= 0)
        a[pl[m], recode[m] - lo] = v[m]
        m = here & (pr >= 0)
        b[pr[m], recode[m] - lo] = v[m]
        gram += a @ b.T
    return gram


def add_rare(gram: np.ndarray, left, right, rare: np.ndarray) -> None:
    """Add the products of all pairs of cells (code, row, value) of the ``rare`` codes."""
    (lc, lr, lv), (rc, rr, rv) = ([x[m] for x in side] for side in (left, right) for m in [(side[1] >= 0) & rare[side[0]]])
    order = np.argsort(rc, kind="stable")
    rc, rr, rv = rc[order], rr[order], rv[order]
    first = np.searchsorted(rc, lc)
    n = np.searchsorted(rc, lc, "right") - first
    flat, ends = gram.reshape(-1), np.cumsum(n)
    lo = 0
    while lo < len(lc):
        done = ends[lo] - n[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, done + (1 << 21), "right")))
        who = np.repeat(np.arange(lo, hi), n[lo:hi])
        at = np.arange(len(who)) + np.repeat(first[lo:hi] - (ends[lo:hi] - n[lo:hi] - done), n[lo:hi])
        np.add.at(flat, lr[who] * gram.shape[1] + rr[at], (lv[who] * rv[at]).astype(np.float64))
        lo = hi


def sparse_sq_norms(table) -> np.ndarray:
    _, row_of, _ = list_parts(table, "idx")
    v = table.column("val").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.bincount(row_of, weights=v * v, minlength=table.num_rows)


def from_gram(gram: np.ndarray, na: np.ndarray, nb: np.ndarray, metric: str) -> np.ndarray:
    """Distances from dot products and squared norms."""
    if metric == "cosine":
        scale = np.sqrt(na)[:, None] * np.sqrt(nb)[None, :]
        return 1.0 - np.divide(gram, scale, out=np.zeros_like(gram), where=scale > 0)
    total = na[:, None] + nb[None, :]
    d2 = np.maximum(total - 2.0 * gram, 0.0)
    # below rounding of the subtraction: the rows are equal
    d2[d2 < 1e-13 * total] = 0.0
    return np.sqrt(d2)


def distances(table, left, right, metric: str, by_pairs: bool = True) -> np.ndarray:
    """Distance matrix of one tile, from dense ``vec`` or sparse ``idx``/``val`` rows. What is rare
    depends on the tile: without ``by_pairs`` equal rows keep one rounding in more of the tiles."""
    dense = "vec" in table.column_names
    if dense:
        x = dense_matrix(table, "vec")
        sq = np.einsum("ij,ij->i", x, x)
        a, b = x[left], x[right]
        gram = a @ b.T
    else:
        sq = sparse_sq_norms(table)
        gram = sparse_gram(table, left, right, vals=True, by_pairs=by_pairs)
    na, nb = sq[left], sq[right]
    if metric == "cosine" or not dense:
        return from_gram(gram, na, nb, metric)
    total = na[:, None] + nb[None, :]
    d2 = np.maximum(total - 2.0 * gram, 0.0)
    # the subtraction loses digits for close rows: redo those from differences
    i, j = np.nonzero(d2 < 1e-6 * total)
    for lo in range(0, len(i), 1 << 16):
        s = slice(lo, lo + (1 << 16))
        diff = a[i[s]] - b[j[s]]
        d2[i[s], j[s]] = np.einsum("ij,ij->i", diff, diff)
    return np.sqrt(d2)


# Row summaries of the distance matrix.

def profile_kernel(metric: str):
    def run(table: pa.Table) -> pa.Table:
        left, right, same = split_sides(table)
        d, ids = distances(table, left, right, metric), column(table, "id")
        out = []
        sides = [(ids[left], d)] if same else [(ids[left], d), (ids[right], d.T)]
        for who, m in sides:
            lo, hi = m.copy(), m.copy()
            n = np.full(len(who), m.shape[1], np.int64)
            total = m.sum(axis=1)
            if same:
                total = total - np.diagonal(m)
                n -= 1
                np.fill_diagonal(lo, np.inf)
                np.fill_diagonal(hi, -np.inf)
            out.append((who, n, total, lo.min(axis=1), hi.max(axis=1)))
        cols = [np.concatenate(c) for c in zip(*out)]
        return pa.table(dict(zip(["id", "n", "total", "lo", "hi"], cols)))

    return run


# Range neighbours.

class Cells:
    """Cells of the rows of a list column, for dot products of any of its rows."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, values: np.ndarray | None = None) -> None:
        self.codes, self.at, self.values = codes, np.concatenate(([0], np.cumsum(lengths))), values

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row number within ``rows``, code, value) of all cells of some rows."""
        n = self.at[rows + 1] - self.at[rows]
        who = np.repeat(np.arange(len(rows)), n)
        cell = np.arange(len(who)) + np.repeat(self.at[rows] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        return who, self.codes[cell], np.ones(len(who)) if self.values is None else self.values[cell]

    def gram(self, left: np.ndarray, right: np.ndarray, below: int | None = None, width: int = CHUNK) -> np.ndarray:
        """Dot products over the codes that both sides have (and that are ``below``)."""
        sides = [self.of(left), self.of(right)]
        if below is not None:
            sides = [tuple(x[s[1] < below] for x in s) for s in sides]
        both = np.intersect1d(sides[0][1], sides[1][1])
        out = np.zeros((len(left), len(right)))
        for lo in range(0, len(both), width):
            part = both[lo : lo + width]
            dense = []
            for (who, code, value), rows in zip(sides, (left, right)):
                at = np.minimum(np.searchsorted(part, code), len(part) - 1)
                here = part[at] == code
                m = np.zeros((len(rows), len(part)))
                m[who[here], at[here]] = value[here]
                dense.append(m)
            out += dense[0] @ dense[1].T
        return out


def near_parts(table: pa.Table, metric: str, eps: tuple[float, ...]):
    """(left rows, right rows, same side, which pairs are within each ``eps``) of a tile; a row
    is never near itself. Distances are taken once for all ``eps``.

    A range tile is one part; with a column ``light`` only pairs with a light row count. A
    tile of postings has a part per feature (``rank``), and a pair counts where its smallest
    common prefix feature is.
    """
    if "rank" not in table.column_names:
        left, right, same = split_sides(table)
        d = distances(table, left, right, metric)
        if "light" in table.column_names:
            light = column(table, "light").astype(bool)
            d[~(light[left][:, None] | light[right][None, :])] = np.inf
        if same:
            np.fill_diagonal(d, np.inf)
        yield left, right, same, [d <= e for e in eps]
        return
    names, _, lengths = list_parts(table, "idx")
    codes = names.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    cells = Cells(codes, lengths, table.column("val").combine_chunks().flatten().to_numpy(zero_copy_only=False))
    prefix, _, lengths = list_parts(table, "prefix")
    prefixes = Cells(prefix.to_numpy(zero_copy_only=False), lengths)
    sq, ranks = sparse_sq_norms(table), column(table, "rank")
    is_left, same = column(table, "left").astype(bool), bool(column(table, "diag")[0])
    order = np.argsort(ranks, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(ranks[order])) + 1):
        left, right = (rows, rows) if same else (rows[is_left[rows]], rows[~is_left[rows]])
        if len(left) * len(right) < 1 + same:
            continue
        d = from_gram(cells.gram(left, right), sq[left], sq[right], metric)
        if same:
            np.fill_diagonal(d, np.inf)
        if (d <= max(eps)).any():
            d[prefixes.gram(left, right, below=ranks[rows[0]]) > 0] = np.inf
            yield left, right, same, [d <= e for e in eps]


def eps_count_kernel(metric: str, eps: tuple[float, ...]):
    """(id, e, n): other rows within the e-th ``eps`` that a tile finds, for rows that have one."""

    def run(table: pa.Table) -> pa.Table:
        n = np.zeros((len(eps), table.num_rows), np.int64)
        for left, right, same, nears in near_parts(table, metric, eps):
            for e, near in enumerate(nears):
                n[e, left] += near.sum(axis=1)
                if not same:
                    n[e, right] += near.sum(axis=0)
        e, at = np.nonzero(n)
        return pa.table({"id": column(table, "id")[at], "e": e.astype(np.int32), "n": n[e, at]})

    return run


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node number reachable from each of ``n`` nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new


def matrix_components(near: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and of the columns of a matrix of links, -1 without any;
    ``same``: rows and columns are the same nodes. Each row and column is opened once, so a
    dense matrix costs no more than reading it."""
    rows, cols = np.full(near.shape[0], -1), np.full(near.shape[1], -1)
    if same:
        cols = rows
    open_r = near.any(axis=1)
    open_c = open_r if same else near.any(axis=0)
    for start in np.flatnonzero(open_r):
        if rows[start] >= 0:
            continue
        new = np.array([start])
        rows[new], open_r[new] = start, False
        while len(new):
            hit = np.flatnonzero(near[new].any(axis=0) & open_c)
            cols[hit], open_c[hit] = start, False
            if same:
                new = hit
                continue
            new = np.flatnonzero(near[:, hit].any(axis=1) & open_r)
            rows[new], open_r[new] = start, False
    return rows, cols


def chain_edges(ids: np.ndarray, root: np.ndarray):
    """A path through each component: keeps connectivity with at most n-1 edges and
    no node of degree above two."""
    order = np.lexsort((ids, root))
    a, b = order[:-1], order[1:]
    linked = (root[a] == root[b]) & (root[a] >= 0)
    return ids[a[linked]], ids[b[linked]]


def eps_edges_kernel(metric: str, eps: tuple[float, ...], level: tuple[int, ...]):
    """Core-core links of a tile as a spanning forest, and border-core links, for each pair of
    parameters p: (p, u, v, core). ``level`` says which ``eps`` a pair has, column ``core`` holds
    one flag per pair.

    A border row has fewer than min_samples neighbours, so its links are few.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, flags = column(table, "id"), dense_flags(table, "core")
        none = np.zeros(0, np.int64)
        out = [(np.zeros(0, np.int32), none, none, np.zeros(0, bool))]
        for left, right, same, nears in near_parts(table, metric, eps):
            for p, e in enumerate(level):
                near, cl, cr = nears[e], flags[left, p], flags[right, p]
                a, b = matrix_components(near[np.ix_(cl, cr)], same)
                who = ids[left[cl]] if same else np.concatenate([ids[left[cl]], ids[right[cr]]])
                found = [chain_edges(who, a if same else np.concatenate([a, b]))]
                i, j = np.nonzero(near & ~cl[:, None] & cr[None, :])
                found.append((ids[left[i]], ids[right[j]]))
                if not same:
                    i, j = np.nonzero(near & cl[:, None] & ~cr[None, :])
                    found.append((ids[right[j]], ids[left[i]]))
                out += [(np.full(len(u), p, np.int32), u, v, np.full(len(u), k == 0)) for k, (u, v) in enumerate(found)]
        return pa.table(dict(zip(["p", "u", "v", "core"], (np.concatenate(c) for c in zip(*out)))))

    return run


def fewer_links(table: pa.Table) -> pa.Table:
    """The links of several blocks with one spanning forest of the core links per p."""
    p, u, v, core = (column(table, c) for c in ("p", "u", "v", "core"))
    core = core.astype(bool)
    out = [[x[~core] for x in (p, u, v, core)]]
    for one in np.unique(p[core]):
        here = core & (p == one)
        nodes, at = np.unique(np.concatenate([u[here], v[here]]), return_inverse=True)
        a, b = chain_edges(nodes, components(len(nodes), at[: here.sum()], at[here.sum():]))
        out.append([np.full(len(a), one, np.int32), a, b, np.ones(len(a), bool)])
    return pa.table(dict(zip(table.column_names, (np.concatenate(c) for c in zip(*out)))))


def forest_kernel(table: pa.Table) -> pa.Table:
    """A spanning forest of an edge list."""
    u, v = column(table, "u"), column(table, "v")
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = chain_edges(nodes, components(len(nodes), at[: len(u)], at[len(u):]))
    return pa.table({"u": a, "v": b})


def dense_flags(table: pa.Table, name: str) -> np.ndarray:
    arr = table.column(name).combine_chunks()
    return arr.flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(len(arr), -1)


def components_kernel(table: pa.Table) -> pa.Table:
    """Components of an edge list whose size the caller has checked."""
    u, v = column(table, "u"), column(table, "v")
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = components(len(nodes), at[: len(u)], at[len(u):])
    return pa.table({"node": nodes, "root": nodes[root]})


# Nearest neighbours: left rows are queries, right rows are training rows.

def knn_kernel(metric: str, k: int):
    def run(table: pa.Table) -> pa.Table:
        left, right, _ = split_sides(table)
        ids = column(table, "id")
        right = right[np.argsort(ids[right], kind="stable")]
        d = distances(table, left, right, metric, by_pairs=False)
        kept = min(k, len(right))
        if len(right) > 4 * k:
            # all rows as near as the k-th one, by distance, then id
            row, at = np.nonzero(~(d > np.partition(d, k - 1, axis=1)[:, k - 1 : k]))
            order = np.lexsort((at, d[row, at], row))
            first = np.searchsorted(row[order], np.arange(len(left)))
            best = at[order][first[:, None] + np.arange(k)]
        else:
            best = np.argsort(d, axis=1, kind="stable")[:, :k]
        q = np.repeat(ids[left], kept)
        found = {"q": q, "id": ids[right][best.ravel()], "d": np.take_along_axis(d, best, axis=1).ravel()}
        if "label" in table.column_names:
            found["label"] = table.column("label").combine_chunks().take(pa.array(right[best.ravel()]))
        return pa.table(found)

    return run


def nearest(k: int):
    """The ``k`` nearest of each query of several blocks."""

    def run(table: pa.Table) -> pa.Table:
        q, i, d = (column(table, c) for c in ("q", "id", "d"))
        order = np.lexsort((i, d, q))
        ranked = q[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(q)), 0))
        return table.take(order[np.arange(len(q)) - start < k])

    return run


# Silhouette: distance sums from each row to each cluster.

def silhouette_kernel(metric: str):
    """Clusters that lie wholly in one block are finished here, so a row gets one
    minimum for all of them and one sum for each cluster split over blocks."""

    def one_way(ids, own, sums, names, first, sizes, whole):
        out = []
        size, done = sizes[first], whole[first]
        best = np.full(len(ids), np.inf)
        for c in range(len(names)):
            mine = own == names[c]
            if done[c]:
                best = np.where(mine, best, np.minimum(best, sums[:, c] / size[c]))
                pick = mine
            else:
                pick = np.ones(len(ids), bool)
            if pick.any():
                out.append((ids[pick], np.full(pick.sum(), names[c]), sums[pick, c], np.full(pick.sum(), size[c]), np.full(pick.sum(), np.inf)))
        got = np.isfinite(best)
        m = int(got.sum())
        out.append((ids[got], np.full(m, np.iinfo(np.int64).min), np.zeros(m), np.ones(m, np.int64), best[got]))
        return out

    def run(table: pa.Table) -> pa.Table:
        left, right, same = split_sides(table)
        ids, cl = column(table, "id"), column(table, "cluster").astype(np.int64)
        size, whole = column(table, "size").astype(np.int64), column(table, "whole").astype(bool)
        # rows of a cluster next to each other, so that their distances are one run
        left, right = (rows[np.argsort(cl[rows], kind="stable")] for rows in (left, right))
        d = distances(table, left, right, metric)
        names, first = np.unique(cl[right], return_index=True)
        out = one_way(ids[left], cl[left], np.add.reduceat(d, first, axis=1), names, first, size[right], whole[right])
        if not same:
            names, first = np.unique(cl[left], return_index=True)
            out += one_way(ids[right], cl[right], np.add.reduceat(d, first, axis=0).T, names, first, size[left], whole[left])
        cols = [np.concatenate(c) for c in zip(*out)]
        return pa.table(dict(zip(["id", "other", "total", "size", "best"], cols)))

    return run


# Set similarity against sketches.

def similarity_kernel(ks: tuple[int, ...], exact: bool = True):
    """Per row: partners with a shared term, their similarity sum and maximum, the
    same for each sketch size, and squared errors (each pair booked once, on the
    left row). ``sig`` holds the slots of all sizes one after the other. Without ``exact``
    only sketches are compared, rows have no terms and errors are zero."""

    def run(table: pa.Table) -> pa.Table:
        left, right, same = split_sides(table)
        ids, shape = column(table, "id"), (len(left), len(right))
        if exact:
            _, _, sizes = list_parts(table, "idx")
            inter = sparse_gram(table, left, right, vals=False)
            union = sizes[left][:, None] + sizes[right][None, :] - inter
            true = np.divide(inter, union, out=np.zeros_like(inter), where=union > 0)
        pairs = np.triu(np.ones(shape, bool), 1) if same else np.ones(shape, bool)
        self_pair = np.eye(len(left), dtype=bool) if same else np.zeros(shape, bool)
        sig, start = dense_ints(table, "sig") if ks else None, 0
        out = []
        for k in ((0,) if exact else ()) + tuple(ks):
            err = np.zeros(len(left))
            if k == 0:
                value = true
            else:
                value = equal_slots(sig[left, start : start + k], sig[right, start : start + k]) / k
                start += k
                if exact:
                    err = np.where(pairs, (value - true) ** 2, 0.0).sum(axis=1)
            value = np.where(self_pair, 0.0, value)
            views = [(ids[left], value, err)]
            if not same:
                views.append((ids[right], value.T, np.zeros(len(right))))
            for who, m, e in views:
                out.append((who, np.full(len(who), k, np.int32), (m > 0).sum(axis=1), m.sum(axis=1), m.max(axis=1), e))
        cols = [np.concatenate(c) for c in zip(*out)]
        return pa.table(dict(zip(["id", "k", "n", "total", "top", "err"], cols)))

    return run


def equal_slots(a: np.ndarray, b: np.ndarray, rows: int = 64) -> np.ndarray:
    """Number of equal slots of each pair of sketches, a few left rows at a time so
    that the counters stay in cache.

    Slot values are replaced by their rank among the tile's values, which are few, and up to
    255 slots are counted in single bytes: both let a register hold many pairs.
    """
    both = np.concatenate([a, b])
    order = np.argsort(both, axis=0)
    ordered = np.take_along_axis(both, order, axis=0)
    rank = np.zeros(both.shape, np.uint16 if len(both) < 1 << 16 else np.uint32)
    np.cumsum(ordered[1:] != ordered[:-1], axis=0, out=rank[1:], dtype=rank.dtype)
    codes = np.empty_like(rank)
    np.put_along_axis(codes, order, rank, axis=0)
    x, y = codes[: len(a)], np.ascontiguousarray(codes[len(a):].T)
    hits = np.zeros((len(a), len(b)), np.uint16 if len(y) < 1 << 16 else np.uint32)
    for lo in range(0, len(a), rows):
        part = x[lo : lo + rows]
        same, few = np.empty((len(part), len(b)), bool), np.empty((len(part), len(b)), np.uint8)
        for first in range(0, len(y), 255):
            few[:] = 0
            for s in range(first, min(first + 255, len(y))):
                np.equal(part[:, s, None], y[s], out=same)
                np.add(few, same.view(np.uint8), out=few)
            hits[lo : lo + rows] += few
    return hits


def dense_ints(table: pa.Table, name: str) -> np.ndarray:
    arr = table.column(name).combine_chunks()
    return arr.flatten().to_numpy(zero_copy_only=False).reshape(len(arr), -1)


# Sketches.

def permuted(hv: np.ndarray, a: np.ndarray, b: np.ndarray, prime: int, mask: int) -> np.ndarray:
    """All permutations of all hashes (hashes x slots).

    int64 products wrap around as in the original arithmetic. ``prime`` is 2^61 - 1, so the
    high bits are added to the low ones instead of a division.
    """
    bits = prime.bit_length()
    if prime != (1 << bits) - 1:
        raise ValueError("the prime has to be one less than a power of two")
    with np.errstate(over="ignore"):
        v = hv[:, None] * a + b
    low = v & prime
    low += v >> bits
    low += np.where(low < 0, prime, 0)
    low -= np.where(low >= prime, prime, 0)
    return low & mask


def signature_batches(a: np.ndarray, b: np.ndarray, prime: int, mask: int, short: bool = False):
    """Slot-wise minima of the permuted term hashes of each row.

    A batch's distinct terms are permuted once; rows take segmented minima over them, about
    ``CHUNK`` terms at a time. Columns beside ``hashes`` are passed on. ``short``: the same 32
    bits as signed numbers of half the width, which are only compared.
    """

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            flat, _, lengths = list_parts(table, "hashes")
            hv, at = np.unique(flat.to_numpy(zero_copy_only=False).astype(np.int64), return_inverse=True)
            perm = np.empty((len(hv), len(a)), np.uint32)
            for lo in range(0, len(hv), CHUNK):
                perm[lo : lo + CHUNK] = permuted(hv[lo : lo + CHUNK], a, b, prime, mask)
            sig = np.full((table.num_rows, len(a)), mask, np.int64)
            rows = np.flatnonzero(lengths)
            ends = np.cumsum(lengths[rows])
            lo = 0
            while lo < len(rows):
                start = ends[lo] - lengths[rows[lo]]
                hi = max(lo + 1, int(np.searchsorted(ends, start + CHUNK, "right")))
                terms = at[start : ends[hi - 1]]
                if hi == lo + 1:  # one row, of any length
                    for x in range(0, len(terms), CHUNK):
                        np.minimum(sig[rows[lo]], perm[terms[x : x + CHUNK]].min(axis=0), out=sig[rows[lo]])
                else:
                    first = ends[lo:hi] - lengths[rows[lo:hi]] - start
                    sig[rows[lo:hi]] = np.minimum.reduceat(perm[terms], first, axis=0)
                lo = hi
            offsets = pa.array(np.arange(table.num_rows + 1, dtype=np.int32) * len(a))
            flat = sig.ravel().astype(np.uint32).view(np.int32) if short else sig.ravel()
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
            kept = [n for n in batch.schema.names if n != "hashes"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], lists], [*kept, "sig"])

    return run


# k-means with centroids of checked size.

# Two means this near to each other, as a share of the lengths, are compared from differences.
NEAR_TIE = 1e-9


def dense_center_distances(x: np.ndarray, means: np.ndarray, metric: str) -> np.ndarray:
    """Distance of each row to each mean, one mean after the other."""
    d = np.empty((len(x), len(means)))
    for c, mean in enumerate(means):
        if metric == "cosine":
            scale = np.sqrt((x * x).sum(axis=1)) * np.sqrt((mean * mean).sum())
            d[:, c] = 1.0 - np.divide(x @ mean, scale, out=np.zeros(len(x)), where=scale > 0)
        else:
            d[:, c] = np.sqrt(((x - mean) ** 2).sum(axis=1))
    return d


def nearest_dense(x: np.ndarray, means: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """The nearest mean of each dense row, of equally near ones the first, and how much nearer
    it is than the next one. All distances come from one product; rows with a second mean
    about as near are told apart by ``dense_center_distances``."""
    sq, own = np.einsum("ij,ij->i", x, x), (means * means).sum(axis=1)
    if metric == "cosine":
        dots, scale = x @ means.T, np.sqrt(sq)[:, None] * np.sqrt(own)[None, :]
        d, size = 1.0 - np.divide(dots, scale, out=np.zeros_like(dots), where=scale > 0), np.ones(len(x))
    else:
        # without the row's own length, which is the same for all means
        d, size = x @ (-2.0 * means.T), sq + own.max(initial=0.0)
        d += own
    best = d.argmin(axis=1)
    if len(means) < 2:
        return best, np.full(len(x), np.inf)
    rows = np.arange(len(x))
    first = d[rows, best]
    d[rows, best] = np.inf
    second = d.min(axis=1)
    gap = second - first
    close = np.flatnonzero(~(gap > NEAR_TIE * size))
    if metric != "cosine":
        # of squares, so that the difference keeps its digits
        apart = np.sqrt(np.maximum(first + sq, 0.0)) + np.sqrt(np.maximum(second + sq, 0.0))
        gap = np.divide(gap, apart, out=np.zeros(len(x)), where=gap > 0)
    if len(close):
        exact = dense_center_distances(x[close], means, metric)
        best[close] = exact.argmin(axis=1)
        two = np.partition(exact, 1, axis=1)
        gap[close] = two[:, 1] - two[:, 0]
    return best, gap


def nearest_sparse(table: pa.Table, means: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest_dense`` for sparse rows."""
    d, best = sparse_center_distances(table, means, metric)
    if len(means) < 2:
        return best, np.full(len(best), np.inf)
    two = np.partition(d, 1, axis=1)
    return best, two[:, 1] - two[:, 0]


def sparse_center_distances(table: pa.Table, means: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Distances of sparse (``idx`` positions, ``val``) rows to all means, and the nearest one, of
    equally near ones the first. Rows are compared without their own length, which would round
    small differences away."""
    at, row_of, _ = list_parts(table, "idx")
    at = at.to_numpy(zero_copy_only=False).astype(np.int64)
    v = table.column("val").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sq = np.bincount(row_of, weights=v * v, minlength=table.num_rows)
    dots = np.empty((table.num_rows, len(means)))
    for c, mean in enumerate(means):
        dots[:, c] = np.bincount(row_of, weights=v * mean[at], minlength=table.num_rows)
    own = (means * means).sum(axis=1)
    if metric == "cosine":
        scale = np.sqrt(sq)[:, None] * np.sqrt(own)[None, :]
        d = 1.0 - np.divide(dots, scale, out=np.zeros_like(dots), where=scale > 0)
        return d, d.argmin(axis=1)
    score = own[None, :] - 2.0 * dots
    return np.sqrt(np.maximum(sq[:, None] + score, 0.0)), score.argmin(axis=1)


def assign_batches(means: np.ndarray, metric: str):
    """(id, cluster, d): the nearest mean of each row, of equally near ones the first."""

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            if "vec" in table.column_names:
                x = dense_matrix(table, "vec")
                best = nearest_dense(x, means, metric)[0]
                d = np.empty(len(x))
                for c in np.unique(best):
                    d[best == c] = dense_center_distances(x[best == c], means[c : c + 1], metric)[:, 0]
            else:
                d, best = sparse_center_distances(table, means, metric)
                d = d[np.arange(len(d)), best]
            kept = [n for n in batch.schema.names if n == "vec"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(best.astype(np.int32)), pa.array(d), *[batch.column(n) for n in kept]],
                ["id", "cluster", "d", *kept],
            )

    return run


def to_bits(batches):
    """(bits): each vector as the bytes of its numbers, which a pass reads without a step per number."""
    for batch in batches:
        x = dense_matrix(pa.Table.from_batches([batch]), "vec")
        offsets = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
        bits = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])
        yield pa.RecordBatch.from_arrays([bits], ["bits"])


def from_bits(bits: pa.BinaryArray, width: int) -> np.ndarray:
    """The vectors of ``to_bits``, all of ``width`` numbers."""
    start = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset]
    return np.frombuffer(bits.buffers()[2], np.float64, len(bits) * width, int(start)).reshape(len(bits), width)


def cluster_sums(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of each cluster by one product; rows with a NaN or an infinity stay with theirs."""
    member = np.zeros((len(x), k))
    member[np.arange(len(x)), cluster] = 1.0
    total = member.T @ x
    if not np.isfinite(total).all():
        total = np.zeros((k, x.shape[1]))
        np.add.at(total, cluster, x)
    return total


def change_batches(before: Sequence[np.ndarray] | None, means: Sequence[np.ndarray], metric: str):
    """Per trial, what rows that change their cluster add to the sums of clusters:
    (trial, c, pos, s), with the number of rows at the position after the last, and the least
    margin between a row's nearest mean and the next one, as position -1. Without ``before``
    all rows are new. Trials may differ in their number of means."""
    trials, width = len(means), means[0].shape[1]

    def run(batches):
        total, margin = [np.zeros((len(m), width + 1)) for m in means], np.full(trials, np.inf)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if table.num_rows == 0:
                continue
            dense = "idx" not in table.column_names
            if dense:
                x = from_bits(table.column("bits").combine_chunks(), width) if "bits" in table.column_names else dense_matrix(table, "vec")
                nearest_of = lambda m: nearest_dense(x, m, metric)  # noqa: B023, E731
            else:
                at, who, _ = list_parts(table, "idx")
                at = at.to_numpy(zero_copy_only=False).astype(np.int64)
                v = table.column("val").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                nearest_of = lambda m: nearest_sparse(table, m, metric)  # noqa: B023, E731
            for t in range(trials):
                new, gap = nearest_of(means[t])
                k = len(means[t])
                if k > 1:
                    margin[t] = min(margin[t], gap.min())
                if before is None and dense:
                    total[t][:, :width] += cluster_sums(x, new, k)
                    total[t][:, width] += np.bincount(new, minlength=k)
                    continue
                old = np.full(len(new), -1) if before is None else nearest_of(before[t])[0]
                moved = new != old
                if not moved.any():
                    continue
                add = [(new, 1.0)] if before is None else [(new, 1.0), (old, -1.0)]
                if not dense:
                    cell = moved[who]
                    row, pos, value = who[cell], at[cell], v[cell]
                for to, sign in add:
                    if dense:
                        np.add.at(total[t][:, :width], to[moved], sign * x[moved])
                    else:
                        np.add.at(total[t], (to[row], pos), sign * value)
                    np.add.at(total[t][:, width], to[moved], sign)
        cells = [np.nonzero(x) for x in total]
        t = np.repeat(np.arange(trials), [len(c) for c, _ in cells])
        c, pos = (np.concatenate(x) for x in zip(*cells))
        sums = np.concatenate([x[at] for x, at in zip(total, cells)])
        columns = [np.concatenate([t, np.arange(trials)]), np.concatenate([c, np.zeros(trials)]), np.concatenate([pos, np.full(trials, -1)])]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(x.astype(np.int32)) for x in columns], pa.array(np.concatenate([sums, margin]))],
            ["trial", "c", "pos", "s"],
        )

    return run
