"""Plain versions of operators 11 to 13."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np


def trie(rows, group=20):
    """Rows (conv_id, turn, role, text) to the nodes of the prefix trie."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, group))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    # Nodes in the order they are met, so parents come before children.
    ids, up, turn_of, depth, members, ends = {}, [None], [None], [0], [[]], [[]]
    for c, seq in built.items():
        at = 0
        members[0].append(c)
        for turn in seq:
            if (at, turn) not in ids:
                ids[at, turn] = len(up)
                up.append(at)
                turn_of.append(turn)
                depth.append(depth[at] + 1)
                members.append([])
                ends.append([])
            at = ids[at, turn]
            members[at].append(c)
        ends[at].append(c)
    if not built:
        return []
    children = [0] * len(up)
    for v in range(1, len(up)):
        children[up[v]] += 1
    words = [0, *(len(re.findall(r"[^\x20\x09-\x0D]+", t[1])) for t in turn_of[1:])]
    leaves, nodes = [int(not n) for n in children], [1] * len(up)
    saved = [(len(m) - 1) * w for m, w in zip(members, words)]
    for v in range(len(up) - 1, 0, -1):
        for sums in (leaves, nodes, saved):
            sums[up[v]] += sums[v]
    return sorted(
        (min(m), depth[v], min(members[up[v]]) if v else None, len(m), children[v], leaves[v], nodes[v], saved[v], hashlib.sha256(",".join(map(str, sorted(ends[v]))).encode()).hexdigest())
        for v, m in enumerate(members)
    )


TRIE_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "n_nodes", "saved_tokens", "ends_sha256")


def whitening(rows, wanted=4):
    """Rows (id, vector): (n, eigenvalue shares, {id: deviation}, {id: whitened}) by a plain eigen-decomposition."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in kept}
    white = {i: (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values) for i, x in kept}
    return n, values / np.trace(centred.T @ centred / n), deviation, white
