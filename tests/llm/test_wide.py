"""Wide bitmaps of large sets never rule out a link."""

import numpy as np
import pyarrow as pa

from pagesift.llm import sigtree
from pagesift.llm.tasks import buffers


def test_wide_bitmaps_keep_links():
    r = np.random.default_rng(3)
    sets = []
    for size in (900, 1100, 1500, 2100, 4000, 4100):
        base = np.unique(r.integers(0, 2**63, size, dtype=np.uint64))
        for share in (0, 0.02, 0.07, 0.1, 0.5):
            n = int(len(base) * share)
            sets.append(np.unique(np.concatenate([base[n:], r.integers(0, 2**63, n, dtype=np.uint64)])))
        sets.append(base[: int(0.86 * len(base))])
    signatures = sigtree.Signatures(*buffers(pa.array([sigtree._signature(s) for s in sets], pa.binary())))
    n = np.array([len(s) for s in sets])
    i, j = np.triu_indices(len(sets), 1)
    keep = sigtree._wide_enough(signatures, i, n, signatures, j, n, 85)
    links = np.array([sigtree.linked(sets[a], sets[b], 85) for a, b in zip(i, j)])
    exact = np.array([100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b])) for a, b in zip(i, j)])
    assert (links == exact).all() and links.sum() > 20
    assert keep[links].all()
    large = signatures.wide[i] & signatures.wide[j]
    assert keep[large].sum() < 3 * links[large].sum() and large.sum() > 200
