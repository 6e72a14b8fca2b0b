"""Sets without a common shingle meet in no region, whatever their size class."""

import numpy as np

from starmart.llm import shingle_join


def _none():
    return shingle_join.Popular(np.empty(0, np.uint64), np.empty(0, np.int64))


def _sets(n, size, seed):
    numbers = np.random.default_rng(seed)
    return [np.unique(numbers.integers(0, 1 << 64, size, np.uint64)) for _ in range(n)]


def test_unrelated_sets_share_no_cell():
    bounds = shingle_join.Bounds(80, 100)
    for size in (131, 196, 293, 439, 658):  # the least of a class fill the fewest cells
        made = [set(bounds.signatures(h, _none()).tolist()) for h in _sets(60, size, size)]
        assert len(set().union(*made)) == sum(len(m) for m in made), size


def test_linked_sets_share_a_cell_at_every_distance():
    for bounds in (shingle_join.Bounds(80, 100), shingle_join.Bounds(85, 100)):
        for size in (5, 8, 30, 129, 131, 194, 196, 291, 293, 438):
            for seed, h in enumerate(_sets(6, size, size)):
                for gone in range(bounds.most(len(h)) + 1):
                    other = np.random.default_rng(seed).permutation(h)[gone:]  # more than a link allows, at the end
                    new = _sets(1, 1 + bounds.most(len(other)), seed + 99)[0][:max(0, bounds.most(len(other)) - gone)]
                    other = np.unique(np.concatenate((other, new)))
                    same = len(np.intersect1d(h, other))
                    if 2 * same < len(h) + len(other) and bounds.linked(same, len(h) + len(other)):  # copies are of one class
                        popular = shingle_join.Popular(h[::3].copy(), np.full(len(h[::3]), 50)) if seed % 2 else _none()
                        one, two = (bounds.signatures(x, popular) for x in (h, other))
                        assert len(np.intersect1d(one, two)), (size, gone, seed)
