import numpy as np

from featuremap.llm import _mph


def test_slots_are_a_permutation_and_strangers_fail_the_fingerprint():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 20_000):
        a, b = r.integers(0, 2 ** 64, (2, n), dtype=np.uint64)
        a[: n // 2] = 5                                  # equal first halves
        f = _mph.Mph(_mph.build(a, b))
        assert f.size == n
        assert sorted(f.slots(a, b).tolist()) == list(range(n))
        x, y = r.integers(0, 2 ** 64, (2, 500), dtype=np.uint64)
        at = f.slots(x, y)
        assert ((at >= -1) & (at < max(n, 1))).all()
