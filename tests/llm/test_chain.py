import itertools

import numpy as np

from playstream.llm.chain import fit, marginals, viterbi


def paths(scores, moves):
    n, s = scores.shape
    for path in itertools.product(range(s), repeat=n):
        yield path, sum(scores[t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))


def test_against_all_paths():
    rng = np.random.RandomState(1)
    lengths = np.array([3, 1, 5, 2, 0, 5])
    scores, moves = rng.randn(lengths.sum(), 3), rng.randn(3, 3)
    prob, moved, norm = marginals(scores, moves, lengths)
    best = viterbi(scores, moves, lengths)
    want_moved, want_norm, at = np.zeros((3, 3)), 0.0, 0
    for n in lengths:
        if n:
            all_paths = list(paths(scores[at:at + n], moves))
            z = np.log(sum(np.exp(v) for _, v in all_paths))
            want_norm += z
            want = np.zeros((n, 3))
            for path, v in all_paths:
                for t, k in enumerate(path):
                    want[t, k] += np.exp(v - z)
                for a, b in zip(path, path[1:]):
                    want_moved[a, b] += np.exp(v - z)
            assert np.allclose(prob[at:at + n], want)
            assert tuple(best[at:at + n]) == max(all_paths, key=lambda x: x[1])[0]
        at += n
    assert np.allclose(moved, want_moved) and np.isclose(norm, want_norm)


def test_fit_learns_moves():
    rng = np.random.RandomState(2)
    states = np.array([(t // 4) % 2 for t in range(400)])
    x = np.stack([2 * states + rng.randn(400), np.ones(400)], axis=1)
    lengths = np.full(20, 20)
    weights, moves = fit(x, states, lengths, 2, steps=200)
    alone = ((x @ weights).argmax(axis=1) == states).mean()
    assert (viterbi(x @ weights, moves, lengths) == states).mean() > max(alone, 0.85)
    assert moves[0, 0] + moves[1, 1] > moves[0, 1] + moves[1, 0]
