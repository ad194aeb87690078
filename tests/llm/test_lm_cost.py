"""The network's training and scoring against a plain form: same numbers, less CPU time."""

import os
import subprocess
import sys
import time
from pathlib import Path

import numpy as np

from shopmetrics.llm import pseudolm


def _log_softmax(z):
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _plain_units(model, around):
    x = np.broadcast_to(model["h"], (len(around), pseudolm.HIDDEN)).copy()
    for k, table in enumerate(model["e"] @ model["w"]):
        x += table[around[:, k]]
    return np.tanh(x)


def _plain_log_probs(model, around, target):
    h, (group, place) = _plain_units(model, around), np.divmod(target, model["b"].shape[1])
    found = _log_softmax(h @ model["g"] + model["a"])[np.arange(len(h)), group].astype(np.float64)
    for k in np.unique(group):
        at = np.flatnonzero(group == k)
        found[at] += _log_softmax(h[at] @ model["o"][k] + model["b"][k])[np.arange(len(at)), place[at]]
    return found


def _plain_train(model, around, target, state):
    """The same steps with a row for each place: sums along short rows, neighbours' gradients by sorted sums, one side at a time."""
    order, members = np.random.default_rng(len(target)).permutation(len(target)), model["b"].shape[1]
    for begin in range(0, len(order), pseudolm.BATCH):
        at = order[begin : begin + pseudolm.BATCH]
        at = at[np.argsort(target[at] // members, kind="stable")]
        a, n = around[at], len(at)
        group, place = np.divmod(target[at], members)
        h = _plain_units(model, a)
        grad = {k: np.zeros_like(model[k]) for k in ("e", "w", "o", "b")}
        z = np.exp(_log_softmax(h @ model["g"] + model["a"]))
        z[np.arange(n), group] -= 1
        z /= n
        grad["g"], grad["a"], dh = h.T @ z, z.sum(axis=0), z @ model["g"].T
        for k, lo, hi in pseudolm._runs(group):
            z = np.exp(_log_softmax(h[lo:hi] @ model["o"][k] + model["b"][k]))
            z[np.arange(hi - lo), place[lo:hi]] -= 1
            z /= n
            grad["o"][k], grad["b"][k] = h[lo:hi].T @ z, z.sum(axis=0)
            dh[lo:hi] += z @ model["o"][k].T
        dh *= 1 - h * h
        grad["h"] = dh.sum(axis=0)
        for k in range(2 * pseudolm.SIDE):
            by = np.argsort(a[:, k].astype(np.uint16), kind="stable")
            words = a[by, k]
            first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            hot = np.add.reduceat(dh[by], first, axis=0)
            grad["e"][words[first]] += hot @ model["w"][k].T
            grad["w"][k] = model["e"][words[first]].T @ hot
        state["step"] = t = state.get("step", 0) + 1
        rate = pseudolm.RATE / (1 + t / 500) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        for name, g in grad.items():
            m1, m2 = state.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m1 += 0.1 * (g - m1)
            m2 += 0.001 * (g * g - m2)
            model[name] -= (rate * m1 / (np.sqrt(m2) + 1e-8)).astype(np.float32)


def _text(places, classes):
    """Words by Zipf's law, with the contexts of one document."""
    words = np.random.default_rng(3).zipf(1.3, places) % classes
    return words, pseudolm.contexts(words, np.array([0, places]), classes)


def test_the_steps_are_those_of_the_plain_form():
    words, around = _text(3 * pseudolm.BATCH + 100, 400)
    fast, plain = pseudolm.start(classes=400), pseudolm.start(classes=400)
    states = {}, {}
    pseudolm.train(fast, around, words, states[0])
    _plain_train(plain, around, words, states[1])
    for name in plain:
        assert fast[name].dtype == np.float32 and np.allclose(states[0][name][0], states[1][name][0], rtol=1e-3, atol=1e-6), name
    got = pseudolm.log_probs(fast, around, words)
    assert np.abs(got - _plain_log_probs(plain, around, words)).max() < 1e-2
    assert np.abs(got - _plain_log_probs(fast, around, words)).max() < 1e-4


def _ratio():
    words, around = _text(8 * pseudolm.BATCH, 2000)

    def seconds(train):
        model, state, begun = pseudolm.start(classes=2000), {}, time.process_time()
        train(model, around, words, state)
        return time.process_time() - begun

    return np.median([seconds(pseudolm.train) / seconds(_plain_train) for _ in range(15)])  # in turns: the machine's speed drifts


def test_a_step_costs_less_than_the_plain_form():
    """In a process of its own with one thread, as a worker has it."""
    here = Path(__file__).resolve()
    env = {**os.environ, "OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1", "PYTHONPATH": os.pathsep.join([str(here.parents[2]), str(here.parent)])}
    out = subprocess.run([sys.executable, "-c", "import test_lm_cost; print(test_lm_cost._ratio())"], env=env, capture_output=True, text=True, check=True)
    assert float(out.stdout) < 0.85
