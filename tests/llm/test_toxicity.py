import numpy as np
import pyarrow as pa

from cratelight.llm import toxicity
from cratelight.llm.common import table


def test_windows_overlap_and_cover():
    counts = np.array([0, 1, 32, 33, 56, 57, 500])
    text, first = toxicity.cut(counts)
    for i, n in enumerate(counts):
        own = first[text == i]
        seen = {k for f in own for k in range(f, min(f + toxicity.WINDOW, n))}
        assert seen == set(range(n)) and all(b - a <= toxicity.STRIDE for a, b in zip(own, own[1:], strict=False))


def test_gradients():
    net = toxicity.Network.fresh(1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(2)
    gates = rng.standard_normal((5, 2, 3 * toxicity.UNITS, 3)).astype(np.float32)
    lengths = np.array([5, 3, 1])
    logit, kept = net.forward(gates, lengths, keep=True)
    d, d_gates = net.backward(kept, lengths, np.ones(3, np.float32))
    for name in ("turn", "look", "out"):
        flat = net.weights[name].reshape(-1)
        for k in rng.choice(len(flat), 6):
            old, step = flat[k], 1e-2
            flat[k] = old + step
            up = net.forward(gates, lengths).sum()
            flat[k] = old - step
            down = net.forward(gates, lengths).sum()
            flat[k] = old
            assert abs((up - down) / (2 * step) - d[name].reshape(-1)[k]) < 5e-3
    for spot in [(0, 0, 3, 0), (4, 1, 30, 0), (2, 1, 14, 1), (0, 1, 25, 2)]:
        up, down = gates.copy(), gates.copy()
        up[spot] += 1e-2
        down[spot] -= 1e-2
        assert abs((net.forward(up, lengths).sum() - net.forward(down, lengths).sum()) / 2e-2 - d_gates[spot]) < 5e-3


def test_a_text_scores_its_worst_window():
    net = toxicity.Network.fresh(3)
    words = [f"w{i}" for i in range(100)]
    whole = net.texts(pa.array([" ".join(words)]))[0]
    starts = [0, 24, 48, 68]
    parts = net.texts(pa.array([" ".join(words[s : s + 32]) for s in starts]))
    assert abs(whole - parts.max()) < 1e-5
    assert net.chance(pa.array([None, "", "...", "a"])).tolist()[:3] == [0, 0, 0]


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    rows = toxicity.op5_gru_attention(spark, folder).join(table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    toxic = np.array([r.toxic for r in rows]) == 1
    said = np.array([r.predicted for r in rows]) == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert said[toxic].mean() > 0.9 and said[~toxic].mean() < 0.02
