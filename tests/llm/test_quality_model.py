import math

import numpy as np
from pickwise.llm import quality_model as qm

from .helpers import documents, odd_rows, prose


def naive_score(w, text):
    """The network's forward pass, filter by filter and chunk by chunk."""
    codes = list(text.encode())
    n_pos = max(1, -(-(len(codes) - qm.WIDTH) // qm.STRIDE) + 1)
    codes += [0] * ((n_pos - 1) * qm.STRIDE + qm.WIDTH - len(codes))
    out = []
    for p in range(n_pos):
        x = [v for c in codes[p * qm.STRIDE:p * qm.STRIDE + qm.WIDTH] for v in w["embed"][c]]
        taps = w["conv"].reshape(-1, qm.FILTERS)
        out.append([float(w["bias"][f]) + sum(float(a) * float(b) for a, b in zip(x, taps[:, f])) for f in range(qm.FILTERS)])
    chunks = [out[a:a + qm.CHUNK] for a in range(0, max(1, n_pos - (qm.CHUNK - qm.STEP)), qm.STEP)]
    pooled = [[max(0.0, max(row[f] for row in c)) for f in range(qm.FILTERS)] for c in chunks]
    feats = [sum(p[f] for p in pooled) / len(pooled) for f in range(qm.FILTERS)] + [max(p[f] for p in pooled) for f in range(qm.FILTERS)]
    feats.append(len(chunks[0]) / qm.CHUNK)
    hidden = [max(0.0, float(w["dense_bias"][h]) + sum(x * float(w["dense"][i, h]) for i, x in enumerate(feats))) for h in range(qm.HIDDEN)]
    return 1 / (1 + math.exp(-(float(w["out_bias"][0]) + sum(x * float(o) for x, o in zip(hidden, w["out"])))))


def test_forward_pass_equals_brute_force():
    texts = ["", "a", prose(1, 3), prose(2, 60), "é ü \U0001f600" * 9, "x" * 255, "x" * 256, "x" * 257, prose(3, 200), "", "b" * 1000]
    net = qm.Network()
    rng = np.random.default_rng(5)
    net.w["bias"] = rng.normal(0, 0.3, qm.FILTERS).astype(np.float32)
    got = net.scores(qm.as_slice([t.encode() for t in texts]))
    assert np.allclose(got, [naive_score(net.w, t) for t in texts], atol=2e-5)


def test_gradients_equal_differences():
    texts = [prose(4, 30).encode(), b"", prose(5, 120).encode(), b"abc"]
    y, net = np.array([1.0, 0.0, 0.0, 1.0]), qm.Network()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}

    def loss():
        p = net.scores(qm.as_slice(texts))
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    g, rng = net.gradients(qm.as_slice(texts), y), np.random.default_rng(1)
    for name, w in net.w.items():
        at = tuple(rng.integers(s) for s in w.shape) if name != "embed" else (ord("b"), 3)
        was, eps = w[at], 1e-3
        w[at] = was + eps
        up = loss()
        w[at] = was - eps
        down = loss()
        w[at] = was
        assert math.isclose(float(g[name][at]), (up - down) / (2 * eps), rel_tol=0.1, abs_tol=2e-4), name


def test_learns_held_out_labels_and_takes_odd_rows(spark):
    rows = odd_rows()
    marks = []
    for i in range(100, 260):
        good = i % 2 == 0
        rows.append((i, prose(i, 60) if good else "$$ #1 CLICK || " * (10 + i % 7), "s"))
        marks.append((i, int(good)))
    marks += [(100, 1), (None, 1), (101, None), (9999, 0), (102, 7)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    out = qm.classify(documents(spark, rows, clash=True), labels, steps=120).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    held = [r for r in out if r.held_out and (r.doc_id or 0) >= 100]
    assert len(held) > 10 and sum(r.predicted == (r.doc_id % 2 == 0) for r in held) >= 0.95 * len(held)


def test_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in qm.classify(documents(spark, odd_rows()), labels).collect()} == {0.5}
