import math
import re
import zlib
from collections import Counter

from pickwise.llm import ngram_lm

from .helpers import documents, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), None]


def by_force(rows):
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _, _ in rows]
    uni, pair, context = Counter(), Counter(), Counter()
    for (_, text, _), held in zip(rows, out):
        if not held:
            t = tokens(text)
            uni.update(t)
            for a, b in zip([0, *t], t):
                pair[a, b] += 1
                context[a] += 1
    after, n = Counter(a for a, _ in pair), sum(uni.values())
    found = []
    for (i, text, _), held in zip(rows, out):
        t = tokens(text)
        p1 = [(uni[w] + 1) / (n + len(uni) + 1) for w in t]
        score = 0.0
        for a, b, p in zip([0, *t], t, p1):
            d = ngram_lm.DISCOUNT
            score += math.log10((pair[a, b] - d) / context[a] if pair[a, b] else (d * after[a] / context[a] if context[a] else 1) * p)
        found.append((-1 if i is None else i, held, len(t), sum(uni[w] > 0 for w in t), n, sum(map(math.log10, p1)), score))
    return found


def test_scores_equal_brute_force(spark):
    rows = odd_rows() + [(100 + i, prose(i, 30 + i).replace("b", "B"), "s") for i in range(60)]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in ngram_lm.score_texts(documents(spark, rows, clash=True)).collect())
    want = sorted(by_force(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9)
        assert abs(g[6] - w[6]) < 0.001 * g[2] + 1e-6          # probabilities are quantised


def test_empty_table(spark):
    assert ngram_lm.score_texts(documents(spark, [])).collect() == []
