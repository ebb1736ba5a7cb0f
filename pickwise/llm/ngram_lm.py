"""Op 7: language-model scores from an Elias-Fano n-gram trie.

Model: words (A-Z lower-cased) and one end per text; a bigram model with absolute
discounting that backs off to add-one unigrams:
p(w | v) = (c(v w) - D) / c(v) if v w was seen, else D n(v) / c(v) * p(w), where n(v)
counts the distinct words after v (an unseen v has weight 1). What is seen and
the share given to the rest never exceed one together.

All counts cover the whole training part of the table. The model is never in
one place: it is cut into shards by context, and the texts' n-grams travel to it.
A task turns its texts into blocks: distinct (context, word) pairs in order,
each with the documents that hold it, cut by shard. A shard merges the
training counts of all blocks, writes its trie (contexts, monotone pointers,
successors relative to their context, quantised probabilities) to files of
its own, maps them and answers all blocks: sums per document, so nothing
per word goes back. Words not seen after their context travel once more, to
the shard of their unigram count. Sums of a block meet again at the end.

Skew: pairs are pre-aggregated per block; a context with more than
1 / (4 shards) of all words is spread over all shards by its next word (there
are fewer than 4 * shards such contexts), and its weight is applied at the end.

Nulls and edges: a null text is empty (one end); a null doc_id is held out of
nothing and trains; with no training documents N is 0 and every token gets
the add-one probability of an empty count; repeated rows count each time; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.reuse import materialize
from .elias_fano import BigramTrie
from .text import ByteHash, mix, slices, words

#: Word hashes are odd, so these two cannot be words.
START, END = np.uint64(2), np.uint64(4)
DISCOUNT = 0.75
#: Words of a block, and bytes of text whose n-grams make a shard.
BLOCK_WORDS, SHARD_BYTES = 1_500_000, 16 << 20


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed, as one value."""
    codec = pa.Codec("zstd", 1)
    return pickle.dumps([(a.dtype.str, len(a), codec.compress(np.ascontiguousarray(a).tobytes(), asbytes=True)) for a in arrays])


def load(value: bytes) -> list[np.ndarray]:
    codec = pa.Codec("zstd")
    return [np.frombuffer(codec.decompress(b, n * np.dtype(t).itemsize, asbytes=True), dtype=t) if n else np.zeros(0, t)
            for t, n, b in pickle.loads(value)]


def pairs_of(payload: bytes) -> tuple[np.ndarray, ...]:
    """Contexts, pairs per context, next words, tokens per pair, documents of the tokens."""
    c1, runs, u2, n, docs = load(payload)
    return c1, runs.astype(np.int64), u2, n.astype(np.int64), docs


def small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint16 if not len(x) or x.max() < 1 << 16 else np.uint32)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(h) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def merged(h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order with their summed counts."""
    order = np.argsort(h, kind="stable")
    h, count = h[order], count[order]
    new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[new], (np.add.reduceat(count, new) if len(new) else count[:0])


def by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by shard, and where each shard starts in it."""
    order = np.argsort(small(shard) if len(shard) else shard, kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(shard, minlength=shards))))


def unigram_batches(shards: int):
    """mapInArrow function: (held_out, text) -> shard, payload (word hashes, counts) of training texts."""
    def flush(parts: list[np.ndarray], n_docs: int) -> pa.RecordBatch:
        h = np.concatenate([*parts, np.zeros(0, np.uint64)])
        h, count = merged(h, np.ones(len(h), np.int64))
        order, at = by_shard(shard_of(h, shards), shards)
        h, count = h[order], count[order]
        rows = [(s, dump(h[at[s]:at[s + 1]], count[at[s]:at[s + 1]].astype(np.uint32))) for s in range(shards) if at[s + 1] > at[s]]
        if n_docs:
            rows.append((int(shard_of(np.array([END]), shards)[0]), dump(np.array([END]), np.array([n_docs], np.uint32))))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                          names=["shard", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, parts, held, n_docs = ByteHash(lower=True), [], 0, 0
        for b in batches:
            out = np.asarray(b.column("held_out"))
            for s in slices(b.column("text")):
                start, end, doc = words(s)
                train = ~out[s.lo:s.hi]
                own = train[doc]
                parts.append(hasher.ranges(hasher.prefix(s.data), start[own], end[own]))
                held, n_docs = held + len(parts[-1]), n_docs + int(train.sum())
                if held >= BLOCK_WORDS:
                    yield flush(parts, n_docs)
                    parts, held, n_docs = [], 0, 0
        if parts:
            yield flush(parts, n_docs)
    return run


def unigram_shards(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """All payloads of a shard -> one sorted table with its sums."""
    parts = [load(x) for x in pdf["payload"]]
    h, count = merged(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64))
    return pd.DataFrame({"shard": [key[0]], "n": [int(count.sum())], "types": [len(h)], "payload": [dump(h, count)]})


def block_batches(shards: int, hot: np.ndarray):
    """mapInArrow function: (doc_id, held_out, text) -> shard, block, payload.

    A payload holds the pairs of one block that belong to one shard: distinct
    contexts, pairs per context, next words, tokens per pair and the token's
    documents (numbers in the block, training documents first). One payload
    per block carries the documents themselves."""
    def flush(block: int, parts: list, ids: list, outs: list) -> pa.RecordBatch:
        h = np.concatenate([p[0] for p in parts])
        doc = np.concatenate([p[1] for p in parts])
        out = np.concatenate(outs)
        place = np.empty(len(out), dtype=np.int64)
        place[np.argsort(out, kind="stable")] = np.arange(len(out))
        doc = place[doc]
        # Words and marks of a document are consecutive: START w1 .. wn END.
        pair = np.flatnonzero(h != END)
        h1, h2, doc = h[pair], h[pair + 1], doc[pair]
        order = np.lexsort((h2, h1))
        h1, h2, doc = h1[order], h2[order], doc[order]
        new = np.flatnonzero(np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))))
        tokens = np.diff(np.append(new, len(h1)))
        u1, u2 = h1[new], h2[new]
        at_hot = np.isin(u1, hot)
        shard = shard_of(np.where(at_hot, mix(u1 ^ mix(u2)), u1), shards)
        order, at = by_shard(shard, shards)
        rows = []
        for s in range(shards):
            own = order[at[s]:at[s + 1]]
            if not len(own):
                continue
            c1, first = np.unique(u1[own], return_index=True)
            n = tokens[own]
            which = np.repeat(new[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            rows.append((s, dump(c1, small(np.diff(np.append(first, len(own)))), u2[own], small(n), small(doc[which]))))
        known = np.array([i is not None for i in ids])
        number = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        back = np.argsort(place)
        rows.append((int(block % shards), dump(number[back], known[back], out[back])))
        kind = [0] * (len(rows) - 1) + [1]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array(kind, pa.int32()),
             pa.array(np.full(len(rows), int((~out).sum())), pa.int64()), pa.array(np.full(len(rows), len(out)), pa.int64()),
             pa.array([r[1] for r in rows], pa.binary())], names=["shard", "block", "kind", "n_train", "n_docs", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHash(lower=True)
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        parts, ids, outs, held = [], [], [], 0
        for b in batches:
            out, doc_id = np.asarray(b.column("held_out")), b.column("doc_id")
            for s in slices(b.column("text")):
                n = s.hi - s.lo
                start, end, doc = words(s)
                h = hasher.ranges(hasher.prefix(s.data), start, end)
                full = np.empty(len(h) + 2 * n, dtype=np.uint64)
                full[np.arange(len(h)) + 2 * doc + 1] = h
                count = np.bincount(doc, minlength=n)
                last = np.cumsum(count + 2) - 1
                full[last] = END
                full[last - count - 1] = START
                parts.append((full, np.repeat(np.arange(n), count + 2) + len(ids)))
                ids += doc_id.slice(s.lo, n).to_pylist()
                outs.append(out[s.lo:s.hi])
                held += len(full)
                if held >= BLOCK_WORDS:
                    yield flush(block, parts, ids, outs)
                    block, parts, ids, outs, held = block + 1, [], [], [], 0
        if parts:
            yield flush(block, parts, ids, outs)
    return run


def shard_scorer(shards: int, hot: dict[int, int], discount: float):
    """applyInPandas function: all payloads of a shard -> answers for blocks.

    kind 0: per document of a block: tokens, known words, sum of log10(c + 1), sum of log10 p;
    kind 1: the documents of a block; kind 2: words to look up in unigram shard
    ``shard``: block, document, word, how often; kind 3: unseen words after hot contexts;
    kind 4: hot contexts and their distinct next words here."""
    hot_h = np.array(sorted(hot), dtype=np.uint64)
    hot_c = np.array([hot[int(h)] for h in hot_h], dtype=np.int64)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = [(0, b, 1, p) for b, p, k in zip(pdf["block"], pdf["payload"], pdf["kind"]) if k == 1]
        pdf = pdf[pdf["kind"] == 0].sort_values("block")
        counts = []
        for payload, n_train in zip(pdf["payload"], pdf["n_train"]):
            c1, runs, u2, n, docs = pairs_of(payload)
            upto = np.concatenate(([0], np.cumsum(docs < n_train)))
            at = np.concatenate(([0], np.cumsum(n)))
            c = upto[at[1:]] - upto[at[:-1]]
            own = np.flatnonzero(c)
            counts.append((np.repeat(c1, runs)[own], u2[own], c[own]))
        h1, h2, c = (np.concatenate([x[i] for x in counts] or [np.zeros(0, np.uint64)]) for i in range(3))
        order = np.lexsort((h2, h1))
        h1, h2, c = h1[order], h2[order], c[order].astype(np.int64)
        del counts, order
        new = np.flatnonzero(np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))) if len(h1) else np.zeros(0, np.int64)
        c = np.add.reduceat(c, new) if len(new) else c
        h1, h2 = h1[new], h2[new]
        contexts, first = np.unique(h1, return_index=True)
        after = np.diff(np.append(first, len(h1)))
        total = np.add.reduceat(c, first) if len(first) else c
        is_hot = np.isin(contexts, hot_h)
        if is_hot.any():
            total = total.copy()
            total[is_hot] = hot_c[np.searchsorted(hot_h, contexts[is_hot])]
            rows.append((0, 0, 4, dump(contexts[is_hot], after[is_hot])))
        backoff = np.where(is_hot, 0.0, np.log10(discount * after / np.maximum(total, 1)))
        log_prob = np.log10((c - discount) / np.repeat(total, after)) if len(c) else np.zeros(0)
        asked: dict[str, list] = {"block": [], "doc": [], "word": [], "n": []}
        with tempfile.TemporaryDirectory() as folder:
            BigramTrie.write(Path(folder), h1, h2, log_prob, contexts, backoff)
            del h1, h2, c, log_prob
            trie = BigramTrie(Path(folder))
            for block, payload, n_docs in zip(pdf["block"], pdf["payload"], pdf["n_docs"]):
                c1, runs, u2, n, docs = pairs_of(payload)
                n_docs = int(n_docs)
                node = trie.context(c1)
                known = node >= 0
                lp = np.full(len(u2), np.nan)
                lp[np.repeat(known, runs)] = trie.log_prob(node[known], runs[known], u2[np.repeat(known, runs)])
                weight = np.zeros(len(c1))
                weight[known] = trie.log_backoff(node[known])
                count = np.zeros(len(c1))
                count[known] = total[node[known]]
                hot_at = np.searchsorted(hot_h, c1)
                hot_here = np.zeros(len(c1), dtype=bool)
                ok = hot_at < len(hot_h)
                hot_here[ok] = hot_h[hot_at[ok]] == c1[ok]
                count[hot_here] = hot_c[hot_at[hot_here]]
                weight[hot_here] = 0.0
                count[c1 == START] = 0
                unseen = np.isnan(lp)
                value = np.where(unseen, np.repeat(weight, runs), lp)
                pair = np.repeat(np.arange(len(u2)), n)          # of every token
                ctx = np.repeat(np.arange(len(c1)), runs)[pair]
                per = lambda x: np.bincount(docs, weights=x, minlength=n_docs)
                rows.append((0, block, 0, dump(
                    np.bincount(docs, minlength=n_docs).astype(np.uint32), per(count[ctx] > 0).astype(np.uint32),
                    per(np.log10(count + 1)[ctx]), per(value[pair]))))
                lost = np.flatnonzero(unseen[pair])
                if len(lost):
                    # Each (document, word) once, with how often it is asked.
                    d, w = docs[lost].astype(np.int64), u2[pair[lost]]
                    order = np.lexsort((d, w))
                    d, w = d[order], w[order]
                    first = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (w[1:] != w[:-1]))))
                    asked["block"].append(np.full(len(first), block, dtype=np.int64))
                    asked["doc"].append(d[first])
                    asked["word"].append(w[first])
                    asked["n"].append(np.diff(np.append(first, len(d))))
                    burnt = lost[hot_here[ctx[lost]]]
                    if len(burnt):
                        rows.append((0, block, 3, dump(docs[burnt], c1[ctx[burnt]])))
        if asked["block"]:
            block, doc, word, n = (np.concatenate(x) for x in asked.values())
            order, at = by_shard(shard_of(word, shards), shards)
            for s in range(shards):
                own = order[at[s]:at[s + 1]]
                if len(own):
                    rows.append((s, 0, 2, dump(block[own], doc[own].astype(np.uint32), word[own], n[own].astype(np.uint32))))
        return pd.DataFrame(rows, columns=["shard", "block", "kind", "payload"])
    return run


def unigram_answers(n_tokens: int, n_types: int):
    """cogroup function: words asked of a unigram shard and the shard -> per block sums of log10 p."""
    denominator = np.log10(n_tokens + n_types + 1)

    def run(key, asked: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame({"block": [], "kind": [], "payload": []})
        h, count = load(table["payload"].iloc[0]) if len(table) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        rows = []
        for payload in asked["payload"]:
            block, doc, word, n = load(payload)
            at = np.searchsorted(h, word)
            c = np.zeros(len(word))
            ok = at < len(h)
            ok[ok] = h[at[ok]] == word[ok]
            c[ok] = count[at[ok]]
            value = n * (np.log10(c + 1) - denominator)
            for b in np.unique(block):
                own = block == b
                d, inverse = np.unique(doc[own], return_inverse=True)
                rows.append((int(b), 2, dump(d, np.bincount(inverse, weights=value[own]))))
        return pd.DataFrame(rows, columns=["block", "kind", "payload"])
    return run


def block_sums(n_tokens: int, n_types: int, ends: int, hot_backoff: dict[int, float]):
    """applyInPandas function: all answers for one block -> its documents' scores."""
    denominator = np.log10(n_tokens + n_types + 1)
    hot_h = np.array(sorted(hot_backoff), dtype=np.uint64)
    hot_w = np.array([hot_backoff[int(h)] for h in hot_h])

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, known_id, out = load(pdf.loc[pdf["kind"] == 1, "payload"].iloc[0])
        n = len(ids)
        tokens, known, base, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for kind, payload in zip(pdf["kind"], pdf["payload"]):
            if kind == 0:
                t, k, b, x = load(payload)
                tokens += t
                known += k
                base += b
                score += x
            elif kind == 2:
                d, x = load(payload)
                score[d] += x
            elif kind == 3:
                d, h = load(payload)
                score += np.bincount(d, weights=hot_w[np.searchsorted(hot_h, h)], minlength=n)
        base += np.log10(ends + 1) - tokens * denominator      # the end token's count, and every token's denominator
        known += ends > 0
        return pd.DataFrame({"doc_id": pd.array(np.where(known_id, ids, 0), dtype="Int64").copy() if known_id.all() else
                             pd.array([int(i) if k else None for i, k in zip(ids, known_id)], dtype="Int64"),
                             "held_out": out.astype(bool), "n_tokens": tokens, "n_known": known,
                             "train_tokens": np.full(n, n_tokens, np.int64), "base_score": base, "score": score})
    return run


def score_texts(docs: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    uni = rows.select("held_out", "text").mapInArrow(unigram_batches(shards), "shard int, payload binary")
    uni = materialize(uni.groupBy("shard").applyInPandas(unigram_shards, "shard int, n long, types long, payload binary"))
    sums = uni.agg(F.sum("n"), F.sum("types")).first()
    n_tokens, n_types = sums[0] or 0, sums[1] or 0

    least = max(1, n_tokens // (4 * shards))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column("payload"):
                h, count = load(x.as_py())
                own = (count > least) | (h == END)
                yield pa.RecordBatch.from_arrays([pa.array(h[own].view(np.int64)), pa.array(count[own])], names=["h", "n"])

    found = {r.h & 0xFFFFFFFFFFFFFFFF: r.n for r in uni.select("payload").mapInArrow(frequent, "h long, n long").collect()}
    ends = found.pop(int(END), 0)
    hot = dict(found)
    if ends > least:
        hot[int(START)] = ends
    blocks = rows.mapInArrow(block_batches(shards, np.array(sorted(hot), dtype=np.uint64)),
                             "shard int, block long, kind int, n_train long, n_docs long, payload binary")
    answers = materialize(blocks.groupBy("shard").applyInPandas(
        shard_scorer(shards, hot, discount), "shard int, block long, kind int, payload binary"))

    after: dict[int, int] = {}
    for r in answers.filter("kind = 4").select("payload").collect():      # a few numbers per shard and hot context
        for h, n in zip(*load(bytes(r.payload))):
            after[int(h)] = after.get(int(h), 0) + int(n)
    hot_backoff = {h: float(np.log10(discount * max(after.get(h, 1), 1) / c)) for h, c in hot.items()}
    asked = answers.filter("kind = 2").select("shard", "payload")
    looked_up = asked.groupBy("shard").cogroup(uni.select("shard", "payload").groupBy("shard")).applyInPandas(
        unigram_answers(n_tokens, n_types), "block long, kind int, payload binary")
    parts = answers.filter("kind in (0, 1, 3)").select("block", "kind", "payload").unionByName(looked_up)
    return parts.groupBy("block").applyInPandas(
        block_sums(n_tokens, n_types, ends, hot_backoff),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
