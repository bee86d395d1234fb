import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import gru
from ledgerlake.llm import lm as L
from tests.llm.helpers import docs, edge_texts, prose


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\n"]


def held(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def run(spark, tmp_dir, texts):
    docs(spark, texts).write.parquet(f"{tmp_dir}/documents.parquet")
    return L.op3_lm(spark, tmp_dir).collect()


def test_base_scores_equal_brute_force(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(L, "LISTED", 30)
    monkeypatch.setattr(L, "WORDS", 12)
    long_word = "w" * 100
    texts = edge_texts() + [prose(50, k) + " ÄÖ\u001c x " + long_word for k in range(60)] + [long_word] * 30 + [f"rare{k} word" for k in range(20)]
    rows = {r["doc_id"]: r for r in run(spark, tmp_dir, texts)}
    c = Counter(w for i, t in enumerate(texts) if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        w, r = tokens(t), rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(w), sum(c[x] > 0 for x in w), n)
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert abs(r["base_score"] - base) < 1e-6 and r["score"] < 0


def test_probabilities_sum_to_one():
    """Over every known token and one unseen kind, after training."""
    counts = Counter({f"w{k}".encode(): 400 // (k + 1) + 1 for k in range(60)})
    counts[L.END] = 50
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:20]
    vocab = L.Vocabulary(top, sum(counts.values()), len(counts))
    net = vocab.net()
    rng = np.random.RandomState(0)
    texts = [[f"w{int(k)}".encode() for k in rng.zipf(1.5, 30) % 60] for _ in range(80)]
    codes = L.Codes(vocab)
    coded = [vocab.encode(codes.numbers(t), codes) for t in texts]
    net.train(coded, {})
    prefix = [b"w1", b"w3", b"w50"]
    x, _ = vocab.encode(codes.numbers(prefix), codes)
    total = 0.0
    for target in range(vocab.size):
        y = np.array([0, 0, 0, target], np.int32)
        both, without = net.score([(x, y)])[0], net.score([(x[:3], y[:3])])[0]
        total += math.exp(both - without)
    assert abs(total - 1) < 1e-4
    rare = [c for w, c in counts.items() if w not in vocab.index]
    assert vocab.rare_total == sum(rare) and vocab.rare_kinds == len(rare)
    assert abs(sum((c + 0.1) / (vocab.rare_total + 0.1 * (vocab.rare_kinds + 1)) for c in [*rare, 0]) - 1) < 1e-9


def test_gradients_by_finite_differences():
    counts = np.array([50, 30, 20, 10, 8, 5, 3, 2])
    rng = np.random.RandomState(3)
    docs_ = [(rng.randint(0, 10, n).astype(np.int32), rng.randint(0, 8, n).astype(np.int32)) for n in (7, 4, 9)]
    net = gru.Net(counts, 10, 3, width=5)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    seen = {}

    def record(name, rows, grad, memory, rate, scale):
        out = seen.setdefault(name, np.zeros_like(net.w[name], dtype=np.float64))
        out[rows] += grad

    net._step = record
    net.train(docs_, {}, lanes=2, window=50)
    for name in ("inputs", "state", "cls", "cls_bias", "word", "word_bias"):
        w = net.w[name]
        for _ in range(4):
            at = tuple(rng.randint(0, s) for s in w.shape)
            old, eps = w[at], 1e-2
            w[at] = old + eps
            hi = -net.score(docs_).sum()
            w[at] = old - eps
            lo = -net.score(docs_).sum()
            w[at] = old
            assert abs((hi - lo) / (2 * eps) - seen[name][at]) < 2e-2 * max(1, abs(seen[name][at])), (name, at)


def test_state_is_carried_across_windows_and_lanes_do_not_matter():
    counts = np.array([50, 30, 20, 10])
    rng = np.random.RandomState(3)
    texts = [(rng.randint(0, 6, n).astype(np.int32), rng.randint(0, 4, n).astype(np.int32)) for n in (70, 5, 33, 1, 150)]
    net = gru.Net(counts, 6, 2)
    a = net.score(texts, lanes=2, window=8)
    assert np.allclose(a, net.score(texts, lanes=5, window=64), atol=1e-3)
    assert np.allclose(a, [net.score([t], window=200)[0] for t in texts], atol=1e-3)


def test_learning_beats_the_counts_on_held_out_text(spark, tmp_dir):
    # words that follow each other, which counts alone cannot tell
    texts = [" ".join(f"a{(k + j) % 12}" for j in range(60)) for k in range(400)]
    rows = [r for r in run(spark, tmp_dir, texts) if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_no_training_rows_and_empty_table(spark, tmp_dir):
    only = next(i for i in range(100) if held(i))
    rows = run(spark, tmp_dir, [(only, "a b")])
    assert rows[0]["train_tokens"] == 0 and rows[0]["n_known"] == 0 and rows[0]["n_tokens"] == 3
    docs(spark, []).write.parquet(f"{tmp_dir}/e/documents.parquet")
    assert L.op3_lm(spark, f"{tmp_dir}/e").count() == 0


def test_scores_beyond_single_precision_are_exact():
    """Scores whose exponentials overflow or vanish give the same probabilities as in exact arithmetic."""
    rng = np.random.RandomState(5)
    for size in (1.0, 40.0, 400.0):
        net = gru.Net(np.array([50, 30, 20, 10, 8, 5]), 6, 2)
        net.w["word"] = rng.normal(0, size, net.w["word"].shape).astype(np.float32)
        net.w["cls"] = rng.normal(0, size, net.w["cls"].shape).astype(np.float32)
        h = rng.uniform(-1, 1, (40, net.width)).astype(np.float32)
        y = rng.randint(0, 6, 40)

        def log_shares(z):
            z = z - z.max(axis=1, keepdims=True)
            return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

        want = np.zeros(40)
        by_class = log_shares(h.astype(np.float64) @ net.w["cls"] + net.w["cls_bias"])
        for i, word in enumerate(y):
            k = net.cls[word]
            lo, hi = net.edge[k], net.edge[k + 1]
            z = h[i:i + 1].astype(np.float64) @ net.w["word"][lo:hi].T + net.w["word_bias"][lo:hi]
            want[i] = by_class[i, k] + log_shares(z)[0, word - lo]
        got = net._out(h, y)[0]
        assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-4, atol=1e-3 * size)


def test_texts_are_coded_in_groups(spark, tmp_dir, monkeypatch):
    """However many texts are looked up together, their inputs and sums are the same."""
    monkeypatch.setattr(L, "LISTED", 30)
    monkeypatch.setattr(L, "WORDS", 12)
    rows = docs(spark, edge_texts() + ["", None] + [prose(40, k) for k in range(30)]).select("doc_id", "text").withColumn("learns", F.lit(True)).withColumn("share", F.lit(0))
    counts = L.token_counts(rows)
    listed = L.listed_counts(counts)
    vocab = L.vocabulary(counts, listed)

    def shown(tokens):
        monkeypatch.setattr(L, "CODED_TOKENS", tokens)
        return sorted((r["doc_id"], r["n_tokens"], r["known"], round(r["listed_sum"], 6), round(r["rare_sum"], 6), r["n_rare"], bytes(r["x"]),
                       tuple(sorted((bytes(t["token"]), t["n"]) for t in r["tail"]))) for r in L.coded(rows.repartition(2), vocab, listed).collect())

    assert shown(1) == shown(10**6)
    codes = L.Codes(vocab, listed)
    text = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert all(x == vocab.inputs_of(codes.numbers(L.tokens_of(text[i])), codes).tobytes() for i, *_, x, _ in shown(100))
