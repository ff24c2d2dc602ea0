import math
import zlib
from collections import Counter

import numpy as np
import pytest

from martspark.llm import blocks as B
from martspark.llm import lm as M
from martspark.llm.common import table
from martspark.llm.queries import tokenizer_path
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def words(text):
    return (text or "").encode().lower().split()


def brute_base(rows):
    out7 = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not out7(i) for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    res = []
    for i, t in rows:
        tok = [*words(t), None]
        res.append((i, out7(i), len(tok), sum(counts[w] > 0 for w in tok), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tok), 6)))
    return sorted(res, key=str)


def check(df):
    got = M.score(df, tokenizer_path()).collect()
    want = brute_base([tuple(r) for r in df.select("doc_id", "text").collect()])
    mine = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str)
    for a, b in zip(mine, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-5)
    assert len(mine) == len(want)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    return got


def test_tables(spark):
    got = check(table(spark, SF, "documents"))
    held = [r for r in got if r["held_out"]]
    ids = sum(r["n_ids"] for r in held)
    assert -sum(r["score"] for r in held) / ids < math.log10(50257) * 0.75      # far better than all ids alike


def test_odd_texts(spark):
    check(H.odd(spark))


def test_empty(spark):
    assert M.score(H.empty(spark), tokenizer_path()).count() == 0


def corpus(n=400, texts=40, seed=0):
    """Numbers, ids of texts, their sizes, and the prior, of a corpus over ``n`` ids; more are unseen."""
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 200, texts)
    ids = np.minimum(rng.zipf(1.3, sizes.sum()) - 1, n - 1)
    counts = np.zeros(n + 50, np.int64)
    counts[:n] = np.bincount(ids, minlength=n)
    counts[-1] = texts
    known = M.Numbers(counts)
    numbers, end = known.of[ids], int(known.of[-1])
    pairs = M.Pairs(known)
    for last, then, _ in M.neighbours(numbers, sizes, end):
        pairs.add(last, then)
    return known, numbers, sizes, end, pairs


def model(prior, seed=1):
    m = M.Attention(prior, seed)
    m.w["near"] = np.random.default_rng(2).standard_normal(2 * M.STRIDE).astype(np.float32)
    m.w["out"] *= 10
    return m


def plain(m, known, seq, end):
    """Attention of one text, id by id, over the ids that its window shows."""
    w, total = m.w, []
    x = [end, *seq]
    e = lambda k, name: m.embed[k] @ w[name]
    for t, goal in enumerate([*seq, end]):
        lo = max(0, t // M.STRIDE * M.STRIDE - M.STRIDE)
        a = [math.exp(e(x[t], "query") @ e(x[j], "both")[:M.WIDTH] / math.sqrt(M.WIDTH) + w["near"][t - j]) for j in range(lo, t + 1)]
        y = sum(p * e(x[j], "both")[M.WIDTH:] for p, j in zip(a, range(lo, t + 1))) / sum(a)
        z = y @ w["out"] + w["bias"] + m.after[x[t]]
        total.append(z[known.group[goal]] - math.log(np.exp(z - z.max()).sum()) - z.max())
    return sum(total)


@pytest.mark.parametrize("ready", [False, True])
def test_windows_against_plain_attention(monkeypatch, ready):
    known, _, _, end, pairs = corpus()
    m = model(M.Prior(pairs))
    rng = np.random.default_rng(3)
    sizes = np.array([0, 1, 15, 16, 17, 31, 32, 100])
    seqs = [rng.integers(0, known.size, k) for k in sizes]
    monkeypatch.setattr(M, "SLICE", 20)
    windows = M.Windows(np.concatenate(seqs), sizes, end, known)
    if ready:
        m.ready()
    got = m.log_sums(windows)
    assert np.allclose(got, [plain(m, known, s.tolist(), end) for s in seqs], atol=2e-3)


def test_gradient_against_differences():
    known, _, _, end, pairs = corpus()
    prior = M.Prior(pairs)
    seq, m = np.random.default_rng(4).integers(0, known.size, 60), model(prior)
    win, goal = M.Windows(seq, np.array([60]), end, known).of(slice(None))
    g = m.gradient(win, goal)
    for name in m.NAMES:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        vals = []
        for d in (1e-2, -1e-2):
            k = model(prior)
            k.w[name][at] += d
            vals.append(-k.log_chances(win, goal).sum() / 61)
        assert (vals[0] - vals[1]) / 2e-2 == pytest.approx(g[name][at], rel=0.03, abs=1e-4), name


def test_training_learns_a_pattern():
    seq = np.tile([0, 1, 2, 0, 3, 2], 300)
    known = M.Numbers(np.append(np.bincount(seq), 1))
    numbers, end = known.of[seq], int(known.of[-1])
    pairs = M.Pairs(known)
    for last, then, _ in M.neighbours(numbers, np.array([len(seq)]), end):
        pairs.add(last, then)
    windows = M.Windows(numbers, np.array([len(seq)]), end, known)
    m = M.Attention(M.Prior(pairs))
    before = m.log_sums(windows)[0] / len(seq)
    for k in range(60):
        m.train(windows, 0.03, k)
    assert before < -0.2 and m.log_sums(windows)[0] / len(seq) > -0.05


@pytest.mark.parametrize("frequent", [M.FREQUENT, 100])
def test_prior_is_a_distribution(monkeypatch, frequent):
    """Chances of all ids after any id, the unseen ones included, sum to 1; and pairs are counted plainly."""
    monkeypatch.setattr(M, "FREQUENT", frequent)
    monkeypatch.setattr(M, "SLICE", 77)
    known, numbers, sizes, end, pairs = corpus()
    prior = M.Prior(pairs)
    last, then = (x.ravel() for x in np.meshgrid(np.arange(known.size), np.arange(known.size), indexing="ij"))
    p = np.exp(prior.after[last, known.group[then]] + prior.inside(last, then)) * np.where(then == known.seen, known.unseen, 1)
    assert np.allclose(p.reshape(known.size, -1).sum(1), 1, atol=1e-4)
    want, at = Counter(), 0
    for k in sizes.tolist():
        x = [end, *numbers[at:at + k].tolist(), end]
        want.update(zip(x, x[1:]))
        at += k
    fine = pairs.flat[pairs.ends[1]:].reshape(pairs.edge, -1)
    assert all(fine[a, b] == want[a, b] for a in range(pairs.edge) for b in range(pairs.edge))
    assert pairs.flat[:pairs.ends[0]].sum() == sum(want.values())


def test_an_id_is_gathered_once_for_its_two_windows():
    """Runs of windows hold each id about once, though every window shows the one before; what they
    hold is the texts, their targets, and where texts begin."""
    known, _, _, end, _ = corpus()
    sizes = np.array([0, 5, 16, 400, 15, 1000, 31])
    seqs = [np.random.default_rng(k).integers(0, known.size, n) for k, n in enumerate(sizes)]
    windows = M.Windows(np.concatenate(seqs), sizes, end, known)
    (ids, first), goal = windows.of(slice(None))
    assert ids.size < 1.2 * goal.size
    assert len(windows) == sum(n // M.STRIDE + 1 for n in sizes) and first.sum() == len(sizes)
    assert (ids[1:, 0] == ids[:-1, -1]).all()                   # a run begins with the ids before it
    at = np.flatnonzero(first.ravel()) * M.STRIDE
    x, y = ids[:, 1:].ravel(), goal.ravel()
    for i, s in zip(at, seqs):
        assert x[i:i + len(s) + 1].tolist() == [end, *s] and y[i:i + len(s) + 1].tolist() == known.group[[*s, end]].tolist()
    assert (y != M.CLASSES).sum() == sum(sizes + 1)
    got, order = windows.of(np.array([2, 0])), [2, 0]
    assert (got[0][0] == ids[order]).all() and (got[0][1] == first[order]).all() and (got[1] == goal[order]).all()


def test_a_window_sees_no_other_text():
    known, _, _, end, pairs = corpus()
    m = model(M.Prior(pairs)).ready()
    rng = np.random.default_rng(5)
    sizes = np.array([40, 0, 7, 200, 33])
    seqs = [rng.integers(0, known.size, n) for n in sizes]
    alone = [m.log_sums(M.Windows(s, np.array([len(s)]), end, known))[0] for s in seqs]
    assert np.allclose(m.log_sums(M.Windows(np.concatenate(seqs), sizes, end, known)), alone, atol=1e-3)


def test_train_is_adam_of_each_parameter():
    known, numbers, sizes, end, pairs = corpus()
    prior, windows = M.Prior(pairs), M.Windows(numbers, sizes, end, known)
    m, plain_, mean, square = model(prior), model(prior), {}, {}
    m.train(windows, 0.02, 3)
    order, step = np.random.default_rng(3).permutation(len(windows)), M.BATCH
    for t, lo in enumerate(range(0, len(windows), step), 1):
        for k, g in plain_.gradient(*windows.of(order[lo:lo + step], 1)).items():
            mean[k] = 0.9 * mean.get(k, 0) + 0.1 * g
            square[k] = 0.98 * square.get(k, 0) + 0.02 * g * g
            plain_.w[k] = (plain_.w[k] - 0.02 * mean[k] / (1 - 0.9 ** t) / (np.sqrt(square[k] / (1 - 0.98 ** t)) + 1e-6)).astype(np.float32)
    assert t > 1 and all(np.allclose(m.w[k], plain_.w[k], atol=2e-3) for k in m.NAMES)


@pytest.mark.parametrize("level", [1, 3, 9])
def test_blocks_hold_the_same_at_any_level(spark, level):
    """Also a lower level of compression than the default's gives back words, bodies and counts."""
    rows = [(k, t) for k, t in enumerate(["a b a", "", None, "b  c\u00e9 b", "a " * 500])]
    parts = B.blocks(H.frame(spark, rows).coalesce(1), M.word_spans, 3, trained=M.C.remainder("doc_id", 7) != 2, name="test", level=level).collect()
    (body,) = [r for r in parts if r["body"] is not None]
    names, count = {}, {}
    for r in parts:
        if r["words"] is not None:
            at = B.unpack_rising(r["numbers"]).tolist()
            names.update(zip(at, B.blob_words(r["words"])))
            count.update(zip(B.blob_words(r["words"]), B.unpack(r["counts"], "<u8").tolist()))
    ids, _, sizes, tokens = B.bodies(body)
    flat, texts = [names[i] for i in tokens.tolist()], dict(rows)
    assert flat == [w for i in ids.tolist() for w in words(texts[i])]
    assert sizes.tolist() == [len(words(texts[i])) for i in ids.tolist()]
    assert count == {w: sum(words(t).count(w) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2) for w in set(flat)}


def test_empty_numbers():
    known = M.Numbers(np.zeros(9, np.int64))
    prior = M.Prior(M.Pairs(known))
    assert np.isfinite(M.Attention(prior).ready().log_sums(M.Windows(known.of[[1, 2]], np.array([2]), 0, known))).all() and prior.inside(np.array([0]), np.array([0]))[0] == pytest.approx(-math.log(9))


def test_below_a_bigram(spark):
    """Held-out scores are better than those of a smoothed bigram of the same ids."""
    import tiktoken
    import public_tokenizers
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()]
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=M.bpe.load_ranks(tokenizer_path()), special_tokens={})
    out7 = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    text = {i: [-1, *(k for w in words(t) for k in enc.encode_ordinary(" " + w.decode("utf-8", "replace"))), -1] for i, t in rows}
    one, two = Counter(), Counter()
    for i, x in text.items():
        if not out7(i):
            one.update(x[1:])
            two.update(zip(x, x[1:]))
    first = Counter()
    for (a, _), k in two.items():
        first[a] += k
    n = sum(one.values())
    chance = lambda a, b: (two[a, b] + 4 * (one[b] + 1) / (n + 50258)) / (first[a] + 4)
    held = [x for i, x in text.items() if out7(i)]
    plain = sum(math.log10(chance(a, b)) for x in held for a, b in zip(x, x[1:])) / sum(len(x) - 1 for x in held)
    got = [r for r in M.score(table(spark, "/root/testdata/sf0.01", "documents"), tokenizer_path()).collect() if r["held_out"]]
    mine = sum(r["score"] for r in got) / sum(r["n_ids"] for r in got)
    print("model", mine, "bigram", plain)
    assert sum(r["n_ids"] for r in got) == sum(len(x) - 1 for x in held) and mine > plain


def test_held_out_scores_need_attention(spark):
    """Words follow the word two before them: the best model without attention knows only the last."""
    rng, names = np.random.default_rng(6), ["the", "of", "and", "to", "in", "is"]
    rows = []
    for k in range(900):
        x = rng.integers(0, 6, 600)
        for t in range(2, 600):
            x[t] = (x[t - 2] + 1) % 6 if rng.random() < 0.95 else x[t]
        rows.append((k, " ".join(names[i] for i in x)))
    held = [r for r in M.score(H.frame(spark, rows), tokenizer_path()).collect() if r["held_out"]]
    pairs = Counter(p for _, t in rows for p in zip(t.split(), t.split()[1:]))
    first = Counter(w for _, t in rows for w in t.split()[:-1])
    plain = -sum(n * math.log10(n / first[a]) for (a, _), n in pairs.items()) / sum(pairs.values())
    assert -sum(r["score"] for r in held) / sum(r["n_ids"] for r in held) < 0.9 * plain
