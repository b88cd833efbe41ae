import base64
import collections
import hashlib
import math
import random
import re
import types
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from haulwise.llm import attention_lm as lm
from haulwise.llm import bpe, lexicon
from haulwise.llm.queries import op8_lm_score, op9_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pre_tokens_match_the_pattern():
    rng = random.Random(3)
    parts = [*"ab z'  \n\t.!?19éßñ漢²½_", "'s", "'re", "'ll", "'ve", "'d", "'m ", "　", "\xa0", " ", "😀", "é", "\x85"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(5000)]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    line, starts, ends, rows = bpe.pre_tokens(np.frombuffer(b"".join(raw), np.uint8), offsets, bpe.character_classes())
    got, line = [[] for _ in texts], line.tobytes()
    for a, b, k in zip(starts.tolist(), ends.tolist(), rows.tolist()):
        got[k].append(line[a:b].decode())
    assert got == [regex.findall(PATTERN, t) for t in texts]


def test_packed_arrays_and_words():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 1 << 40, 50), np.zeros(0, np.int64), np.arange(300)]
    assert all((a == b).all() for a, b in zip(lexicon.unpack(lexicon.pack(*arrays)), arrays))
    words = [b"", b"a" * 1000, "é".encode(), b"x"]
    assert lexicon.unpack_words(lexicon.pack_words(words)) == words and lexicon.unpack_words(lexicon.pack_words([])) == []


def test_query_is_what_tiktoken_gives(spark, small_dir, texts, encoding):
    rows = op9_bpe(spark, small_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows_round_trip(odd_docs, no_docs, encoding):
    back = bpe.decode(bpe.encode(odd_docs, PATH, PATTERN), PATH).collect()
    rows = odd_docs.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in back) == sorted((str(r.doc_id), (r.text or "").encode()) for r in rows)
    want = sorted(np.array(encoding.encode_ordinary(r.text or ""), "<u4").tobytes() for r in rows)
    assert sorted(bytes(r.ids) for r in back) == want
    assert bpe.decode(bpe.encode(no_docs, PATH, PATTERN), PATH).count() == 0


def test_decoding_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray(b"")), (3, bytearray(b"\1\0\0\0"))], "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, PATH).collect()}
    assert got[1] is None and bytes(got[2]) == b"" and len(got[3]) == 1


def test_blocks_of_any_size_agree(stored, texts, monkeypatch, encoding):
    docs = stored(sorted(texts.items()), "doc_id long, text string").repartition(3)
    path_docs = stored([tuple(r) for r in docs.collect()], "doc_id long, text string")
    monkeypatch.setattr(lexicon.blocks, "__defaults__", (20_000,))
    got = {r.doc_id: bytes(r.ids) for r in bpe.encode(path_docs, PATH, PATTERN).collect()}
    assert got == {i: np.array(encoding.encode_ordinary(t), "<u4").tobytes() for i, t in texts.items()}


def test_gradient():
    rng = np.random.default_rng(0)
    size = sum(int(np.prod(s)) for s in lm.SHAPES.values())
    vector = lm.first_weights().astype(np.float64) + rng.normal(0, 0.05, size)
    pairs = tuple(x.astype(float) for x in lm.pair_logits(rng.random((lm.UNITS, lm.UNITS)), rng.random(lm.UNITS), rng.random(lm.UNITS)))
    inputs, targets = rng.integers(0, lm.UNITS, (2, 3, lm.WINDOW))
    valid = np.ones((3, lm.WINDOW), bool)
    valid[1, 20:] = False
    _, g = lm.loss_and_gradient(vector, pairs, inputs, targets, valid)
    at = 0
    for shape in lm.SHAPES.values():
        n = int(np.prod(shape))
        k = at + int(np.abs(g[at:at + n]).argmax())
        step = np.zeros_like(vector)
        step[k] = 1e-5
        up, down = (lm.loss_and_gradient(vector + s * step, pairs, inputs, targets, valid)[0] for s in (1, -1))
        assert g[k] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)
        at += n


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 100, 3000).astype(float)
    opens = rng.random(3000) < 0.5
    opens[2999] = True
    units = lm.Units(counts, opens)
    pairs = lm.pair_logits(rng.random((lm.UNITS, lm.UNITS)), rng.random(lm.UNITS), rng.random(lm.UNITS))
    vector = lm.first_weights(3) + rng.normal(0, 0.1, len(lm.first_weights())).astype(np.float32)
    return vector, pairs, units


def test_each_id_is_scored_once_and_causally(model):
    vector, pairs, units = model
    rng = np.random.default_rng(4)
    sizes = np.array([1, 24, 25, 200, 3])
    ids = rng.integers(0, 2999, sizes.sum())
    ids[np.cumsum(sizes) - 1] = 2999
    logs, opening = lm.score_ids(vector, pairs, units, ids, sizes, 2999)
    assert np.isfinite(logs).all() and (logs < 0).all() and (opening <= 1e-6).all()
    changed = ids.copy()
    changed[1 + 24 + 25 + 100] = (ids[1 + 24 + 25 + 100] + 1) % 2999
    other, _ = lm.score_ids(vector, pairs, units, changed, sizes, 2999)
    moved = np.flatnonzero(np.abs(other - logs) > 1e-6)
    assert moved.min() == 150 and moved.max() < 150 + lm.WINDOW  # later ids of the same text only
    alone, _ = lm.score_ids(vector, pairs, units, ids[1:25], sizes[1:2], 2999)
    assert np.allclose(alone, logs[1:25], atol=1e-4)


def test_probabilities_of_next_ids_sum_to_one(model):
    vector, pairs, units = model
    head = np.array([5, 17, 99])
    texts = [np.array([*head, k, 2999]) for k in range(3000)]
    logs, opening = lm.score_ids(vector, pairs, units, np.concatenate(texts), np.full(3000, 5), 2999)
    p = np.exp(logs.reshape(-1, 5)[:, 3])
    assert p.sum() == pytest.approx(1, abs=1e-3)
    opens = units.unit < lm.UNITS // 2
    assert p[opens].sum() == pytest.approx(math.exp(opening.reshape(-1, 5)[0, 3]), abs=1e-3)


def test_training_lowers_the_loss(model):
    _, pairs, units = model
    rng = np.random.default_rng(6)
    start = rng.integers(0, 40, 600)
    windows = (start[:, None] * 7 + np.arange(lm.WINDOW + 1) * 3) % 997
    before = lm.first_weights()
    after = lm.train(before, pairs, windows)
    valid = np.ones((600, lm.WINDOW), bool)
    loss = lambda w: lm.loss_and_gradient(w, pairs, windows[:, :-1], windows[:, 1:], valid)[0]
    assert loss(after) < loss(before) - 1


def test_every_id_is_a_training_target_once(encoding):
    end, docs = 50_300, {1: "x" * 3000, 2: "", 3: "\u6f22\u5b57" * 400, 4: "Donaudampfschifffahrt " * 90, None: "a b", 10: "held out?"}
    unit = np.arange(end + 1) % 30_000  # apart enough to tell the ids
    batch = pa.RecordBatch.from_arrays([pa.array(list(docs), pa.int64()), pa.array(list(docs.values()))], names=["doc_id", "text"])
    with open(PATH, "rb") as f:
        blob = types.SimpleNamespace(value=f.read())
    rows = [r for b in lm._training_windows(blob, PATTERN, end, unit, 3, 10, 0)([batch]) for r in b.to_pylist()]
    windows = np.concatenate([np.frombuffer(r["windows"], np.int16).reshape(-1, lm.WINDOW + 1) for r in rows])
    last = windows[:, 1 + lm.WINDOW - lm.STRIDE:]
    want = collections.Counter()
    for i, t in docs.items():
        if i is None or zlib.crc32(str(i).encode()) % 10:
            want.update(unit[[*encoding.encode_ordinary(" " + t.lower().strip() if t else ""), end]].tolist())
    assert collections.Counter(last[last >= 0].tolist()) == want


WORD = re.compile(rb"[^\x20\x09-\x0d]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def brute_base(texts):
    words = {i: [*WORD.findall((t or "").encode().translate(LOWER)), None] for i, t in texts.items()}
    counts = collections.Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return n, {i: (len(ws), sum(counts[w] > 0 for w in ws),
                   sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in words.items()}


def test_base_scores_match_brute_force(spark, small_dir, texts):
    tokens, want = brute_base(texts)
    rows = op8_lm_score(spark, small_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == (*want[r.doc_id][:2], tokens)
        assert r.base_score == pytest.approx(want[r.doc_id][2], rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.score < 0 and math.isfinite(r.score)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 1.2 * sum(r.base_score for r in held)


def test_held_out_scores_beat_the_base(spark, small_dir):
    held = op8_lm_score(spark, small_dir.replace("sf0.001", "sf0.01")).where("held_out").collect()
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_far_weights_give_finite_scores(model):
    vector, pairs, units = model
    logs, opening = lm.score_ids(vector * np.float32(300), pairs, units, np.arange(100), np.array([100]), 2999)
    assert np.isfinite(logs).all() and np.isfinite(opening).all()


def test_lm_of_odd_rows(odd_docs, no_docs):
    rows = lm.score_documents(odd_docs, PATH, PATTERN).collect()
    assert len(rows) == odd_docs.count() and all(math.isfinite(r.score) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1 and by[1].score == pytest.approx(by[2].score)
    assert by[4].n_tokens == 40_001 and by[None].held_out is False
    assert lm.score_documents(no_docs, PATH, PATTERN).count() == 0


def test_a_class_is_one_product_and_every_position_keeps_its_place(model, monkeypatch):
    """Log probabilities and gradients by the plain formula, position by
    position; nothing but the products of a class is done class by class."""
    vector, pairs, _ = model
    rng = np.random.default_rng(9)
    w = lm.split(vector.astype(np.float64))
    hidden, before, targets = rng.normal(size=(500, lm.DEPTH)), *rng.integers(0, lm.UNITS, (2, 500))
    targets[:100] = 7  # one class holds many, some hold none
    targets[targets // lm.MEMBERS == 3] = 0
    settled = []
    settle = lm._settle
    monkeypatch.setattr(lm, "_settle", lambda x: settled.append(len(x)) or settle(x))
    g = {}
    logs, back = lm.unit_log_probs(w, hidden, before, targets, pairs, g)
    assert settled == [500, 500]
    _, opening = lm.unit_log_probs(w, hidden, before, targets, pairs)
    want = {"cls": np.zeros(lm.SHAPES["cls"]), "cls_bias": np.zeros(lm.CLASSES),
            "member": np.zeros(lm.SHAPES["member"]), "member_bias": np.zeros(lm.SHAPES["member_bias"])}
    for i, (h, b, t) in enumerate(zip(hidden, before, targets)):
        c, m = divmod(t, lm.MEMBERS)
        p = np.exp(h @ w["cls"] + w["cls_bias"] + pairs[0][b])
        r = np.exp(h @ w["member"][c] + w["member_bias"][c] + pairs[1][b, c])
        p, r = p / p.sum(), r / r.sum()
        assert logs[i] == pytest.approx(np.log(p[c]) + np.log(r[m]), abs=1e-5)
        assert opening[i] == pytest.approx(np.log(p[:lm.OPENING].sum()), abs=1e-5)
        p[c] -= 1
        r[m] -= 1
        assert np.allclose(back[i], w["cls"] @ p + w["member"][c] @ r, atol=1e-5)
        want["cls"] += np.outer(h, p)
        want["cls_bias"] += p
        want["member"][c] += np.outer(h, r)
        want["member_bias"][c] += r
    assert all(np.allclose(g[k], want[k], atol=1e-4) for k in want)
