"""Formatted conversations, importance draws and whitening against plain readings."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import chat, importance, whitening

# --- conversations --------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, turns int, pieces int, formatted int, loss int, row int"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4, 5) for row in rows], TURNS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


HARD = [
    "", None, "<|im_end|>", "<\\|im_end|>\\", "<|im_sep|><\\\\|im_start|>user\nx", "<", "|im_end|>", "\\|", "a\nb\n\n", "<<|", "é😀<|",
    chat.HOSTILE, "\\e\\n\\p", "x" * 50_000 + "<|" * 1000, "\x00\x01", "<" + "\\" * 500,
]


def hard_turns(seed):
    chosen = random.Random(seed)
    rows = []
    for conv in [*range(25), None, -1]:
        for turn in range(chosen.randrange(1, 9)):
            rows.append((conv, chosen.choice([turn, turn, 1, None]),
                         chosen.choice(["user", "assistant", "assistant", "system", None, "a\nb|\\n\\p", "<|im_end|>"]),
                         chosen.choice(HARD)))
    rows += rows[:5]
    rows += [(99, i, "assistant" if i % 3 else "user", f"t{i}") for i in range(700)]
    chosen.shuffle(rows)
    return rows


def plain_turns(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns, key=lambda t: (*t[:2], t[2].encode(), t[3].encode()))]
            for conv, turns in found.items()}


@pytest.mark.parametrize("seed", range(2))
def test_conversations_read_back(spark, seed):
    rows = hard_turns(seed)
    want = plain_turns(rows)
    got = {r.conv_id: r for r in chat.digests(chat.formatted(conversations(spark, rows))).collect()}
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        learned = "".join(text for role, text in turns if role == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learned), sha(learned))


def test_formatted_text_and_mask(spark):
    rows = [(1, 2, "assistant", "é<|x"), (1, 0, "user", "hi"), (1, 1, "user", None), (1, 3, "assistant", "more")]
    row = chat.formatted(conversations(spark, rows)).first()
    assert row.formatted == ("<|im_start|>user\nhi<|im_sep|><|im_end|>\n"
                             "<|im_start|>assistant\né<\\|x<|im_sep|>more<|im_end|>\n")
    content = row.formatted.encode()
    assert [content[s.start:s.stop].decode() for s in row.loss] == ["é<\\|x", "more"]


def test_no_text_spells_a_control_string(spark):
    for row in chat.formatted(conversations(spark, hard_turns(5))).collect():
        marks = re.findall(r"<\|.*?\|>", row.formatted)
        assert set(marks) <= {chat.START, chat.SEPARATOR, chat.END}
        assert row.formatted.count(chat.START) == row.formatted.count(chat.END)


def test_hostile_conversation(spark):
    rows = chat.with_hostile(conversations(spark, []))
    row = chat.digests(chat.formatted(rows)).first()
    assert (row.conv_id, row.n_turns, row.loss_chars, row.loss_sha256) == (-1, 2, len(chat.HOSTILE), sha(chat.HOSTILE))
    assert chat.formatted(conversations(spark, [])).count() == 0


# --- importance ------------------------------------------------------------------

def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_buckets(text):
    found = plain_words(text)
    runs = [" ".join(found[i:i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)]
    return [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain_draw(docs, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_buckets(text))
    for text in target:
        t.update(plain_buckets(text))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))

    rows = []
    for key, text in docs:
        found = plain_buckets(text)
        weight = sum(map(gain, found))
        h = int(sha(f"42:{'' if key is None else key}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, len(plain_words(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return rows


def drawn_docs(seed):
    chosen = random.Random(seed)
    alphabet = ["Abc", "the", "THE", "x1", "Straße", "ÀÉ", "日本語", "q\x85z", "é", "7", "zz" * 300, " wide"]
    texts = ["", None, "  .,;", "one", "Two words", "a b c", "word " * 3000, "日" * 4000, "n b"]
    for _ in range(150):
        texts.append("".join(chosen.choice(alphabet) + chosen.choice([" ", "\n", ", ", "-", "\x00", "\t"])
                             for _ in range(chosen.randrange(60))))
    return list(enumerate(texts)) + [(4, "one"), (20, texts[20]), (None, texts[30]), (None, None)]


@pytest.mark.parametrize("piece", [importance.PIECE_BYTES, 50])
def test_resampled(spark, monkeypatch, piece):
    monkeypatch.setattr(importance._weights, "__defaults__", (piece,))
    monkeypatch.setattr(importance._counts, "__defaults__", (piece,))
    docs = drawn_docs(3)
    target = ["the Abc the", None, "x1 Straße 日本語", "zz a b"]
    rows = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in docs],
                                 "doc_id long, text string, weight int, bucket int, row int, place int").repartition(5)
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resampled(rows, benchmark)
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(map(tuple, plain_draw(docs, target)), key=order)


def test_pieces_give_the_same_runs():
    text = " ".join(f"w{i % 37} é{i}" for i in range(400)).encode()
    for bound in (1, 7, 100, 10**6):
        found = [importance.runs_of(parts) for parts in importance._blocks(iter([text, b"", text]), bound)]
        buckets = Counter((int(d), int(b)) for runs in found for doc, bucket in runs for d, b in zip(doc, bucket, strict=True))
        assert buckets == Counter((d, b) for d in (0, 2) for b in plain_buckets(text.decode()))


def test_crc_matrices():
    chosen = random.Random(1)
    rows = [bytes(chosen.randrange(256) for _ in range(chosen.choice([0, 1, 2, 9, 9, 600]))) for _ in range(300)]
    content = np.frombuffer(b"".join(rows), np.uint8)
    lengths = np.array([len(r) for r in rows])
    assert importance.crc_rows(content, np.cumsum(lengths) - lengths, lengths).tolist() == [zlib.crc32(r) for r in rows]


def test_ranks_of_equal_scores_and_of_nothing(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 7).alias("doc_id"), F.lit(20).alias("n_words"), F.lit(1).alias("n_features"),
        F.lit(1).alias("weight"), F.lit(5).alias("score"),
    )
    got = importance.ranked(rows).where("rank is not null").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 51)) and {r.doc_id for r in got} == {0}
    assert importance.ranked(rows.where("false")).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resampled(docs, docs).count() == 0


# --- whitening -------------------------------------------------------------------

def plain_whitened(vectors, most=16):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    centred = distinct - distinct.mean(axis=0)
    v = centred.T @ centred / len(distinct)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    deviation = [sum((len(distinct) * int(a) - int(s)) ** 2 for a, s in zip(row, distinct.sum(axis=0), strict=True)) for row in x]
    return len(distinct), deviation, (x - distinct.mean(axis=0)) @ vectors / np.sqrt(values), values / np.trace(v)


KINDS = "vec_id long, embedding array<float>, label int, x int, width int, n int, row int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, 4) for i, v in rows], KINDS)


def test_whitened(spark):
    chosen = np.random.default_rng(2)
    mixed = chosen.normal(size=(500, 24)) * np.linspace(3, 0.2, 24) @ chosen.normal(size=(24, 24))
    sound = [[float(np.float32(a)) for a in row] for row in mixed / 10]
    sound += sound[:40] + [sound[0]] * 300
    rows = list(enumerate(sound)) + [(None, sound[1]), (3, sound[9])]
    bad = [(1000, None), (1001, [None] * 24), (1002, [float("nan")] * 24), (1003, [float("inf")] * 24), (1004, [])]
    got = whitening.whitened(vectors_of(spark, rows + bad).repartition(6)).collect()
    n, deviation, white, share = plain_whitened([v for _, v in rows])
    assert len(got) == len(rows) * 16 and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    signs = None
    for i, (key, _) in enumerate(rows):
        own = [by_row[key, deviation[i]][c] for c in range(1, 17)]
        found = np.array([r.whitened for r in own])
        if signs is None:
            signs = np.sign(found * white[i])
        np.testing.assert_allclose(found * signs, white[i], atol=1e-8)
        np.testing.assert_allclose([r.explained for r in own], share, rtol=1e-10)


def test_whitening_without_variance_far_entries_and_widths(spark):
    one = whitening.whitened(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [
        (c, 1, 0, None, 0.0) for _ in range(2) for c in (1, 2)]
    two = whitening.whitened(vectors_of(spark, [(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0]), (5, [7.0])])).collect()
    assert {(r.vec_id, r.component, r.n) for r in two} == {(1, 1, 2), (1, 2, 2), (1, 3, 2), (2, 1, 2), (2, 2, 2), (2, 3, 2), (5, 1, 1)}
    assert {r.vec_id: round(abs(r.whitened), 12) for r in two if r.component == 1 and r.vec_id < 5} == {1: 1.0, 2: 1.0}
    assert all(r.whitened is None for r in two if r.component > 1)
    far = whitening.whitened(vectors_of(spark, [(1, [1e30, 0.0]), (2, [-3e38, 1.0]), (3, [0.5, 0.5])])).collect()
    assert {r.deviation for r in far if r.vec_id == 1} == {None}
    assert all(math.isfinite(r.whitened) for r in far if r.component == 1)
    assert whitening.whitened(vectors_of(spark, [])).count() == 0
    assert whitening.whitened(vectors_of(spark, [(1, None)])).count() == 0


@pytest.mark.parametrize("values", [
    np.linspace(5, 1, 30), np.repeat([4.0, 4.0, 1.0], 10), np.r_[np.ones(3), np.zeros(20)],
    np.r_[1.0, 1.0 + 1e-13, 1.0 - 1e-13, np.linspace(0.5, 0.1, 20)], 10.0 ** -np.arange(25.0), np.zeros(20),
])
def test_leading_eigenvalues(values):
    q, _ = np.linalg.qr(np.random.default_rng(4).normal(size=(len(values), len(values))))
    v = q * values @ q.T
    v = (v + v.T) / 2
    found, vectors = whitening.leading(v)
    scale = max(values.max(), 1e-300)
    np.testing.assert_allclose(found, np.sort(values)[::-1][:16], atol=1e-13 * scale)
    np.testing.assert_allclose(vectors @ vectors.T, np.eye(16), atol=1e-12)
    assert np.abs(v @ vectors.T - vectors.T * found).max() <= 1e-13 * scale


def test_inertia_counts():
    a = np.random.default_rng(1).normal(size=(40, 40))
    v = a @ a.T
    values = np.linalg.eigvalsh(v)
    inertia = whitening.Inertia(v)
    for shift in [-1.0, 0.5, 3.0, 20.0, 70.0, 1e4, *((values[1:] + values[:-1]) / 2).tolist()]:
        assert inertia.above(shift) == int((values > shift).sum())


def test_sums_keep_wide_numbers():
    x = np.array([[1 << 53, -(1 << 53)], [(1 << 53) - 1, 5]], np.int64)
    lists = pa.array(x.tolist(), pa.list_(pa.int64()))
    rows = [r for batch in whitening._sums([pa.RecordBatch.from_arrays([lists], ["x"])]) for r in batch.to_pylist()]
    assert [(r["high"] << 32) + r["low"] for r in rows] == [sum(c) for c in zip(*x.tolist(), strict=True)]
