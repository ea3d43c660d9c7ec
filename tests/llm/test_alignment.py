"""Alignment of two tokenizers against the libraries and a plain scan over the bytes."""

import hashlib
import json
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gradeloom.llm import alignment
from gradeloom.llm.alignment import Csr
from gradeloom.llm.token_files import load_tokenizer

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "a ", "  two  spaces  ", "\n", "a\n\n b\t c", "it's we're o'clock", "<|endoftext|> <s> </s> <0x41> <unk>",
    "x ▁ y", "▁", "\x00 nul", "été naïve Straße", "数学 は 楽しい", "👩‍👩‍👧 z", "é ﻿ ​ 　  x", "1234567890 12", "word " * 3000,
    "x" * 5000, "ab" * 3000 + " end", "it's we're o'clock", "a",
]


def libraries():
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=RIGHT)


def left_bytes():
    letters = {c: b for b, c in enumerate(alignment_letters())}
    with open(LEFT, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    return {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if all(c in letters for c in token)}


def alignment_letters():
    """Each byte's letter, read off the library: what it writes for each byte."""
    from tokenizers.pre_tokenizers import ByteLevel

    out = {}
    for point in [*range(0x80), *range(0x80, 0x800), *range(0x800, 0x110000, 0x1000)]:
        if 0xD800 <= point < 0xE000:
            continue
        raw = chr(point).encode()
        word = "".join(w for w, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(point)))
        out |= dict(zip(raw, word))
    return [out.get(b, b) for b in range(256)]  # some bytes occur in no text


def brute(rows):
    """What the contract says of ``(doc_id, text)`` rows, text by text."""
    left, right = libraries()
    a_bytes = left_bytes()

    def b_bytes(i):
        piece = right.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()

    found, holders = [], Counter()
    for doc_id, text in rows:
        found.append((doc_id, None))
        if not text:
            continue
        whole = (" " + text).encode()
        a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
        sides = [[f(i) for i in ids] for f, ids in ((a_bytes.__getitem__, a), (b_bytes, b))]
        if any(b"".join(s) != whole for s in sides):
            continue
        ends = [np.cumsum([len(t) for t in s]).tolist() for s in sides]
        links, groups, i, j, start = [], [], 0, 0, (0, 0)
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append((a[start[0] : i], b[start[1] : j]))
                start = i, j
        holders.update(set(links))
        found[-1] = doc_id, (len(a), len(b), groups, links)
    best = {}
    for (a, _), n in holders.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for doc_id, got in found:
        if got is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        n_a, n_b, groups, links = got
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(holders[x] == best[x[0]] for x in links), sum(holders[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest(), sum(len(p) * len(q) for p, q in groups)))
    return out, holders


@pytest.fixture(scope="module")
def models():
    return load_tokenizer(LEFT), alignment.load_pieces(RIGHT)


@pytest.mark.parametrize("block_bytes", [1, 8 << 20])
def test_odd_texts(spark, models, block_bytes):
    rows = [(None if k == 3 else k // 2, t) for k, t in enumerate(TEXTS)]
    table = [(i, t, "x", 1) for i, t in rows]
    docs = spark.createDataFrame(table, "doc_id bigint, text string, block string, pairs int").repartition(3)
    want, _ = brute(rows)
    got = alignment.align_documents(docs, *models, block_bytes=block_bytes).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(r["n_a"] > 0 for r in got) > 15 and any(r["n_a"] == 0 for r in got)


def test_whole_table_against_the_libraries(spark, sf_dir, models):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want, holders = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(tuple(r) for r in alignment.align_documents(docs, *models).collect()) == sorted(want)
    pairs = {(r["a"], r["b"]): r["n"] for r in alignment.vocabulary_links(docs, *models).collect()}
    assert pairs == holders


def test_empty_table(spark, models):
    assert alignment.align_documents(spark.createDataFrame([], "doc_id bigint, text string"), *models).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab  '▁\n\té数👩　.1<s>"), max_size=40))
def test_words_stand_alone(text):
    """Encoding word by word gives what the model gives for the whole text."""
    _, right = libraries()
    data, borders = alignment.spaced(pa.array([text]))
    cuts, _ = alignment.space_words(data, borders)
    words = [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    if text and "▁" not in text:
        assert [i for w in alignment.piece_encoder(alignment.load_pieces(RIGHT))(words) for i in w] == right.encode(text)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_row_products(seed):
    rng = np.random.default_rng(seed)
    rows, inner, width = rng.integers(1, 9, 3)
    left, right = (rng.integers(0, 3, (a, b)) * (rng.random((a, b)) < 0.4) for a, b in ((rows, inner), (inner, width)))

    def csr(dense):
        r, c = np.nonzero(dense)
        return Csr(np.searchsorted(r, np.arange(len(dense) + 1)), c, dense[r, c], dense.shape[1])

    def dense(m):
        out = np.zeros((len(m.starts) - 1, m.width), np.int64)
        out[m.row_of(), m.columns] = m.values
        return out

    assert (dense(csr(left) @ csr(right)) == left @ right).all()
    assert (dense(csr(left).transposed()) == left.T).all()
    assert (csr(left).product_sizes(csr(right)) == ((left > 0).astype(int) @ (right > 0)).sum(axis=1)).all()


def test_links_count_common_bytes_and_groups_give_all_their_pairs(models):
    found = alignment.Aligner(*models).align(pa.array(["unbelievable été 数学", None, "internationalisation"]))
    a = np.array([len(t) for t in alignment.left_tokens(models[0])])[found.left]
    assert np.add.reduceat(found.links.values, found.links.starts[:-1]).tolist() == a.tolist()
    shared = found.shared_group_links()
    want = [(i, j) for i, g in enumerate(found.left_group) for j, h in enumerate(found.right_group) if g == h]
    assert list(zip(shared.row_of(), shared.columns)) == want
    assert found.shared_group_counts().sum() == len(want)
    overlap = set(zip(found.links.row_of().tolist(), found.links.columns.tolist()))
    assert overlap <= {(int(i), int(j)) for i, j in want}
