import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paperloom.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "it's we'LL x's", "a<|endoftext|>b <|startoftext|>", "a\x1cb c\x85d\xa0e", "NAÏVE café é İ Σ ΟΔΟΣ ß ﬁ", "12³½ 东京 x_y--z", "'''s ​ ﻿", "w" * 3000, "BELEDİYESİ, İ. İi! aİ\u0301 xİ;İ İ\u0307?", "İSTANBUL\u2019da"]


def test_ids_are_the_tokenizers():
    tok, own = Tokenizer.from_file(PATH), P.tokens_of(PATH)
    for text in ODD:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    own = P.tokens_of(PATH)
    assert own.encode(text) == own._encoded(text)


def test_ids_over_all_scripts():
    r, own = random.Random(31), P.tokens_of(PATH)
    blocks = [(0x20, 0x7F), (0xA0, 0x250), (0x250, 0x590), (0x590, 0x900), (0x900, 0x1000), (0x1E00, 0x2100), (0x2100, 0x3000), (0x3000, 0x3400), (0x4E00, 0x5200), (0xAC00, 0xAD00), (0xFB00, 0xFFF0), (0x1F300, 0x1F700)]
    odd = "İıſßŉǰẞÅΣς'.,;:!?-_ \u0301\u0307\u200d\ufeff"
    for _ in range(20_000):
        low, high = r.choice(blocks)
        text = "".join(r.choice(odd) if r.random() < 0.3 else chr(r.randrange(low, high)) for _ in range(r.randrange(1, 12)))
        assert own.encode(text) == own._encoded(text), ascii(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    free, expected = [], []
    for n in lengths:  # all windows looked at
        fits = [(f, -i) for i, f in enumerate(free) if f >= n]
        if fits:
            f = min(fits)[0]
            expected.append(f - n)
            free.remove(f)
            free.append(f - n)
        else:
            expected.append(64 - n)
            free.append(64 - n)
    left, got = {}, []
    for n, (window, offset) in zip(lengths, P.best_fit_decreasing(lengths, 64), strict=True):
        assert offset == 64 - left.get(window, 64)
        left[window] = left.get(window, 64) - n
        got.append(left[window])
    assert got == expected


def test_packs_everything(docs, prose):
    rows = [(i, prose(i, 5 + 37 * i)) for i in range(40)] + [(100, None), (101, ""), (None, "x"), (5, prose(5, 5 + 37 * 5)), (200, prose(3, 9000))] + [(300 + i, t) for i, t in enumerate(ODD)]
    found = P.pack_documents(docs(rows), PATH).collect()
    tok = Tokenizer.from_file(PATH)
    asked, given_, windows = defaultdict(int), defaultdict(int), defaultdict(list)
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        for s in range(0, len(ids), 4096):
            asked[doc_id, s, tuple(ids[s : s + 4096]), len(ids)] += 1
    for r in found:
        given_[r["doc_id"], r["start"], tuple(r["ids"]), r["doc_tokens"]] += 1
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert asked == given_
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r["length"] for r in found)
    assert 4096 * len(windows) - total < 4096 * 2


def test_checksums_and_empty(docs):
    r = P.pack_documents(docs([(1, "some words")]), PATH, payload="ids_crc32").first()
    ids = Tokenizer.from_file(PATH).encode("some words", add_special_tokens=False).ids + [2]
    assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert P.pack_documents(docs([]), PATH).count() == 0


def test_repeated_rows_and_long_documents(docs, prose):
    base = prose(2, 60_000)
    rows = [(1, "same words again")] * 10_000 + [(2 + k, base[k:]) for k in range(6)] + [(None, None)] * 50 + [(100 + k, prose(k, 30)) for k in range(200)]
    found = P.pack_documents(docs(rows), PATH, payload="ids_crc32", group=64).collect()
    lengths, windows = defaultdict(int), defaultdict(list)
    for x in found:
        lengths[x["doc_id"]] += x["length"]
        windows[x["sequence_id"]].append((x["offset"], x["length"]))
    tok = Tokenizer.from_file(PATH)
    count = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids) + 1
    asked = defaultdict(int)
    for i, t in rows[10_000:]:
        asked[i] += count(t)
    asked[1] = 10_000 * count("same words again")
    assert lengths == asked
    for w in windows.values():
        ends = [0, *(o + n for o, n in sorted(w))]
        assert [o for o, _ in sorted(w)] == ends[:-1] and ends[-1] <= 4096


@pytest.mark.parametrize("groups", [1, 7])
def test_groups_have_their_own_windows(spark, groups):
    pieces = spark.createDataFrame([(i, 0, 1000 + i, 1000 + i) for i in range(100)], "doc_id long, start long, length long, doc_tokens long")
    found = P.pack(pieces, groups).collect()
    assert len(found) == 100
    assert len({r["sequence_id"] >> 32 for r in found}) == groups


def test_parts_by_the_merges_alone(tmp_path):
    """Every Latin letter and mark, alone and among others, has the ids that the whole tokenizer gives; few parts go through all its steps."""
    import public_tokenizers

    words = P.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    whole = words._encoded
    letters = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA0, 0x130), *range(0x131, 0x250)]]
    texts = [x for c in letters for x in (c, f"a{c}b", f"{c}{c}", f"tra{c}tion.", f"{c.upper()}E{c}", f"«{c}»")] + ["\x01\x02", "a\x7fb", "soft\xadhyphen", "it's THE naïve Łódź... 1984!"]
    asked = []
    words._encoded = lambda text: asked.append(text) or whole(text)
    for t in texts:
        assert words.encode(t) == whole(t), t
    assert len(asked) < len(texts) / 10
