"""Token alignment against whole-text tokenisation and plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import hard
from seriesprep.llm import token_align as ta

A_PATH, B_PATH = f"{ta.FOLDER}/{ta.BYTES_FILE}", f"{ta.FOLDER}/{ta.PIECES_FILE}"
TRICKY = [
    "a  b   c", " lead", "trail ", "x\n y \tz", "it's I'll don't 's", "<|endoftext|> <s> </s> <0x0A> <unk>", "ﬁ é é ½ ①", "a▁b", "x ▁ y", "▁",
    "日本語 テキスト です", "🙂 🙂🙂 👩‍👩‍👧", "a b   c", "\x00 \x01z", "tab\tnew\r\nline", " ", "   ", "1234 5,678.90", "​ zero‍ width", "Ünïcödé ÇA", "a \u0085 b",
]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH), {i: t for t, i in a.get_vocab().items()}, ta.byte_symbols()


def groups_of(tools, text):
    """Groups as pairs of id lists, from the whole text; None without tokens."""
    a, b, names, symbols = tools
    if not text:
        return None
    whole = b" " + text.encode()
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ba = [bytes(symbols[c] for c in names[i]) for i in ia]
    bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
    if b"".join(ba) != whole or b"".join(bb) != whole:
        return None
    out, i, j, na, nb = [([], [])], 0, 0, 0, 0
    while i < len(ia) or j < len(ib):
        if na == nb and (out[-1][0] or out[-1][1]):
            out.append(([], []))
        if na <= nb and i < len(ia):
            out[-1][0].append(ia[i])
            na += len(ba[i])
            i += 1
        else:
            out[-1][1].append(ib[j])
            nb += len(bb[j])
            j += 1
    return out


def plain(tools, rows):
    all_groups = [groups_of(tools, t) for _, t in rows]
    count = Counter(p for g in all_groups if g for p in {(x, y) for left, right in g for x in left for y in right})
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (i, _), g in zip(rows, all_groups, strict=True):
        if not g:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for left, right in g for x in left for y in right]
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in g)
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links),
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out, count


def check(spark, tools, rows):
    got, counts = ta.align_corpus(hard.table(spark, rows))
    want, pairs = plain(tools, rows)
    hard.same(got.collect(), want)
    assert {(r["a"], r["b"]): r["count"] for r in counts.collect()} == dict(pairs)


def test_hard_rows(spark, tools):
    check(spark, tools, hard.ROWS + [(100 + k, t) for k, t in enumerate(TRICKY)])


def test_small_chunks_pieces_and_caches(spark, tools, monkeypatch):
    monkeypatch.setattr(ta, "CHUNK_CHARS", 300)
    monkeypatch.setattr(ta, "PIECE_CHARS", 40)
    monkeypatch.setattr(ta, "KNOWN_UNITS", 20)
    rng = random.Random(1)
    words = "the und 🙂 été a▁b x\n\ny  double naïve 12,5 l'eau don't — … \t".split(" ")
    rows = [(k, rng.choice([" ", "  ", " "]).join(rng.choices(words, k=rng.randrange(40)))) for k in range(120)]
    check(spark, tools, rows + [(k + 500, t) for k, t in rows[:30]] * 2)


def test_units_equal_whole_texts(tools):
    rng = random.Random(5)
    own = ta.Aligner(A_PATH, B_PATH)
    assert own.cuts
    letters = list("abcEé ß日🙂'.,;-_<>0123\n\t\r\x00\x1c\x85  ▁") + [" "] * 12 + ["the", "'s", "ing", "</s>", "  "]
    texts = ["".join(rng.choices(letters, k=rng.randrange(1, 30))) for _ in range(3000)]
    for text, found in zip(texts, own.of_texts(texts), strict=True):
        want = groups_of(tools, text)
        assert (found is None) == (want is None), repr(text)
        if want:
            joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want)
            assert found[2] == hashlib.sha256(joined.encode()).hexdigest(), repr(text)


def test_empty_and_tokenless_tables(spark):
    out, counts = ta.align_corpus(hard.table(spark, []))
    assert out.count() == 0 and counts.count() == 0
    assert out.columns == ["doc_id", *ta.MEASURES, "groups_sha256"]
    none, _ = ta.align_corpus(hard.table(spark, [(1, None), (2, ""), (None, "a▁b")]))
    hard.same(none.collect(), [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, None)])


def test_no_unbounded_group_in_the_plan(spark):
    docs = hard.table(spark)
    texts = ta.distinct_texts(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in texts and "SortAggregate" not in texts and "collect" not in texts


def test_a_chunk_takes_little_more_than_its_text():
    rng = random.Random(8)
    known = ["".join(rng.choices("aeioubcdlmnrst", k=rng.randrange(2, 9))) for _ in range(20_000)]
    texts = [" ".join(rng.choices(known, k=400)) for _ in range(200)]
    row = ta._chunk(ta.aligner(A_PATH, B_PATH), texts, [1] * len(texts), [1] * len(texts))
    assert row.num_rows == 1 and row.nbytes < 1.5 * sum(map(len, texts))


@pytest.mark.parametrize(("most", "width"), [(0, 1), (255, 1), (256, 2), (65_536, 4), (1 << 32, 8)])
def test_packed_numbers_come_back(most, width):
    values = np.array([0, 1, most], np.int64)
    assert len(ta.pack(values)) == 1 + 3 * width and ta.unpack(ta.pack(values)).tolist() == values.tolist()
    assert ta.unpack(ta.pack(values[:0])).tolist() == []
