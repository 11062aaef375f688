"""Alignments against plain sets of ends and the libraries' own calls."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tributary.llm import align
from tributary.llm.bpe import byte_letters

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "\n", "\n\n x \t y", "The quick brown fox", "<|endoftext|> and <s> </s> <unk> <0x41>", "naïve café 東京タワー 🙂👩‍👩‍👧", "a▁b", "▁", "x" * 3000,
    " " * 700, "a" + "\n" * 600 + "b", "ab " * 4000, "\x00\x01 z", "1234567890 12 3", "it's we'll DON'T", "trailing ", " leading", "é\u0301", "\u3000wide\u00a0space\u2028", "The quick brown fox",
    "漢字かな交じり文" * 40, "http://www.example.org/a?b=c&d=%20", "مرحبا بالعالم",
]


@pytest.fixture(scope="module")
def tools():
    library = Tokenizer.from_file(PATHS[0])
    library.encode_special_tokens = True
    return library, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens(tools, text):
    library, pieces = tools
    if not text:
        return [], [], [], []
    letters = byte_letters()
    a = library.encode(" " + text, add_special_tokens=False).ids
    raw_a = [bytes(letters[c] for c in library.id_to_token(i)) for i in a]
    b = pieces.encode(text)
    raw_b = []
    for i in b:
        piece = pieces.id_to_piece(i)
        raw_b.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    whole = (" " + text).encode()
    return (a, b, raw_a, raw_b) if b"".join(raw_a) == whole == b"".join(raw_b) else ([], [], [], [])


def plain_groups(raw_a, raw_b):
    ends_a, ends_b = (np.cumsum([len(t) for t in raw]).tolist() for raw in (raw_a, raw_b))
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        out.append((i, x, j, y))
        i, j = x, y
    return out


def plain(tools, rows):
    found = []
    for key, text in rows:
        a, b, raw_a, raw_b = tokens(tools, text)
        groups = plain_groups(raw_a, raw_b)
        links = Counter((x, y) for i, m, j, n in groups for x in a[i:m] for y in b[j:n])
        found.append((key, a, b, groups, links))
    docs = Counter(p for *_, links in found for p in links)
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for key, a, b, groups, links in found:
        shown = ";".join(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])) for i, m, j, n in groups)
        out.append((
            key, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if docs[p] == most[p[0]]),
            sum(n * docs[p] for p, n in links.items()), hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    return sorted(out, key=str), docs


def made(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, key string, row int")


@pytest.mark.parametrize("head", [align.HEAD, 40, 0])
def test_equals_plain_sets(spark, tools, monkeypatch, head):
    monkeypatch.setattr(align, "HEAD", head)
    rng = random.Random(5)
    words = ["the", "of", "Interesting", "tokenization", "naïve", "東京", "12,345", "\n", "  ", "don't", "x" * 30, "ünïcödé"]
    rows = list(enumerate(TEXTS)) + [(100 + k, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for k in range(60)] + [(3, "again"), (None, "no id"), (None, "no id")]
    found = align.Alignment(made(spark, rows).repartition(5), *PATHS)
    want, docs = plain(tools, rows)
    assert sorted(map(tuple, found.digests().collect()), key=str) == want
    assert {(r.a, r.b): r.docs for r in found.pair_table().collect()} == docs
    assert found.digests().columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_wide_groups_are_counted_by_their_ids(spark, tools, monkeypatch):
    monkeypatch.setattr(align, "WIDE_GROUP", 2)
    rows = [(k, t) for k, t in enumerate(TEXTS) if t is None or len(t) < 4000]
    assert sorted(map(tuple, align.Alignment(made(spark, rows), *PATHS).digests().collect()), key=str) == plain(tools, rows)[0]


def test_small_slices_and_parts(spark, tools, monkeypatch):
    for name, value in (("SLICE_BYTES", 10), ("COUNTED", 16), ("EMITTED", 3)):
        monkeypatch.setattr(align, name, value)
    rows = [(k, t) for k, t in enumerate(TEXTS) if t is None or len(t) < 500]
    for head in (align.HEAD, 10):
        monkeypatch.setattr(align, "HEAD", head)
        assert sorted(map(tuple, align.Alignment(made(spark, rows), *PATHS).digests().collect()), key=str) == plain(tools, rows)[0]


def test_stretches_of_random_ends():
    rng = random.Random(11)
    for _ in range(400):
        last = rng.randint(1, 300)
        ends = [np.array(sorted({*rng.sample(range(1, last + 1), rng.randint(1, last)), last}), dtype="<u4") for _ in range(2)]
        if rng.random() < 0.3:
            ends[1] = ends[0]
        apart = align.groups_apart(*ends)
        numbers = [align.group_numbers(len(e), apart[:, k], apart[:, k + 1]) for e, k in zip(ends, (0, 2), strict=True)]
        bounds = [np.searchsorted(x, np.arange(x[-1] + 2)).tolist() for x in numbers]
        got = list(zip(bounds[0], bounds[0][1:], bounds[1], bounds[1][1:], strict=False))
        sizes = [np.diff(e.astype(int), prepend=0).tolist() for e in ends]
        assert got == plain_groups(*([b"x" * n for n in s] for s in sizes))


def test_spans_and_empty_table(spark, tools):
    rows = [(k, t) for k, t in enumerate(TEXTS) if t is None or len(t) < 500]
    got = {r.doc_id: [tuple(g) for g in r.groups] for r in align.group_spans(made(spark, rows), *PATHS).collect()}
    assert got == {k: plain_groups(*tokens(tools, t)[2:]) for k, t in rows}
    none = made(spark, [])
    assert align.Alignment(none, *PATHS).digests().count() == 0 and align.group_spans(none, *PATHS).count() == 0


def test_the_quick_library_gives_the_same_ids(tools):
    side = align.ByteLevel(PATHS[0])
    texts = [t for t in TEXTS if t]
    assert side._quick is not None
    ids = lambda found: [x.tolist() for x in found]
    assert ids(side.encode(texts)) == [tools[0].encode(t, add_special_tokens=False).ids for t in texts]
    assert ids(side.encode([t])[0] for t in texts) == [tools[0].encode(t, add_special_tokens=False).ids for t in texts]
