"""Byte-level BPE and the alignment of two tokenizers, against the libraries and plain versions."""

import base64
import collections
import functools
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from ledgerline.llm import alignment, byte_bpe
from ledgerline.llm.alignment import Stream

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, ids string, decoded string, block string, text_no int, pairs int"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def texts():
    rng = random.Random(5)
    words = ["the", "Wörter", "naïve", "été", "niño", "日本語", "x1", "don't", "we'll", "<|endoftext|>", "<s>", "😀", "á", "՘", "!?!"]
    mixed = ["".join(rng.choice([*words, " ", "  ", "\n", "\t", "\r\n", " ", "　"]) for _ in range(n)) for n in (3, 40, 400)]
    return [
        "", None, " ", "   \n\n ", "a", "ab", "▁", "a▁b", "\x00", "՘a֋1࢏", "x" * 3000, "ab" * 700,
        " " * 900, "\n" * 300, "é" * 400, "the end", "the end", " lead and trail ", "1234567890" * 30, *mixed,
        "".join(chr(c) for c in range(1, 3000) if not 0xD800 <= c < 0xE000), " ".join(rng.choice(words) for _ in range(9000)),
    ]


def docs(spark, own):
    rows = [(None if i % 9 == 8 else i, t, "x", "y", "z", -1, -2) for i, t in enumerate(own)]
    return spark.createDataFrame(rows, DOCS)


@functools.cache
def encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# -- 11 --------------------------------------------------------------------------------------------


def test_ids_are_those_of_the_library(spark):
    own = texts()
    found = byte_bpe.encode(docs(spark, own), RANKS, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "block", "text_no", "pairs", "ids", "decoded"]
    rows = found.collect()
    assert len(rows) == len(own)
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == encoding().encode_ordinary(text), text[:50]
        assert bytes(r["decoded"]) == text.encode()
    want = collections.Counter(
        (len(e), sha(",".join(map(str, e)).encode()), sha((t or "").encode()))
        for t in own
        for e in [encoding().encode_ordinary(t or "")]
    )
    report = byte_bpe.report(docs(spark, own), RANKS, public_tokenizers.PATTERN).collect()
    assert collections.Counter((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in report) == want


def test_merges_alike_and_alone_agree_with_plain_merging():
    ranks = {bytes([b]): b for b in range(256)}
    rng = random.Random(3)
    while len(ranks) < 330:  # tokens over two letters, so that ties and shared neighbours abound
        one, two = rng.choice(list(ranks)[97:99] + list(ranks)[256:]), rng.choice(list(ranks)[97:99] + list(ranks)[256:])
        ranks.setdefault(one + two, len(ranks))

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    words = byte_bpe.Vocabulary(ranks)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 90))) for _ in range(400)]
    want = [[ranks[p]] if p in ranks else plain(p) for p in pieces]
    assert byte_bpe.merge_all(pieces, words) == want
    assert [byte_bpe.merge(p, ranks) for p in pieces if p not in ranks] == [w for p, w in zip(pieces, want, strict=True) if p not in ranks]
    assert byte_bpe.merge_alike(pieces[:50], 128, words) == [plain(p) for p in pieces[:50]]


def test_empty_table_has_no_ids(spark):
    assert byte_bpe.report(docs(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


# -- 12 --------------------------------------------------------------------------------------------


@functools.cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def both(text):
    """(id, start, end) of both tokenizers, or nothing."""
    a, b = libraries()
    signs = alignment._byte_of_sign()
    spelled = [
        [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
        [
            (i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
            for i in b.encode(text)
        ],
    ]
    if not text or any(b"".join(t for _, t in s) != (" " + text).encode() for s in spelled):
        return [], []
    out = []
    for s in spelled:
        at, own = 0, []
        for i, t in s:
            own.append((i, at, at + len(t)))
            at += len(t)
        out.append(own)
    return out


def plain_groups(a, b):
    out, cuts = [], sorted({e for *_, e in a} & {e for *_, e in b})
    for low, high in zip([0, *cuts], cuts, strict=False):
        out.append("|".join(",".join(str(i) for i, _, e in s if low < e <= high) for s in (a, b)))
    return out


def plain_links(a, b):
    return [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)] if len(a) < 4000 else swept(a, b)


def swept(a, b):
    out, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            out.append((i, b[k][0]))
            k += 1
    return out


@pytest.fixture(scope="module")
def models():
    return alignment.read_models(A, B, public_tokenizers.PATTERN)


@pytest.mark.parametrize("width", [300, 1 << 15])
def test_alignment_equals_a_plain_one(spark, models, width):
    own = texts()
    streams = [both(t or "") for t in own]
    rows = sorted(alignment.align(docs(spark, own).coalesce(1), models, width=width, block_bytes=20_000).collect())
    assert len(rows) == len(own)
    size = models.load()[1].size
    for r, (a, b) in zip(rows, streams, strict=True):
        groups, links = plain_groups(a, b), plain_links(a, b)
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (len(a), len(b), len(groups), len(links))
        assert r["groups"] == ";".join(groups)
        assert dict(zip(r["pairs"], r["times"], strict=True)) == collections.Counter(i * size + j for i, j in links)


@pytest.mark.parametrize("own", [[None, ""], ["the end of the day, \u65e5\u672c " * 4], ["so it ends " * 40_000]])
def test_a_batch_of_long_or_empty_texts_alone_is_aligned(spark, models, own):
    width = 32 if len(own[0] or "") < 1000 else 1 << 15
    rows = sorted(alignment.align(docs(spark, own).coalesce(1), models, width=width).collect())
    assert len(rows) == len(own)
    for r, t in zip(rows, own, strict=True):
        a, b = both(t or "")
        groups, links = plain_groups(a, b) if len(a) < 1000 else None, plain_links(a, b)
        assert (r["n_a"], r["n_b"], r["n_links"], sum(r["times"])) == (len(a), len(b), len(links), len(links))
        assert groups is None or r["groups"] == ";".join(groups)


def test_report_counts_pairs_by_document(spark, models):
    own = texts()[:-1] + ["the end of the day", "the end of a day", "the end"]
    links = [plain_links(*both(t or "")) for t in own]
    counts = collections.Counter(p for own_links in links for p in set(own_links))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    want = collections.Counter(
        (len(x), sum(counts[p] == top[p[0]] for p in x), sum(counts[p] for p in x)) for x in links
    )
    found = alignment.report(docs(spark, own).repartition(3), models).collect()
    assert collections.Counter((r["n_links"], r["n_best"], r["count_sum"]) for r in found) == want
    assert {r["groups_sha256"] for r in found if r["n_a"] == 0} == {""}
    assert alignment.report(docs(spark, []), models).count() == 0


def test_ids_of_texts_that_end_in_spaces_are_those_of_the_libraries(models):
    own = ["a ", "a  ", " a ", " ", "  ", "\n ", "\t\n  ", "日本 ", "<s> ", "a b  c ", "\u00a0 ", "\u3000 "]
    a, b, _ = models.load()
    for found, want in (
        (a.encode([" " + t for t in own]), [libraries()[0].encode(" " + t, add_special_tokens=False).ids for t in own]),
        (b.encode([" " + t for t in own]), libraries()[1].encode(own)),
    ):
        ids, count = found
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == want


def test_composition_of_fragments_is_associative(models):
    a_model, b_model, spelling = models.load()
    rng = random.Random(8)
    for _ in range(30):
        n = rng.randrange(4, 60)
        streams = []
        for size in (a_model.size, b_model.size):
            ends = sorted(rng.sample(range(1, n), rng.randrange(0, n - 1))) + [n]
            streams.append(Stream(np.array([rng.randrange(size) for _ in ends], np.int32), np.array(ends, np.int64)))
        cuts = [0, *sorted(rng.sample(range(1, n), min(n - 1, 5))), n]
        parts = [spelling.fragment(*(s.part(x, y) for s in streams)) for x, y in zip(cuts, cuts[1:], strict=False)]

        def reduced(own, pick):
            own = list(own)
            while len(own) > 1:
                i = pick(len(own) - 1)
                own[i : i + 2] = [spelling.compose(own[i], own[i + 1])]
            return spelling.whole(own[0])

        want = spelling.closed(*streams)
        for pick in (lambda k: 0, lambda k: k - 1, rng.randrange):
            got = reduced(parts, pick)
            assert got.text == want.text and (got.groups, got.links) == (want.groups, want.links)
            assert got.pairs.tolist() == want.pairs.tolist() and got.times.tolist() == want.times.tolist()


def test_the_faster_library_merges_as_the_file_says(models):
    """Every token of A is reached by its own merges, so pairs of one spelling are one pair."""
    a = models.load()[0]
    library = libraries()[0]
    signs = {v: k for k, v in alignment._byte_of_sign().items()}
    for token, i in a.fast._mergeable_ranks.items():
        assert [t.id for t in library.model.tokenize("".join(signs[b] for b in token))] == [i]
