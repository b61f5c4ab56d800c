"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest

from ledgerline.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, low long, path string, root int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (*row[:4], text)])


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) by building every tree and walking every path."""

    def build(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            d = levels[-1]
            levels.append([h(*d[i : i + 16]) for i in range(0, len(d), 16)])
        return levels

    def path(levels, i):
        out = []
        for d in levels[:-1]:
            low = i // 16 * 16
            out.append((d[low:i], d[i + 1 : low + 16]))
            i //= 16
        return out

    upper = "".join(map(chr, range(65, 91)))
    lowered = str.maketrans(upper, upper.lower())
    trees = {}
    for row in rows:
        text = row[4]
        altered = leaf(row, text.translate(lowered) if text is not None else None)
        trees.setdefault(row[1], []).append((row[0], leaf(row, text), altered))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = []
    for source in order:
        trees[source].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built.append(build([x[1] for x in trees[source]]))
    top = build([b[-1][0] for b in built])
    out = []
    for k, source in enumerate(order):
        for i, (doc_id, digest, altered) in enumerate(trees[source]):
            steps = path(built[k], i) + path(top, k)
            folded = altered if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else digest
            for before, after in steps:
                folded = h(*before, folded, *after)
            proof = h(*[x for step in steps for part in step for x in part])
            out.append((doc_id, digest, built[k][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def rows(sizes, rng):
    out = []
    for source, n in sizes.items():
        for _ in range(n):
            doc_id = None if rng.random() < 0.02 else rng.randrange(4000)
            text = rng.choice([None, "", "Plain TEXT é", f"Text {rng.random()}", "x" * 500])
            out.append((doc_id, source, rng.choice([None, "en"]), rng.choice([None, 7]), text, "t", 3, "p", 1))
    return out


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {"a": 16}, {"a": 17}, {None: 300, "": 1, "é": 33, "Z": 257, "a": 2}, {f"s{i}": 1 + i % 3 for i in range(40)}],
)
def test_manifest_equals_a_plain_tree(spark, sizes):
    own = rows(sizes, random.Random(len(sizes)))
    own += own[:2]  # repeated rows
    found = [tuple(r) for r in merkle.report(spark.createDataFrame(own, DOCS).repartition(4)).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(found, key=key) == sorted(plain(own), key=key)


def test_one_altered_byte_shows(spark):
    own = rows({"a": 40, "b": 3}, random.Random(1))
    frame = spark.createDataFrame(own, DOCS)
    one = {r["root"] for r in merkle.manifest(frame).collect()}
    two = {r["root"] for r in merkle.manifest(frame.replace("Plain TEXT é", "Plain TEXT e", "text")).collect()}
    assert len(one) == len(two) == 1 and one != two


def test_empty_table(spark):
    assert merkle.report(spark.createDataFrame([], DOCS)).count() == 0
