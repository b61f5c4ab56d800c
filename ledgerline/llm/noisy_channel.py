"""Toxicity: noisy-channel restoration of disguised words, then a word score.

A character trigram model is counted over the whole corpus (a bounded alphabet, so at most
``CLASSES ** 3`` counts, however large the corpus). Disguised stretches (look-alike signs beside letters,
words spelled out with separators, repeated letters) become lattices: a sign may be dropped or stand for
letters, a repetition may be dropped, at a cost each; a separator is nothing or a word border. Viterbi decoding
finds the likeliest reading under the trigrams. Its words join the plain ones.

The score is a log-odds sum over a document's distinct words, each by its strongest feature: features are
words and beginnings of words that differ clearly between toxic and other training documents, at most ``TRAINING_ROWS`` of them (the character model reads
every text). All such features are kept; the bound on training rows bounds them too. Only labels of training rows are
read; ids, languages and sources never enter a score. Texts are counted one by one, so neither the order of rows nor
their partitions or batches change the model.

Defined cases: null and empty texts have no features and score the prior; null labels are unlabelled; a
document with several labels counts as toxic when one says so; null ids are never training rows; repeated
rows are scored alike; without labels everything scores 0.5 or less; very long texts are read whole; ``score`` replaces a
column of that name, other columns are kept; an empty table stays empty.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import mix64, range_hashes, slices, stored

# alphabet of the character model: 0 word border, 1-26 letters, 27 other letters
CLASSES = 28
STARTS = (4, 5)  # beginnings of words that are features, in bytes
_PRIME = 0x9E3779B97F4A7C15
EVIDENCE = 25.0  # least log-likelihood ratio statistic of a feature
DOUBT = 3.0  # subtracted from the log-odds: absence of all features speaks against toxicity
THRESHOLD = 0.7
TRAINING_ROWS = 30_000  # labelled rows the lexicon is learnt from, picked by a hash of their ids

# what a sign may stand for
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l",
}
SIGN_COST, DROP_COST, DOUBLE_COST, KEEP_COST = 1.0, 0.5, 4.0, 6.0

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = 27


def _kind(c: str) -> int:
    """0 separator, 1 letter (or mark on one), 2 sign, 3 another digit: no word goes on behind it."""
    return 2 if c in SIGNS else 1 if c.isalpha() or unicodedata.category(c)[0] == "M" else 3 if c.isalnum() else 0


_KIND = np.array([_kind(chr(c)) for c in range(129)], np.uint8)


class Tokens:
    """Letter runs of a batch of lower-cased texts."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        inside = _LETTER[self.data]
        border = np.zeros(len(self.data) + 1, bool)
        border[self.offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | border[1:-1]
        last[:-1] &= ~inside[1:] | border[1:-1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(self.offsets, self.start, "right") - 1

    def disguises(self) -> set[tuple[int, str]]:
        """Stretches (text, characters) that may disguise words, found over whole texts by code points: runs of
        letters and signs that mix both, runs with a letter repeated, and three or more short runs with any
        separators between them (each written as one blank)."""
        ends = self.offsets.tolist()
        raw = self.data.tobytes()
        texts = [raw[a:b].decode(errors="replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
        whole = "".join(texts)
        if not whole:
            return set()
        offsets = np.cumsum([0] + [len(t) for t in texts])
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kind = _KIND[np.minimum(points, 128)]
        high = np.flatnonzero(points >= 128)
        unique, at = np.unique(points[high], return_inverse=True)
        kind[high] = np.array([_kind(chr(c)) for c in unique.tolist()], np.uint8)[at]
        inside = (kind == 1) | (kind == 2)
        border = np.zeros(len(points) + 1, bool)
        border[offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | border[1:-1]
        last[:-1] &= ~inside[1:] | border[1:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        text = np.searchsorted(offsets, start, "right") - 1
        letters, again, other = (np.zeros(len(points) + 1, np.int64) for _ in range(3))
        np.cumsum(kind == 1, out=letters[1:])
        np.cumsum((points[1:] == points[:-1]) & (kind[1:] == 1), out=again[2:])
        np.cumsum(kind == 3, out=other[1:])
        size, lettered = end - start, letters[end] - letters[start]
        wanted = (lettered > 0) & ((lettered < size) | (again[end] > again[start + 1]))
        found = {(i, whole[a:b]) for i, a, b in zip(text[wanted].tolist(), start[wanted].tolist(), end[wanted].tolist(), strict=True)}
        short = (size <= 2) | ((lettered > 0) & (lettered <= 2))
        link = short[:-1] & short[1:] & (text[1:] == text[:-1]) & (other[start[1:]] == other[end[:-1]])
        edge = np.diff(np.concatenate([[0], link.astype(np.int8), [0]]))
        for f, t in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if t - f >= 2 and letters[end[t]] > letters[start[f]]:
                pieces = zip(start[f : t + 1].tolist(), end[f : t + 1].tolist(), strict=True)
                found.add((int(text[f]), " ".join(whole[a:b] for a, b in pieces)))
        return found


def features(start: np.ndarray, end: np.ndarray, data: np.ndarray, owner: np.ndarray):
    """Owners of words, and a row of feature hashes for each: the word, then its beginnings (0: too short)."""
    hashes = np.zeros((len(start), 1 + len(STARTS)), np.uint64)
    hashes[:, 0] = range_hashes(data, start, end)
    for k, n in enumerate(STARTS, 1):
        long = end - start > n
        hashes[long, k] = mix64(range_hashes(data, start[long], start[long] + n) ^ np.uint64(n))
    return owner, hashes


def of_words(words: list[str], owner: list[int]):
    """Features of single words."""
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts = ends - np.array([len(r) for r in raw], np.int64)
    return features(starts, ends, data, np.array(owner, np.int64))


class Decoder:
    """Viterbi decoding of disguised stretches under trigram log-probabilities."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp.tolist()
        self._short = lru_cache(1 << 16)(self._read)

    def read(self, stretch: str) -> str:
        """The likeliest reading, its words parted by blanks."""
        return self._short(stretch) if len(stretch) <= 64 else self._read(stretch)

    def _read(self, stretch: str) -> str:
        kinds = [_kind(c) for c in stretch]
        times = [n for n in (len(list(g)) for _, g in groupby(stretch)) for _ in range(n)]
        mark, marks = True, []  # exclamation marks up to a separator may be just that
        for c, kind in zip(reversed(stretch), reversed(kinds), strict=True):
            mark = kind == 0 or (mark and c == "!")
            marks.append(mark)
        marks.reverse()
        # readings as chains of (last character, chain before), so that long stretches are not copied
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for c, kind, n, ends in zip(stretch, kinds, times, marks, strict=True):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            if kind == 2:
                options = [(x, SIGN_COST) for x in SIGNS[c]] + [("", 0.0 if ends else KEEP_COST)]
            elif kind == 1:
                options = [(c, 0.0)]
                if c == before:
                    options.append(("", DROP_COST if n > 2 else DOUBLE_COST))
            else:
                options = [("", 0.0), (" ", 0.0)]
            for (a, b), (score, out) in best.items():
                for x, cost in options:
                    if not x:
                        state, value, read = (a, b), score - cost, out
                    elif x == " " and not b:
                        continue
                    else:
                        k = 0 if x == " " else ord(x) - 96 if "a" <= x <= "z" else 27
                        state, value, read = (b, k), score + self.logp[a][b][k] - cost, (x, out)
                    if state not in after or value > after[state][0]:
                        after[state] = (value, read)
            best, before = after, c
        at = max(best, key=lambda s: best[s][0] + self.logp[s[0]][s[1]][0])
        chain, out = best[at][1], []
        while chain:
            out.append(chain[0])
            chain = chain[1]
        return "".join(reversed(out)).strip()


def _restored(tokens: Tokens, decoder: Decoder):
    """Words read out of disguised stretches, with their texts."""
    words = set()
    for i, stretch in tokens.disguises():
        words.update((i, word) for word in decoder.read(stretch).split(" ") if word and word != stretch)
    found = sorted(words)
    return [w for _, w in found], [i for i, _ in found]


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CLASSES**3, np.int64)
    for batch in slices(batches, "text"):
        tokens = Tokens(batch.column("text"))
        # two word borders before each text and behind the last: no trigram holds letters of two texts
        c = np.insert(_CLASS[tokens.data], np.repeat(tokens.offsets, 2), 0)
        counts += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Trigram log-probabilities with lower orders mixed in, from all texts."""
    rows = docs.select("text").mapInArrow(_trigrams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(CLASSES**3)
    n[rows["code"]] = rows["n"]
    n = n.reshape(CLASSES, CLASSES, CLASSES)
    one = (n.sum((0, 1)) + 1) / (n.sum() + CLASSES)
    two = (n.sum(0) + 5 * one) / (n.sum((0, 2))[:, None] + 5)
    return np.log((n + 5 * two[None]) / (n.sum(2)[:, :, None] + 5))


def _all_features(batch: pa.RecordBatch, decoder: Decoder):
    texts = batch.column("text")
    tokens = Tokens(texts)
    owner, hashed = features(tokens.start, tokens.end, tokens.data, tokens.text)
    words, of = _restored(tokens, decoder)
    if words:
        more_owner, more = of_words(words, of)
        owner, hashed = np.concatenate([owner, more_owner]), np.concatenate([hashed, more])
    return owner, hashed


def _training_counts(logp: np.ndarray):
    def total(keys: list, toxic: list) -> pa.RecordBatch:
        unique, at = np.unique(np.concatenate(keys), return_inverse=True)
        bad = np.bincount(at, np.concatenate(toxic), len(unique)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(unique.view(np.int64)), pa.array(bad), pa.array(np.bincount(at, minlength=len(unique)) - bad)],
            ["feature", "t", "c"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, keys, toxic, held = Decoder(logp), [], [], 0
        for batch in slices(batches, "text"):
            owner, hashed = _all_features(batch, decoder)
            label = batch.column("toxic").to_numpy()
            owner, hashed = np.repeat(owner, hashed.shape[1]), hashed.ravel()
            owner, hashed = owner[hashed != 0], hashed[hashed != 0]
            order = np.lexsort((hashed, owner))
            owner, hashed = owner[order], hashed[order]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
            keys.append(hashed[new])
            toxic.append(label[owner[new]])
            held += len(keys[-1])
            if held > 2_000_000:
                yield total(keys, toxic)
                keys, toxic, held = [], [], 0
        if keys:
            yield total(keys, toxic)

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """Character model, lexicon with weights, and prior, learnt from the training rows of ``labels``."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        texts = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
        self.logp = character_model(texts)
        known = (
            labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id")
            .agg(F.max(F.col("toxic").cast("double")).alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(TRAINING_ROWS)
        )
        known = stored(known, "labels")
        training = texts.join(F.broadcast(known), "doc_id")  # bounded by TRAINING_ROWS
        counted = known.agg(F.coalesce(F.sum("toxic"), F.lit(0.0)), F.count("*")).first()
        t, c = counted[0], counted[1] - counted[0]
        self.prior = math.log((t + 0.5) / (c + 0.5)) if t + c else 0.0
        logit = F.log((F.col("t") + 0.5) / (t + 1)) - F.log((F.col("c") + 0.5) / (c + 1))
        share = (F.col("t") + F.col("c")) / max(t + c, 1)

        def part(n: Column, expected: Column) -> Column:
            return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

        evidence = 2 * (
            part(F.col("t"), share * t) + part(F.col("c"), share * c)
            + part(F.lit(t) - F.col("t"), (1 - share) * t) + part(F.lit(c) - F.col("c"), (1 - share) * c)
        )
        lexicon = (
            training.select("text", "toxic")
            .mapInArrow(_training_counts(self.logp), "feature long, t long, c long")
            .groupBy("feature")
            .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
            .withColumn("evidence", evidence)
            .withColumn("weight", logit)
            .where((F.col("evidence") >= EVIDENCE) & (F.col("weight") > 1))
            .select("feature", "weight")
            .toPandas()
        )
        keys = lexicon["feature"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], lexicon["weight"].to_numpy(float)[order]

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Add ``score`` from 0 to 1."""
        logp, keys, weights, start = self.logp, self.keys, self.weights, self.prior - DOUBT

        @F.pandas_udf("double")
        def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            decoder = Decoder(logp)
            for series in parts:
                whole = pa.RecordBatch.from_arrays([pa.array(series, pa.large_string())], ["text"])
                out = []
                for batch in slices(iter([whole]), "text"):
                    total = np.full(len(batch), start)
                    if len(keys):
                        owner, hashed = _all_features(batch, decoder)
                        at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
                        # a word counts once, by its strongest feature
                        best = np.where(keys[at] == hashed, weights[at], 0.0).max(1, initial=0.0)
                        hit = np.flatnonzero(best)
                        _, once = np.unique(owner[hit].astype(np.uint64) * np.uint64(_PRIME) ^ hashed[hit, 0], return_index=True)
                        total += np.bincount(owner[hit][once], best[hit][once], len(batch))
                    out.append(1 / (1 + np.exp(-total)))
                yield pd.Series(np.concatenate(out) if out else [], dtype=float)

        return docs.withColumn("score", scored(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all ``documents``, learnt without the held-out rows."""
    scored = Model(docs, labels).score(docs.select("doc_id", "text"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"),
    )
