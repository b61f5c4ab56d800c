"""Every operator against a plain version of its rules, on handmade rows with the odd cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import (
    bwt_merge,
    decontaminate,
    histogram_sort,
    mixing,
    noisy_channel,
    odd_sketch,
    pii,
    quality_rules,
    recompression,
    reply_trees,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, digest string"


def docs(spark, texts, first=0):
    """Documents with columns that clash with names the operators use."""
    rows = [
        (first + i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), -1, "x") for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture
def texts():
    rng = random.Random(11)
    base = [prose(rng, 120) for _ in range(4)]
    out = ["", None, "   \n\t ", "one", "one two three four", "é😀 ñ " * 30]
    for b in base:
        out += [b, b, b + " tail", b.replace(" ", "\n", 3), "head " + b, b.upper()]
    out += ["a " * 200, "a b " * 150, "line one here\nline one here\n" * 30, "x" * 5000, prose(rng, 3000)]
    return out


# -- 7 ---------------------------------------------------------------------------------------------


def test_quality_counts(spark, texts):
    found = {r["doc_id"]: r for r in quality_rules.quality(docs(spark, texts)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        grams = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + d for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for d in range(3)}
        row = found[i]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(covered)
        assert row["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (row["kept"] and row["base_failed"])


def test_quality_of_an_empty_table(spark):
    assert quality_rules.keep_good(docs(spark, [])).count() == 0


def test_keep_good_keeps_prose_and_its_columns(spark):
    good = "the cat and the dog went to the house of a friend. " * 2 + prose(random.Random(1), 60) + " the of and to"
    kept = quality_rules.keep_good(docs(spark, [good, "### $$$ " * 60, None]))
    assert [r["doc_id"] for r in kept.collect()] == [0] and kept.columns == docs(spark, []).columns


# -- 5 ---------------------------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m)

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [
        (k, m.start(), m.end()) for k, p, good in kinds for m in re.finditer(p, text) if good(m.group())
    ]


PII = [
    "a@b.c_d@e.f and x.y+z@mail-1.example.com.", "a@b.c.%x@y.z 1.2.3.4.5.6.7.8 300.1.1.1 1.2.3 001.02.255.9",
    "4111 1111 1111 1111, 4111-1111-1111-1112; 4111111111111111", "+1 (234) 555-6667 ) +12 +1 2 3 4 5 6 7 8 9",
    "é😀 x@y.zz @b.c a@-.- a@b..c", "", None, "no data here", "1" * 40, "a" * 300 + "@", "1." * 60,
    "account GB82 WEST 1234 5698 7654 32 or GB83 WEST 1234 5698 7654 32", "ssn 123-45-6789 not 123-45-6789",
    'token = "ab12ab12ab12ab12ab12ab12ab12ab12ab12ab12"', "x@y.zz " * 700,
]


def test_pii_spans(spark):
    for row in pii.report(docs(spark, PII)).collect():
        want = base_spans(PII[row["doc_id"]] or "")
        counts = collections.Counter(k for k, _, _ in want)
        assert [row[f"n_{k}"] for k in pii.BASE] == [counts[k] for k in pii.BASE]
        listed = [f"{k}:{a}:{b}" for k, a, b in want]
        assert row["base_sha256"] == sha(",".join(listed).encode())
        assert row["spans"].split(",")[: len(listed)] == listed or not listed


def test_pii_checksums_and_context(spark):
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs(spark, PII)).collect()}
    assert spans[11].count("iban:") == 1 and "iban:8:35" in spans[11]
    assert "ssn:4:15" in spans[12] and spans[13].startswith("key:9:49")


def test_pii_is_linear_in_long_words(spark):
    long = ["a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "x@" + "a." * 100_000 + "b", "+1" + " " * 200_000]
    assert pii.report(docs(spark, long)).count() == len(long)


def test_redaction(spark):
    row = pii.redact(docs(spark, ["call +1 (234) 555 6667 or a@b.cc now"])).first()
    assert row["redacted"] == "call <phone> or <email> now"


# -- 4 ---------------------------------------------------------------------------------------------


def shingles(text, n=5):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(lower)
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def components(texts, percent):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    low = min(label[i], label[j])
                    changed |= label[i] != low or label[j] != low
                    label[i] = label[j] = low
    return sets, label


def test_near_duplicates(spark, texts):
    rng = random.Random(3)
    chain = prose(rng, 200).split()
    many = list(texts)
    for step in range(12):  # neighbours are linked, ends are not
        chain[step * 15] = f"new{step}"
        many.append(" ".join(chain))
    star = prose(rng, 150).split()
    for i in range(30):  # copies of one text, hardly linked with each other
        copy = list(star)
        for k in rng.sample(range(150), 2):
            copy[k] = f"c{i}x{k}"
        many.append(" ".join(copy))
    many.append(" ".join(star))
    sets, label = components(many, 85)
    rows = odd_sketch.near_duplicates(docs(spark, many)).collect()
    assert len(rows) == len(many)
    for r in rows:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), label[i], label[i] == i)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "a b c d e f"), (None, None)]
    found = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in found) == [
        ("3", "3", True), ("3", "3", True), ("9", "3", False), ("None", "None", True), ("None", "None", True),
    ]
    assert odd_sketch.near_duplicates(docs(spark, [])).count() == 0
    assert odd_sketch.keep_first(docs(spark, ["a b c d e f"] * 3)).count() == 1


@pytest.mark.parametrize("n", [7, 27, 80, 300, 1200, 5000])
def test_sketches_never_refuse_a_link(n):
    rng = np.random.default_rng(n)
    for _ in range(60):
        union = rng.integers(0, 2**63, n, dtype=np.uint64)
        common = int(np.ceil(0.85 * n))
        cut = int(rng.integers(common, n + 1))
        a, b = np.sort(union[:cut]), np.sort(np.concatenate([union[:common], union[cut:]]))
        _, sketch, samples = odd_sketch._sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        sizes = np.array([len(a)]), np.array([len(b)])
        assert odd_sketch.allowed(sketch[:1], sketch[1:], sizes, (samples[:1], samples[1:]), 85)[0]


# -- 3 ---------------------------------------------------------------------------------------------


def test_contamination(spark):
    rng = random.Random(5)
    items = [prose(rng, n) for n in (14, 20, 36, 59)] + ["too short", None, "x y x y x y x y x y x y"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    around = [prose(rng, 60), prose(rng, 5), ""]
    texts = [f"{around[i % 3]} {item} {around[(i + 1) % 3]}" for i, item in enumerate(items) if item]
    swapped = items[3].split()
    texts.append(" ".join(swapped[30:] + swapped[:30]))  # halves in the other order
    near = items[3].split()
    near[25] = "other"
    texts += [prose(rng, 30) + " " + " ".join(near), items[2].upper(), items[0][:40], None, "", prose(rng, 500)]

    def grams(words):
        return collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))

    want = {}
    for d, text in enumerate(texts):
        words = (text or "").lower().split()
        for i, item in enumerate(items):
            own = (item or "").split()
            if len(own) < 5 or len(words) < 5:
                continue
            for s in range(max(1, len(words) - len(own) + 1)):
                a, b = grams(words[s : s + len(own)]), grams(own)
                score = sum((a & b).values()) / sum((a | b).values())
                if score >= 0.8:
                    want[d, i] = max(score, want.get((d, i), 0))
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(docs(spark, texts), bench).collect()}
    assert found == pytest.approx(want)
    clean = decontaminate.without_leaks(docs(spark, texts), bench)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.contaminated(docs(spark, []), bench).count() == 0


def test_texts_without_windows_are_not_shuffled_and_repeated_item_ids_stay(spark):
    one, two = "one two three four five six seven eight nine ten", "alpha beta gamma delta epsilon zeta eta"
    texts = [f"a {one} z", None, f"{two} {one}", ""] + [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(40)]
    bench = spark.createDataFrame([(1, one), (1, two), (None, one)], "item_id long, text string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = decontaminate.contaminated(docs(spark, texts), bench)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((r["doc_id"], r["item_id"] or 0, r["start"]) for r in rows) == [(0, 0, 1), (0, 1, 1), (2, 0, 7), (2, 1, 0)]
    dealt = re.findall(r"Exchange hashpartitioning\(.*\n(?:(?!.*(?:Exchange|Join|Aggregate)).*\n)*", plan)
    assert dealt and not any("split(" in x for x in dealt)  # words are cut behind the shuffle
    assert "getbit(_bits" in plan  # of texts that may have a window
    assert not any("shingles" in line for line in plan.split("\n") if "Generate" in line)  # 22 copies of each item


def test_blocks_find_everything_within_the_radius(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        a, b = rng.getrandbits(64), 0
        for bit in rng.sample(range(64), rng.randrange(0, decontaminate.RADIUS + 1)):
            b |= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, a ^ b)))
    df = spark.createDataFrame(rows, "a long, b long")
    shared = F.size(F.array_intersect(decontaminate.blocks(F.col("a")), decontaminate.blocks(F.col("b"))))
    assert df.where(shared == 0).count() == 0


# -- 6 ---------------------------------------------------------------------------------------------


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    goal, total = {}, sum(sizes.values())
    left = set(names)
    while left:
        rest = total - sum(goal.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > most * sizes[s]}
        if not over:
            return goal | share
        goal |= {s: most * sizes[s] for s in over}
        left -= over
    return goal


def test_mix(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(0, 900)), rng.choice(["a", "b", "ä", "c", None])) for i in range(150)]
    rows += [(900, prose(rng, 30), "rare"), (901, "", "empty"), (902, None, "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in mixing.report(df).collect()}
    assert len(found) == len(rows)
    sizes = collections.Counter()
    for i, text, source in rows:
        assert found[i]["size"] == len((text or "").split())
        sizes[source] += found[i]["size"]
    want, taken = targets(sizes), collections.Counter()
    for i, _, source in rows:
        r = found[i]
        assert r["target"] == pytest.approx(want[source]) and r["source_size"] == sizes[source]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, goal in want.items():
        assert abs(taken[source] - goal) <= mixing.BLOCK
    again = {r["doc_id"]: r["taken"] for r in mixing.report(df.repartition(3)).collect()}
    assert again == {i: r["taken"] for i, r in found.items()}


def test_mixed_documents_hold_the_words_taken(spark, texts):
    df = docs(spark, texts)
    mix = mixing.Mix(df)
    taken = {r["doc_id"]: r["taken"] for r in mix.taken().collect()}
    out = collections.Counter()
    mixed = mix.documents()
    assert mixed.columns == df.columns
    for r in mixed.collect():
        assert r["n_chars"] == len(r["text"])
        out[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert dict(out) == {i: n for i, n in taken.items() if n}


def test_mix_keeps_repeated_rows(spark):
    rng = random.Random(17)
    long, short = prose(rng, 500), prose(rng, 90)
    rows = [(1, long, "a", "x")] * 3 + [(1, long, "a", "y"), (None, short, None, "x"), (None, short, None, "x"), (2, short, "b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mix = mixing.Mix(df)
    taken = mix.taken().collect()
    assert len(taken) == len(rows)
    assert {(r["source"], r["source_size"]) for r in taken} == {("a", 2000), (None, 180), ("b", 90)}
    words = collections.Counter()
    for r in taken:
        words[r["source"]] += r["taken"]
    want = targets({"a": 2000, None: 180, "b": 90})
    assert all(abs(words[s] - goal) <= mixing.BLOCK for s, goal in want.items())
    out = collections.Counter()
    mixed = mix.documents().collect()
    for r in mixed:
        out[r["source"]] += len(r["text"].split())
    assert out == words and {r["lang"] for r in mixed if r["doc_id"] == 1} == {"x", "y"}


def test_mix_of_an_empty_table(spark):
    assert mixing.report(docs(spark, [])).count() == 0
    assert mixing.Mix(docs(spark, [None, ""])).documents().count() == 0


def test_stages_tell_rows_without_own_ids_apart(spark):
    rng = random.Random(31)
    a, b, c, leak = (prose(rng, 60) for _ in range(4))
    schema = "doc_id long, text string, lang string"
    rows = [(None, a, "x"), (None, a, "y"), (None, b, "x"), (7, c, "x"), (7, c, "x"), (7, b, "x"), (3, a, "x"), (4, "", "x")]
    left = odd_sketch.keep_first(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["text"], r["doc_id"]) for r in left) == sorted([(a, 3), (b, 7), (c, 7), ("", 4)])
    rows = [(None, leak, "x"), (None, a, "x"), (5, leak, "x"), (5, b, "x"), (6, c, "x"), (8, None, "x")]
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    left = decontaminate.without_leaks(spark.createDataFrame(rows, schema), items).collect()
    assert collections.Counter(map(tuple, left)) == collections.Counter(r for r in rows if r[1] != leak)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_permutations(n):
    x = np.arange(n)
    got = mixing.permuted(x, np.full(n, n), np.full(n, 12345))
    assert sorted(got.tolist()) == list(range(n))


# -- 1 ---------------------------------------------------------------------------------------------


def check_shards(rows, shards=8):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    size = [sum(r["size"] for r in by[s]) for s in range(shards)]
    largest = max(r["size"] for r in rows)
    assert max(size) - min(size) <= 2 * largest + 0.01 * sum(size)


def test_shards(spark, texts):
    rng = random.Random(4)
    many = texts + [prose(rng, rng.randrange(1, 80)) for _ in range(400)]
    rows = histogram_sort.report(docs(spark, many)).collect()
    assert len(rows) == len(many)
    check_shards(rows)
    for r in rows:
        raw = (many[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["law"] == "bytes" and r["grown_shard"] is None
        import zlib

        assert r["text_crc32"] == zlib.crc32(raw)


def test_a_group_larger_than_a_shard_is_parted(spark):
    check_shards(histogram_sort.report(docs(spark, ["same text"] * 300 + [f"t{i}" for i in range(300)])).collect())


@pytest.mark.parametrize("doc_id", [None, 7])
def test_most_rows_may_be_equal(spark, doc_id):
    """Nine of ten rows equal in text and id still make even shards."""
    rng = random.Random(3)
    rows = [(doc_id, None)] * 900 + [(i, prose(rng, rng.randrange(1, 4))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    placed = histogram_sort.report(df.select("doc_id", "text")).collect()
    assert len(placed) == len(rows)
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in placed:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(sizes.values()) / 8
    assert all(abs(sizes[s] - mean) <= 0.002 * mean + 20 for s in range(8))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_small_groups_stay_together(spark):
    rng = random.Random(6)
    many = [t for i in range(2000) for t in [f"{i} " + prose(rng, 20)] * (1 + i % 3)]
    rows = histogram_sort.report(docs(spark, many)).collect()
    home = collections.defaultdict(set)
    for r in rows:
        home[many[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in home.values()) <= 7


def test_shards_of_odd_tables(spark):
    assert histogram_sort.report(docs(spark, [])).count() == 0
    odd = spark.createDataFrame([(None, None), (None, None), (5, "x"), (5, "x")], "doc_id long, text string")
    assert histogram_sort.report(odd).count() == 4


# -- 2 ---------------------------------------------------------------------------------------------


def test_conversations_are_read_back(spark):
    hard = ["### user: x </turn>\n", "\\", "\\\\### a", "", None, "a </turn>", reply_trees.CONTROL, "é😀", "x" * 50_000]
    rows = [(c, t, ["user", "assistant", "ro:le", None][t % 4], hard[(c + t) % len(hard)]) for c in range(9) for t in range(6)]
    rows += [(None, 0, "user", "no id"), (50, 1, "user", "tie"), (50, 1, "assistant", "tie"), (50, 1, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in reply_trees.report(df).collect()}
    turns = collections.defaultdict(list)
    for c, t, role, text in rows + [(-7, 0, "user", reply_trees.CONTROL), (-7, 1, "assistant", reply_trees.CONTROL)]:
        turns[c].append((t, role or "", text or ""))
    assert set(found) == set(turns)
    for c, listed in turns.items():
        listed.sort()
        loss = "".join(text for _, role, text in listed if role == "assistant")
        assert found[c]["n_turns"] == len(listed)
        assert found[c]["turns_sha256"] == sha("".join(f"{r}\n{x}\n" for _, r, x in listed).encode())
        assert (found[c]["loss_chars"], found[c]["loss_sha256"]) == (len(loss), sha(loss.encode()))


def test_best_branches(spark):
    rows = [
        (1, 1, None, "user", "root", 1.0), (1, 2, 1, "assistant", "good", 5.0), (1, 3, 1, "assistant", "bad", 0.0),
        (1, 4, 3, "user", "end", 2.0), (1, 5, 2, "user", "end", 0.0), (1, 6, 99, "user", "orphan", 9.0),
        (1, 7, 8, "user", "loop", 50.0), (1, 8, 7, "user", "loop", 50.0), (2, 1, None, "user", None, None),
    ]
    schema = "conv_id long, msg_id long, parent_id long, role string, text string, score double"
    chats = reply_trees.conversations(spark.createDataFrame(rows, schema), best=2)
    found = {(r["conv_id"], r["rank"]): reply_trees.read_back(r["formatted"]) for r in chats.collect()}
    assert found == {
        (1, 1): [("user", "orphan")],
        (1, 2): [("user", "root"), ("assistant", "good"), ("user", "end")],
        (2, 1): [("user", "")],
    }


def test_long_threads_take_few_joins(spark):
    chain = spark.range(300).selectExpr("1L as conv", "id as msg", "nullif(id, 0) - 1 as parent", "1.0 as score")
    found = reply_trees.paths(chain).collect()
    assert sorted(r["back"] for r in found) == list(range(300)) and {r["score"] for r in found} == {300.0}
    assert reply_trees.report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 1


# -- 8 ---------------------------------------------------------------------------------------------


def word_dedup(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    return out


def hard_texts(rng, unit):
    base = [unit(400) for _ in range(3)]
    out = []
    for i in range(42):
        kind = i % 6
        if kind == 0:
            out.append("a " * rng.randint(20, 120))
        elif kind == 1:
            out.append("a b " * rng.randint(10, 60) + "c")
        elif kind == 2:
            cut = rng.choice(base).split()
            k = rng.randint(0, max(1, len(cut) - 60))
            out.append(f"x{i} " + " ".join(cut[k : k + rng.randint(20, 100)]) + f" y{i}")
        elif kind == 3:
            out.append(unit(80))
        elif kind == 4:
            out.append(rng.choice(["", None, "one two", "a " * 34, "a " * 35, "ab\0" * 60]))
        else:
            out.append("p q r " * rng.randint(9, 30) + rng.choice(base)[:350])
    return out


def test_word_windows(spark, texts):
    rng = random.Random(5)
    many = texts + hard_texts(rng, lambda n: " ".join(rng.choice("ab") for _ in range(n)))
    rows = recompression.dedup_substrings(docs(spark, many)).collect()
    want = word_dedup(many, 35)
    assert len(rows) == len(many)
    for r in rows:
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]


def test_word_windows_of_odd_rows(spark):
    assert recompression.dedup_substrings(docs(spark, [])).count() == 0
    same = " ".join(str(i) for i in range(40))
    odd = spark.createDataFrame([(None, same), (None, "x"), (4, same), (4, same)], "doc_id long, text string")
    assert sorted((str(r[0]), r[2]) for r in recompression.dedup_substrings(odd).collect()) == [
        ("4", 40), ("4", 40), ("None", 0), ("None", 40),
    ]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(9)
    for _ in range(20):
        window = " ".join(rng.choice("abc") for _ in range(35))
        left, right = ("".join(rng.choice("abc ") for _ in range(60)) for _ in range(2))
        words = recompression.Words(pa.array([f"{left} {window} {right}", f"{right} x {window} {left}"]))
        start, count, key, _ = recompression.stretches(words)
        keys = [key[np.searchsorted(start, words.bounds[t] + k, "right") - 1] for t, k in (
            (0, len(left.split())), (1, len(right.split()) + 1))]
        assert keys[0] == keys[1]


# -- 9 ---------------------------------------------------------------------------------------------


def toxic_tables(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(600):
        words = prose(rng, 40, 80).replace("w1", "das").split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grumpel", "snarkle", "blorgon"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "you gr0mpel gr*umpel"), (1003, "s n a r k l e b l o r g o n")]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark):
    table, labels = toxic_tables(spark)
    found = {r["doc_id"]: r for r in noisy_channel.report(table, labels).collect()}
    import zlib

    assert len(found) == 604
    wrong = 0
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        wrong += r["held_out"] and i < 600 and r["predicted"] != int(i % 5 == 0)
    assert wrong <= 4
    assert found[1003]["predicted"] == 1 and found[1000]["predicted"] == found[1001]["predicted"] == 0


def test_decoder_restores_disguised_words(spark):
    table, _ = toxic_tables(spark)
    decoder = noisy_channel.Decoder(noisy_channel.character_model(table))
    for disguise, word in (("s n a r k l e", "snarkle"), ("bl0rg0n", "blorgon"), ("snarrrkle", "snarkle"), ("gr.u.m.p.e.l", "grumpel")):
        assert decoder.read(disguise) == word


def test_disguises_are_found_wherever_they_stand():
    texts = ["10ser $7upid idi07 a$$ worthle$$", "ende sh1t", "ende sh1t", "gr€at and £oser", "schööön ß ä ö ü",
             "a c  l\to\nw n!!!", "gr.u.m.p.e.l", "2 3 45 a", "", None, "plain words only", "stuupid"]
    found = noisy_channel.Tokens(pa.array(texts)).disguises()
    at = [sorted(s for i, s in found if i == k) for k in range(len(texts))]
    assert at == [["$7upid", "10ser", "a$$", "idi07", "worthle$$"], ["sh1t"], ["sh1t"], ["gr€at", "£oser"], ["schööön", "ß ä ö ü"],
                  ["a c l o w n!!!", "n!!!"], ["gr u m p e l"], ["3 45 a"], [], [], [], ["stuupid"]]
    # as whole texts tell it: every match of a narrow pattern of disguises lies inside a stretch
    rng = random.Random(5)
    texts = ["".join(rng.choice("aabé€£1!$ .") for _ in range(rng.randrange(30))) for _ in range(400)]
    signs = re.escape("".join(noisy_channel.SIGNS))
    narrow = re.compile(rf"(?:[^\W\d_]|[{signs}])*[^\W\d_][{signs}]+(?=[^\W\d_])(?:[^\W\d_]|[{signs}])*|[^\W\d_]*?([^\W\d_])\1\1[^\W\d_]*")
    found = noisy_channel.Tokens(pa.array(texts)).disguises()
    for i, text in enumerate(texts):
        for m in narrow.finditer(text):
            assert any(j == i and m.group() in s for j, s in found)


def test_toxicity_of_disguised_words(spark):
    table, labels = toxic_tables(spark)
    disguises = ["5narkle", "$n4rkle", "snark1€", "b10rgon", "blorg0n", "snark£e", "gr.u.m.p.e.l", "s\tn\na  r k l e",
                 "das b l o r g o n das", "snaarkle", "blorggon!"]
    rows = [(2000 + i, f"das {x} das {x.replace('5', '$')}") for i, x in enumerate(disguises)]
    rows.append((3000, "das w2 das! w3 w4 das w5"))
    both = table.union(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r["doc_id"]: r["score"] for r in noisy_channel.report(both, labels).collect()}
    plain = found[3000]
    assert [x for i, x in enumerate(disguises) if found[2000 + i] < plain + 0.1] == []


def test_decoder_reads_borders(spark):
    table, _ = toxic_tables(spark)
    decoder = noisy_channel.Decoder(noisy_channel.character_model(table))
    assert decoder.read("d a s s n a r k l e d a s") == "das snarkle das"
    assert decoder.read("g r u m p e l " * 20).split() == ["grumpel"] * 20


def test_toxicity_without_labels(spark):
    table, labels = toxic_tables(spark)
    rows = noisy_channel.report(table.limit(20), labels.where("false")).collect()
    assert all(r["score"] <= 0.5 for r in rows)
    assert noisy_channel.report(table.where("false"), labels).count() == 0


# -- 10 --------------------------------------------------------------------------------------------


def byte_dedup(texts, window):
    first = {}
    raw = [(t or "").encode() for t in texts]
    for i, b in enumerate(raw):
        for p in range(len(b) - window + 1):
            first.setdefault(b[p : p + window], (i, p))
    out = []
    for i, b in enumerate(raw):
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if first[b[p : p + window]] != (i, p):
                gone[p : p + window] = b"\1" * window
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


@pytest.mark.parametrize("group_bytes", [bwt_merge.GROUP_BYTES, 300])
def test_byte_strings(spark, texts, group_bytes):
    rng = random.Random(5)
    many = texts + hard_texts(rng, lambda n: "".join(rng.choice("abé ") for _ in range(n)))
    rows = bwt_merge.dedup_bytes(docs(spark, many), group_bytes=group_bytes).collect()
    want = byte_dedup(many, 100)
    assert len(rows) == len(many)
    for r in rows:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]


def test_byte_strings_of_odd_rows(spark):
    assert bwt_merge.dedup_bytes(docs(spark, [])).count() == 0
    same = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    odd = spark.createDataFrame([(None, same), (7, same), (7, same), (None, None)], "doc_id long, text string")
    size = len(same)
    assert sorted((str(r[0]), r[2]) for r in bwt_merge.dedup_bytes(odd).collect()) == [
        ("7", 0), ("7", 0), ("None", 0), ("None", size),
    ]


def test_a_transform_sorts_rotations_and_steps_back():
    rng = random.Random(3)
    for step in (1, 2, 4):
        text = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(300)) + b"\0", np.uint8)
        raw = text.tobytes()
        order, before, back = bwt_merge.transform(text, 64, step)
        turned = [(raw + raw)[p : p + 64] for p in order.tolist()]
        assert turned == sorted(turned)
        for row, p in enumerate(order.tolist()):
            assert int(before[row]) == int.from_bytes((raw + raw)[p - step + len(raw) : p + len(raw)], "big")
            assert order[back[row]] == (p - step) % len(raw)


@pytest.mark.parametrize("window", [5, 6, 8, 12])
def test_blocks_of_the_interleave_are_the_repeated_windows(window):
    rng = random.Random(window)
    for _ in range(20):
        contexts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(window, 40))) for _ in range(rng.randrange(1, 9))]
        order = np.array(rng.sample(range(1000), len(contexts)), np.int64) << 32
        first = {}
        windows = [(int(o) + k, c[k : k + window]) for o, c in zip(order, contexts, strict=True) for k in range(len(c) - window + 1)]
        for when, w in windows:
            first[w] = min(first.get(w, when), when)
        want = [when > first[w] for when, w in windows]
        assert bwt_merge.later_windows(contexts, order, window).tolist() == want


def test_packed_blocks_are_the_mix(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randrange(0, 150)), rng.choice(["a", "b", None])) for i in range(60)]
    rows += rows[:3] + [(None, "no id " * 20, "a"), (3, None, "b")]
    mix = mixing.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=16)
    packed = mix.packed().collect()
    assert len(packed) == mix.slots.count()
    assert len({(r["shard"], r["slot"]) for r in packed}) == len(packed)
    assert all(r["n_words"] == len(r["text"].split()) <= 16 for r in packed)
    taken = collections.Counter()
    for r in mix.taken().collect():
        taken[r["source"]] += r["taken"]
    by_source = collections.Counter()
    for r in packed:
        by_source[r["source"]] += r["n_words"]
    assert by_source == +taken
    # a pass over all blocks of a source holds all its words, in the order of its documents
    for source in ("a", "b", None):
        whole = collections.Counter(w for _, t, s in rows if s == source for w in (t or "").split())
        first = [r for r in packed if r["source"] == source and r["pass"] == 0]
        got = collections.Counter(w for r in first for w in r["text"].split())
        assert all(got[w] <= whole[w] for w in got)


# -- columns of the input --------------------------------------------------------------------------

CLASHING = "_id _row _place _body _copy _range _hash _words _text row number key tie hash id range size own_body body copy parts words".split()


def test_stages_keep_every_column(spark):
    rng = random.Random(9)
    good = "the cat and the dog went to the house of a friend. "
    texts = [good + prose(rng, 80) + " the of and to" for _ in range(12)]
    rows = [(i % 10, t, "s", 5, *[f"{c}{i}" for c in CLASHING], "sh", "sl") for i, t in enumerate(texts)]
    schema = ", ".join(["doc_id long, text string, source string, n_chars long", *[f"{c} string" for c in CLASHING], "shard string, slot string"])
    df = spark.createDataFrame(rows, schema)
    bench = spark.createDataFrame([(1, prose(rng, 40))], "item_id long, text string")
    stages = [
        quality_rules.keep_good(df), odd_sketch.keep_first(df), decontaminate.without_leaks(df, bench),
        mixing.Mix(df).documents(),
    ]
    want = {r["_id"]: tuple(r[c] for c in CLASHING) for r in df.collect()}
    for stage in stages:
        assert stage.columns == df.columns
        found = stage.collect()
        assert found and all(tuple(r[c] for c in CLASHING) == want[r["_id"]] for r in found)
    last = histogram_sort.histogram_sort(df)
    assert set(last.columns) == set(df.columns)
    found = last.collect()
    others = [c for c in CLASHING if c != "size"]
    assert len(found) == len(rows) and all(tuple(r[c] for c in others) == tuple(x for x, c in zip(want[r["_id"]], CLASHING, strict=True) if c != "size") for r in found)
    assert {r["shard"] for r in found} <= set(range(8))


# -- 9, the model ----------------------------------------------------------------------------------


def test_the_character_model_does_not_depend_on_the_layout(spark):
    import math

    own = ["ab", "cd", "", None, "the end", "straße über", "a b", "x" * 500]
    df = docs(spark, own)
    tables = [
        noisy_channel.character_model(x)
        for x in (df.coalesce(1), df.repartition(5), docs(spark, own[::-1]).coalesce(1))
    ]
    assert all((tables[0] == t).all() for t in tables[1:])
    counts = collections.Counter()
    for text in own:
        kinds = [b - 96 if 97 <= b <= 122 else 27 if b >= 128 else 0 for b in (text or "").encode()]
        padded = [0, 0, *kinds, 0, 0]
        counts.update(zip(padded, padded[1:], padded[2:], strict=False))
    n = noisy_channel.CLASSES
    total = sum(v for k, v in counts.items() if k != (0, 0, 0))
    assert total > 0
    two = lambda a, b, c: (
        sum(v for (_, x, y), v in counts.items() if (x, y) == (b, c))
        + 5 * (sum(v for (*_, y), v in counts.items() if y == c) + 1) / (sum(counts.values()) + n)
    ) / (sum(v for (_, x, _), v in counts.items() if x == b) + 5)
    for a, b, c in [(1, 2, 0), (0, 3, 4), (4, 0, 3), (2, 0, 3), (24, 24, 24)]:
        # letters of two texts are never neighbours
        got = (counts[a, b, c] + 5 * two(a, b, c)) / (sum(v for (x, y, _), v in counts.items() if (x, y) == (a, b)) + 5)
        if b or a:
            assert math.isclose(math.exp(tables[0][a, b, c]), got, rel_tol=1e-9)
    assert (2, 0, 3) not in counts
