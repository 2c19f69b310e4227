"""Every operator on tables with nulls, ties, long texts and repeats, on empty tables, and with clashing columns."""

import ctypes
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lathework.llm import common, katz, quality
from lathework.llm.boosting import BoostedTrees
from lathework.llm.decontaminate import contaminated, drop_contaminated, overlap
from lathework.llm.hamming import Shard, top_k
from lathework.llm.katz import score_katz
from lathework.llm.katz_orders import score_orders
from lathework.llm.line_dedup import Bloom, drop_repeated_lines
from lathework.llm.packing import combinations, nonnegative_least_squares, pack, packed, plan
from lathework.llm.pii import PATTERNS, find_pii
from lathework.llm.quality import LineCrf, score_quality, training_rows
from lathework.llm.repeats import drop_repeats, lcp_intervals, maximal_repeats
from lathework.llm.simhash import drop_near_duplicates, near_duplicate_groups, shingles, simhash_groups
from lathework.llm.url_filter import CharModel, RatioModel, judge_urls
from tests.llm.fixtures import ITEM, LINE, documents, empty, frame

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LOW = -(2**63)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def worker_memory(spark, trim):
    """MB of the largest of the Python workers, of which every one gets a task."""

    def told(batches):
        time.sleep(1)
        if trim:
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)
        with open("/proc/self/status") as f:
            kb = int(re.search(r"RssAnon:\s+(\d+)", f.read())[1])
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([kb / 1024])], ["mb"])

    return spark.range(0, 4, 1, 4).mapInArrow(told, "mb double").agg(F.max("mb")).first()[0]


def test_workers_give_back_what_a_task_freed(spark):
    text = F.concat_ws("\n", *(F.concat(F.lit(f"line {j} of a text like no other, which is "), "doc_id") for j in range(40)))
    docs = spark.range(0, 80_000, 1, 4).select(F.col("id").alias("doc_id")).withColumn("text", text)
    drop_repeated_lines(docs.limit(1)).count()  # what is imported and kept once
    before = worker_memory(spark, trim=True)
    assert drop_repeated_lines(docs).where("n_dropped = 0").count() == 80_000
    assert worker_memory(spark, trim=False) < before + 40


def test_what_a_task_freed_goes_back_to_the_system():
    def resident():
        with open("/proc/self/status") as f:
            return int(re.search(r"RssAnon:\s+(\d+)", f.read())[1]) / 1024

    def run(batches):
        parts = [np.ones(8000) for _ in range(4000)]
        last.append(parts[-1])  # what lies below it stays with the process
        del parts
        yield from batches

    last, before = [], resident()
    assert list(run(iter([1, 2]))) == [1, 2] and resident() > before + 150
    assert list(common.given_back(run)(iter([1, 2]))) == [1, 2] and resident() < before + 50


# 10


def brute_lines(rows, least=20, min_docs=3):
    key = lambda x: re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", x).translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
    held = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                held[key(x)].add(LOW if i is None else i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and (LOW if i is None else i) != max(held[key(x)]))]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("budget", [64 << 20, 1 << 10])
def test_line_dedup_is_exact_for_any_filter_budget(spark, budget):
    found = drop_repeated_lines(frame(spark), filter_bytes=budget)
    assert found.columns == ["doc_id", "text", "score", "words", "n_lines", "n_dropped"]
    assert collected(found.select("doc_id", "text", "n_lines", "n_dropped")) == brute_lines(documents())
    assert sum(LINE.lower() in (r.text or "").lower() for r in found.collect()) == 1


def test_line_dedup_of_nothing(spark):
    assert drop_repeated_lines(empty(spark)).count() == 0


def test_bloom_filters_have_no_false_negatives_after_folding():
    h = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    for bits in (1 << 16, 1 << 10, 64):
        b = Bloom(bits)
        b.add(h)
        assert Bloom(bits, b.data()).has(h).all()


# 6


def brute_fingerprint(text, k=3):
    s = shingles(None if text is None else text.encode(), k)
    if not s:
        return 0
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(spark):
    rows = [r for r in documents() if r[0] is not None]
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (fps[a] ^ fps[b]).bit_count() <= 3 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    least = {x: min(rows[i][0] for i in range(len(rows)) if label[i] == x) for x in label}
    want = sorted((r[0], np.uint64(f).astype(np.int64).item(), least[x]) for r, f, x in zip(rows, fps, label, strict=True))
    assert collected(simhash_groups(frame(spark, rows))) == sorted(want, key=repr)
    assert simhash_groups(frame(spark)).count() == len(documents())
    assert simhash_groups(empty(spark)).count() == 0


def test_near_duplicates_by_similarity(spark):
    words = [f"w{i}" for i in range(200)]
    near = words[:100] + ["changed"] + words[101:]
    far = [f"w{i}" if i % 4 else f"z{i}" for i in range(200)]
    rows = [(5, " ".join(words), "x", "y"), (3, " ".join(near).upper(), "x", "y"), (9, " ".join(far), "x", "y"), (2, None, "x", "y"), (4, "", "x", "y"), (6, "short", "x", "y"), (7, "short", "x", "y"), (7, "short", "x", "y")]
    found = {(r.id, r.group) for r in near_duplicate_groups(frame(spark, rows)).collect()}
    assert found == {(5, 3), (3, 3), (9, 9), (2, 2), (4, 2), (6, 6), (7, 6)}
    assert sorted(r.doc_id for r in drop_near_duplicates(frame(spark, rows)).collect()) == [2, 3, 6, 9]
    copies = drop_near_duplicates(frame(spark, [(1, "same", "x", "y")] * 3 + [(1, "other", "x", "y"), (None, "same", "x", "y"), (None, "same", "x", "y")]))
    assert collected(copies.select("doc_id", "text")) == [(1, "other"), (None, "same")]
    assert drop_near_duplicates(empty(spark)).count() == 0


def template_texts(families: int, copies: int) -> list[tuple]:
    """Texts of the same words that differ in the order of 30 of 240, and near copies of some."""
    r = random.Random(11)
    names = [f"w{i:03d}" for i in range(240)]
    slots = [r.sample(names[210:], 30) for _ in range(families)]
    slots += [s[:24] + s[24:][::-1] for s in r.sample(slots, copies)]
    return [(i, " ".join(names[:210] + s), "x", "y") for i, s in enumerate(slots)]


def groups_by_brute_force(rows: list[tuple], similarity: float = 0.8) -> set[tuple]:
    sets = [set(shingles(t.encode(), 5)) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if min(len(sets[i]), len(sets[j])) < similarity * max(len(sets[i]), len(sets[j])):
            continue
        both = len(sets[i] & sets[j])
        if both >= similarity * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
            group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    return {(rows[i][0], rows[g][0]) for i, g in enumerate(group)}


def test_near_duplicates_in_a_crowd(spark):
    rows = template_texts(500, 100)
    want = groups_by_brute_force(rows)
    assert sum(i != g for i, g in want) == 100
    assert {(r.id, r.group) for r in near_duplicate_groups(frame(spark, rows)).collect()} == want


def test_near_duplicates_in_a_dense_leaf(spark):
    rows = template_texts(110, 60)
    want = groups_by_brute_force(rows)
    assert sum(i != g for i, g in want) == 60
    assert {(r.id, r.group) for r in near_duplicate_groups(frame(spark, rows)).collect()} == want


def test_near_duplicates_whose_fingerprints_are_far_apart(spark):
    """Pairs of the similarity and no copies: a block that repeats one word, or a few long runs, moves the fingerprint of
    words out of the trees' reach while few distinct shingles differ."""
    r = random.Random(2)
    rows = []
    for i in range(40):
        base = [f"w{r.randrange(10**6)}" for _ in range(60)]
        rows += [(2 * i, " ".join(base), "x", "y"), (2 * i + 1, " ".join(base + [f"q{i}"] * 4000), "x", "y")]
    want = groups_by_brute_force(rows)
    assert {g for _, g in want} == set(range(0, 80, 2))
    assert {(x.id, x.group) for x in near_duplicate_groups(frame(spark, rows)).collect()} == want


def test_near_duplicates_in_a_large_group_of_near_copies(spark):
    r = random.Random(3)
    base = [f"w{r.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(10_000):
        text = list(base)
        text[r.randrange(200)] = f"v{i}"
        rows.append((i, " ".join(text), "x", "y"))
    rows += [(20_000 + i, " ".join(f"z{i}x{k}" for k in range(50)), "x", "y") for i in range(300)]
    assert [x.doc_id for x in drop_near_duplicates(frame(spark, rows)).collect() if x.doc_id < 20_000] == [0]


def test_near_duplicates_on_the_test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(i, t or "", "x", "y") for i, t in docs.collect()]
    found = {(x.id, x.group) for x in near_duplicate_groups(docs).collect()}
    want = groups_by_brute_force(rows)
    assert len(found & want) >= 0.99 * len(want)


def test_near_duplicates_on_the_test_tables_are_all_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = groups_by_brute_force([(i, t or "", "x", "y") for i, t in docs.collect()])
    assert {(x.id, x.group) for x in near_duplicate_groups(docs).collect()} == want


# 7


def brute_overlap(rows, items, width=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})))
    out = []
    for i, t, *_ in rows:
        w, hit, found = split(t), set(), set()
        for k, x in items:
            v = split(x)
            n = min(width, len(v))
            for a in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[a : a + n]:
                        hit |= set(range(p, p + n))
                        found.add(str(k))
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [20_000, 3])
def test_overlap(spark, block):
    items = [(1, ITEM), (2, "beta gamma"), (3, None), (4, ""), (5, "one passage of words that several documents share word for word"), (6, "one passage of words that several documents share word for word"), (7, "the the the the")]
    rows = documents()
    found = overlap(frame(spark), spark.createDataFrame(items, "item_id long, text string"), block=block)
    assert collected(found.select("id", "n_words", "n_hit", "item_ids")) == brute_overlap(rows, items)
    kept = drop_contaminated(frame(spark), spark.createDataFrame(items, "item_id long, text string"))
    assert kept.count() == found.where(~contaminated()).count()
    assert kept.columns == frame(spark).columns


def test_overlap_of_nothing(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert overlap(empty(spark), items).count() == 0
    assert collected(overlap(frame(spark), items.limit(0)).select("n_hit").distinct()) == [(0,)]


# 8


def brute_repeats(rows, least=50):
    earliest = {}
    data = [(LOW if i is None else i, i, (t or "").encode()) for i, t, *_ in rows]
    for rank, _, b in data:
        for p in range(len(b) - least + 1):
            earliest[b[p : p + least]] = min(rank, earliest.get(b[p : p + least], rank))
    out = []
    for rank, i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - least + 1):
            if earliest[b[p : p + least]] < rank:
                gone[p : p + least] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((i, len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"crowd": 1, "chunk_bytes": 20_000}, {"chunk_bytes": 3_000, "bucket_bytes": 2_000}])
def test_repeats(spark, options):
    rows = documents()
    assert collected(drop_repeats(frame(spark), **options)) == brute_repeats(rows)
    assert drop_repeats(empty(spark)).count() == 0


def test_repeats_in_constant_and_periodic_texts(spark):
    r = random.Random(4)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    line = "a line that stands here very often indeed"
    texts = [" " * 3000, word(300) + " " * 2000 + word(80), "ab" * 900, word(30) + "ab" * 300 + word(60), f"{line}\n" * 60, word(70) + f"{line}\n" * 3 + word(9), " " * 51, "b" + "ab" * 26, " " * 49, line * 2]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts + texts[::-1])]
    r.shuffle(rows)
    for options in ({}, {"crowd": 1, "chunk_bytes": 1000}):
        assert collected(drop_repeats(frame(spark, rows), **options)) == brute_repeats(rows)


def test_repeats_in_very_long_monotonous_texts(spark):
    line = "one line that is repeated in this text very often\n"
    rows = [(1, " " * 5_000_000, "x", "y"), (2, " " * 5_000_000 + "end", "x", "y"), (3, line * 100_000, "x", "y"), (4, "start " + line * 100_000, "x", "y")]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in drop_repeats(frame(spark, rows)).collect()}
    assert got == {1: (5_000_000, 0, 0), 2: (5_000_003, 5_000_000, 1), 3: (5_000_000, 0, 0), 4: (5_000_006, 5_000_000, 1)}


def test_repeats_with_text(spark):
    r = next(x for x in drop_repeats(frame(spark), with_text=True).collect() if x.doc_id == 14)
    text = next(t for i, t, *_ in documents() if i == 14).encode()
    assert bytes(r.kept) == b"" and r.starts == [0] and r.stops == [len(text)]


def test_repeats_write_their_answers_to_few_files(spark, monkeypatch):
    monkeypatch.setattr(common, "MADE", [])
    assert drop_repeats(frame(spark)).where("n_removed > 0").count()
    files = {p.rsplit("/", 1)[1].rsplit("-", 1)[0]: len(spark.read.parquet(p).inputFiles()) for p in common.MADE}
    assert files == {"repeat-chunks": 3, "repeat-verdicts": 1, "repeat-spans": 1}


def test_interval_tree_gives_all_maximal_repeats():
    texts = [b"xabcdeyabcdz", b"abcdeq", b"bcd"]
    found = {(texts[g[0][0]][g[0][1] : g[0][1] + n], tuple(g)) for n, g in maximal_repeats(texts, 3)}
    want = set()
    subs = {t[a:z] for t in texts for a in range(len(t)) for z in range(a + 3, len(t) + 1)}
    for s in subs:
        at = [(i, p) for i, t in enumerate(texts) for p in range(len(t) - len(s) + 1) if t[p : p + len(s)] == s]
        sides = lambda d: {texts[i][p + d] if 0 <= p + d < len(texts[i]) else -1 - i for i, p in at}
        ends = lambda d: len(sides(d)) > 1 or min(sides(d)) < 0
        if len(at) > 1 and ends(-1) and ends(len(s)):
            want.add((s, tuple(at)))
    assert found == want
    assert sorted(lcp_intervals([3, 3, 1, 2], 1)) == [(0, 2, 3), (0, 4, 1), (3, 4, 2)]


# 3


def test_packing_round_trip(spark):
    rows = documents()
    exact = Tokenizer.from_file(JSON)
    pieces = pack(frame(spark), JSON, RANKS, with_ids=True).collect()
    want = sorted(tuple(exact.encode(t or "", add_special_tokens=False).ids + [0]) for _, t, *_ in rows)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids)) and len(p.ids) == 4 * p.length
        by_sequence[p.sequence_id].append(p)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        size = sum(p.length for p in own)
        assert own[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(own, own[1:], strict=False))
        assert size == 1024 or size & (size - 1) == 0
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[(p.doc_id, p.doc_tokens)].append(p)
    rebuilt = []
    for own in by_doc.values():
        own.sort(key=lambda p: p.start)
        copies = sum(p.start == 0 for p in own)
        if copies == 1:
            assert all(a.start + a.length == b.start for a, b in zip(own, own[1:], strict=False))
            rebuilt.append(tuple(np.frombuffer(b"".join(bytes(p.ids) for p in own), "<u4").tolist()))
    assert set(rebuilt) <= set(want) and sum(p.length for p in pieces) == sum(map(len, want))
    assert pack(empty(spark), JSON, RANKS).count() == 0


def test_special_tokens_follow_the_tokenizer(spark):
    text = "a <|endoftext|> b \U0001d400"
    ids = Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids + [0]
    pieces = sorted(pack(frame(spark, [(1, text, "x", "y")]), JSON, RANKS, with_ids=True).collect(), key=lambda p: p.start)
    assert np.frombuffer(b"".join(bytes(p.ids) for p in pieces), "<u4").tolist() == ids


def test_packing_plan_fills_windows():
    sizes = np.random.default_rng(2).integers(1, 3000, 800)
    sequences = list(packed(sizes, 1024))
    totals = Counter(sum(n for *_, n in s) for s in sequences)
    assert all(t == 1024 or t & (t - 1) == 0 for t in totals) and sum(t != 1024 for t in totals.elements()) <= 10
    x = nonnegative_least_squares(np.array([[0, 300, 724], [0, 512, 512]]), np.bincount([300, 724, 300, 724, 512, 512], minlength=1025))
    assert np.allclose(x, [2, 1], atol=0.05)
    rests = np.random.default_rng(3).integers(1, 1024, 4000)
    groups = plan(rests, 1024)
    used = [i for g in groups for i in g]
    assert len(used) == len(set(used)) > 0.6 * len(rests) and all(rests[g].sum() == 1024 for g in groups)


def test_least_squares_against_all_supports():
    r = np.random.default_rng(6)
    for _ in range(5):
        histogram = np.zeros(33, np.int64)
        histogram[r.choice(np.arange(1, 32), 9, replace=False)] = r.integers(1, 30, 9)
        columns = combinations(histogram, 32)[:9]
        a = np.zeros((33, len(columns)))
        for c, own in enumerate(columns):
            for v in own[own > 0]:
                a[v, c] += 1
        error = lambda x: float(((a @ x - histogram) ** 2).sum())  # noqa: E731, B023
        best = error(np.zeros(len(columns)))
        for n in range(1, len(columns) + 1):
            for own in itertools.combinations(range(len(columns)), n):
                x = np.zeros(len(columns))
                x[list(own)] = np.linalg.lstsq(a[:, own], histogram, rcond=None)[0]
                if (x >= -1e-9).all():
                    best = min(best, error(x))
        assert error(nonnegative_least_squares(columns, histogram, 20_000, 1e-9)) <= best * 1.001 + 1e-6


def test_combinations_fill_the_window():
    histogram = np.bincount([3, 3, 3, 5, 7, 10, 10, 2, 8], minlength=17)
    found = {tuple(c[c > 0].tolist()) for c in combinations(histogram, 16, often=9)}
    lengths = [2, 3, 5, 7, 8, 10]
    two_and_three = {c for n in (2, 3) for c in itertools.combinations_with_replacement(lengths, n) if sum(c) == 16}
    assert two_and_three <= found and all(sum(c) == 16 for c in found) and (2, 3, 3, 8) in found


def test_packing_of_monotonous_texts(spark):
    texts = [" " * 2_000_000, "\n" * 2_000_000, "a" * 100_000, " \t" * 50_000, "x " * 100_000]
    exact = Tokenizer.from_file(JSON)
    want = [len(exact.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
    pieces = pack(frame(spark, [(i, t, "x", "y") for i, t in enumerate(texts)]), JSON, RANKS).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("whole")).collect()
    assert sorted((p.doc_id, p.n, p.whole) for p in pieces) == [(i, n, n) for i, n in enumerate(want)]


# 4


def test_katz_matches_brute_force_and_sums_to_one(spark):
    rows = documents()
    train = training_rows("doc_id", 7, 2)
    found = collected(score_katz(frame(spark), train, chunk=3000).select("doc_id", "train", "n_tokens", "n_known", "base_score", "score"))
    tokens = lambda t: (t or "").encode().lower().split() + [b"\n"]
    learnt = [tokens(t) for i, t, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    u, pairs, heads = Counter(x for t in learnt for x in t), Counter(), Counter()
    for t in learnt:
        for a, b in zip([b""] + t, t, strict=False):
            pairs[a, b] += 1
            heads[a] += 1
    of = lambda c: np.array([sum(v == r for v in c.values()) for r in range(1, 7)])
    n, model, d = sum(u.values()), katz.Unigrams(sum(u.values()), len(u), of(u)), katz.discounts(of(pairs))
    p1 = lambda w: float(model.probability(np.array([u[w]]))[0])
    followers = defaultdict(list)
    for (a, b), c in pairs.items():
        followers[a].append((b, c))

    def weight(a):
        none = all(c > 5 for _, c in followers[a])
        total = heads[a] + none
        return total, (1 - sum(d[min(c, 6)] * c for _, c in followers[a]) / total) / (1 - sum(p1(b) for b, _ in followers[a]))

    def log_p(a, b):
        if pairs[a, b]:
            return math.log10(d[min(pairs[a, b], 6)] * pairs[a, b] / weight(a)[0])
        return (math.log10(weight(a)[1]) if a in followers else 0) + math.log10(p1(b))

    want = []
    for i, t, *_ in rows:
        w = tokens(t)
        own = i is not None and zlib.crc32(str(i).encode()) % 7 != 2
        want.append((i, own, len(w), sum(u[x] > 0 for x in w), sum(math.log10((u[x] + 1) / (n + len(u) + 1)) for x in w), sum(log_p(a, b) for a, b in zip([b""] + w, w, strict=False))))
    for got, ref in zip(found, sorted(want, key=repr), strict=True):
        assert got[:4] == ref[:4] and np.allclose(got[4:], ref[4:], rtol=1e-9)
    for a in list(followers)[:20]:
        assert abs(sum(10 ** log_p(a, b) for b in u) + 10 ** (log_p(a, b"never seen")) - 1) < 1e-9
    assert score_katz(empty(spark), train).count() == 0
    untrained = score_katz(frame(spark), F.lit(False)).agg(F.max(F.abs("score"))).first()[0]
    assert untrained == 0.0


def brute_katz(rows, order):
    """log10 P(word | history words) by recursion over dictionaries, and the training texts."""
    tokens = lambda t: (t or "").encode().lower().split() + [b"\n"]
    learnt = [tokens(t) for i, t, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    unigrams = Counter(x for t in learnt for x in t)
    of = lambda c: np.array([sum(v == r for v in c.values()) for r in range(1, 7)])
    model = katz.Unigrams(sum(unigrams.values()), len(unigrams), of(unigrams))
    grams = {n: Counter() for n in range(2, order + 1)}
    for t in learnt:
        s = [b"", *t]
        for n, counts in grams.items():
            counts.update(tuple(s[i - n + 1 : i + 1]) for i in range(n - 1, len(s)))
    d = {n: katz.discounts(of(c)) for n, c in grams.items()}
    after = defaultdict(dict)
    for c in grams.values():
        for g, k in c.items():
            after[g[:-1]][g[-1]] = k

    def probability(history, word):
        if not history:
            return float(model.probability(np.array([unigrams[word]]))[0])
        seen = after.get(history)
        if seen is None:
            return probability(history[1:], word)
        own = d[len(history) + 1]
        total = sum(seen.values()) + all(k > 5 for k in seen.values())
        if word in seen:
            return own[min(seen[word], 6)] * seen[word] / total
        if history not in weight:
            weight[history] = (1 - sum(own[min(k, 6)] * k for k in seen.values()) / total) / (1 - sum(probability(history[1:], w) for w in seen))
        return weight[history] * probability(history[1:], word)

    weight: dict = {}
    return probability, tokens, unigrams, after


@pytest.mark.parametrize("order", [2, 3])
def test_katz_of_any_order_matches_brute_force_and_sums_to_one(spark, order):
    rows = documents()
    rows.append((70, "the of and the of and the of " * 40, "x", "y"))
    probability, tokens, unigrams, after = brute_katz(rows, order)
    train = training_rows("doc_id", 7, 2)
    found = collected(score_orders(frame(spark, rows), train, order).select("doc_id", "train", "n_tokens", "n_known", "base_score", "score"))
    n, v = sum(unigrams.values()), len(unigrams)
    want = []
    for i, t, *_ in rows:
        w = tokens(t)
        s = [b"", *w]
        score = sum(math.log10(probability(tuple(s[max(0, p - order + 1) : p]), s[p])) for p in range(1, len(s)))
        own = i is not None and zlib.crc32(str(i).encode()) % 7 != 2
        want.append((i, own, len(w), sum(unigrams[x] > 0 for x in w), sum(math.log10((unigrams[x] + 1) / (n + v + 1)) for x in w), score))
    for got, ref in zip(found, sorted(want, key=repr), strict=True):
        assert got[:4] == ref[:4] and np.allclose(got[4:], ref[4:], rtol=1e-9)
    for history in list(after)[:: max(1, len(after) // 12)]:
        assert abs(sum(probability(history, w) for w in unigrams) + probability(history, b"never seen") - 1) < 1e-9
    if order == 2:
        packed_form = collected(score_katz(frame(spark, rows), train).select("doc_id", "train", "n_tokens", "n_known", "base_score", "score"))
        assert all(np.allclose(a[4:], b[4:], rtol=1e-9) for a, b in zip(found, packed_form, strict=True))
    else:
        assert score_orders(empty(spark), train).count() == 0
        assert score_orders(frame(spark), F.lit(False)).agg(F.max(F.abs("score"))).first()[0] == 0.0


# 9


def test_pii_base_spans_match_python(spark):
    texts = ["mail a.b@c.de, x@y and ab@c.d@e.f", "ip 1.2.3.4.5 256.1.1.1 and 010.0.0.1", "card 4111 1111 1111 1111 or 4111111111111112, 0000000000000", "call +1 (386) 555-3733 or +12", "é漢\U0001f600 z@q.de", None, "", "1" * 5000, "a" * 40_000 + "@b.c", "+1" + "(" * 20_000, "1 " * 5000, "token = \"f5d9a5f145ec1d4094641bcfa9b27f35c6a4b9f6\" password=d9f3929e83c8655244"]
    python = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def fine(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(v - 9 if v > 9 else v for v in twice) % 10 == 0
        return True

    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    assert list(python) == list(PATTERNS)
    for r in find_pii(frame(spark, rows)).collect():
        t = texts[r.doc_id] or ""
        want = [f"{k}:{m.start()}:{m.end()}" for k, p in python.items() if not (k == "email" and len(t) > 20_000) for m in re.finditer(p, t) if fine(k, m.group())]
        if len(t) < 20_000 or "@" not in t:
            assert r.base_spans == want, (r.doc_id, r.base_spans, want)
        assert set(r.base_spans) <= set(r.spans)
    assert find_pii(empty(spark)).count() == 0


def test_pii_adds_disguised_data_and_leaves_the_rest(spark):
    r = random.Random(5)
    name = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(4, 9))) + str(r.randint(10, 99))
    ip = lambda sep: sep.join(str(r.randint(10, 250)) for _ in range(4))
    key = lambda: "".join(r.choice("0123456789abcdef") for _ in range(38)) + "a1"
    rows = [(i, f"write to {name()}@mail{i % 7}.example.com from {ip('.')} now{', 300.4.5.6' if i % 40 == 0 else ''} and look at home.The end is at work.Now token = \"{key()}\" or a-long-name-with-words-{i}-in-it", "x", "y") for i in range(400)]
    texts = {1000: f"write to {name()} [at] mail3.example [dot] com now", 1001: f"host {ip('[.]')} here", 1002: f'it is "{key()}" here', 1003: "look at home.The end of some-words-and-more-words-2024", 1004: "version 300.400.1.2 here", 1005: "4111 1111 1111 1112"}
    rows += [(i, t, "x", "y") for i, t in texts.items()]
    found = {x.doc_id: (list(x.base_spans), list(x.spans)) for x in find_pii(frame(spark, rows)).where("doc_id >= 1000").collect()}
    added = {i: sorted({s.split(":")[0] for s in spans} - {s.split(":")[0] for s in base}) for i, (base, spans) in found.items()}
    assert added == {1000: ["email"], 1001: ["ip"], 1002: ["secret"], 1003: [], 1004: [], 1005: []}
    a, z = map(int, found[1000][1][0].split(":")[1:])
    assert texts[1000][a:z].endswith("example [dot] com") and "[at]" in texts[1000][a:z]


def test_boosted_trees_learn_and_their_column_agrees(spark):
    r = np.random.default_rng(2)
    x = np.array(list(itertools.product(range(3), range(4), range(2))))
    truth = (x[:, 0] == 1) ^ (x[:, 1] > 1)
    good, bad = np.where(truth, 90, 4) + r.integers(0, 5, len(x)), np.where(truth, 3, 80) + r.integers(0, 5, len(x))
    trees = BoostedTrees(x, good, bad)
    p = trees.probabilities(x)
    assert np.abs(p - good / (good + bad)).max() < 0.1 and ((p > 0.5) == truth).all()
    df = spark.createDataFrame([tuple(map(int, row)) for row in x], "a int, b int, c int")
    odds = [row[0] for row in df.select(trees.log_odds([F.col(c) for c in "abc"])).collect()]
    assert np.allclose(odds, np.log(p / (1 - p)), atol=1e-9)


CLASHING = ["__id", "__lost", "__bad", "__gone", "__base", "__email", "id", "key", "group", "own_id", "own_lost", "own_key", "own_base", "own_email", "n", "chunk", "rank", "copies"]


def test_clashing_columns_are_kept(spark):
    plain = frame(spark).select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"])
    clash = plain.select("*", *(F.lit(c).alias(c) for c in CLASHING))
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    whole = {
        "lines": drop_repeated_lines, "near": drop_near_duplicates, "contaminated": lambda d: drop_contaminated(d, items), "pii": find_pii, "quality": lambda d: score_quality(d, labels),
    }
    for name, fn in whole.items():
        got, want = fn(clash), fn(plain)
        assert set(got.columns) == set(want.columns) | set(CLASHING), name
        assert collected(got.select(want.columns)) == collected(want), name
        assert all(tuple(r) == tuple(CLASHING) for r in got.select(CLASHING).collect()), name
    alone = {"groups": simhash_groups, "overlap": lambda d: overlap(d, items), "repeats": drop_repeats, "packing": lambda d: pack(d, JSON, RANKS), "katz": lambda d: score_katz(d, training_rows("doc_id", 7, 2))}
    for name, fn in alone.items():
        assert fn(clash).count() == fn(plain).count(), name


# 1


def test_quality_tells_junk_from_prose(spark):
    rows = [r for r in documents(200) if r[0] is not None and r[1] and len(r[1]) < 5000]
    junk = [(1000 + i, re.sub(r"\w+", lambda m: m.group().upper() + "!!", t) if i % 2 else " | ".join(t.split()[:30]), "x", "y") for i, t, *_ in rows[:120]]
    labels = [(r[0], 1) for r in rows] + [(r[0], 0) for r in junk] + [(rows[0][0], 1)]
    extra = [(5000, None, "x", "y"), (5001, "", "x", "y"), (None, "some text", "x", "y")]
    found = score_quality(frame(spark, rows + junk + extra), spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r.doc_id: r for r in found.collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((got[i].predicted == 1) == (i < 1000) for i in held) / len(held)
    assert right > 0.95 and all(0 <= r.score <= 1 for r in got.values()) and found.count() == len(rows + junk + extra)
    again = score_quality(empty(spark), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert again.count() == 0
    alone = score_quality(frame(spark, rows[:3]), spark.createDataFrame([], "doc_id long, quality int")).select("score").distinct().collect()
    assert [r.score for r in alone] == [0.5]


def plain_features(line, before):
    n, words = len(line), line.split()
    if not n:
        return [1.0] + [0.0] * 15
    of = lambda kind: sum(c in kind for c in line)
    letters = sum(chr(c).isalpha() if c < 128 else True for c in line)
    k = len(words) or 1
    upper, marks, same = of(bytes(range(65, 91))) / max(1, letters), of(b"!#$%&*@^~<>=+_{}[]\\/") / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / k
    pipes = line.count(b"|") / k
    return [0.0, min(n, 2000) / 2000, letters / n, upper, upper > 0.5, marks, marks > 0.03, marks > 0.12, of(b"0123456789") / n, same, same > 0.15, len(set(words)) / k, pipes, pipes > 0.3, line in before, min(n / k, 30) / 30]


def test_features_of_lines(monkeypatch):
    texts = [(t or "").encode() for _, t, *_ in documents()] + [b"", b"\n\n", b"a\n", b" \n x  y\n| | 7", b"a b a a\na b a a\n\n\na b a a", b"LOUD!! A\xff\x0bb"]
    want = []
    for t in texts:
        lines = t.split(b"\n")
        want += [plain_features(x, set(lines[:i])) for i, x in enumerate(lines)]
    for block in (1 << 20, 50):
        monkeypatch.setattr(quality, "BLOCK", block)
        x, weights, sizes = quality.projected(texts, np.eye(16))
        assert np.allclose(x, np.array(want, float), atol=1e-12) and sizes.sum() == len(want) and weights.sum() == sum(len(t) + 1 for t in texts)


def test_marginals_against_all_label_sequences():
    r = np.random.default_rng(8)
    crf = LineCrf(r.normal(size=3), r.normal(size=(2, 2)))
    sizes = np.array([1, 7, 2, 9, 1])
    x = r.normal(size=(sizes.sum(), 3))
    want, pairs, at = [], np.zeros((2, 2)), 0
    for n in sizes:
        potential, total, good, links = x[at : at + n] @ crf.weights, 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(p for p, v in zip(potential, y, strict=True) if v) + sum(crf.links[a, b] for a, b in itertools.pairwise(y)))
            total += w
            good += w * np.array(y)
            for a, b in itertools.pairwise(y):
                links[a, b] += w
        want += (good / total).tolist()
        pairs += links / total
        at += n
    p, found = crf.marginals(x, sizes)
    assert np.allclose(p, want) and np.allclose(found, pairs)
    for lane in (64, 4, 2, 1):
        assert np.allclose(crf.good(x @ crf.weights, sizes, lane), want)


def test_chains_keep_their_neighbours():
    text = "\n".join(f"line {i} {'!' * (i % 7)}" for i in range(100)).encode()
    whole, _, _ = quality.projected([text], np.eye(16))
    full = quality.with_neighbours(whole, *quality.edges(np.array([100])))
    found = [quality.Chain(0, 1, *c).nodes()[0] for c in quality.chains_of(text, 10, 3)]
    assert [len(x) for x in found] == [10, 10, 10]
    for x, s in zip(found, (0, 45, 90), strict=True):
        assert np.allclose(x, full[s : s + 10], atol=1e-6)


def test_quality_of_very_long_texts(spark):
    rows = [r for r in documents(80) if r[0] is not None and r[1] and len(r[1]) < 5000]
    junk = [(1000 + i, t.upper() + "!!", "x", "y") for i, t, *_ in rows]
    labels = spark.createDataFrame([(r[0], 1) for r in rows] + [(r[0], 0) for r in junk], "doc_id long, quality int")
    long = [(5000, "a\n" * 10_000_000, "x", "y"), (5001, " " * 2_000_000, "x", "y"), (5002, "\n" * 2_000_000, "x", "y")]
    found = score_quality(frame(spark, rows + junk + long), labels).where("doc_id >= 5000").select("doc_id", "score").collect()
    assert len(found) == 3 and all(0 <= r.score <= 1 for r in found)


# 5


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def test_url_rules_and_ratio(spark):
    cases = [("https://a.example.com/en/1?x=/", "a.example.com", "/en/1", "example.com/en/", "block"), ("http://WWW.example.com/en/2#t", "www.example.com", "/en/2", "www.example.com/en/", "allow"), ("http://x.com", "x.com", "", None, None), ("http://x.com/", "x.com", "/", "com/", "allow"), ("ftp", "", "", None, None), (None, "", "", None, None), ("http://notcom/a", "notcom", "/a", None, None), ("https://h.net/es/q", "h.net", "/es/q", "net/es/", "block")]
    more = [(f"https://shop{i}.com/item/{i}",) for i in range(60)] + [(f"https://casino{i}.net/es/win/{i}",) for i in range(60)] + [("https://shop99.org/item/7",), ("https://casino99.org/es/win/7",)]
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate([*cases, *more])], "page_id long, url string, host string")
    got = {r.page_id: r for r in judge_urls(pages, RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule) and (verdict is None or got[i].verdict == verdict)
    assert (got[len(got) - 2].verdict, got[len(got) - 1].verdict) == ("allow", "block")
    assert judge_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in judge_urls(pages.where("page_id < 0 or page_id = 4"), RULES).collect()} == {"allow"}


def plain_probability(texts, order, context, char):
    """Witten-Bell interpolation by counting in the padded texts."""
    p = 1 / 257
    for k in range(order + 1):
        own = context[len(context) - k :]
        after = Counter(t[i + k] for t in texts for i in range(order - k, len(t) - k) if t[i : i + k] == own)
        if not after:
            break
        p = (after[char] + len(after) * p) / (sum(after.values()) + len(after))
    return p


def test_ratio_and_threshold_by_counting():
    r = random.Random(9)
    accepted, rejected = (["".join(r.choice(letters) for _ in range(r.randint(3, 9))) for _ in range(25)] for letters in ("abcx", "cdex"))
    model = RatioModel(accepted, rejected, 2)

    def ratio(text):
        out = 0.0
        for sign, all_texts in ((1, accepted), (-1, rejected)):
            texts = ["\x02\x02" + t + "\x02" for i, t in enumerate(all_texts) if i % 5]
            padded = "\x02\x02" + text + "\x02"
            out += sign * sum(math.log(plain_probability(texts, 2, padded[i - 2 : i], padded[i])) for i in range(2, len(padded)))
        return out / (len(text) + 1)

    for text in (*accepted[:6], *rejected[:6], "", "zzz", "abcde"):
        assert abs(model.ratio(text) - ratio(text)) < 1e-9
    yes, no = [ratio(t) for t in accepted[::5]], [ratio(t) for t in rejected[::5]]
    wrong = lambda cut: sum(x < cut for x in yes) / len(yes) + sum(x >= cut for x in no) / len(no)
    cuts = sorted(yes + no)
    assert wrong(model.threshold) <= min(wrong((a + b) / 2) for a, b in itertools.pairwise(cuts)) + 1e-9


@pytest.mark.parametrize("n", [6000, 3])
def test_url_model_and_threshold_use_all_urls(spark, n):
    """Scores are those of models counted over all distinct URLs but every fifth by hash, the threshold is that of all the rest."""
    r = random.Random(5)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(2, 7)))
    urls = [f"http://{word('abcdef')}{i}.com/{word('abxé')}" for i in range(n)] + [f"http://{word('cdefgh')}{i}.net/es/{word('xyz')}" for i in range(n)]
    urls += [f"http://{word('abcdefghé')}.org/{word('abxyz')}" for _ in range(40)] + ["http://org", "http://q\x02q.org/x"]
    rows = judge_urls(spark.createDataFrame([(u,) for u in urls], "url string"), RULES, order=3).withColumn("held", F.pmod(F.xxhash64(F.concat("host", "path")), F.lit(5)) == 0).collect()
    part = {}
    for kind in ("com/", "net/es/"):
        for held in (True, False):
            whole = sorted({x.host + x.path for x in rows if x.rule == kind})
            part[kind, held] = sorted({x.host + x.path for x in rows if x.rule == kind and x.held == held}) or whole
    yes, no = (CharModel(part[kind, False], 3) for kind in ("com/", "net/es/"))
    ratio = lambda t: (yes.log_likelihood(t) - no.log_likelihood(t)) / (len(t) + 1)
    scored = [x for x in rows if x.rule is None]
    assert len(scored) == 42
    assert all(abs(x.score - ratio(x.host + x.path)) < 1e-9 for x in scored)
    good, bad = (np.sort([ratio(t) for t in part[kind, True]]) for kind in ("com/", "net/es/"))
    cuts = np.unique(np.concatenate([good, bad]).round(12))
    cuts = (cuts[1:] + cuts[:-1]) / 2
    wrong = np.searchsorted(good, cuts) / len(good) + 1 - np.searchsorted(bad, cuts) / len(bad)
    best = min(zip(wrong.round(12), abs(cuts), cuts, strict=True))[2]
    assert all((x.verdict == "allow") == (x.score >= best) for x in scored if abs(x.score - best) > 1e-9)


def test_character_model_is_a_distribution():
    m = CharModel(["abcab", "abd"], 3)
    for context in ("\x02\x02\x02", "\x02ab", "zzz"):
        assert abs(sum(m.probability(context, c) for c in "abcd\x02") + (257 - 5) * m.probability(context, "?") - 1) < 1e-9


# 2


@pytest.mark.parametrize("shard_rows", [1_000_000, 40])
def test_top_k_is_exact(spark, shard_rows):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 40)).round(3)
    vectors[50:90] = vectors[7]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)] + [(400, None), (None, [1.0] * 40), (500, [1.0, -1.0]), (520, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = defaultdict(list)
    for r in top_k(df, F.col("vec_id") % 20 == 0, k=7, shard_rows=shard_rows).collect():
        found[r.query_id].append((r.rank, r.distance, r.neighbor_id))
    code = {i: [(v[j] > 0) if j < len(v) else False for j in range(40)] for i, v in rows if i is not None and v is not None}
    for q in [i for i in code if i % 20 == 0]:
        want = sorted((sum(a != b for a, b in zip(code[q], c, strict=True)), i) for i, c in code.items())[:7]
        assert sorted(found[q]) == [(n + 1, d, i) for n, (d, i) in enumerate(want)]
    assert top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_ends_by_its_bound(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    codes = np.packbits(np.array([[x > 0 for x in r.embedding] for r in rows]), axis=1).view(np.uint16)
    shard = Shard(ids, codes, 10)
    asks = ids % 20 == 0
    q, i, d = shard.results(ids[asks], codes[asks])
    assert shard.index.verified < 0.6 * asks.sum() * len(shard.first)
    for own, code in zip(ids[asks], codes[asks], strict=True):
        want = np.bitwise_count(codes ^ code).sum(1, dtype=np.int64)
        best = np.lexsort((ids, want))[:10]
        assert (i[q == own] == ids[best]).all() and (d[q == own] == want[best]).all()


def test_minimizers_do_not_depend_on_segments(monkeypatch):
    from lathework.llm import repeats

    r = np.random.default_rng(9)
    texts = [r.integers(97, 101, n).astype(np.uint8) for n in (10, 70, 5000, 30, 12_345, 0, 49, 50)] + [np.full(3000, 97, np.uint8)]
    data, sizes = np.concatenate(texts), np.array([len(t) for t in texts])

    def found(segment):
        monkeypatch.setattr(repeats, "SEGMENT", segment)
        x = repeats.Anchors(data, sizes, 50, 20, 16)
        return sorted(zip(x.doc.tolist(), x.place.tolist(), x.hash.tolist(), x.around.tolist(), strict=True))

    whole = found(1 << 22)
    assert whole == found(1000) == found(137) and len(whole) > 500
    ends = np.cumsum(sizes)
    places = {p for _, p, *_ in whole}
    for d, (a, z) in enumerate(zip(ends - sizes, ends, strict=True)):
        for s in range(a, z - 49):
            assert any(p in places for p in range(s, s + 31)), d
