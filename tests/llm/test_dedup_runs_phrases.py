"""Exact dedup, periodic runs and collocations against brute force on small documents with odd cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations, exact_dedup, periodic_runs
from millrace.llm.queries import QUERIES
from millrace.scratch import scratch_path
from millrace.tables import table

SF = "/root/testdata/sf0.001"
LONG = "over and " * 30_000


def saved(spark, rows, schema, parts=3):
    path = scratch_path(spark, "rows")
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return path


# Exact dedup

EXACT = [
    (0, None), (1, ""), (2, " "), (3, "one"), (4, "One"), (5, "one "), (6, "one"), (7, LONG), (8, LONG), (9, LONG[:-1]),
    (9, "one"), (9, "one"), (None, "alone"), (None, "one"), (None, "none"), (None, "none"), (10, None), (11, "été"), (12, "été"),
]
EXACT += [(100 + i, "hot") for i in range(300)]


def exact_groups(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    expected = collections.Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i))
        for nth, i in enumerate(ids, 1):
            expected[(i, ids[-1], len(ids), nth == len(ids))] += 1
    return expected


def as_counter(df):
    return collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


def weak(text):
    """A digest that many different texts share."""
    return F.char_length(text) % 3


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_exact_dedup(spark, digest):
    rows = [(i, t, "x", 1) for i, t in EXACT]
    path = saved(spark, rows, "doc_id long, text string, digest string, _metadata int")
    found = exact_dedup.exact_duplicates(spark, path, scratch_path(spark, "state"), digest)
    assert as_counter(found) == exact_groups(EXACT)


def test_exact_dedup_goes_on(spark):
    """Files that arrive later meet what the state remembers; old files are not taken in twice."""
    path, state = saved(spark, EXACT, "doc_id long, text string"), scratch_path(spark, "state")
    before = exact_dedup.remember(spark, path, state).agg(F.sum("n")).first()[0]
    again = exact_dedup.remember(spark, path, state).agg(F.sum("n")).first()[0]
    assert before == again == len(EXACT)
    more = [(500, "one"), (501, "new"), (502, "hot")]
    spark.createDataFrame(more, "doc_id long, text string").write.mode("append").parquet(path)
    found = exact_dedup.exact_duplicates(spark, path, state)
    assert as_counter(found) == exact_groups(EXACT + more)


def test_exact_dedup_of_nothing(spark):
    path = scratch_path(spark, "rows")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(path)
    assert exact_dedup.exact_duplicates(spark, path, scratch_path(spark, "state")).count() == 0


def test_exact_dedup_state_is_on_disk_and_session_untouched(spark):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    path, state = saved(spark, EXACT, "doc_id long, text string"), scratch_path(spark, "state")
    exact_dedup.remember(spark, path, state)
    assert spark.conf.get(provider) == before
    offsets = spark.read.text(f"{state}/offsets").agg(F.max(F.contains("value", F.lit("RocksDBStateStoreProvider")))).first()[0]
    assert offsets


# Periodic runs


def brute_runs(w, least):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i + q - s
            smaller = (all(w[k] == w[k + p] for k in range(s, s + size - p)) for p in range(1, q))
            if size >= max(least, 2 * q) and not any(smaller):
                out.append((s, size, q))
    return sorted(out, key=lambda run: (run[0], run[2]))


def brute_collapsed(w, runs):
    gone = set()
    for s, size, q in runs:
        gone |= set(range(s + q, s + size))
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def looping_texts():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "one", "a " * 11, "a " * 12, "a " * 13, "a b " * 6, "A a " * 6, "a\x1cb c " * 5, "été à " * 7 + "fin"]
    for _ in range(150):
        words = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 50))]
        if words and rng.random() < 0.5:
            at, period = rng.randrange(len(words)), rng.randint(1, 9)
            words = words[:at] + [(words + ["z"] * 9)[at + i % period] for i in range(len(words) - at)]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_match_brute_force(spark, least):
    rows = [(i, t, 1, "x") for i, t in enumerate(looping_texts())]
    rows += rows[4:8] + [(None, "a b " * 8, 1, "x"), (None, "a b " * 8, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, block string").repartition(3)
    got = collections.Counter()
    for r in periodic_runs.collapse_runs(docs, least).collect():
        got[(r.doc_id, r.n_words, r.text, tuple(tuple(run) for run in r.runs))] += 1
    expected = collections.Counter()
    for i, t, *_ in rows:
        w = [x.decode() for x in (t or "").encode().split()]
        runs = brute_runs(w, max(least, 2))
        expected[(i, len(w), brute_collapsed(w, runs), tuple(runs))] += 1
    assert got == expected


def test_runs_of_long_texts():
    """Loops of any period in one long text take one pass each, not one per multiple of the period."""
    for period in (1, 2, 999):
        _, codes, starts = periodic_runs.coded([" ".join(f"w{i % period}" for i in range(200_000))])
        assert periodic_runs.runs_of(codes, starts) == [[(0, 200_000, period)]]


def test_suffix_array_parts():
    """Suffix order, common prefixes and intervals are what sorting and comparing give."""
    rng = random.Random(8)
    lists = [[rng.randrange(3) for _ in range(n)] for n in (30, 1, 17)]
    codes = np.array(sum(lists, []), np.int64)
    starts = np.array([0, 30, 31, 48])
    levels = periodic_runs.ranked(codes, starts)
    order = np.argsort(levels[-1])
    suffix = lambda i: (int(np.searchsorted(starts, i, "right")), *codes[i : starts[np.searchsorted(starts, i, "right")]])
    assert order.tolist() == sorted(range(48), key=suffix)

    def shared(a, b):
        a, b = suffix(a), suffix(b)
        same = 0
        while a[0] == b[0] and same + 1 < min(len(a), len(b)) and a[same + 1] == b[same + 1]:
            same += 1
        return same

    lcp = periodic_runs.lcp_of(levels, order)
    assert lcp.tolist() == [0] + [shared(a, b) for a, b in zip(order, order[1:])]
    depths, firsts, lasts, owner = periodic_runs.lcp_intervals(lcp.tolist())
    for depth, first, last in zip(depths, firsts, lasts):
        inner = lcp[first + 1 : last + 1]
        assert inner.min() == depth and lcp[first] < depth and (last == 47 or lcp[last + 1] < depth)
    assert len(set(zip(firsts, lasts))) == len(depths) and (owner >= 0).sum() == (lcp > 0).sum()


def test_op12_on_the_tables(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        w = (text or "").encode().split()
        if len(w) > 400:
            continue
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        w = [x.decode() for x in w]
        runs = brute_runs(w, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, brute_collapsed(w, runs))]
        facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert got[doc_id] == (len(runs), *facts, *sha)


# Collocations


def brute_collocations(rows, least, top, absorbed=100, longest=5):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", (text or "").encode().lower()):
            w = [x.decode() for x in re.findall(rb"[^\x20\x09]+", piece)]
            totals[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    counts[(lang, *w[i : i + size])] += 1
    frequent = {p: f for p, f in counts.items() if len(p) > 2 and f >= least}
    inside = collections.Counter()
    for (lang, *w), f in frequent.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                part = (lang, *w[i : i + size])
                inside[part] = max(inside[part], f)
    ranked = collections.defaultdict(list)
    for (lang, *w), a in frequent.items():
        if (lang, *w) in inside and 100 * inside[(lang, *w)] >= absorbed * a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[(lang, *w[:k])], counts[(lang, *w[k:])]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        ranked[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, totals[lang], -s)
        for lang, found in ranked.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    }


def phrase_rows():
    rng = random.Random(4)
    words = "the of new york san jose été ñ Zoo x\x1cy".split(" ")
    rows = [(None, "en"), ("", "en"), (" \t\n.,", None), ("?", "fr"), ("the " * 900, "en"), ("new york " * 400, None)]
    passage = " ".join(f"p{i % 37}" for i in range(700))
    rows += [(passage, "en")] * 12 + [(passage + " tail", "de")] * 3
    for _ in range(300):
        picked = [rng.choice(words) + rng.choice(["", "", "", "", ",", ".", "\n", "\t"]) for _ in range(rng.randint(1, 60))]
        rows.append((" ".join(picked), rng.choice(["en", "en", "en", "fr", None, ""])))
    return rows + rows[-20:]


@pytest.mark.parametrize("block_bytes", [2_000, 16_000_000])
def test_collocations(spark, block_bytes):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, phrase string, n int").repartition(3)
    found = collocations.collocations(docs, min_count=10, top=40, block_bytes=block_bytes)
    assert {tuple(r) for r in found.collect()} == brute_collocations(rows, 10, 40)


def test_collocations_absorbed_by_longer_ones(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = collocations.collocations(docs, min_count=8, top=500, absorbed=60, longest=4)
    assert {tuple(r) for r in found.collect()} == brute_collocations(rows, 8, 500, 60, 4)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(docs).count() == 0
    docs = spark.createDataFrame([(None, None), (" ", "en")], "text string, lang string")
    assert collocations.collocations(docs).count() == 0


def test_chunks_overlap_and_hold_every_word_once():
    rng = random.Random(6)
    for size in [1, 4, 8, 9, 50, 2_000]:
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(size)] if size < 2_000 else [b"a"] * size
        chunks = collocations.chunks_of(words, 4)
        joined = []
        for chunk, followed in chunks:
            w = chunk.split(b" ")
            assert len(w) <= collocations.MOST + 4 or not followed
            joined += w[: len(w) - 4] if followed else w
        assert joined == words and not chunks[-1][1] and all(followed for _, followed in chunks[:-1])


def test_scores_are_exact(spark):
    big = [(10**14 + 7, 10**16 + 9, 3 * 10**14 + 1, 2 * 10**14 + 5), (100, 10**16, 100, 100)]
    df = spark.createDataFrame(big, "a long, n long, l long, r long")
    got = [r[0] for r in df.select(collocations.exact_score(*[F.col(c) for c in "anlr"])).collect()]
    assert got == [1000 * a * n // (left * right) for a, n, left, right in big]
