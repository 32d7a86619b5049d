"""The text operators against brute force on small documents with every odd case, and the queries."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from millrace.llm import (
    decontamination, encoding, language, line_dedup, near_copies, packing, pii, quality, simhash, substring_dedup,
    token_counts, token_files,
)
from millrace.llm.components import components
from millrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_lines int, _bitmap string"


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def odd_texts():
    rng = random.Random(5)
    some = ["alpha", "beta", "gamma", "delta", "été", "Zoo", "one", "two"]
    long = " ".join(rng.choice(some) for _ in range(400))
    passage = " ".join(f"w{i}" for i in range(30))
    texts = [
        None, "", "\n", " \t\x0b", "A\nb\n\na", "a\x1cb\xa0c\nA ", "x " * 70, long, long + " tail",
        "start " + passage + " end", passage, passage[:-3] + "zz", "ÀB cd\r\nÀB cd", "one two one two one two",
    ]
    texts += [" ".join(rng.choice(some) for _ in range(rng.randint(1, 60))) for _ in range(25)]
    texts += ["same line\n" + t for t in texts[-12:]]
    return [(i, t) for i, t in enumerate(texts)] + [(3, "third again"), (7, long), (None, "no id"), (None, "no id")]


@pytest.fixture(scope="module")
def docs(spark):
    # Columns with names the operators use, which they replace or ignore.
    rows = [(d, t, 1, "x") for d, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def unique():
    return sorted(set(odd_texts()), key=lambda r: (r[0] is not None, r[0] or 0))


def by_text(df, *names):
    return {(r.doc_id, r.text): tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup(docs, unique, keep_first):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    found = collections.defaultdict(set)
    for row in unique:
        for line in (row[1] or "").split("\n"):
            found[key(line)].add(row)
    bitmaps = line_dedup.line_bitmaps(docs, min_docs=3, keep_first=keep_first)
    got = {}
    for r in bitmaps.collect():
        lines = [i for run in r.keep for i in range(run["first"], run["first"] + run["lines"])]
        got[(r.doc_id, r._text_hash)] = (r.n_lines, lines)
    hashes = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    assert len(got) == len(unique)
    seen = set()
    for row in sorted(unique, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r])):
        lines, kept = (row[1] or "").split("\n"), []
        for i, line in enumerate(lines):
            k = key(line)
            goes = k != "" and len(found[k]) >= 3 and not (keep_first and k not in seen)
            seen.add(k)
            if not goes:
                kept.append(i)
        assert got[(row[0], hashes[row])] == (len(lines), kept), row


def test_apply_bitmaps_keeps_rows_and_columns(docs):
    out = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, 3, False))
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)


def test_substring_dedup(docs, unique):
    kept = substring_dedup.remove_repeats(docs, window=6)
    hashes = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    seen, expected = set(), collections.Counter()
    repeats = collections.Counter(odd_texts())
    for row in sorted(unique, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r])):
        w = words(row[1])
        gone = set()
        for i in range(len(w) - 5):
            k = tuple(w[i : i + 6])
            if k in seen:
                gone |= set(range(i, i + 6))
            seen.add(k)
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        expected[(row[0], left, len(w), len(gone))] += repeats[row]
    got = collections.Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in kept.collect())
    assert got == expected


def test_window_hashes_match_direct_sum():
    x = np.arange(1, 50, dtype=np.uint64) * np.uint64(977)
    for length in (1, 2, 5, 6, 13, 20):
        powers = [pow(int(substring_dedup.FACTORS[0]), i, 1 << 64) for i in range(length)]
        direct = [sum(int(v) * p for v, p in zip(x[i:], powers)) % (1 << 64) for i in range(50 - length)]
        assert substring_dedup.window_hashes(x, length, substring_dedup.FACTORS[0]).tolist() == direct
        assert substring_dedup.least_of(x[::-1], length).tolist() == [min(x[::-1][i : i + length]) for i in range(50 - length)]


def test_simhash_entries():
    """Both ways through an entry give the classes that all pairs give."""
    rng = random.Random(2)
    entry = sorted(rng.sample(range(1 << 16), 900))

    def root(x, parent):
        while parent[x] != x:
            x = parent[x]
        return x

    def classes(links):
        parent = {f: f for f in entry}
        for a, b in links:
            a, b = root(a, parent), root(b, parent)
            parent[max(a, b)] = min(a, b)
        return {f: root(f, parent) for f in entry}

    pairs = [(a, b) for i, a in enumerate(entry) for b in entry[:i] if (a ^ b).bit_count() <= 2]
    assert classes(simhash.linked(entry)) == classes(pairs)
    some = entry[:40]
    assert classes(simhash.linked(some)) == classes([p for p in pairs if p[0] in some and p[1] in some])


def test_simhash_classes(spark):
    rng = random.Random(3)
    text = [f"word{rng.randint(0, 400)}" for _ in range(300)]
    rows = [(i, " ".join(text[:k] + ["edit"] + text[k + 1 :])) for i, k in enumerate(rng.sample(range(300), 80))]
    rows += [(100, None), (101, ""), (102, "  "), (103, "one"), (103, "one"), (None, "one"), (104, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fps = [simhash.fingerprint(simhash.shingle_hashes(t)) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(fps):
            group[i] = min(group[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 2)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[group[i]] = min(least.get(group[i], d), d)
    expected = sorted(((r[0], least.get(group[i])) for i, r in enumerate(rows)), key=str)
    got = simhash.near_duplicates(docs)
    assert sorted(((r.doc_id, r.component_id) for r in got.collect()), key=str) == expected
    assert simhash.one_of_each(docs).count() == len(set(group))


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    got = {(r.node, r.root) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(101, 100)}


ITEM = "A farmer named Tom Smith has 12 km of fence and gives 5 km of it to Ann while he keeps the other 12 km for goats."


def test_decontamination(spark):
    changed = ITEM.replace("Tom Smith", "Bob Jones").replace("12", "40").replace("Ann", "Eve")
    rows = [
        (1, "Before. " + ITEM + " After."), (2, changed), (4, None), (5, ""),
        (3, changed.replace("40", "41", 1)), (6, "nothing of the kind stands here at all, not one part"), (None, ITEM), (1, None),
        (7, "tiny little item of six words"),
    ]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string")
    items = spark.createDataFrame(
        [(10, ITEM), (11, "too short"), (12, None), (13, "Tiny little item of six words")], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()}
    assert got == {(1, 10), (2, 10), (None, 10), (7, 13)}
    assert decontamination.without_leaks(docs, items).count() == len(rows) + 2 - 6
    assert decontamination.leaks(docs.limit(0), items).count() == decontamination.leaks(docs, items.limit(0)).count() == 0


def test_quality_counts(docs):
    got = quality.judged(docs)
    for r in got.collect():
        w, x = words(r.text), r.text or ""
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [line for line in x.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines, r.n_symbols) == (
            len(w), sum(map(len, w)), len(covered), len(lines) - len(set(lines)), len(re.findall(r"[#*$%&|<>]", x))
        )
        assert r.base_failed == (len(w) < 50 or 2 * len(covered) > len(w))
        assert not (r.kept and r.base_failed)


def test_encoder_matches_the_library():
    encode = encoding.encoder(encoding.vocabulary())
    alphabet = list("abcZÀßÿñé  \n\t\x0b\x0c\r\x1c\x85\xa0　.,'!?12$%&|<>-_ªµİΣσ́ﬁ中😀") + ["<|endoftext|>", "don't", "Thble,"]
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 25)))
        ids = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert encode.encode(text) == np.array(ids, "<u4").tobytes(), repr(text)


def reference_ids(text):
    return encoding.encoder(encoding.vocabulary()).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_packing(docs):
    out = packing.pack_documents(docs, encoding.vocabulary(), window=64, round_tokens=500)
    rows = out.collect()
    windows = collections.defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length and r.length <= 64
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    pieces = collections.Counter((r.doc_id, r.start, bytes(r.ids)) for r in rows)
    expected = collections.Counter()
    for d, t in odd_texts():
        ids = np.array([*reference_ids(t), 2], "<u4")
        expected.update((d, s, ids[s : s + 64].tobytes()) for s in range(0, len(ids), 64))
    assert pieces == expected
    padded = {r.n_tokens: r.padded_length for r in packing.sequence_lengths(out, 64).collect()}
    assert all(p == (n if n & (n - 1) == 0 else 64) for n, p in padded.items())


def test_tightest_window():
    rng, tree, plain = random.Random(4), packing.OpenWindows(100), []
    for name in range(2000):
        if rng.random() < 0.5:
            room = rng.randint(1, 100)
            tree.open(room, name)
            plain.append(room)
        else:
            length = rng.randint(1, 100)
            fits = [r for r in plain if r >= length]
            found = tree.take(length)
            assert (found and found[1]) == (min(fits) if fits else None)
            if fits:
                plain.remove(min(fits))


def test_token_files(spark, docs, tmp_path):
    import pyarrow.orc as orc

    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, encoding.vocabulary())
    rows = sorted(token_files.checksums(token_files.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    crc = lambda t: zlib.crc32(np.array([*reference_ids(t), 1], "<u4").tobytes())
    assert sorted((str(r.doc_id), r.ids_crc32) for r in rows) == sorted((str(d), crc(t)) for d, t in odd_texts())
    files = list((tmp_path / "tokens").glob("*.orc"))
    assert files and all(orc.ORCFile(f).nstripes >= 1 for f in files)
    one = token_files.read_tokens(spark, path).filter("doc_id = 9")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,9)" in one._jdf.queryExecution().toString()


def test_language(spark):
    rng = random.Random(6)
    kinds = {"aa": ["the", "tion", "with", "hand"], "bb": ["zcz", "ky", "prz", "ow"], "cc": ["ωρα", "και", "λόγος"]}
    rows = [
        (i, " ".join(rng.choice(kinds[k]) for _ in range(rng.randint(20, 60))), k)
        for i, k in enumerate(rng.choices(list(kinds), k=200))
    ]
    docs = spark.createDataFrame(rows + [(900, None, "aa"), (None, "the hand", None), (901, "12 34!", "bb"), (902, "", None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    got = language.predict(docs, model)
    found = {r.doc_id: r for r in got.collect()}
    right = [found[d].language.lang_pred == k for d, _, k in rows if zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(right) > 20 and all(right)
    assert all(found[d].language.lang_pred == "und" and found[d].language.rejected for d in (900, 901, 902))
    assert found[None].language.lang_pred == "aa" and 0 < found[None].language.score <= 1
    none = language.fit(docs.limit(0))
    assert {r.language.lang_pred for r in language.predict(docs, none).collect()} == {"und"}


def test_counts_do_not_depend_on_steps(monkeypatch):
    text = "Größe und Maß " * 50
    whole = language.counts(text)
    monkeypatch.setattr(language, "STEP", 17)
    assert (language.counts(text) == whole).all()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    each = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(v - 9 if v > 9 else v for v in each) % 10 == 0


def base_spans(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            n = re.sub("[^0-9]", "", m[0])
            if {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(n) <= 19 and luhn(n), "phone": 9 <= len(n) <= 15,
            }[kind]:
                spans.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def test_pii_base_spans(spark):
    rng = random.Random(8)
    parts = ["a@b.co", "é", "x.y@z", "@", ".com", "4111 1111 1111 1111", "1.2.3.4", "255.256.1.1", "+1 (203) 555-0100", "+", "  ", "9", "-", "4111-1111", "0012.1.1.1.7", "😀", "_", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(600)] + [None, "", "a" * 5000, "1" * 5000, "1." * 3000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "a@b.co"), (0, texts[0])], "doc_id long, text string")
    rows = pii.personal_data(docs).select("doc_id", pii.written(F.col("base")).alias("b"), "added").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.b == base_spans((texts[r.doc_id] if r.doc_id is not None else "a@b.co") or ""), r
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_edits_keep_counts(spark):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        text = "".join(rng.choice(["word ", "été", "\n", " ", "Long-er,", "x"]) for _ in range(rng.randint(0, 300)))
        cuts = [rng.randint(-1, len(text) + 1) for _ in range(8)]
        edits = [(min(a, b), max(a, b), rng.choice(["", "new words", "y", None])) for a, b in zip(cuts[::2], cuts[1::2])]
        rows.append((i, text, edits))
    rows += [(100, None, [(0, 0, "all new")]), (101, "abc def", None), (102, "abc def", [(0, 7, "")]), (None, "a b", [None, (1, 1, "z")])]
    schema = "doc_id long, text string, edits array<struct<start:int,end:int,replacement:string>>"
    docs = spark.createDataFrame(rows, schema)
    out = token_counts.apply_edits(token_counts.with_trees(docs, encoding.vocabulary(), leaf=20), encoding.vocabulary())
    for r in out.collect():
        text = next(t for d, t, _ in rows if d == r.doc_id) or ""
        last, taken = 0, []
        for e in sorted((e for e in r.edits or [] if e), key=lambda e: (e.start, e.end, e.replacement or "")):
            if last <= e.start <= e.end <= len(text):
                taken.append(e)
                last = e.end
        for e in reversed(taken):
            text = text[: e.start] + (e.replacement or "") + text[e.end :]
        assert (r.text or "") == text and r.n_tokens == len(reference_ids(text)), r.doc_id


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        spark_side, duck_side = oracle.compare(df, oracle.connect(SF), ORACLES[name])
        assert spark_side == duck_side
    else:
        assert df.count() > 0


def test_pipeline(spark):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == before.columns and docs.count() > 0.8 * before.count()
    assert decontamination.leaks(docs, items).count() == 0
    assert simhash.near_duplicates(docs).filter("doc_id != component_id").count() == 0


def test_empty_tables(docs):
    none, path = docs.limit(0), encoding.vocabulary()
    assert line_dedup.line_bitmaps(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert quality.judged(none).count() == packing.pack_documents(none, path).count() == 0
    assert token_counts.with_trees(none, path).count() == 0


def test_pipeline_keeps_one_of_many_copies(spark):
    """A text of ten copies or more loses its lines in all copies but one, which reaches packing."""
    import corpus_pipeline

    texts = [f"first line of story {k} about {'abcde'[k]}\nits second line {k}\nand the end of it {k}" for k in range(3)]
    rows = [(100 * k + i, t) for k, t in enumerate(texts) for i in range(12)] + [(900, "a text that stands alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, SF)
    kept = [r.text for r in docs.collect()]
    assert all(kept.count(t) == 1 for t in [*texts, "a text that stands alone"])


def test_near_dedup_drops_near_copies(spark):
    """Of near copies that differ in more bits than simhash links, one is left, and nothing else goes."""
    import corpus_pipeline

    rng = random.Random(12)
    rows, sets = [], {}
    for group in range(12):
        text = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 200))]
        for k in range(6):
            w = list(text)
            for at in rng.sample(range(len(w)), k * len(w) // 60):
                w[at] = "other"
            rows.append((100 * group + k, " ".join(w)))
    rows += [(None, rows[0][1] + " tail"), (5000, None), (5001, "two words"), (5002, "two words more")]
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, min(len(w), 1)))}
    jaccard = lambda a, b: len(a & b) / max(len(a | b), 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()]
    assert not [(a, b) for a in kept for b in kept if a != b and jaccard(sets[a], sets[b]) >= near_copies.SHARE]
    assert all(any(jaccard(sets[a], sets[b]) >= near_copies.SHARE for b in sets if b != a) for a in sets if a not in kept)
    assert {100 * g for g in range(12)} | {5000, 5001, 5002} <= set(kept) and None not in kept


def test_decontamination_names_at_any_place_and_case(spark):
    item = "Anna has 12 apples. Anna gives 5 apples to Tom. How many apples does Anna have left?"
    renamed = item.replace("Anna", "Maria").replace("Tom", "Bob").replace("12", "30")
    mixed = renamed.replace("Maria gives", "Peter gives")
    texts = [
        renamed, "Before that. " + renamed + " And more.", renamed.replace(" ", "\n"), ITEM.replace(" ", "\n  "), ITEM.lower(), ITEM.upper(),
        item.lower(), item.upper(), mixed, "Nobody here. Nothing Else. Tom and Anna, Bob and Maria. They have 12 and 5.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()}
    assert got == {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 1), (7, 1)}


def test_near_copies_write_no_row_for_pairs_that_are_not_near(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(400)]
    changed = lambda d, step: " ".join(f"x{d}-{i}" if i % step == d % step else w for i, w in enumerate(base))
    # A group in which all share buckets and none are near, and one in which all are near to the first.
    texts = {d: changed(d, 40) for d in range(160)} | {1000 + d: " ".join([*base[:200], *(f"y{rng.random()}" for _ in range(d % 9))]) for d in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    counts, write = [], near_copies.materialize
    monkeypatch.setattr(near_copies, "materialize", lambda df, label: (counts.append((label, (out := write(df, label)).count())), out)[1])
    kept = {r.doc_id for r in near_copies.one_of_near(docs).collect()}
    sets = {d: set(zip(*[t.split()[i:] for i in range(near_copies.SHINGLE)])) for d, t in texts.items()}
    jaccard = lambda a, b: len(a & b) / len(a | b)
    near = [(a, b) for a in texts for b in texts if a < b and jaccard(sets[a], sets[b]) >= near_copies.SHARE]
    roots = {d: d for d in texts}
    for _ in range(5):
        for a, b in near:
            roots[a] = roots[b] = min(roots[a], roots[b])
    assert kept == set(roots.values()) and len(kept) == 161
    shared = dict(counts)["candidates"] * near_copies.BANDS
    assert all(n <= shared / 4 for label, n in counts if label in ("met", "found")), counts
