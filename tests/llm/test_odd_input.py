"""Stages and operators on clashing names, empty tables, repeated rows, and texts with very many matches."""

import random
import struct
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import common, decontamination, encoding, line_dedup, pii, token_counts
from millrace.llm.queries import QUERIES
from millrace.tables import table

SF = "/root/testdata/sf0.001"
NAMES = ["_text_hash", "_bitmap", "_language", "_node", "_carried", "_id", "_no_id", "_words", "_style", "_n", "fp", "at"]


@pytest.fixture(scope="module")
def clashing(spark):
    docs = table(spark, SF, "documents")
    more = docs.withColumns({name: F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")) for name in NAMES})
    return more.unionAll(more.filter("doc_id < 20")).persist()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:4])
def test_stages_keep_columns_of_any_name(spark, clashing, name, stage):
    kept = stage(spark, clashing, SF)
    assert kept.columns == clashing.columns
    wrong = F.lit(False)
    for c in NAMES:
        wrong = wrong | (F.col(c) != F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")))
    assert kept.count() > 100 and kept.filter(wrong).isEmpty()
    plain = stage(spark, clashing.drop(*NAMES), SF)
    assert sorted(map(str, kept.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_nothing(spark, name, stage):
    assert stage(spark, table(spark, SF, "documents").limit(0), SF).count() == 0


def test_sums_before(spark):
    rng = random.Random(1)
    rows = [([rng.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 3, 7, 8, 9, 64, 65, 1000)]
    df = spark.createDataFrame(rows, "x array<int>")
    for x, got in df.select("x", common.sums_before(F.col("x"), 8)).collect():
        assert got == [sum(x[:i]) for i in range(len(x))]


def test_very_many_matches_in_one_text(spark):
    mails = " ".join(f"user{i}@host{i}.org" for i in range(30_000))
    docs = spark.createDataFrame([(1, mails), (2, "a@b.co and 10.0.0.1")], "doc_id long, text string")
    began = time.time()
    found = {r.doc_id: (len(r.base), r.base[-1]) for r in pii.personal_data(docs).collect()}
    assert found[1][0] == 30_000 and mails[found[1][1].start : found[1][1].end] == "user29999@host29999.org"
    assert found[2][0] == 2 and time.time() - began < 60


def test_edits_of_every_word_encode_a_text_once(spark):
    text = " ".join(f"word{i} 12345" for i in range(20_000))
    vocabulary = encoding.vocabulary()
    docs = spark.createDataFrame([(1, text), (2, text[:50] + " 99999 " + "tail " * 2000)], "doc_id long, text string")
    built = token_counts.with_trees(docs.withColumn("edits", token_counts.replacements("[0-9]{5}", "n")), vocabulary)
    rows = {r.doc_id: r for r in token_counts.apply_edits(built, vocabulary).collect()}
    import re

    for r in rows.values():
        before = text if r.doc_id == 1 else text[:50] + " 99999 " + "tail " * 2000
        assert r.text == re.sub("[0-9]{5}", "n", before)
        assert r.n_encoded <= len(r.text)
    # One place edited: some leaves, not the text.
    assert rows[2].n_encoded < 2_000 < len(rows[2].text)


def test_short_items_are_found(spark):
    items = spark.createDataFrame([(1, "Why is grass green?"), (2, "Solve"), (3, None), (4, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "he asked: why is grass green? nobody knew"), (2, "why is grass blue"), (3, "please solve it"), (4, None), (5, "one two three four five six")],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id, r.n_windows, r.n_matched) for r in decontamination.leaks(docs, items).collect()}
    assert got == {(1, 1, 1, 1), (3, 2, 1, 1), (5, 4, 2, 2)}


def test_words_of_letters_and_signs_need_no_pass_through_the_library():
    words = encoding.WordEncoder(encoding.vocabulary(), 300)
    lean = "word Word WORD!! erorre,%%% 27.109.211.155 don't DON'T 'sa -'s ''s x'S. Éaué$$$ straße. <|x a<b|c> { } ~0".replace("<|x ", "").split()
    whole = "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|> <| Ωmega naïvé 東京 « µ İx".split()
    passed = []
    plain = words._encode
    words._encode = lambda text: passed.append(text) or plain(text)
    rng = random.Random(3)
    drawn = ["".join(rng.choice("aZé'sTreVEl<>|,.-09ß×µ") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    for word in [*lean, *whole, *drawn]:
        ids = words.tokenizer.encode(word, add_special_tokens=False).ids
        assert words.encode(word) == struct.pack(f"<{len(ids)}I", *ids), word
        assert len(words) <= 2 * words.kept_words + 20
    assert not set(lean) & set(passed) and set(whole) <= set(passed)


def test_windows_are_hashed_without_arrays_of_words(spark):
    texts = ["One two, three Four five 6 km seven. Eight", " ".join(f"w{i}" for i in range(30_000)), "too short", "", None]
    docs = common.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    words = decontamination.templates(docs)
    got = decontamination.windows(words, 5, 4)
    # A window as an array in a function over places would be written down before it is hashed.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "Generate explode" in plan
    of = {(r.doc_id, r._style): r._words for r in words.collect()}
    cut = [
        (d, style, at, tuple(held[at : at + 5]), len(held)) for (d, style), held in of.items() for at in range(0, len(held) - 4, 4)
    ]
    hashed = spark.createDataFrame(cut, "doc_id long, _style string, at int, w array<string>, _n int").selectExpr(
        "doc_id", "_style", "at", "xxhash64(w) AS h1", "xxhash64(1, w) AS h2", "_n"
    )
    rows = got.select("doc_id", "_style", "at", "_h1", "_h2", "_n").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, hashed.collect())) and len(rows) > 22_000


def test_names_and_numbers_of_very_many_parts(spark):
    item = "a farmer keeps twelve black goats behind the old stone mill and sells one every spring"
    names, numbers = "so " + "Big Title " * 20_000, "12.5:" * 40_000 + "7"
    texts = [f"{names}. {item}", f"{numbers} {item}", names, numbers, names.replace("Title", "O'Hara-Lee"), None]
    docs = common.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).persist()
    # A run of any length is one placeholder and one value, found without a step down the stack for each part.
    words = {(r.doc_id, r._style): r._words for r in decontamination.templates(docs).collect()}
    for style in ("inside", "anywhere"):
        assert words[2, style] == ["so", decontamination.NAME] and words[0, style] == words[2, style] + item.split()
        assert words[3, style] == [decontamination.NUMBER] and words[1, style] == words[3, style] + item.split()
    assert words[2, "none"] == names.lower().split() and words[4, "anywhere"] == ["so", decontamination.NAME]
    held = {(r.doc_id, r._style, r.at): r.value for r in decontamination.slots(docs.filter("doc_id < 4")).collect()}
    assert held[0, "inside", 1] == held[2, "anywhere", 1] == decontamination.NAME + names[3:].strip()
    assert held[1, "none", 0] == held[3, "inside", 0] == decontamination.NUMBER + numbers and len(held) == 10
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()} == {(0, 1), (1, 1)}


def test_stage_decontamination_of_very_long_runs(spark):
    item = max((r.text for r in table(spark, SF, "benchmark").filter("text IS NOT NULL").collect()), key=len)
    names, numbers = "so " + "Big Title " * 20_000, "12.5:" * 40_000 + "7"
    texts = [f"{names}. {item}", f"{numbers} . {item}", names, numbers]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.decontamination(spark, docs, SF)
    assert sorted(map(tuple, kept.collect())) == [(2, names), (3, numbers)]


def test_repeated_rows_and_missing_ids_leak_alike(spark):
    text = "how many apples does a farmer sell in one week of summer"
    items = spark.createDataFrame([(1, text), (1, text)], "item_id long, text string")
    rows = [(None, text), (None, text), (7, text.upper()), (7, text.upper()), (8, "nothing of the kind at all is here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()} == {(None, 1), (7, 1)}
    assert [r.doc_id for r in decontamination.without_leaks(docs, items).collect()] == [8]


def luhn_digits(rng, wanted):
    """Sixteen digits whose sum of digits is right, or is not."""
    while True:
        d = [4] + [rng.randrange(10) for _ in range(15)]
        total = sum(x if i % 2 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(d))
        if (total % 10 == 0) == wanted:
            return "".join(map(str, d))


def test_formats_beyond_the_base_rules_are_found(spark):
    """Dotted cards, addresses with other signs, national numbers and tokens behind words that name them;
    numbers that look alike and fail their check stay."""
    rng = random.Random(5)
    four = lambda d, sign: sign.join(d[i : i + 4] for i in range(0, 16, 4))
    part = lambda top=255: str(rng.randint(1, top))
    rows, planted, decoys = [], set(), set()
    for i in range(1500):
        kind = ["card", "ip", "phone", "secret", "decoy card", "decoy ip", "plain", "base"][i % 8]
        value, cue = {
            "card": (four(luhn_digits(rng, True), "."), "card "),
            "ip": ("-".join(part() for _ in range(4)), "host "),
            "phone": (f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", "call "),
            "secret": ("".join(rng.choice("0123456789abcdef") for _ in range(40)), 'token = "'),
            "decoy card": (four(luhn_digits(rng, False), "."), "no "),
            "decoy ip": ("-".join([part(), "9" + part(99).rjust(2, "0"), part(), part()]), "part "),
            "plain": ("anunusuallylongwordwithoutanynumbers", "the "),
            "base": (rng.choice([f"user{i}@mail.org", "10.1.2." + part(), "+1 203 555 01" + str(10 + i % 90)]), "see "),
        }[kind]
        text = f"some words stand here {cue}{value}" + ('" ' if kind == "secret" else " ") + "and others there"
        rows.append((i, text))
        span = (i, text.index(value), text.index(value) + len(value))
        if kind in ("card", "ip", "phone", "secret"):
            planted.add((span[0], kind, *span[1:]))
        elif kind != "base":
            decoys.add(span)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, *s) for r in pii.personal_data(docs).collect() for s in r.added}
    assert len(found & planted) >= 0.9 * len(planted)
    assert len(found & planted) >= 0.9 * len(found)
    assert len({s for s in found if (s[0], *s[2:]) in decoys}) <= 0.1 * len(found)


def test_personal_data_learns_from_all_proposals(spark, monkeypatch):
    rng = random.Random(4)
    parts = ["call +1 203 555 0100", "card 4111 1111 1111 1111", "host 1.2.3.4", "mail a@b.co", "7 1234 5678", "1.2.3.999", "x@y"]
    docs = spark.createDataFrame([(d, " ".join(rng.choices(parts, k=4))) for d in range(300)], "doc_id long, text string")
    used, real = [], pii.GBTClassifier

    class Counting(real):
        def fit(self, rows):
            used.append(rows.agg(F.sum("weight" if "weight" in rows.columns else F.lit(1))).first()[0])
            return super().fit(rows)

    monkeypatch.setattr(pii, "GBTClassifier", Counting)
    monkeypatch.setattr(pii, "SAMPLE", 50, raising=False)
    total = pii.proposed(docs).select(F.sum(F.size("wider"))).first()[0]
    pii.personal_data(docs).count()
    assert 0.5 * total < used[0] < 0.7 * total


def test_thresholds_of_kinds(spark):
    rng = random.Random(3)
    kinds = {"ip": 0.5, "email": 0.02, "card": 0.0, "secret": 1.0}
    rows = [(k, round(rng.random(), 1), 0.0) for k in kinds for _ in range(200)]
    rows = [(k, s, float(rng.random() < (0.97 if s > kinds[k] and kinds[k] not in (0.0, 1.0) else kinds[k]))) for k, s, _ in rows]
    ranked = spark.createDataFrame(rows, "kind string, score double, label double").select(F.struct("kind").alias("span"), "score", "label")
    expected = {}
    for kind in kinds:
        for least in sorted({s for k, s, _ in rows if k == kind}):
            labels = [v for k, s, v in rows if k == kind and s >= least]
            if sum(labels) / len(labels) >= pii.PRECISION:
                expected[kind] = least
                break
    assert len(expected) == 3 and dict(map(tuple, pii.thresholds(ranked.repartition(7)))) == expected


def test_a_text_of_very_many_kept_runs_is_split_once(spark):
    n = 30_000
    text = "\n".join(f"line {i}" for i in range(n))
    keep = F.transform(F.sequence(F.lit(0), F.lit(n - 2), F.lit(2)), lambda i: F.struct(i.alias("first"), F.lit(1).alias("lines")))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bitmaps = docs.select("doc_id", F.xxhash64("text").alias("_text_hash"), F.lit(n).alias("n_lines"), F.lit(n // 2).alias("n_dropped"), keep.alias("keep"))
    began = time.monotonic()
    kept = line_dedup.apply_bitmaps(docs, bitmaps).first().text
    assert kept == "\n".join(f"line {i}" for i in range(0, n, 2)) and time.monotonic() - began < 8


def test_token_counts_have_one_python_process_a_task(spark):
    found = QUERIES["op10_token_counts"](spark, SF)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
