"""Benchmark decontamination by templates.

Numbers, units behind numbers, and names become typed placeholders; the rest is lower-cased words.
White space is one blank before that, so line breaks do not matter. Each text has a template in three
styles: names are capitalized words inside a sentence; capitalized words anywhere, so that a name at the
start of a sentence can change too; or nothing, in lower case, so that copies in other case are found.
What leaks in one style is a leak. Windows of ``WINDOW`` template words of all documents meet those of the
benchmark in a hash join: first at every few words, which finds every document that can hold the
share asked for, then at every word of the documents found. What the placeholders stood for is compared on the hits alone: along one
alignment of an item with a document every value of the item must stand for one value of the
document, so a question with other numbers or names is found, and windows that mix values are not
counted. A document leaks an item if it holds ``SHARE`` of the item's windows.

The benchmark side is broadcast only where its size is under the session's threshold; beyond it
the join is a shuffle of hashes. NULL and empty texts have no windows, nor have items of fewer than
``WINDOW`` words, which are never reported. Rows of the same id and text are one document or item. A
NULL id is an id like any other. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    KEY, PLAIN_KEY, carried, keyed, matched, named_plainly, of_documents, plainly_keyed, returned, text_of,
)
from millrace.scratch import materialize

WINDOW = 5
SHARE = 0.8
# Placeholders: characters for private use, each a word of its own.
NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"
# A repeated group gives nothing back (``*+``; nothing follows it): Java goes down the stack for each part of a run
# otherwise, and a thousand capitalized words in a row end the executor.
NUMBERS = r"[0-9]+(?:[.,:/][0-9]+)*+"
# Unit words and signs (fixed values).
UNIT_WORDS = (
    "km m cm mm mi miles? met(?:er|re)s? feet ft inch(?:es)? kg g mg lbs? oz pounds? tons? l ml lit(?:er|re)s? "
    "hours? hrs? h min minutes? sec seconds? s days? weeks? months? years? dollars? euros? cents? percent degrees? % € \\$"
).split()
UNITS = rf"{NUMBER} *({'|'.join(UNIT_WORDS)})(?![\p{{L}}\p{{N}}])"
SPACES = r"[\s\p{Z}]+"
# Both look for the capital first, which most places lack.
NAMES = r" (?=\p{Lu})(?<=[\p{Ll}0-9,;\ue000\ue001] )(\p{Lu}[\p{Ll}'’-]+(?: \p{Lu}[\p{Ll}'’-]+)*+)"
ANYWHERE = r"(?=\p{Lu})(?<![\p{L}\p{N}])(\p{Lu}(?=['’]?\p{L}?\p{Ll})[\p{L}'’-]+(?: \p{Lu}(?=['’]?\p{L}?\p{Ll})[\p{L}'’-]+)*+)"
# What is a name, by style.
STYLES = {"inside": NAMES, "anywhere": ANYWHERE, "none": None}
BETWEEN = r"[^\p{L}\p{N}\ue000-\ue002]+"


def _steps(style: str) -> tuple[Column, ...]:
    """The text, then with numbers, units and names replaced, one after the other. Lower case comes after the
    numbers, which it does not change, so that all styles share these two steps, and last where it matters to names."""
    plain = F.regexp_replace(text_of(), SPACES, " ")
    numbered = F.regexp_replace(plain, NUMBERS, f" {NUMBER} ")
    names = STYLES[style]
    if names is None:
        numbered = F.lower(numbered)
    measured = F.when(F.contains(numbered, F.lit(NUMBER)), F.regexp_replace(numbered, UNITS, f"{NUMBER} {UNIT} ")).otherwise(numbered)
    return plain, numbered, measured, F.lower(F.regexp_replace(measured, names, f" {NAME} ")) if names else measured


def template(named: Column) -> Column:
    """The words of a text with placeholders, in lower case."""
    return F.array_remove(F.split(named, BETWEEN, -1), "")


def templates(rows: DataFrame) -> DataFrame:
    """The columns of KEY, ``_style`` and ``_words``, a row per style. All templates are made in one
    projection, which makes what they share once."""
    made = rows.select(*KEY, *[template(_steps(style)[-1]).alias(f"_{style}") for style in STYLES])
    styled = F.array(*[F.struct(F.lit(style).alias("_style"), F.col(f"_{style}").alias("_words")) for style in STYLES])
    return made.select(*KEY, F.inline(styled))


def windows(words: DataFrame, window: int, stride: int = 1) -> DataFrame:
    """Windows of ``templates``, from every ``stride``-th word on: the columns of KEY, ``_style``, ``at``, two
    hashes of the window's words, and ``_n``, the words of the template.

    Rows are made of the places alone and words are cut and hashed on the way, in generated code: windows
    as arrays would each be written down first."""
    # No filter on the size: it would be pushed below and make the template a second time.
    last = F.size("_words") - window
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(stride)))
    each = words.select(*KEY, "_style", "_words", F.explode(starts).alias("at"))
    cut = F.slice("_words", F.col("at") + 1, window)
    hashes = [F.xxhash64(cut).alias("_h1"), F.xxhash64(F.lit(1), cut).alias("_h2")]
    return each.select(*KEY, "_style", "at", *hashes, F.size("_words").alias("_n"))


def stride_for(share: float) -> int:
    """Windows of a document that may be passed over between two that are looked up.

    An item of ``n`` windows whose matched runs all hold fewer than ``g`` windows has at most a share
    of ``(g - 1) / g`` if it has ``g`` windows or more, so a larger share means a run of ``g``, one of which
    starts at a multiple of ``g``.
    """
    stride = 1
    while stride / (stride + 1) < share and stride < 64:
        stride += 1
    return stride


def _valued(kind: str, places: Column) -> Column:
    pairs = F.arrays_zip(places.alias("at"), F.col(f"`{kind}`").alias("value"))
    return F.transform(
        pairs, lambda x: F.struct(x["at"].alias("at"), F.concat(F.lit(kind), x["value"]).alias("value"))
    )


def slots(rows: DataFrame) -> DataFrame:
    """What each placeholder of the templates stands for: the columns of KEY, ``_style``, ``at`` and ``value``."""
    return reduce(DataFrame.unionAll, [_slots(rows, style) for style in STYLES])


def _slots(rows: DataFrame, style: str) -> DataFrame:
    plain, numbered, measured, named = _steps(style)
    kinds = {
        NUMBER: F.regexp_extract_all(plain, F.lit(NUMBERS), F.lit(0)),
        UNIT: F.regexp_extract_all(numbered, F.lit(UNITS), F.lit(1)),
    }
    if STYLES[style]:
        kinds[NAME] = F.regexp_extract_all(measured, F.lit(STYLES[style]), F.lit(1))
    words = rows.select(*KEY, template(named).alias("_words"), *[v.alias(k) for k, v in kinds.items()])
    places = lambda kind: F.filter(
        F.transform("_words", lambda word, i: F.when(word == kind, i)), lambda i: i.isNotNull()
    )
    found = [_valued(kind, places(kind)) for kind in kinds]
    filled = words.select(*KEY, F.inline(F.concat(*found))).filter(F.col("at").isNotNull())
    return filled.select(*KEY, F.lit(style).alias("_style"), "at", "value")


def items_of(benchmark: DataFrame) -> DataFrame:
    return keyed(benchmark.select(F.col("item_id").alias("doc_id"), "text")).distinct()


def leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE
) -> DataFrame:
    """``doc_id``, ``_text_hash``, ``item_id``, ``n_windows`` of the item and ``n_matched`` of them in
    the document, for every document and item it leaks, by the style that matches most."""
    items = items_of(benchmark)
    words = templates(items)
    kept = F.size(F.filter("_words", lambda w: ~w.isin(NUMBER, UNIT, NAME)))
    # Rows of names alone would match any others.
    words = materialize(words.filter((F.col("_style") != "anywhere") | (2 * kept > F.size("_words"))), "templates")
    found = _leaks(docs, items, words.filter(F.size("_words") >= window), window, share)
    short = words.filter((F.size("_words") < window) & (F.size("_words") > 0))
    for row in short.select(F.size("_words").alias("n")).distinct().orderBy("n").collect():
        # An item that is shorter than a window is one window of its own length.
        found = found.unionAll(_leaks(docs, items, words.filter(F.size("_words") == row["n"]), row["n"], share))
    part = F.col("n_matched") / F.col("n_windows")
    best = found.groupBy(*KEY, "item_id", "_item_hash").agg(
        F.max(F.struct(part.alias("_part"), "n_windows", "n_matched")).alias("_best")
    )
    return best.select(*KEY, "item_id", "_best.n_windows", "_best.n_matched")


def _touched(documents: DataFrame, item_windows: DataFrame, window: int, share: float) -> DataFrame:
    """The documents, once each and with their texts, that share a window with an item in any style, at every
    few words. Items of too few windows for the few words to be more than one are looked for at every word.

    The texts go through one shuffle, whatever the size of the tables, and what is left is written."""
    stride = stride_for(share)
    long = F.col("_n") >= window + stride - 1
    steps = [(stride, item_windows.filter(long))]
    if not item_windows.filter(~long).isEmpty():
        steps.append((1, item_windows.filter(~long)))
    words = templates(documents)
    hits = []
    for step, some in steps:
        # Without the second hash: a document too many is compared in full later.
        looked_for = materialize(some.select("_h1").distinct(), "looked-for")
        hits.append(windows(words, window, step).select(*KEY, "_h1").join(looked_for, "_h1", "left_semi").select(*KEY))
    touched = materialize(reduce(DataFrame.unionAll, hits).distinct(), "touched")
    return materialize(of_documents(documents.hint("merge"), touched).distinct(), "touched-texts")


def _leaks(docs: DataFrame, items: DataFrame, words: DataFrame, window: int, share: float) -> DataFrame:
    """The same for items whose templates are ``words``, with ``_item_hash`` and by style."""
    of_item = {"doc_id": "item_id", "_text_hash": "_item_hash", "at": "_item_at"}
    item_windows = materialize(windows(words, window).withColumnsRenamed(of_item), "item-windows")
    documents = _touched(keyed(docs), item_windows, window, share)
    met = windows(templates(documents), window).drop("_n")
    met = met.join(item_windows.drop("_n"), ["_style", "_h1", "_h2"])
    hits = met.select(
        *KEY, "_style", "at", "item_id", "_item_hash", "_item_at", (F.col("at") - F.col("_item_at")).alias("_shift")
    ).distinct()
    hits = materialize(hits, "hits")
    # Slots inside hits, on both sides. Rows without a partner have no placeholder there.
    item_slots = slots(items).withColumnsRenamed(of_item | {"value": "_item_value"})
    steps = F.explode(F.sequence(F.lit(0), F.lit(window - 1)))
    match = [*KEY, "_style", "item_id", "_item_hash", "_shift"]
    inside = hits.select(*match, F.col("_item_at").alias("_window"), steps.alias("_k")).withColumn(
        "_item_at", F.col("_window") + F.col("_k")
    )
    filled = matched(inside, item_slots, ["item_id", "_item_hash", "_style", "_item_at"]).select(
        *match, "_window", "_item_value", (F.col("_item_at") + F.col("_shift")).alias("at")
    )
    compared = matched(filled, slots(documents), [*KEY, "_style", "at"])
    compared = materialize(compared, "compared")
    values = compared.groupBy(*match, "_item_value").agg((F.min("value") != F.max("value")).alias("_mixed"))
    mixed = matched(compared, values.filter("_mixed"), [*match, "_item_value"], "left_semi")
    bad = mixed.select(*match, F.col("_window").alias("_item_at")).distinct()
    sound = matched(hits, bad, [*match, "_item_at"], "left_anti")
    found = sound.groupBy(*KEY, "_style", "item_id", "_item_hash").agg(F.countDistinct("_item_at").alias("n_matched"))
    sizes = item_windows.groupBy("_style", "item_id", "_item_hash").agg(F.count("*").alias("n_windows"))
    return (
        matched(found, sizes, ["_style", "item_id", "_item_hash"])
        .filter(F.col("n_matched") >= share * F.col("n_windows"))
        .select(*KEY, "item_id", "_item_hash", "n_windows", "n_matched")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    rows = plainly_keyed(carried(docs)).hint("merge")
    leaked = named_plainly(leaks(docs, benchmark, window, share).select(*KEY).distinct())
    return returned(rows.join(leaked, PLAIN_KEY, "left_anti"), docs.columns)
